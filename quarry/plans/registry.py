"""Registry of named queries: each has a Spark builder and, when SQL can
express it, the equivalent DuckDB SQL (the correctness oracle)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class QuerySpec:
    name: str
    build: Builder
    sql: str | None
    ops: tuple[str, ...]        # operator ids from the survey inventory
    writes: bool = False        # builds by writing and reading back data


REGISTRY: dict[str, QuerySpec] = {}


def query(name: str, *, sql: str | None, ops: tuple[str, ...], writes: bool = False):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = QuerySpec(name, fn, sql, ops, writes)
        return fn
    return deco


def fixed_sql(expr: str, digits: int) -> str:
    """SQL twin of ``quarry.functions.fixed_round``."""
    x, scale = f"CAST({expr} AS DOUBLE)", f"{10 ** digits}.0"
    return f"(CASE WHEN abs({x} * {scale}) >= 9007199254740992.0 THEN {x} ELSE floor({x} * {scale} + 0.5) / {scale} END)"
