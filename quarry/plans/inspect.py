"""Plan inspection: the text of ``explain`` and checks on it (used in tests
and when reviewing a query's physical plan)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def pushed_filters(df: DataFrame) -> list[str]:
    """``PushedFilters`` lists of every file scan in the plan."""
    return re.findall(r"PushedFilters: \[(.*?)\]", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*?>)", plan_text(df))


def has_node(df: DataFrame, name: str) -> bool:
    return name in plan_text(df, "simple")


def count_nodes(df: DataFrame, name: str) -> int:
    return plan_text(df, "simple").count(name)
