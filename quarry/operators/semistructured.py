"""JSON text inside columns: parse once, then field access, arrays, explode.

A column may arrive as JSON text (string) or already parsed (struct /
array, e.g. when the JSON reader inferred it). ``parse_json_column``
branches on the column's type, so the same pipeline runs on both.
Parsing is a Catalyst expression (``from_json``), vectorised per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from quarry.functions.scalar import to_timestamp_text, year_in_range


def parse_json_column(df: DataFrame, column: str, schema: DataType | str,
                      alias: str | None = None) -> DataFrame:
    """Replace (or add as ``alias``) a JSON text column by its parsed value.

    Malformed text gives null. If the column is already a struct or array
    it is kept as is instead of failing in ``from_json``.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, StringType):
        parsed = F.from_json(F.col(column), schema)
    elif isinstance(dtype, (StructType, ArrayType)):
        parsed = F.col(column)
    else:
        raise TypeError(f"{column} is {dtype.simpleString()}, expected JSON text or parsed JSON")
    return df.withColumn(alias or column, parsed)


def lift_field(df: DataFrame, struct_col: str, field: str, alias: str | None = None) -> DataFrame:
    """Copy a nested struct field to a top-level column."""
    return df.withColumn(alias or field, F.col(f"{struct_col}.{field}"))


def first_element(c: str | Column) -> Column:
    """Element 0 of an array; null for an empty or null array (no ANSI error)."""
    return F.get(F.col(c) if isinstance(c, str) else c, 0)


def explode_array(df: DataFrame, array_col: str, alias: str, keep: list[str],
                  outer: bool = False) -> DataFrame:
    """One row per element. ``outer=False`` drops parents whose array is
    null or empty; ``outer=True`` keeps them with a null element."""
    gen = F.explode_outer if outer else F.explode
    return df.select(*keep, gen(F.col(array_col)).alias(alias))


def array_has(c: str | Column, value) -> Column:
    return F.array_contains(F.col(c) if isinstance(c, str) else c, value)


def json_path(c: str | Column, path: str) -> Column:
    """JSONPath extraction from JSON text without a schema (string result)."""
    return F.get_json_object(F.col(c) if isinstance(c, str) else c, path)


def published_in_year(df: DataFrame, text_col: str, year: int, alias: str) -> DataFrame:
    """Parse a timestamp text field and keep rows published in ``year``.

    Bad timestamp text becomes null (and is filtered out) instead of failing
    the job under ANSI mode.
    """
    out = df.withColumn(alias, to_timestamp_text(text_col))
    return out.filter(year_in_range(alias, year, year))
