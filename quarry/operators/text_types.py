"""Types of raw text columns, found by one mergeable aggregate.

Every value belongs to one class, the narrowest kind of value its text can be
read as. The classes form a lattice: a column's type is the least one above all
classes that occur in it. What is kept per column is a count for each class,
and counts of two parts of a table add up, so types can be taken per file,
stored, and merged later without reading the data again. Spark's own
inference keeps only the type, and takes one more job per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

#: Classes from narrow to wide within each branch.
CLASSES = ("null", "boolean", "int", "long", "decimal", "double", "date", "timestamp", "text")
_TYPES = {"boolean": "boolean", "int": "int", "long": "bigint", "double": "double", "date": "date", "timestamp": "timestamp_ntz", "text": "string"}

# Forms of text. A plain number has no exponent; its range decides between int, long and decimal.
_WHOLE, _PLAIN, _EXPONENT = r"^[+-]?[0-9]+$", r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$", r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)[eE][+-]?[0-9]+$"
_DATE, _TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?$"
#: Digits a decimal may have.
DIGITS = 38


def _digits(c: Column) -> Column:
    return F.length(F.regexp_replace(c, "[^0-9]", ""))


def value_class(column: str) -> Column:
    """The class of one value's text. White space and empty texts are text."""
    c = F.col(column)
    return (F.when(c.isNull(), "null")
            .when(F.lower(c).isin("true", "false"), "boolean")
            .when(c.rlike(_WHOLE) & c.try_cast("int").isNotNull(), "int")
            .when(c.rlike(_WHOLE) & c.try_cast("bigint").isNotNull(), "long")
            .when(c.rlike(_PLAIN) & (_digits(c) <= DIGITS), "decimal")
            .when(c.rlike(_PLAIN) | c.rlike(_EXPONENT), "double")
            .when(c.rlike(_DATE) & c.try_cast("date").isNotNull(), "date")
            .when(c.rlike(_TIMESTAMP) & c.try_cast("timestamp_ntz").isNotNull(), "timestamp")
            .otherwise("text"))


def class_counts(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per column (and value of ``by``): column_name, ordinal, rows per
    class, and for plain numbers the digits before and after the point. One
    scan, one partial aggregate per task; the columns must be strings."""
    names = list(columns) if columns is not None else [f.name for f in df.schema.fields if f.name not in by]
    aggs = []
    classed = df.select(*by, *[F.col(f"`{n}`").alias(f"x{i}") for i, n in enumerate(names)])
    classed = classed.select("*", *[value_class(f"x{i}").alias(f"c{i}") for i in range(len(names))])
    for i in range(len(names)):
        plain = F.col(f"c{i}").isin("int", "long", "decimal")
        whole, part = (F.length(F.regexp_extract(f"x{i}", r"^[+-]?([0-9]*)[.]?([0-9]*)$", g)) for g in (1, 2))
        aggs += [F.count_if(F.col(f"c{i}") == k).alias(f"{k}_{i}") for k in CLASSES]
        aggs += [F.max(F.when(plain, whole)).alias(f"whole_{i}"), F.max(F.when(plain, part)).alias(f"part_{i}")]
    fields = [*[f"{k}_rows" for k in CLASSES], "whole_digits", "part_digits"]
    one = classed.groupBy(*by).agg(*aggs)
    stats = F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(i + 1).alias("ordinal"), *[F.col(f"{a}_{i}").alias(f) for a, f in zip(
        [*CLASSES, "whole", "part"], fields)]) for i, n in enumerate(names)]))
    return one.select(*by, stats.alias("s")).select(*by, "s.*")


def merge_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The counts of parts (stored tables of ``class_counts``, united) as those of the whole, or per value of ``by``."""
    return counts.groupBy(*by, "column_name", "ordinal").agg(
        *[F.sum(f"{k}_rows").alias(f"{k}_rows") for k in CLASSES], *[F.max(c).alias(c) for c in ("whole_digits", "part_digits")])


def _some(*classes: str) -> Column:
    out = F.lit(False)
    for k in classes:
        out = out | (F.col(f"{k}_rows") > 0)
    return out


def least_type() -> Column:
    """The least type above all classes that occur: numbers widen up to double, dates to timestamps, all else to string."""
    number, time = _some("int", "long", "decimal", "double"), _some("date", "timestamp")
    kinds = _some("boolean").cast("int") + number.cast("int") + time.cast("int")
    wide = F.coalesce(F.col("whole_digits"), F.lit(0)) + F.coalesce(F.col("part_digits"), F.lit(0)) > DIGITS
    decimal = F.format_string("decimal(%d,%d)", F.greatest(F.col("whole_digits") + F.col("part_digits"), F.lit(1)), F.col("part_digits"))
    return (F.when(_some("text") | (kinds > 1) | (kinds == 0), "string")
            .when(_some("boolean"), "boolean")
            .when(_some("timestamp"), "timestamp_ntz").when(_some("date"), "date")
            .when(_some("double") | (_some("decimal") & wide), "double")
            .when(_some("decimal"), decimal)
            .when(_some("long"), "bigint").otherwise("int"))


def inferred_types(counts: DataFrame) -> DataFrame:
    """The counts with one more column ``data_type``. A column of nulls only is a string."""
    return counts.withColumn("data_type", least_type())


def inferred_schema(df: DataFrame, columns: Sequence[str] | None = None) -> StructType:
    """The types as a struct for a reader or for ``typed`` (one row per column comes to the driver)."""
    rows = inferred_types(class_counts(df, columns)).select("column_name", "ordinal", "data_type", "null_rows").orderBy("ordinal").collect()
    return StructType([StructField(r["column_name"], _parse_datatype_string(r["data_type"]), True) for r in rows])


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """The text columns cast to the types found (nothing is lost: the types hold every value)."""
    kinds = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])
