"""Typed readers for Parquet, CSV and JSON, plus local lookups.

Policy for dirty input (one rule for every format): declared types are
applied with ``try_cast`` on string columns, so a bad value becomes null
and is counted, never silently mixed with real nulls and never a job
failure. Schema inference is available but costs an extra pass over the
input, so the declared forms are the ones to use on large data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the stand-in tables ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; the schema comes from the file footers."""
    return spark.read.format("parquet").load(path)


def read_path_sql(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """Query files directly from SQL, ``SELECT * FROM fmt.`path```."""
    if fmt not in {"parquet", "csv", "json", "orc", "text"}:
        raise ValueError(f"unsupported direct-file format {fmt!r}")
    escaped = path.replace("`", "``")
    return spark.sql(f"SELECT * FROM {fmt}.`{escaped}`")


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    header: bool = True,
    sep: str = ",",
    schema: StructType | str | None = None,
    infer_schema: bool = False,
    sampling_ratio: float | None = None,
    enforce_header: bool = True,
    mode: str = "PERMISSIVE",
    normalise: bool = False,
    multi_line: bool = False,
    keep_empty_strings: bool = True,
) -> DataFrame:
    """CSV scan in one of three typing modes.

    * ``schema`` given: declared types (a ``StructType`` or a DDL string).
      With ``enforce_header=True`` the header names must match the schema
      (Spark's ``enforceSchema=false``), so fields are never matched by
      position by accident.
    * ``infer_schema=True``: one extra pass over the input (or a sample of
      it with ``sampling_ratio``) to pick the types.
    * neither: every column is a string.

    ``multi_line=True`` allows quoted values that contain line breaks
    (the writer quotes them); each file is then parsed by one task.

    ``keep_empty_strings=True``: a quoted empty field (``""``) is an empty
    string and only a missing field is null, which is how the writer
    encodes them; Spark's default reads both as null.
    """
    reader = (spark.read.option("header", header).option("sep", sep).option("mode", mode)
              .option("multiLine", multi_line))
    if keep_empty_strings:
        reader = reader.option("nullValue", "\u0000")
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", not enforce_header)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
        if sampling_ratio is not None:
            reader = reader.option("samplingRatio", sampling_ratio)
    df = reader.csv(path)
    return normalise_columns(df) if normalise else df


def read_json(
    spark: SparkSession,
    path: str,
    *,
    schema: StructType | str | None = None,
    layout: str = "lines",
) -> DataFrame:
    """JSON scan.

    ``layout="lines"``: one record per line, splittable, the layout to use
    at scale. ``layout="array"``: every file holds one JSON value spread
    over several lines (an array of records or a single record); Spark
    reads such a file whole in one task, so parallelism comes from the
    number of files. A JSON-lines file read as ``array`` yields only its
    first record, which is why the layout is an explicit argument.
    """
    if layout not in {"lines", "array"}:
        raise ValueError("layout must be 'lines' or 'array'")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if layout == "array":
        reader = reader.option("multiLine", True)
    return reader.json(path)


def normalise_columns(df: DataFrame, old: str = " ", new: str = "_") -> DataFrame:
    """Rename every column, replacing ``old`` with ``new`` (metadata only)."""
    return df.toDF(*[c.replace(old, new) for c in df.columns])


def from_local(spark: SparkSession, rows, schema: StructType | str) -> DataFrame:
    """A small local lookup (pandas frame or list of rows) as a DataFrame.

    Meant for bounded reference data such as code lists; it travels with
    the plan, so it must stay small. Use a table for anything that grows.
    """
    return spark.createDataFrame(rows, schema=schema)


def typed_with_rejects(
    df: DataFrame, types: Mapping[str, str], keep: Iterable[str] | None = None
) -> tuple[DataFrame, Column]:
    """Cast string columns with ``try_cast`` and flag values that failed.

    Returns the typed frame (with a boolean ``_rejected`` column that is
    true when a non-null input did not convert) and an aggregate column
    counting rejected rows, to be used in ``agg``.
    """
    failed = F.lit(False)
    typed_cols = {}
    for name, dtype in types.items():
        raw = F.col(name)
        typed_cols[name] = raw.try_cast(dtype).alias(name)
        failed = failed | (raw.isNotNull() & raw.try_cast(dtype).isNull())
    names = list(keep) if keep is not None else df.columns
    names += [c for c in types if c not in set(names)]
    out = df.select(*[typed_cols.get(c, F.col(c)) for c in names],
                    failed.alias("_rejected"))
    reject_count = F.sum(F.col("_rejected").cast("long")).alias("rejected_rows")
    return out, reject_count
