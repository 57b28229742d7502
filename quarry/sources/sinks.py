"""Writers: files (CSV, JSON, Parquet or a configurable format) and tables.

Every writer takes an explicit ``mode``; the default is ``overwrite`` so
that a rerun of a job replaces its output instead of failing halfway
(``errorifexists`` is still available). ``single_file`` runs the last
stage as one task and is off by default: it is only sensible for small
outputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Text formats keep full microsecond precision (Spark's default text layout
# for timestamps stops at milliseconds and would silently drop the rest).
TEXT_TIMESTAMP_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _prepare(df: DataFrame, single_file: bool) -> DataFrame:
    return df.coalesce(1) if single_file else df


def write_path(df: DataFrame, path: str, fmt: str = "parquet", *, mode: str = "overwrite",
               single_file: bool = False, partition_by: list[str] | None = None,
               **options) -> str:
    """Generic path sink (``fmt`` may be parquet, orc, csv, json or delta
    when its connector is on the classpath)."""
    writer = _prepare(df, single_file).write.format(fmt).mode(mode)
    for key, value in options.items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_parquet(df: DataFrame, path: str, *, compression: str = "snappy",
                  mode: str = "overwrite", single_file: bool = False) -> str:
    return write_path(df, path, "parquet", mode=mode, single_file=single_file,
                      compression=compression)


def write_csv(df: DataFrame, path: str, *, header: bool = True, sep: str = ",",
              mode: str = "overwrite", single_file: bool = False) -> str:
    # Spark's CSV writer trims leading/trailing white space by default,
    # which turns " " into null; values are written as they are.
    return write_path(df, path, "csv", mode=mode, single_file=single_file,
                      header=header, sep=sep, ignoreLeadingWhiteSpace=False,
                      ignoreTrailingWhiteSpace=False, **TEXT_TIMESTAMP_OPTIONS)


def _json_array_per_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Wrap the JSON records of one partition into one JSON array.

    Each output row is one line of the file: ``[`` + first record, then
    ``,`` + record, then ``]``. The partition is streamed batch by batch,
    nothing is held beyond one Arrow batch.
    """
    first = True
    for pdf in batches:
        if pdf.empty:
            continue
        lines = pdf["j"]
        prefix = pd.Series([","] * len(lines), index=lines.index)
        if first:
            prefix.iloc[0] = "["
            first = False
        yield pd.DataFrame({"value": prefix + lines})
    yield pd.DataFrame({"value": ["[]" if first else "]"]})


def write_json(df: DataFrame, path: str, *, layout: str = "lines", mode: str = "overwrite",
               single_file: bool = False, max_rows_per_file: int = 1_000_000) -> str:
    """JSON sink.

    ``layout="lines"`` is Spark's JSON-lines writer. ``layout="array"``
    writes one JSON array per output file (one file per partition, records
    one per line), which ``read_json(layout="array")`` reads back with every
    record; readers then get one task per file, so the rows are counted and
    dealt evenly over enough files that none gets more than about
    ``max_rows_per_file`` (unless ``single_file`` asks for one).
    """
    if layout == "lines":
        return write_path(df, path, "json", mode=mode, single_file=single_file,
                          **TEXT_TIMESTAMP_OPTIONS)
    if layout != "array":
        raise ValueError("layout must be 'lines' or 'array'")
    records = _prepare(df, single_file).select(
        F.to_json(F.struct(*df.columns), TEXT_TIMESTAMP_OPTIONS).alias("j"))
    if not single_file:
        files = -(-df.count() // max_rows_per_file)
        records = records.repartition(files) if files > 1 else records
    text = records.mapInPandas(_json_array_per_partition, "value string")
    text.write.mode(mode).option("maxRecordsPerFile", 0).text(path)
    return path


def save_table(df: DataFrame, table: str, *, mode: str = "overwrite", fmt: str = "parquet",
               bucket_by: tuple[int, list[str]] | None = None) -> str:
    """Managed-table sink. In overwrite mode the table's schema is replaced
    by the frame's schema. ``bucket_by=(n, cols)`` pre-partitions the table
    so later joins and aggregations on ``cols`` skip their shuffle."""
    writer = df.write.format(fmt).mode(mode)
    if bucket_by is not None:
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    writer.saveAsTable(table)
    return table


def ctas(spark: SparkSession, table: str, select_sql: str, *, if_not_exists: bool = True,
         fmt: str = "parquet") -> DataFrame:
    """``CREATE TABLE [IF NOT EXISTS] t USING fmt AS SELECT ...``; returns the table."""
    guard = "IF NOT EXISTS " if if_not_exists else ""
    spark.sql(f"CREATE TABLE {guard}{table} USING {fmt} AS {select_sql}")
    return spark.read.table(table)
