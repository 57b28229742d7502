"""Tables in version folders, and counts taken while writing.

Spark refuses to overwrite a table that the written plan reads from. A
versioned table is an external table whose location is one of several
folders: a new version is written whole beside the old one, then the catalog
entry is pointed to it. A failure before that leaves the table as it was, and
plans that already read the old folder go on with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def location(spark: SparkSession, name: str) -> str:
    """The folder a table reads from."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").select("data_type").collect()
    return rows[0][0]


def create_versioned(spark: SparkSession, name: str, df: DataFrame, root: str) -> str:
    """Write df as the first version under ``root`` and (re)create the table over it; returns its folder."""
    path = f"{root.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_quoted(path)}")
    return path


def replace_version(spark: SparkSession, name: str, transform: Callable[[DataFrame], DataFrame], root: str) -> str:
    """Replace a versioned table by a frame made from itself; returns the new folder.

    With an unchanged schema the swap is one catalog call (``SET LOCATION``).
    With another schema the entry is dropped and created anew: the folders
    stay, but for a moment the name is unknown. The old folder stays for its
    readers until ``drop_versions``.
    """
    old = spark.read.table(name)
    new = transform(old)
    path = f"{root.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
    new.write.parquet(path)
    shape = lambda df: [(f.name, f.dataType) for f in df.schema.fields]
    if shape(new) == shape(old):
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(path)}")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_quoted(path)}")
    return path


def drop_versions(spark: SparkSession, name: str, root: str) -> list[str]:
    """Delete the version folders under ``root`` that the table does not read; returns their names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    folder = hadoop(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    kept, gone = hadoop(location(spark, name)).getName(), []
    for status in fs.listStatus(folder):
        found = status.getPath().getName()
        if found.startswith("v-") and found != kept:
            fs.delete(status.getPath(), True)
            gone.append(found)
    return sorted(gone)


def write_counted(df: DataFrame, sink: Callable[[DataFrame], object], keep: Column | None = None, **metrics: Column) -> dict[str, int]:
    """Write df (its rows with ``keep``) through ``sink`` and return counts taken by
    that one job: ``source_rows``, ``written_rows`` and each further metric (an
    aggregate over the rows before ``keep``). Spark adds the counts of a task
    when it has succeeded, so tasks that are run again count once."""
    before, after = Observation(), Observation()
    seen = df.observe(before, F.count(F.lit(1)).alias("source_rows"), *[m.alias(n) for n, m in metrics.items()])
    kept = seen.where(keep) if keep is not None else seen
    sink(kept.observe(after, F.count(F.lit(1)).alias("written_rows")))
    return {**before.get, **after.get}
