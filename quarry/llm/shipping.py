"""Python objects for the executors, sent by value: workers need not have this package."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from quarry.session import scratch_path


class Shipped:
    """One object in one broadcast; ``value`` is a copy of it on the worker (ask once per task)."""

    def __init__(self, spark: SparkSession, item):
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(item))

    @property
    def value(self):
        import pickle
        return pickle.loads(self.packed.value)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a compressed table under the shared checkpoint folder, read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
