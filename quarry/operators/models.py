"""Fitted pipelines kept as numbered versions on shared storage.

A version is a saved ``PipelineModel`` in a folder of its own and one row in
the register (a small Parquet table that is only appended to). A version counts
once its row is there, so a save that fails halfway is never loaded.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_REGISTER = "name string, version int, path string"


def _register(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/register"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], _REGISTER)
    return spark.read.schema(_REGISTER).parquet(path)


def versions(spark: SparkSession, root: str, name: str) -> list[int]:
    return sorted(r[0] for r in _register(spark, root).where(F.col("name") == name).select("version").collect())


def save_model(model: PipelineModel, spark: SparkSession, root: str, name: str) -> int:
    """Save a fitted pipeline as the next version of ``name`` (one writer at a time); returns the version."""
    version = max(versions(spark, root, name), default=0) + 1
    path = f"{root.rstrip('/')}/models/{uuid.uuid4().hex}"
    model.write().save(path)
    spark.createDataFrame([(name, version, path)], _REGISTER).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/register")
    return version


def load_model(spark: SparkSession, root: str, name: str, version: int | None = None) -> PipelineModel:
    """A saved pipeline, the latest one unless a version is named."""
    rows = _register(spark, root).where(F.col("name") == name).collect()
    found = {r["version"]: r["path"] for r in rows}
    if not found or (version is not None and version not in found):
        raise KeyError(f"no version {version or ''} of model {name}")
    return PipelineModel.load(found[version or max(found)])
