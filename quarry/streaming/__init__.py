"""Running the stateless operators on a stream.

The reference has no streaming code, so nothing stateful is built here.
The stateless operators (parsing, cleansing, banding, JSON fields, casts)
are plain ``DataFrame -> DataFrame`` functions without actions, so they
apply to a streaming frame unchanged; this module only wires a file
stream through such a function into a file sink, with the checkpoint on
the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quarry.session import scratch_path


def read_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file source as a stream (schema declared: streams never infer)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def run_available(spark: SparkSession, source: DataFrame, transform: Callable[[DataFrame], DataFrame],
                  out_path: str, fmt: str = "parquet", checkpoint: str | None = None) -> StreamingQuery:
    """Apply ``transform`` to everything available now, append to ``out_path``,
    and stop. Restarting with the same checkpoint processes only new files,
    and a failed run resumes from the last committed batch."""
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    q = (transform(source).writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(out_path))
    q.awaitTermination()
    return q
