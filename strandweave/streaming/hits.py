"""Structured Streaming forms of the stateless read filters and of feature counting.

The engine's merges are bounded; these only let new files of hits flow through the
same expressions.  A read's hits must arrive in one file, as a mapper writes them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def stream_hits(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def apply_batches(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str):
    """Runs a batch plan (uniqueness, selection, filters) on each micro-batch; a batch that is retried replaces its own folder."""
    def one(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
