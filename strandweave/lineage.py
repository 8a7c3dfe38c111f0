"""Cutting lineage: intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder is set where that is unset, in local mode only: on a cluster, other machines wouldn't see it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strandweave-"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """A scan dealt evenly to all cores if it has fewer partitions than there are; such an input is small, at most a split for each core."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    Operators that read an input several times call it first: otherwise each
    reading would plan, and run, all that stands before it once more.  The shuffle
    files of the write go with its end, not when the driver collects its garbage.
    """
    spark, path = df.sparkSession, f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)
