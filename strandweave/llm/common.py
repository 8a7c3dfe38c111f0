"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegralType, StructField, StructType

from ..lineage import shared_folder
from .scan import slices

LOWEST = -(1 << 63)  # the key of a null id
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


@contextmanager
def tables_made() -> Iterator[list[str]]:
    """The folders that ``shared_path`` names within the block, also in the list of a block around it."""
    outer, made = _MADE.get(), []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        if outer is not None:
            outer.extend(made)


def drop_tables(spark: SparkSession, paths: Sequence[str], but: Sequence[DataFrame | None] = ()) -> None:
    """Deletes the folders of tables that nothing reads any more; those that the plans ``but`` read stay."""
    kept = [f for df in but if df is not None for f in df.inputFiles()]
    for path in paths:
        if any(path.rpartition("/")[2] in f for f in kept):
            continue
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends there, and lost executors cost nothing.

    The shuffle files of the write go with its end; else they would stay until the
    driver happens to collect its garbage, and those of all steps add up.
    """
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores appended until no column of ``df`` has it (Spark ignores case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def numbered(df: DataFrame, column: str, key: str) -> tuple[DataFrame, DataFrame | None]:
    """``df`` with the long ``key`` in the order of ``column`` (null: ``LOWEST``), and a table (column, key) where the key isn't the value itself.

    Whole numbers are their own keys; other ids are numbered in a range-partitioned
    sort of the distinct ones, which is written once and joined back.
    """
    if isinstance(df.schema[column].dataType, IntegralType):
        return df.withColumn(key, F.coalesce(F.col(column).cast("bigint"), F.lit(LOWEST))), None
    ids = df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
    ids = materialise(ids.withColumn(key, F.monotonically_increasing_id()), "ids")
    return df.join(ids, column, "left").select(*df.columns, F.coalesce(key, F.lit(LOWEST)).alias(key)), ids


def renamed_ids(df: DataFrame, ids: DataFrame | None, column: str, key: str) -> DataFrame:
    """Keys of ``numbered`` in ``column`` turned back into ids (``LOWEST``: null)."""
    if ids is None:
        return df.withColumn(column, F.nullif(column, F.lit(LOWEST)))
    (name,) = fresh(df, key)
    other = ids.select(F.col(key).alias(name), F.col([c for c in ids.columns if c != key][0]).alias(name + "_id"))
    return df.join(other, F.col(column) == F.col(name), "left").withColumn(column, F.col(name + "_id")).select(*df.columns)


def halves(batch: pa.RecordBatch, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``most`` bytes, or of one row."""
    if batch.num_rows < 2 or batch.get_total_buffer_size() <= most or batch.nbytes <= most:
        yield batch
    else:
        middle = batch.num_rows // 2
        yield from halves(batch.slice(0, middle), most)
        yield from halves(batch.slice(middle), most)


def with_arrow(df: DataFrame, fields: Sequence[StructField], compute: Callable[[pa.RecordBatch], list], text: str | None = None) -> DataFrame:
    """Appends columns that ``compute`` makes from each Arrow batch.

    All input columns are kept, except those named like a new one, which it
    replaces.  Batches are cut to a few MB, of the column ``text`` where it is given.
    """
    names = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in names]
    schema = StructType([*kept, *fields])

    def run(batches):
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for part in slices(batch, text) if text else halves(batch):
                old = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                columns = [*old, *compute(part)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)
