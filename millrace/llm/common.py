"""Reading, row numbers and written tables the operators share."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import fresh_dir

#: Bytes of an Arrow batch handed to Python; bounds a worker's memory whatever the texts' lengths.
BATCH_BYTES = 8 << 20
SPLITS = "spark.sql.files.minPartitionNum"
#: Whether Spark deletes an execution's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: By label, how written tables are packed where that is not Spark's own way.
CODECS = {"crowd-texts": "zstd"}


def prepared(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on: Arrow batches bounded by bytes, UTC, and one size of file splits.

    Row numbers depend on where files are split, and Spark derives that from
    the cores registered when it plans a reading.  The first call fixes the
    number for the session, so that executors that come or go move nothing.
    """
    if spark.conf.get(SPLITS, None) is None:
        spark.conf.set(SPLITS, str(spark.sparkContext.defaultParallelism))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """``uid`` (one number per row, the same at every reading), ``doc_id``, ``text`` and ``more``.

    Taken before any filter, so that the number only depends on the place of
    the row in the files.  Ids may repeat or be null; ``uid`` does neither.
    """
    prepared(df.sparkSession)
    return df.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
        *[F.col(f"`{c}`") for c in more],
    )


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: cuts lineage, survives lost executors.

    What was shuffled for it goes at once, and not when the driver happens to
    collect its garbage: the written table is read from now on.
    """
    spark = prepared(df.sparkSession)
    path = fresh_dir(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression=CODECS.get(label))
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    table = spark.read.schema(df.schema).parquet(path)
    table._millrace_path = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``settle`` gave and that only written tables were made of: nothing reads them again."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._millrace_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose row number is not in ``dropped.uid``; the columns stay as they are.

    The dropped numbers are written first, so that Spark knows their size when
    it chooses between broadcasting them and dealing out both sides.
    """
    name = "_millrace_uid"
    while name in docs.columns:
        name += "_"
    gone = settle(dropped.select(F.col("uid").alias(name)), "dropped")
    marked = docs.withColumn(name, F.monotonically_increasing_id())
    return marked.join(gone, name, "left_anti").drop(name)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """Give freed memory back to the system at a task's end: Spark uses the worker again."""

    @functools.wraps(work)
    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)

    return done
