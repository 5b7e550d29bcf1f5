"""Rows as messages, documents and rolling files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kafka_value(df: DataFrame, key: str | None = None, format: str = "csv") -> DataFrame:
    """(key, value) text columns ready for a message sink."""
    row = F.struct(*df.columns)
    if format not in ("csv", "json"):
        raise ValueError("format must be csv or json")
    value = F.to_csv(row) if format == "csv" else F.to_json(row)
    first = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(first.alias("key"), value.alias("value"))


def to_document_json(df: DataFrame, mapping: dict[str, str | Column]) -> DataFrame:
    """One JSON document per row; every field is written as text."""
    fields = [
        (F.col(c) if isinstance(c, str) else c).cast("string").alias(name)
        for name, c in mapping.items()
    ]
    return df.select(F.to_json(F.struct(*fields)).alias("value"))


def write_documents(path: str, mapping: dict[str, str | Column]):
    """A ``foreachBatch`` function writing newline JSON, one folder per batch.

    A repeated batch overwrites its own folder, so nothing is written twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        to_document_json(batch, mapping).write.mode("overwrite").text(f"{path}/batch={batch_id}")

    return write


def with_bucket(df: DataFrame, ts: str, pattern: str = "yyyy-MM-dd--HHmm") -> DataFrame:
    return df.withColumn("bucket", F.date_format(ts, pattern))


def bucketed_files(
    df: DataFrame,
    path: str,
    ts: str,
    pattern: str = "yyyy-MM-dd--HHmm",
    max_records: int = 1_000_000,
    format: str = "parquet",
) -> None:
    """Write rows below ``bucket=<time>``; a file is rolled at ``max_records`` rows.

    The rebalance hint gathers a bucket's rows in few files and splits a large
    bucket over several tasks.
    """
    (
        with_bucket(df, ts, pattern)
        .hint("rebalance", "bucket")
        .write.mode("append")
        .partitionBy("bucket")
        .option("maxRecordsPerFile", max_records)
        .format(format)
        .save(path)
    )


def bucketed_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    ts: str,
    pattern: str = "yyyy-MM-dd--HHmm",
    roll: str = "20 minutes",
    max_records: int = 1_000_000,
    format: str = "parquet",
):
    """The streaming form; the trigger interval bounds a file's age."""
    return (
        with_bucket(df, ts, pattern)
        .writeStream.format(format)
        .partitionBy("bucket")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", max_records)
        .trigger(processingTime=roll)
    )
