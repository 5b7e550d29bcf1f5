"""Jump consistent hashing of stable keys to shards, in Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import settle


def jump(key: Column, shards: int) -> Column:
    """Struct of ``shard`` under ``shards`` shards and ``grown`` under one more.

    The jump consistent hash of Lamping and Veach: from bucket b, a draw r in
    (0, 1] that key and step decide leads to bucket floor((b + 1) / r).  The
    last bucket below the number of shards is the shard, so both numbers come
    from one walk, and an added shard takes rows only into itself.  Every jump
    gains at least one bucket: ``shards + 1`` steps always suffice.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    start = F.struct(
        F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("grown"), F.lit(0).cast("long").alias("at")
    )

    def step(state: Column, turn: Column) -> Column:
        draw = F.shiftrightunsigned(F.xxhash64(key, turn), 33) + F.lit(1)
        after = F.floor((state["at"] + F.lit(1)) * F.lit(2147483648.0) / draw).cast("long")
        after = F.when(state["at"] <= shards, after).otherwise(state["at"])
        return F.struct(
            F.when(after < shards, after).otherwise(state["shard"]).alias("shard"),
            F.when(after <= shards, after).otherwise(state["grown"]).alias("grown"),
            after.alias("at"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards + 1)), start, step)


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``key``: id and shard count alone decide.  A null id is a key
    like any other; rows that repeat an id share its shard.  ``size`` is the
    text's UTF-8 bytes (null: none) plus 16, ``text_crc32`` that of the bytes
    (null as empty).  ``slot`` numbers a shard's rows from 0 without gaps.

    A shard may hold any number of rows: a slot is the count of rows that the
    shard has in earlier input partitions, plus the place in its own.  Only
    ids and sizes are shuffled, texts never.
    """
    text, key = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    rows = docs.select(
        key.cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(16)).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        jump(key, shards).alias("walk"),
        F.spark_partition_id().alias("part"),
    )
    rows = settle(
        rows.select(
            "doc_id", "size", "text_crc32", "part",
            F.col("walk.shard").cast("int").alias("shard"), F.col("walk.grown").cast("int").alias("grown_shard"),
        ),
        "shards",
    )
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = before.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(
        Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size", "grown_shard")
    )
    return rows.withColumn("place", place).join(before, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("before") + F.col("place") - F.lit(1)).cast("long").alias("slot"), "grown_shard",
    )
