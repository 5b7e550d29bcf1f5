"""Streaming forms built on ``foreachBatch`` with a small state table.

Here a micro-batch is an ordinary table, so the batch operators run on it and
a hot key or a global watermark costs no single task.  What must be remembered
is a table in the state folder.  It alternates between two slots: batch n reads
the slot of batch n - 1 and overwrites the other, so a repeated batch finds the
state it started from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import latedata, scan
from millrace.operators.rolling import Keys, as_list

Sink = Callable[[DataFrame, int], None]


class Slots:
    """The state table left by the batch before."""

    def __init__(self, path: str):
        self._path = path

    def read(self, spark, batch_id: int, schema: str) -> DataFrame:
        if batch_id == 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self._path}/slot={(batch_id - 1) % 2}")

    def write(self, state: DataFrame, batch_id: int) -> None:
        state.write.mode("overwrite").parquet(f"{self._path}/slot={batch_id % 2}")


def folder_sink(path: str) -> Sink:
    """Write each batch to a folder of its own; a repeated batch overwrites it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def persisted(write: Sink) -> Sink:
    """Keep the micro-batch while it is read several times, so that what made it runs once."""

    def kept(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write(batch, batch_id)
        finally:
            batch.unpersist()

    return kept


def ranked_batches(groups: list[str], value: str, tie: str, sink: Sink) -> Sink:
    """A ``foreachBatch`` function that ranks each group's rows by ``value``, largest first.

    For an append-mode window aggregate: a watermark closes a window for all
    keys at once, so one batch holds all its rows.  Adds ``place``, from 1.  A
    group of very many rows is cut into ranges (:func:`scan.places`).
    """
    @persisted
    def write(batch: DataFrame, batch_id: int) -> None:
        down = batch.withColumn("_down", -F.col(value))
        sink(scan.places(down, groups, ["_down", tie]).drop("_down"), batch_id)

    return write


def running_batches(
    keys: Keys,
    seq: str,
    rules: dict[str, scan.Rule],
    state_path: str,
    sink: Sink,
    retain: int | None = None,
    **kw,
) -> Sink:
    """A ``foreachBatch`` function for running folds that no hot key can stall.

    ``retain`` forgets a key whose newest ``seq`` lies more than that behind the
    newest of all, and so bounds the state; without it every key is kept.
    """
    keys = as_list(keys)
    slots = Slots(state_path)

    def fresh_fold(name: str, rule: scan.Rule):
        if rule.kind in ("first", "last"):
            pick = F.min_by if rule.kind == "first" else F.max_by
            return pick(rule.value["v"], F.col(seq)).alias(name)
        return getattr(F, rule.kind)(rule.value).alias(name)

    def merged_fold(name: str, rule: scan.Rule):
        if rule.kind in ("first", "last"):
            pick = F.min_by if rule.kind == "first" else F.max_by
            return pick(name, F.col("_age")).alias(name)
        return getattr(F, rule.kind)(name).alias(name)

    @persisted
    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.groupBy(*keys).agg(
            *[fresh_fold(n, r) for n, r in rules.items()], F.max(F.col(seq).cast("long")).alias("_last")
        )
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh.schema)
        before = slots.read(batch.sparkSession, batch_id, ddl)
        sink(scan.running(batch, keys, seq, rules, start=before.drop("_last"), **kw), batch_id)
        both = before.withColumn("_age", F.lit(0)).unionByName(fresh.withColumn("_age", F.lit(1)))
        after = both.groupBy(*keys).agg(
            *[merged_fold(n, r) for n, r in rules.items()], F.max("_last").alias("_last")
        )
        if retain is not None:
            newest = both.agg(F.max("_last")).first()[0]
            after = after.filter(F.col("_last") >= (newest or 0) - retain)
        slots.write(after, batch_id)

    return write


def _top(spark, slots: Slots, batch_id: int) -> int | None:
    """The largest time seen before this batch: one row."""
    row = slots.read(spark, batch_id, "top long").agg(F.max("top")).first()
    return row[0]


def late_split_batches(
    ts: str,
    seq: str,
    size: int,
    bound: int,
    lateness: int,
    state_path: str,
    on_time: Sink,
    late: Sink,
    **kw,
) -> Sink:
    """A ``foreachBatch`` function giving accepted and late records to two sinks."""
    slots = Slots(state_path)

    @persisted
    def write(batch: DataFrame, batch_id: int) -> None:
        top = _top(batch.sparkSession, slots, batch_id)
        kept, dropped = latedata.late_split(
            batch, ts, seq, size, bound, lateness, seen=top, **kw
        )
        on_time(kept, batch_id)
        late(dropped, batch_id)
        slots.write(batch.agg(F.greatest(F.max(ts), F.lit(top).cast("long")).alias("top")), batch_id)

    return write


def allowed_lateness_batches(
    key: Keys,
    ts: str,
    seq: str,
    value: str,
    size: int,
    bound: int,
    lateness: int,
    state_path: str,
    sink: Sink,
    **kw,
) -> Sink:
    """A ``foreachBatch`` function giving every firing of a tumbling sum.

    The state is one row per key and window that can still change.
    """
    keys = as_list(key)
    tops, windows = Slots(f"{state_path}/top"), Slots(f"{state_path}/windows")

    @persisted
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        top = _top(spark, tops, batch_id)
        ddl = ", ".join(f"`{k}` {batch.schema[k].dataType.simpleString()}" for k in keys)
        total = "bigint" if dict(batch.dtypes)[value] in ("int", "bigint") else "double"
        ddl += f", window_end long, total {total}, n long, firing long"
        before = windows.read(spark, batch_id, ddl)
        fired, after = latedata.lateness_step(
            batch, before, keys, ts, seq, value, size, bound, lateness, top, **kw
        )
        sink(fired, batch_id)
        new_top = batch.agg(F.greatest(F.max(ts), F.lit(top).cast("long")).alias("top"))
        tops.write(new_top, batch_id)
        reached = new_top.first()[0]
        if reached is not None:
            open_ = F.col("window_end") - 1 + lateness > reached - bound
            after = after.filter(open_)
        windows.write(after, batch_id)

    return write
