"""Changelogs: add/withdraw rows for changing results, and collapsing them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.arith import floor_div
from millrace.operators import scan
from millrace.operators.rolling import Keys, as_list


def apply_changes(df: DataFrame, key: Keys, seq: str, op: str, delete: str = "D") -> DataFrame:
    """Snapshot of a change feed: the newest row per key unless it is a delete."""
    return snapshot(df, key, seq, op, delete)


def newest_changes(df: DataFrame, key: Keys, seq: str) -> DataFrame:
    """The newest change per key of a change feed, deletes included, on a table or a stream.

    On a stream (output mode update) the state is the newest change of every
    key.  It stays when it is a delete, so changes that arrive late or again,
    with a number that is not larger, do not bring a deleted row back.  A batch
    gives the keys it has changes of; :func:`snapshot` reads them.  Rows of a
    key are combined before they are shuffled.
    """
    keys = as_list(key)
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_r"))
    return newest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def snapshot(changes: DataFrame, key: Keys, seq: str, op: str, delete: str = "D") -> DataFrame:
    """What batches of newest changes leave behind: the newest per key, unless it is a delete."""
    newest = newest_changes(changes, key, seq)
    return newest.filter(F.col(op) != delete).drop(op)


def change_totals(df: DataFrame, key: Keys, value: str, flag: str = "flag") -> DataFrame:
    """(key, n, total, low, high) of the rows a changelog leaves behind.

    The rows of each value are counted first, additions less withdrawals; least
    and largest are taken of the values that have rows left.  A hot key costs
    one row per value.
    """
    keys = as_list(key)
    sign = F.when(F.col(flag), 1).otherwise(-1).cast("long")
    counted = df.groupBy(*keys, value).agg(F.sum(sign).alias("_n"))
    left = F.when(F.col("_n") > 0, F.col(value))
    return counted.groupBy(*keys).agg(
        F.sum("_n").alias("n"), F.sum(F.when(F.col("_n") != 0, F.col(value) * F.col("_n"))).alias("total"),
        F.min(left).alias("low"), F.max(left).alias("high"),
    ).filter("n > 0")


def upsert_latest(df: DataFrame, key: Keys, seq: str) -> DataFrame:
    """The newest record per key: what repeated upserts leave behind."""
    return newest_changes(df, key, seq)


def retract_group(df: DataFrame, key: Keys, value: str, seq: str, **kw):
    """Running group sum as (flag, key, value, seq): false withdraws, true adds.

    What is withdrawn is the sum as of the record before.  The first record of
    a key always adds a row, null when its value is null; after that nothing is
    emitted while the result stays the same.
    """
    keys = as_list(key)
    total = scan.run_sum(value)
    rules = {"_new": total, "_old": replace(total, before=True), "_n": scan.run_count()}
    moved = scan.running(df.select(*keys, seq, value), keys, seq, rules, **kw)
    again = F.col("_n") > 1
    changed = moved.filter(~again | ~F.col("_new").eqNullSafe(F.col("_old")))
    gone = F.struct(F.lit(False).alias("flag"), F.col("_old").alias("v"))
    added = F.struct(F.lit(True).alias("flag"), F.col("_new").alias("v"))
    entries = F.array_compact(F.array(F.when(again, gone), added))
    return changed.select(*keys, seq, F.explode(entries).alias("e")).select(
        F.col("e.flag").alias("flag"), *keys, F.col("e.v").alias(value), seq
    )


def changelog_left_join(
    left: DataFrame, right: DataFrame, key: str, lseq: str, rseq: str
) -> DataFrame:
    """Changelog of a left join where both sides keep every row.

    A left row without partner is added with nulls; its first partner withdraws
    that row; each pair is added when its second half arrives.  Columns other
    than the key must differ.  ``seq`` is the arrival that caused the entry.
    """
    rest = [c for c in right.columns if c != key]
    right = right.withColumnRenamed(key, "_rk")
    pairs = left.join(right, F.col(key) == F.col("_rk")).select(
        F.lit(True).alias("flag"),
        *left.columns,
        *rest,
        F.greatest(lseq, rseq).alias("seq"),
    )
    first = right.groupBy("_rk").agg(F.min(rseq).alias("_first"))
    alone = left.join(first, F.col(key) == F.col("_rk"), "left").filter(
        F.col("_first").isNull() | (F.col("_first") > F.col(lseq))
    )
    entries = F.array_compact(
        F.array(
            F.struct(F.lit(True).alias("flag"), F.col(lseq).cast("long").alias("seq")),
            F.when(
                F.col("_first").isNotNull(),
                F.struct(F.lit(False).alias("flag"), F.col("_first").cast("long").alias("seq")),
            ),
        )
    )
    nulls = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in rest]
    unmatched = alone.withColumn("_e", F.explode(entries)).select(
        F.col("_e.flag").alias("flag"), *left.columns, *nulls, F.col("_e.seq").alias("seq")
    )
    return pairs.unionByName(unmatched)


#: Rows that one fold takes, and tables that one merge takes.
BLOCK = 256
_ENTRY = "struct<d:double,s:bigint>"


def _placed(top: Column, down: Column) -> Column:
    """How many entries of a top list stay ahead of a new one: the larger, and the equal but earlier."""
    return F.size(F.filter(top, lambda e: e["d"] <= down))


def _merged(top: Column, other: Column, n: int) -> Column:
    return F.slice(F.array_sort(F.concat(top, other)), 1, n)


def _tops_before(tops: DataFrame, last: int, n: int, fan: int) -> DataFrame:
    """``_k, _block, _before``: the best ``n`` of all blocks before each, from the best of each block.

    A scan over mergeable lists: blocks are merged ``fan`` at a time, the lists
    before the merged ones are found in the same way, and then each run of
    blocks is folded from there.  No row or task holds more than ``fan`` lists.
    """
    empty = F.array().cast(f"array<{_ENTRY}>")
    if last == 0:
        return tops.select("_k", "_block", empty.alias("_before"))
    runs = tops.groupBy("_k", floor_div(F.col("_block"), fan).alias("_run"))
    runs = scan.written(runs.agg(F.array_sort(F.collect_list(F.struct("_block", "_top"))).alias("_parts")), "tops")
    best = F.aggregate("_parts", empty, lambda top, part: _merged(top, part["_top"], n))
    above = _tops_before(runs.select("_k", F.col("_run").alias("_block"), best.alias("_top")), last // fan, n, fan)
    above = above.select(F.col("_k").alias("_k2"), F.col("_block").alias("_run2"), "_before")
    both = runs.join(above, scan.same_row(["_k", "_run"], ["_k2", "_run2"]))
    start = F.struct(F.col("_before").alias("top"), F.array().cast(f"array<struct<b:bigint,t:array<{_ENTRY}>>>").alias("out"))
    step = lambda state, part: F.struct(
        _merged(state["top"], part["_top"], n).alias("top"),
        F.concat(state["out"], F.array(F.struct(part["_block"].alias("b"), state["top"].alias("t")))).alias("out"),
    )
    folded = F.aggregate("_parts", start, step, lambda state: state["out"])
    return both.select("_k", F.explode(folded).alias("p")).select("_k", F.col("p.b").alias("_block"), F.col("p.t").alias("_before"))


def top_n_changelog(
    df: DataFrame, key: str, value: str, seq: str, n: int, chunk: int | None = None
) -> DataFrame:
    """Every change of a per-key top-n list as (flag, key, value, rank, seq).

    Equal values keep arrival order.  A key's rows are dealt by their place to
    blocks of ``chunk``; a block starts from the best n of all blocks before it,
    looks only at rows that beat the last of these, and unfolds the list for
    those that enter.  All of it are Spark's own operators, and blocks are
    independent of each other.
    """
    block = chunk or BLOCK
    rows = df.select(
        F.col(key).alias("_k"), (-F.col(value).cast("double")).alias("d"), F.col(seq).cast("long").alias("s")
    ).filter("d IS NOT NULL")
    placed = scan.position(rows, ["_k"], "s", name="_pos")
    placed = placed.select("_k", "d", "s", floor_div(F.col("_pos") - 1, block).alias("_block"))
    blocks = placed.groupBy("_k", "_block").agg(F.array_sort(F.collect_list(F.struct("s", "d"))).alias("_rows"))
    blocks = scan.written(blocks, "blocks")
    last = blocks.agg(F.max("_block")).first()[0] or 0
    entry = lambda r: F.struct(r["d"].alias("d"), r["s"].alias("s"))
    best = F.slice(F.array_sort(F.transform("_rows", entry)), 1, n)
    before = _tops_before(blocks.select("_k", "_block", best.alias("_top")), last, n, BLOCK)
    before = before.select(F.col("_k").alias("_k2"), F.col("_block").alias("_block2"), "_before")
    both = blocks.join(before, scan.same_row(["_k", "_block"], ["_k2", "_block2"]))

    worst = F.get(F.col("_before"), n - 1)["d"]
    able = F.filter("_rows", lambda r: worst.isNull() | (r["d"] < worst))
    start = F.struct(
        F.col("_before").alias("top"),
        F.array().cast(f"array<struct<d:double,s:bigint,top:array<{_ENTRY}>>>").alias("out"),
    )

    def enter(state: Column, r: Column) -> Column:
        top, place = state["top"], _placed(state["top"], r["d"])
        after = F.slice(F.concat(F.slice(top, F.lit(1), place), F.array(entry(r)), F.slice(top, place + 1, F.lit(n))), 1, n)
        told = F.array(F.struct(r["d"].alias("d"), r["s"].alias("s"), top.alias("top")))
        return F.when(place >= n, state).otherwise(F.struct(after.alias("top"), F.concat(state["out"], told).alias("out")))

    entered = both.select("_k", F.explode(F.aggregate(able, start, enter, lambda state: state["out"])).alias("e"))
    entered = entered.select("_k", "e.*").withColumn("place", _placed(F.col("top"), F.col("d")))
    moved = F.slice("top", F.col("place") + 1, F.lit(n))
    told = lambda flag, down, rank: F.struct(
        F.lit(flag).alias("flag"), (-down).alias("v"), rank.cast("long").alias("rank")
    )
    gone = F.transform(moved, lambda e, i: told(False, e["d"], F.col("place") + i + 1))
    new = F.array(told(True, F.col("d"), F.col("place") + 1))
    added = F.slice(F.concat(new, F.transform(moved, lambda e, i: told(True, e["d"], F.col("place") + i + 2))), F.lit(1), n - F.col("place"))
    entries = entered.select("_k", "s", F.explode(F.concat(gone, added)).alias("c"))
    return entries.select("c.flag", F.col("_k").alias(key), F.col("c.v").alias(value), "c.rank", F.col("s").alias("seq"))
