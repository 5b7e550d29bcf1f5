"""Time, session and count windows, triggers and evictors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.arith import floor_div
from millrace.functions.durations import millis, text
from millrace.operators import scan
from millrace.operators.rolling import Keys, as_list


def window_of(ts: str, size: int | str, slide=None, offset=None) -> Column:
    if offset is not None:
        return F.window(ts, text(size), text(slide or size), text(offset))
    return F.window(ts, text(size), text(slide)) if slide else F.window(ts, text(size))


def window_agg(
    df: DataFrame,
    key: Keys,
    ts: str,
    size: int | str,
    aggs: Sequence[Column],
    slide: int | str | None = None,
    offset: int | str | None = None,
    bound: int | str | None = None,
) -> DataFrame:
    """Tumbling or sliding event-time window per key, on a table or a stream."""
    keys = as_list(key)
    if bound is not None:
        df = df.withWatermark(ts, text(bound))
    grouped = df.groupBy(window_of(ts, size, slide, offset), *keys).agg(*aggs)
    rest = [c for c in grouped.columns if c not in {"window", *keys}]
    return grouped.select(
        *keys,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *rest,
    )


def tumble(
    df: DataFrame, ts: str, size, keys: Sequence[str], aggs: Sequence[Column], rowtime=False, **kw
) -> DataFrame:
    """Group window with start, end and, on request, rowtime = end - 1 ms."""
    out = window_agg(df, list(keys), ts, size, aggs, **kw)
    if rowtime:
        out = out.withColumn("rowtime", F.col("window_end") - F.expr("INTERVAL '0.001' SECOND"))
    return out


def window_avg_trunc(
    df: DataFrame, key: Keys, ts: str, size, value: str, cast_first: bool = False, **kw
) -> DataFrame:
    """Average by integer division; ``cast_first`` also truncates every value."""
    amount = F.col(value).cast("long") if cast_first else F.col(value)
    sums = [F.sum(amount).cast("long").alias("_sum"), F.count(value).alias("_n")]
    out = window_agg(df, key, ts, size, sums, **kw)
    return out.withColumn("avg_value", F.expr("_sum div _n").cast("double")).drop("_sum", "_n")


# --- sessions ---------------------------------------------------------------


def _slots(df: DataFrame, keys: list[str], ts: str, gap: int | str, aggs) -> DataFrame:
    """Pre-aggregate to one row per key and gap-wide slot, then number sessions.

    Two rows of one slot are less than a gap apart, so they share a session.
    What is ordered is a key's occupied slots - time span / gap at most - and not
    its rows, and those of a key with very many are cut into chunks.  Sessions
    that touch exactly are merged.
    """
    gap_us = millis(gap) * 1000
    at = F.unix_micros(ts)
    slots = df.groupBy(*keys, floor_div(at, gap_us).alias("_slot")).agg(
        F.min(ts).alias("_lo"), F.max(ts).alias("_hi"), *aggs
    )
    cut = scan.measure(slots, keys, "_slot")
    slots = scan.previous(slots, keys, "_slot", {"_before": "_hi"}, chunk=cut)
    before = F.col("_before")
    starts = before.isNull() | (F.unix_micros("_lo") - F.unix_micros(before) > gap_us)
    marked = slots.withColumn("_start", F.when(starts, F.col("_lo"))).drop("_before")
    rules = {"session_start": scan.run_max("_start")}
    return scan.running(marked, keys, "_slot", rules, chunk=cut).drop("_start")


_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def session_agg(
    df: DataFrame,
    key: Keys,
    ts: str,
    gap: int | str,
    aggs: dict[str, tuple[str, str]],
    bound: int | str | None = None,
) -> DataFrame:
    """Session windows per key; ``aggs`` maps a name to (sum|count|min|max, column).

    The end of a session is its last event plus the gap.
    """
    keys = as_list(key)
    direct = [getattr(F, kind)(column).alias(name) for name, (kind, column) in aggs.items()]
    if df.isStreaming:
        if bound is not None:
            df = df.withWatermark(ts, text(bound))
        out = df.groupBy(F.session_window(ts, text(gap)).alias("w"), *keys).agg(*direct)
        start, end = F.col("w.start"), F.col("w.end")
    else:
        merged = [_MERGE[kind](name).alias(name) for name, (kind, _) in aggs.items()]
        slots = _slots(df, keys, ts, gap, direct)
        out = slots.groupBy(*keys, "session_start").agg(F.max("_hi").alias("_hi"), *merged)
        start = F.col("session_start")
        end = F.timestamp_micros(F.unix_micros("_hi") + millis(gap) * 1000)
    return out.select(
        *keys, start.alias("session_start"), end.alias("session_end"), *list(aggs)
    )


def with_session(df: DataFrame, key: Keys, ts: str, gap: int | str) -> DataFrame:
    """Tag every row with the start of its session."""
    keys = as_list(key)
    slots = _slots(df, keys, ts, gap, []).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_slot", "session_start"
    )
    slot = floor_div(F.unix_micros(ts), millis(gap) * 1000)
    same = slot == F.col("_slot")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(slots, same).select(*df.columns, "session_start")


# --- count windows ----------------------------------------------------------


#: Copies of a row that a sliding count window may send to its windows.
MOST_COPIES = 16


def count_window(
    df: DataFrame,
    key: Keys,
    seq: str,
    size: int,
    aggs: dict[str, Column],
    slide: int | None = None,
    **kw,
) -> DataFrame:
    """Windows by number of records of a key; ``aggs`` maps names to aggregates.

    Tumbling: fires at every ``size``-th record, incomplete groups never fire.
    Sliding: fires at every ``slide``-th record over the last ``size`` at most.
    ``fire`` is the place of the record that fired.  A row is sent to each of
    its windows; where these are more than MOST_COPIES, a frame over the ordered
    rows is used instead, which sends it once.
    """
    keys = as_list(key)
    step = slide or size
    placed = scan.position(df, keys, seq, name="_pos", **kw)
    if size > MOST_COPIES * step:
        framed = scan.row_frame(
            placed, keys, "_pos", size - 1,
            lambda frame, _: {name: agg.over(frame) for name, agg in aggs.items()},
        )
        fired = framed.filter(F.col("_pos") % step == 0)
        return fired.select(*keys, F.col("_pos").alias("fire"), *aggs)
    first = floor_div(F.col("_pos") + step - 1, step) * step
    # A record at place p is part of the fires in [p, p + size - 1].
    last = floor_div(F.col("_pos") + size - 1, step) * step
    member = placed.filter(first <= last).withColumn(
        "fire", F.explode(F.sequence(first, last, F.lit(step).cast("long")))
    )
    named = [agg.alias(name) for name, agg in aggs.items()]
    out = member.groupBy(*keys, "fire").agg(*named, F.max("_pos").alias("_last"))
    return out.filter(F.col("_last") == F.col("fire")).drop("_last")


# --- triggers and evictors --------------------------------------------------


def fire_every(
    df: DataFrame,
    key: Keys,
    ts: str,
    size: int | str,
    seq: str,
    every: int,
    rules: dict[str, scan.Rule],
    **kw,
) -> DataFrame:
    """Fire a window at every ``every``-th element, over all it holds so far.

    The window never fires on time and is never emptied.
    """
    keys = as_list(key)
    w = window_of(ts, size)
    rows = df.withColumns({"window_start": w.start, "window_end": w.end})
    groups = [*keys, "window_start", "window_end"]
    out = scan.running(rows, groups, seq, {"n": scan.run_count(), **rules}, **kw)
    return out.filter(F.col("n") % every == 0).select(*groups, seq, "n", *rules)


def evict(
    df: DataFrame,
    key: Keys,
    ts: str,
    size: int | str,
    seq: str,
    aggs: Sequence[Column],
    keep_n: int | None = None,
    keep_within: int | str | None = None,
) -> DataFrame:
    """Aggregate a window over its last ``keep_n`` records, or over those at most
    ``keep_within`` older than its newest."""
    keys = as_list(key)
    w = window_of(ts, size)
    rows = df.withColumns({"window_start": w.start, "window_end": w.end})
    groups = [*keys, "window_start", "window_end"]
    if (keep_n is None) == (keep_within is None):
        raise ValueError("give either keep_n or keep_within")
    if keep_n is not None:
        # row_number <= n lets Spark keep n rows per group before the shuffle.
        newest = Window.partitionBy(*groups).orderBy(F.col(seq).desc())
        kept = rows.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= keep_n)
    else:
        tops = rows.groupBy(*groups).agg(F.max(ts).alias("_top"))
        tops = tops.select(*[F.col(g).alias(f"_{g}") for g in groups], "_top")
        same = F.lit(True)
        for g in groups:
            same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
        limit = F.unix_micros("_top") - millis(keep_within) * 1000
        kept = rows.join(tops, same).filter(F.unix_micros(ts) >= limit)
    return kept.groupBy(*groups).agg(*aggs)


# --- whole-window lists -----------------------------------------------------


def window_list(
    df: DataFrame,
    ts: str,
    size: int | str,
    seq: str,
    item: Column,
    key: Keys | None = None,
    **kw,
) -> DataFrame:
    """All elements of a window in arrival order: a row (window, place, item) for each.

    A window of any size is given whole, and no row or task has to hold it.
    """
    keys = as_list(key) if key is not None else []
    w = window_of(ts, size)
    rows = df.withColumns({"window_start": w.start, "window_end": w.end, "item": item})
    groups = ["window_start", "window_end", *keys]
    placed = scan.position(rows.select(*groups, seq, "item"), groups, seq, name="place", **kw)
    return placed.select(*groups, "place", "item")


def consecutive_windows(df: DataFrame, key: str, ts: str, size: int | str, value: str) -> DataFrame:
    """Sum per key and window, then the keys of a window ranked by their sum.

    ``place`` 1 is the largest sum; equal sums are ordered by key.  A window of
    very many keys is cut into ranges (:func:`scan.places`).
    """
    sums = window_agg(df, key, ts, size, [F.sum(value).alias("total")])
    ranked = sums.withColumn("_down", -F.col("total"))
    return scan.places(ranked, ["window_start", "window_end"], ["_down", key]).drop("_down")
