"""Alerts on consecutive values of a key, and repeated-event patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.durations import millis
from millrace.operators import scan
from millrace.operators.rolling import Keys, as_list


def jump_alert(
    df: DataFrame,
    key: Keys,
    seq: str,
    value: str,
    threshold: float,
    first: str = "skip",
    **kw,
) -> DataFrame:
    """(key, seq, previous, current) where the value moved by more than a threshold.

    ``first`` says what a key's first record is compared with: nothing ("skip")
    or 0.0 ("zero").
    """
    if first not in ("skip", "zero"):
        raise ValueError("first must be skip or zero")
    keys = as_list(key)
    rules = {"previous": scan.run_last(value), "_n": scan.run_count()}
    out = scan.running(
        df.select(*keys, seq, value), keys, seq, rules, include_current=False, **kw
    )
    if first == "zero":
        out = out.withColumn(
            "previous", F.when(F.col("_n").isNull(), F.lit(0.0)).otherwise(F.col("previous"))
        )
    moved = F.abs(F.col(value) - F.col("previous")) > threshold
    return out.filter(moved).select(*keys, seq, "previous", F.col(value).alias("current"))


def trend_alert(
    df: DataFrame,
    key: Keys,
    ts: str,
    value: str,
    hold: int | str,
    seq: str,
    direction: str = "rising",
    **kw,
) -> DataFrame:
    """First alert of every unbroken trend, as (key, armed_at, alert_at).

    A rise arms a timer ``hold`` later and a drop before that time cancels it;
    equal values change nothing.  ``falling`` swaps rise and drop.  A trend is
    the run of records between two opposite moves.  :func:`trend_alerts` also
    gives the alerts a trend raises after its first one.
    """
    keys = as_list(key)
    up = {"rising": 1, "falling": -1}[direction]
    # A null is neither a rise nor a drop, and the value before it stays.
    rows = df.select(*keys, seq, ts, value).filter(F.col(value).isNotNull())
    kw.setdefault("chunk", scan.measure(rows, keys, seq))
    rows = scan.previous(rows, keys, seq, {"_prev": value}, **kw)
    step = F.coalesce(F.lit(up) * (F.col(value) - F.col("_prev")), F.lit(0.0))
    rows = rows.withColumns({"_with": step > 0, "_against": step < 0})
    trends = scan.running(
        rows, keys, seq, {"_trend": scan.run_sum(F.col("_against").cast("long"))}, **kw
    )
    # A trend's end is the record that starts the next one, so that record counts
    # for both: as the end of one trend and as the first record of the next.
    of_trend = F.struct(
        F.col("_trend").alias("n"),
        F.when(F.col("_with"), F.col(ts)).alias("armed_at"),
        F.lit(None).cast("timestamp").alias("ended"),
    )
    of_last = F.when(
        F.col("_against"),
        F.struct(
            (F.col("_trend") - 1).alias("n"),
            F.lit(None).cast("timestamp").alias("armed_at"),
            F.col(ts).alias("ended"),
        ),
    )
    parts = trends.select(*keys, F.explode(F.array_compact(F.array(of_trend, of_last))).alias("p"))
    ended = parts.groupBy(*keys, "p.n").agg(
        F.min("p.armed_at").alias("armed_at"), F.min("p.ended").alias("_ended")
    )
    due = F.timestamp_micros(F.unix_micros("armed_at") + millis(hold) * 1000)
    alerts = ended.withColumn("alert_at", due).filter(
        F.col("armed_at").isNotNull()
        & (F.col("_ended").isNull() | (F.col("_ended") >= F.col("alert_at")))
    )
    return alerts.select(*keys, "armed_at", "alert_at")


#: Places of what a pending alert meets at one time: the question itself, a move onward, the end of the trend.
_ASKED, _MOVE, _END = 0, 1, 2
_NEVER = 1 << 62


def _next_moves(moves: DataFrame, hold_us: int, chunk: int | scan.Cut | None) -> DataFrame:
    """Each move onward with ``_next``, the first one of its trend at or after its due time, and
    ``_fires``, whether the alert armed by it comes before the trend ends.

    Every move asks at its due time.  Against the order of time, the least
    number of a move seen so far is the next move's, and an end seen so far is
    not before the due time.
    """
    onward = moves.filter("_step > 0")
    ends = moves.filter("_step < 0").select("_k", (F.col("_trend") - 1).alias("_trend"), "_at", "_s")
    last = moves.groupBy("_k").agg(F.max("_trend").alias("_trend"))
    never = F.lit(_NEVER).cast("long")
    last = last.select("_k", "_trend", never.alias("_at"), never.alias("_s"))
    kinds = (
        (onward.withColumn("_at", F.col("_at") + hold_us), _ASKED), (onward, _MOVE), (ends.unionByName(last), _END),
    )
    asked, moved, ended = (df.select("_k", "_trend", "_at", "_s", F.lit(kind).alias("_kind")) for df, kind in kinds)
    line = asked.unionByName(moved).unionByName(ended).withColumns({"_back": -F.col("_at"), "_down": -F.col("_s")})
    rules = {
        "_next": scan.run_min(F.when(F.col("_kind") == _MOVE, F.col("_s"))),
        "_over": scan.run_max(F.when(F.col("_kind") == _END, F.lit(True))),
    }
    seen = scan.running(line, ["_k", "_trend"], ["_back", "_down", "_kind"], rules, chunk=chunk, include_current=False)
    fires = F.col("_next").isNotNull() | F.col("_over").isNotNull()
    return seen.filter(F.col("_kind") == _ASKED).select("_k", "_s", (F.col("_at") - hold_us).alias("_at"), "_next", fires.alias("_fires"))


#: Steps along the links that one round takes.
STEPS = 8


def _along(rows: DataFrame, jumps: DataFrame, steps: int) -> DataFrame:
    """``rows(_k, _s)`` with ``_path``: the numbers that up to ``steps`` jumps lead to, in order.

    Rows meet by key and number, which no two rows of ``jumps`` share; a path
    that has ended keeps its last number, so such rows do not gather either.
    """
    path = rows.select("_k", "_s", F.col("_s").alias("_at"), F.lit(True).alias("_live"), F.array().cast("array<bigint>").alias("_path"))
    for _ in range(steps):
        there = jumps.select(F.col("_k").alias("_k2"), F.col("_s").alias("_s2"), F.col("_next").alias("_then"))
        met = path.join(there, scan.same_row(["_k", "_at"], ["_k2", "_s2"]) & F.col("_live"), "left")
        live = F.col("_then").isNotNull()
        path = met.select(
            "_k", "_s", F.coalesce("_then", "_at").alias("_at"), live.alias("_live"),
            F.when(live, F.array_append("_path", F.col("_then"))).otherwise(F.col("_path")).alias("_path"),
        )
    return path


def _chains(heads: DataFrame, links: DataFrame, longest: int) -> DataFrame:
    """All ``_k, _s`` that the links lead to from the heads, by pointer jumping.

    A round follows STEPS jumps from all that is reached, and then makes that
    many jumps one: the rounds grow with the logarithm of the longest chain.
    """
    reached, jumps = heads, links.select("_k", "_s", "_next").filter("_next is not null")
    while longest > 1:
        path = _along(reached, jumps, min(longest, STEPS) - 1)
        reached = path.select("_k", F.explode(F.array_prepend("_path", F.col("_s"))).alias("_s"))
        longest = -(-longest // STEPS)
        if longest > 1:
            reached = scan.written(reached, "reached")
            whole = _along(jumps.select("_k", "_s"), jumps, STEPS).filter("_live")
            jumps = scan.written(whole.select("_k", "_s", F.col("_at").alias("_next")), "jumps")
    return reached


def trend_alerts(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    hold: int | str,
    seq: str,
    direction: str = "rising",
    chunk: int | scan.Cut | None = None,
) -> DataFrame:
    """Every alert of every trend, as (key, armed_at, alert_at).

    Like :func:`trend_alert`, and after an alert the next move in the same
    direction arms the timer again.  ``ts`` must not go back along ``seq``.  A
    trend's first move arms the timer, and the move that arms it after that is
    the first one at or after the due time; these moves are found by following
    such links, in Spark's own operators and without gathering a key or a trend.
    """
    up = {"rising": 1, "falling": -1}[direction]
    hold_us = millis(hold) * 1000
    rows = df.select(F.col(key).alias("_k"), F.col(seq).cast("long").alias("_s"), F.unix_micros(ts).alias("_at"), value)
    rows = rows.filter(F.col(value).isNotNull())
    width = chunk if isinstance(chunk, int) else None
    cut = scan.Cut(chunk) if width else chunk or scan.measure(rows, ["_k"], "_s")
    rows = scan.previous(rows, ["_k"], "_s", {"_prev": value}, chunk=cut)
    step = F.signum(F.lit(up) * (F.col(value) - F.col("_prev"))).cast("int")
    steps = rows.select("_k", "_s", "_at", step.alias("_step")).filter("_step <> 0")
    against = F.when(F.col("_step") < 0, 1).otherwise(0).cast("long")
    moves = scan.running(steps, ["_k"], "_s", {"_trend": scan.run_sum(against)}, chunk=cut)
    moves = scan.written(moves, "moves")

    trends = moves.filter("_step > 0").groupBy("_k", "_trend")
    spent = F.floor((F.max("_at") - F.min("_at")) / F.lit(max(hold_us, 1))) + 1
    trends = trends.agg(F.min("_s").alias("_s"), F.least(F.count("*"), spent).alias("_most"))
    longest = trends.agg(F.max("_most")).first()[0] or 0
    # Without a hot key there is no hot trend, and no need to look for one.
    links = _next_moves(moves, hold_us, width * 1_000_000 if width else cut if cut.whole else None)
    if longest > 1:
        links = scan.written(links, "links")
    reached = _chains(trends.select("_k", "_s"), links, longest)
    reached = reached.select(F.col("_k").alias("_k2"), F.col("_s").alias("_s2"))
    found = links.filter("_fires").join(reached, scan.same_row(["_k", "_s"], ["_k2", "_s2"]))
    return found.select(
        F.col("_k").alias(key),
        F.timestamp_micros("_at").alias("armed_at"),
        F.timestamp_micros(F.col("_at") + hold_us).alias("alert_at"),
    )


def pattern_times(
    df: DataFrame,
    key: Keys,
    seq: str,
    predicate: Column,
    times: int,
    ts: str | None = None,
    strict: bool = False,
    within: int | str | None = None,
    **kw,
) -> DataFrame:
    """Runs of ``times`` qualifying records of a key, as (key, first, last) places.

    Relaxed runs skip other records; strict runs must be adjacent.  Runs may
    overlap: each qualifying record starts one.  ``within`` limits the time
    between the first and the last record and needs ``ts``.
    """
    if within is not None and ts is None:
        raise ValueError("within needs ts")
    keys = as_list(key)
    rows = df.withColumn("_hit", F.coalesce(predicate, F.lit(False)))
    kept = [*keys, seq, *([ts] if ts else [])]
    kw.setdefault("chunk", scan.measure(rows, keys, seq))
    if strict:
        placed = scan.position(rows.select(*kept, "_hit"), keys, seq, name="_all", **kw)
        hits = placed.filter("_hit")
    else:
        hits = rows.filter("_hit").select(*kept).withColumn("_all", F.lit(0).cast("long"))
    hits = scan.position(hits, keys, seq, name="_pos", **kw)
    back = times - 1
    runs = scan.row_frame(
        hits,
        keys,
        "_pos",
        back,
        lambda _, ordered: {
            "_from": F.lag(F.struct(seq, "_all", *([ts] if ts else [])), back).over(ordered)
            if back
            else F.struct(seq, "_all", *([ts] if ts else []))
        },
    ).filter(F.col("_from").isNotNull())
    if strict:
        runs = runs.filter(F.col("_all") - F.col("_from._all") == back)
    if within is not None:
        spent = F.unix_micros(ts) - F.unix_micros(F.col(f"_from.{ts}"))
        runs = runs.filter(spent <= millis(within) * 1000)
    return runs.select(*keys, F.col(f"_from.{seq}").alias("first"), F.col(seq).alias("last"))
