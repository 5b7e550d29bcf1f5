"""Joins in time: interval, window and session joins and the co-group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.arith import floor_div
from millrace.functions.durations import millis
from millrace.operators import scan
from millrace.operators.rolling import Keys, as_list
from millrace.operators.windows import window_of, with_session


def _right_keys(right: DataFrame, keys: list[str]) -> DataFrame:
    return right.withColumnsRenamed({k: f"_r_{k}" for k in keys})


def _equal(keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_r_{k}"))
    return cond


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: Keys,
    lts: str,
    rts: str,
    lo: int | str,
    hi: int | str,
    lo_open: bool = False,
    hi_open: bool = False,
    how: str = "inner",
    bin: int | str | None = None,
) -> DataFrame:
    """Pairs of equal key whose time difference ``rts - lts`` lies in [lo, hi].

    Batch tables meet on (key, time bin): a left row has one bin and a right
    row at most two, so a key is spread over its bins and no pair outside the
    interval's neighbourhood is formed.  Streams use the plain range condition,
    which Spark turns into state eviction; both sides need a watermark.
    Apart from the key, the two tables must not share column names.
    ``how`` is inner or left: a right row has several bins, so it cannot be the
    preserved side; swap the sides and the bounds for a right join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    keys = as_list(key)
    lo_us, hi_us = millis(lo) * 1000, millis(hi) * 1000
    right = _right_keys(right, keys)
    columns = [*left.columns, *[c for c in right.columns if c not in {f"_r_{k}" for k in keys}]]
    if left.isStreaming or right.isStreaming:
        low = F.col(lts) + F.expr(f"INTERVAL '{lo_us / 1e6:f}' SECOND")
        high = F.col(lts) + F.expr(f"INTERVAL '{hi_us / 1e6:f}' SECOND")
        cond = _equal(keys)
        cond = cond & (F.col(rts) > low if lo_open else F.col(rts) >= low)
        cond = cond & (F.col(rts) < high if hi_open else F.col(rts) <= high)
        return left.join(right, cond, how).select(*columns)

    width = max(millis(bin) * 1000 if bin else hi_us - lo_us, 1)
    at = F.unix_micros(rts)
    left = left.withColumn("_bin", floor_div(F.unix_micros(lts), width))
    right = right.withColumn(
        "_r_bin",
        F.explode(
            F.sequence(
                floor_div(at - hi_us, width), floor_div(at - lo_us, width)
            )
        ),
    )
    gap = F.unix_micros(rts) - F.unix_micros(lts)
    inside = (gap > lo_us if lo_open else gap >= lo_us) & (gap < hi_us if hi_open else gap <= hi_us)
    cond = _equal(keys) & (F.col("_bin") == F.col("_r_bin")) & inside
    return left.join(right, cond, how).select(*columns)


def window_join(
    left: DataFrame,
    right: DataFrame,
    key: Keys,
    lts: str,
    rts: str,
    size: int | str,
    offset: int | str | None = None,
) -> DataFrame:
    """Pairs of equal key that fall in the same tumbling window."""
    keys = as_list(key)
    right = _right_keys(right, keys)
    lw, rw = window_of(lts, size, offset=offset), window_of(rts, size, offset=offset)
    left = left.withColumns({"window_start": lw.start, "window_end": lw.end})
    right = right.withColumn("_r_window", rw.start)
    rest = [c for c in right.columns if c != "_r_window" and c not in {f"_r_{k}" for k in keys}]
    cond = _equal(keys) & (F.col("window_start") == F.col("_r_window"))
    return left.join(right, cond).select(*left.columns, *rest)


def _both(left, right, keys, ts, left_value, right_value, seq=None):
    extra = [seq] if seq else []

    def side(df, flag, value):
        return df.select(*keys, ts, *extra, F.lit(flag).alias("_first"), value.alias("_value"))

    return side(left, True, left_value).unionByName(side(right, False, right_value))


def session_join(
    left: DataFrame, right: DataFrame, key: Keys, ts: str, gap: int | str, lcol: str, rcol: str
) -> DataFrame:
    """Pairs within one session; sessions are built over both inputs of a key."""
    keys = as_list(key)
    both = with_session(_both(left, right, keys, ts, F.col(lcol), F.col(rcol)), keys, ts, gap)
    first = both.filter("_first").select(*keys, "session_start", F.col("_value").alias(lcol))
    second = both.filter(~F.col("_first")).select(
        *keys, "session_start", F.col("_value").alias(rcol)
    )
    return first.join(second, [*keys, "session_start"])


def _held(left, right, keys, ts, gap, seq, item, **kw) -> DataFrame:
    """Both inputs' elements with their place in the session and the counts held so far."""
    both = _both(left, right, keys, ts, F.col(item), F.col(item), seq)
    rules = {
        "fire": scan.run_count(),
        "n_first": scan.run_sum(F.col("_first").cast("long")),
        "n_second": scan.run_sum((~F.col("_first")).cast("long")),
    }
    return scan.running(with_session(both, keys, ts, gap), [*keys, "session_start"], seq, rules, **kw)


def session_cogroup(
    left: DataFrame,
    right: DataFrame,
    key: Keys,
    ts: str,
    gap: int | str,
    seq: str,
    item: str,
    every: int | None = None,
    **kw,
) -> DataFrame:
    """Both groups of a key's session side by side, even when one is empty.

    Without ``every`` the whole session is given once, as one row.  With it the
    session fires at each ``every``-th element; nothing is emptied, so a firing
    gives all elements up to it and firings grow with the session:
    :func:`session_cogroup_steps` gives only what is new.
    """
    keys = as_list(key)
    groups = [*keys, "session_start"]
    if every is None:
        return _listed(_held(left, right, keys, ts, gap, seq, item, **kw), groups)
    # The elements between two firings are listed once; a firing is put together from whole
    # lists, so no element but the firing ones carries content, and each firing is a group of its own.
    steps = session_cogroup_steps(left, right, key, ts, gap, seq, item, every, **kw)
    steps = scan.written(steps, "steps")
    ends = [f"_end_{i}" for i in range(len(groups))]
    last = steps.groupBy(*groups).agg(F.max("fire").alias("_last"))
    last = last.select(*[F.col(g).alias(e) for g, e in zip(groups, ends)], "_last")
    dealt = steps.join(last, scan.same_row(groups, ends)).drop(*ends)
    part = F.struct(F.col("fire").alias("step"), "first_items", "second_items")
    dealt = dealt.select(
        *groups, "n_first", "n_second", part.alias("_part"),
        F.explode(F.sequence(F.col("fire"), F.col("_last"), F.lit(every).cast("long"))).alias("fire"),
    )
    fired = dealt.groupBy(*groups, "fire").agg(
        F.max("n_first").alias("n_first"), F.max("n_second").alias("n_second"),
        F.array_sort(F.collect_list("_part")).alias("_parts"),
    )

    def joined(name: str) -> Column:
        return F.flatten(F.transform("_parts", lambda p: p[name]))

    return fired.withColumns({c: joined(c) for c in ("first_items", "second_items")}).drop("_parts")


def session_cogroup_steps(
    left: DataFrame, right: DataFrame, key: Keys, ts: str, gap: int | str, seq: str, item: str,
    every: int, **kw,
) -> DataFrame:
    """The firings of :func:`session_cogroup` with only the elements since the one before.

    ``n_first`` and ``n_second`` count everything held; the content of a firing
    is the lists of the rows up to it, one after the other.
    """
    keys = as_list(key)
    held = _held(left, right, keys, ts, gap, seq, item, **kw)
    step = floor_div(F.col("fire") + every - 1, every) * every
    out = _listed(held.withColumn("_step", step), [*keys, "session_start", "_step"])
    return out.filter(F.col("fire") == F.col("_step")).drop("_step")


def _listed(held: DataFrame, groups: list[str]) -> DataFrame:
    def items(which: Column) -> Column:
        pairs = F.sort_array(F.collect_list(F.when(which, F.struct("fire", "_value"))))
        return F.transform(pairs, lambda p: p["_value"])

    return held.groupBy(*groups).agg(
        F.max("fire").alias("fire"),
        F.max("n_first").alias("n_first"),
        F.max("n_second").alias("n_second"),
        items(F.col("_first")).alias("first_items"),
        items(~F.col("_first")).alias("second_items"),
    )


def join_then_window(
    left: DataFrame,
    right: DataFrame,
    key: Keys,
    ts: str,
    size: int | str,
    group: Sequence[str],
    value: str,
) -> DataFrame:
    """Windowed sum over a left join, with the window on the left time."""
    keys = as_list(key)
    joined = left.join(_right_keys(right, keys), _equal(keys), "left")
    out = joined.groupBy(window_of(ts, size), *group).agg(F.sum(value).alias("total"))
    return out.select(
        *group,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "total",
    )
