"""Distinct aggregates, OVER frames, ranks and top-N."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.durations import text
from millrace.operators import scan
from millrace.operators.rolling import Keys, as_list


def weighted_avg(value: str | Column, weight: str | Column, sign: str | Column | None = None):
    """Sum(v*w) div Sum(w) in whole numbers, null when the weights sum to 0.

    ``sign`` is +1 for an added row and -1 for a withdrawn one.
    """
    v, w = (F.col(c) if isinstance(c, str) else c for c in (value, weight))
    s = F.lit(1) if sign is None else (F.col(sign) if isinstance(sign, str) else sign)
    top, bottom = F.sum((s * v * w).cast("long")), F.sum((s * w).cast("long"))
    # Whole-number division that truncates towards zero and stays exact for any long.
    return F.when(bottom != 0, F.call_function("div", top, bottom))


def over_rows(
    df: DataFrame, key: Keys, seq: str, before: int, aggs: dict[str, Column], **kw
) -> DataFrame:
    """Aggregates over the ``before`` preceding rows of the key and the current one."""
    keys = as_list(key)
    placed = scan.position(df, keys, seq, name="_pos", **kw)
    out = scan.row_frame(
        placed,
        keys,
        "_pos",
        before,
        lambda framed, _: {name: agg.over(framed) for name, agg in aggs.items()},
    )
    return out.drop("_pos")


def over_distinct(
    df: DataFrame, key: Keys, seq: str, value: str, agg: str, name: str, **kw
) -> DataFrame:
    """sum, count or avg of the distinct values of a key up to the current row.

    Only the first row holding a value counts, so the distinct fold is a plain
    running sum over those rows.  ``seq`` must be unique within a key.
    """
    keys = as_list(key)
    firsts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(seq).alias("_s"))
    firsts = firsts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_s")
    same = F.col(seq) == F.col("_s")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    marked = df.join(firsts, same, "left")
    is_first = F.col("_s").isNotNull()
    rules = {
        "_n": scan.run_sum(is_first.cast("long")),
        "_sum": scan.run_sum(F.when(is_first, F.col(value))),
    }
    out = scan.running(marked, keys, seq, rules, **kw)
    result = {
        "sum": F.col("_sum"),
        "count": F.col("_n"),
        "avg": F.col("_sum") / F.nullif(F.col("_n"), F.lit(0)),
    }[agg]
    return out.select(*df.columns, result.alias(name))


def rank_over(df: DataFrame, key: Keys, order: str, descending: bool = True, name: str = "rank") -> DataFrame:
    """SQL RANK over a numeric column: 1 + the number of rows ordered before.

    Keys of ordinary size take Spark's own rank.  For hot keys equal values are
    counted once per (key, value), so a hot value is one row, the values are cut
    into ranges at splitters that Spark samples, and a value's rank follows from
    the counts of the ranges before and of the values before it in its range.
    Nulls come last in descending order and first in ascending order.
    """
    keys = as_list(key)
    cold, hot, parts = scan.by_size(df, keys)
    ahead = F.col(order).desc() if descending else F.col(order)
    ranked = cold.withColumn(name, F.rank().over(Window.partitionBy(*keys).orderBy(ahead)).cast("long"))
    if hot is None:
        return ranked
    way = -F.col(order) if descending else F.col(order)
    by = ["_last", "_order"]
    rows = hot.withColumns({"_last": F.col(order).isNull() == F.lit(descending), "_order": way})
    counts = rows.groupBy(*keys, *by).agg(F.count("*").alias("_n"))
    before = scan.running(
        scan.in_sorted_parts(counts, [*keys, *by], parts), keys, by, {"_before": scan.run_sum("_n")},
        chunk=F.col("_part"), include_current=False,
    )
    names = [f"_k_{i}" for i in range(len(keys) + 2)]
    before = before.select(
        *[F.col(c).alias(n) for c, n in zip([*keys, *by], names)],
        (F.coalesce("_before", F.lit(0)) + 1).cast("long").alias(name),
    )
    rest = rows.join(before, scan.same_row([*keys, *by], names)).select(*df.columns, name)
    return ranked.select(*df.columns, name).unionByName(rest)


def top_n(df: DataFrame, key: Keys, value: str, n: int, seq: str, name: str = "place"):
    """The n largest per key; a tie goes to the earlier record.

    The row_number filter makes Spark keep n rows per key before the shuffle.
    """
    best = Window.partitionBy(*as_list(key)).orderBy(F.col(value).desc(), F.col(seq))
    return df.withColumn(name, F.row_number().over(best)).filter(F.col(name) <= n)


def distinct_stream(
    df: DataFrame, columns: list[str], ts: str | None = None, bound: int | str | None = None
) -> DataFrame:
    """The first row of each value combination on a stream.

    With ``ts`` and ``bound`` a combination is forgotten once the watermark has
    passed it by the bound, and may then appear again; without them it is kept
    for ever.
    """
    if ts is None:
        return df.dropDuplicates(columns)
    return df.withWatermark(ts, text(bound)).dropDuplicatesWithinWatermark(columns)


def distinct_agg_stream(
    df: DataFrame, key: Keys, value: str, agg: str, ts: str, size, bound, name: str
) -> DataFrame:
    """Distinct aggregate per key and window on a stream: drop repeats, then aggregate."""
    from millrace.operators.windows import window_of

    keys = as_list(key)
    marked = df.withWatermark(ts, text(bound)).withColumn("w", window_of(ts, size))
    once = marked.dropDuplicates([*keys, "w", value])
    grouped = once.groupBy("w", *keys).agg(getattr(F, agg)(value).alias(name))
    return grouped.select(
        *keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), name
    )
