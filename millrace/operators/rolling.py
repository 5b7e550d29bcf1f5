"""Keyed operators that give one updated result per arriving record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.arith import floor_div
from millrace.operators import scan

Keys = str | Sequence[str]


def as_list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def rolling_sum(df, key: Keys, value: str, seq: str, name: str | None = None, **kw) -> DataFrame:
    return scan.running(df, as_list(key), seq, {name or value: scan.run_sum(value)}, **kw)


def rolling_count(df, key: Keys, seq: str, name: str = "n", **kw) -> DataFrame:
    return scan.running(df, as_list(key), seq, {name: scan.run_count()}, **kw)


def _extreme(df, key: Keys, value: str, seq: str, kind, **kw) -> DataFrame:
    """Only the compared field moves; every other field stays as in the first record."""
    keys = as_list(key)
    others = [c for c in df.columns if c not in {*keys, value, seq}]
    rules = {value: kind(value), **{c: scan.run_first(c) for c in others}}
    return scan.running(df, keys, seq, rules, **kw).select(*df.columns)


def rolling_max(df, key: Keys, value: str, seq: str, **kw) -> DataFrame:
    """Running maximum over a row that may never have existed; see rolling_max_by."""
    return _extreme(df, key, value, seq, scan.run_max, **kw)


def rolling_min(df, key: Keys, value: str, seq: str, **kw) -> DataFrame:
    return _extreme(df, key, value, seq, scan.run_min, **kw)


def _extreme_row(df, key: Keys, value: str, seq: str, kind, sign: int, **kw) -> DataFrame:
    """The whole record holding the extreme; on a tie the earlier record stays."""
    keys = as_list(key)
    rest = [c for c in df.columns if c not in {*keys, seq, value}]
    # Nulls never win: they are kept out of the fold instead of being ordered.
    record = F.when(
        F.col(value).isNotNull(),
        F.struct(F.col(value), (F.lit(sign) * F.col(seq)).alias("_s"), *rest),
    )
    out = scan.running(df, keys, seq, {"_best": kind(record)}, **kw)
    picked = {c: F.col(f"_best.{c}") for c in [value, *rest]}
    return out.select(
        *[picked.get(c, F.col(c)).alias(c) for c in df.columns],
        (F.lit(sign) * F.col("_best._s")).alias(f"best_{seq}"),
    )


def rolling_max_by(df, key: Keys, value: str, seq: str, **kw) -> DataFrame:
    return _extreme_row(df, key, value, seq, scan.run_max, -1, **kw)


def rolling_min_by(df, key: Keys, value: str, seq: str, **kw) -> DataFrame:
    return _extreme_row(df, key, value, seq, scan.run_min, 1, **kw)


_RULES = {
    "first": scan.run_first,
    "last": scan.run_last,
    "sum": scan.run_sum,
    "min": scan.run_min,
    "max": scan.run_max,
}


def rolling_reduce(df, key: Keys, seq: str, chunk: int | Column | None = None, **rules: str):
    """Fold each named column by first, last, sum, min or max."""
    folds = {c: _RULES[rule](c) for c, rule in rules.items()}
    return scan.running(df, as_list(key), seq, folds, chunk=chunk)


def rolling_fold(
    df: DataFrame, key: Keys, value: str, seq: str, init: str, sep: str = "_", name: str = "acc"
) -> DataFrame:
    """The accumulated text after each record: init, then all values of the key so far.

    The text grows with every record, so a key's output is quadratic in its
    records; :func:`rolling_fold_segments` bounds it.
    """
    so_far = Window.partitionBy(*as_list(key)).orderBy(seq)
    so_far = so_far.rowsBetween(Window.unboundedPreceding, 0)
    values = F.collect_list(F.col(value).cast("string")).over(so_far)
    return df.withColumn(name, F.concat_ws(sep, F.lit(init), values))


def rolling_fold_segments(
    df: DataFrame,
    key: Keys,
    value: str,
    seq: str,
    init: str,
    segment: int,
    sep: str = "_",
    name: str = "acc",
    **kw,
) -> DataFrame:
    """Like :func:`rolling_fold`, with a text that starts anew after ``segment`` records.

    ``segment_no`` counts the segments of a key; the full text of a record is the
    last text of every earlier segment joined with its own.
    """
    keys = as_list(key)
    placed = scan.position(df, keys, seq, name="_pos", **kw).withColumn(
        "segment_no", floor_div(F.col("_pos") - 1, segment)
    )
    so_far = (
        Window.partitionBy(*keys, "segment_no")
        .orderBy("_pos")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    start = F.when(F.col("segment_no") == 0, F.lit(init))
    text = F.concat_ws(sep, start, F.collect_list(F.col(value).cast("string")).over(so_far))
    return placed.withColumn(name, text).drop("_pos")


def word_count(df: DataFrame, text: str, sep: str = r"\s+") -> DataFrame:
    words = F.explode(F.split(F.col(text), sep)).alias("word")
    return df.select(words).filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


def multi_key_sum(df: DataFrame, keys: Sequence[str], value: str, name: str = "total"):
    return df.groupBy(*keys).agg(F.sum(value).alias(name))
