"""Exact late-data rules with one global watermark.

Times here are epoch milliseconds.  The watermark before a record is the
largest time of all earlier records (by ``seq``) minus the bound.  A record is
late for its window once ``window_end - 1 + lateness <= watermark``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import scan
from millrace.operators.rolling import Keys, as_list
from millrace.session import fresh_dir


def window_start(ts: Column, size: int, offset: int = 0) -> Column:
    """Epoch-aligned start of the window holding ``ts``."""
    return ts - F.pmod(ts - F.lit(offset), F.lit(size))


def wm_model(
    df: DataFrame, ts: str, seq: str, bound: int, seen: int | None = None, **kw
) -> DataFrame:
    """Add the watermark before (null at the start) and after each record.

    ``seen`` is the largest time of records that came before ``df``.
    """
    out = scan.running(df, [], seq, {"_top": scan.run_max(ts)}, include_current=False, **kw)
    # greatest() skips nulls, so the start of the data needs no case of its own.
    top = F.greatest(F.col("_top"), F.lit(seen).cast("long"))
    return out.withColumns(
        {"wm_before": top - bound, "wm_after": F.greatest(top, F.col(ts)) - bound}
    ).drop("_top")


def _judged(df: DataFrame, ts: str, seq: str, size: int, bound: int, lateness: int, **kw):
    marked = wm_model(df, ts, seq, bound, **kw).withColumn(
        "window_end", window_start(F.col(ts), size) + size
    )
    last_ms = F.col("window_end") - 1
    return marked.withColumns(
        {
            "_late": F.coalesce(last_ms + lateness <= F.col("wm_before"), F.lit(False)),
            "_after_fire": F.coalesce(last_ms <= F.col("wm_before"), F.lit(False)),
        }
    )


def late_split(
    df: DataFrame,
    ts: str,
    seq: str,
    size: int,
    bound: int,
    lateness: int = 0,
    seen: int | None = None,
    **kw,
) -> tuple[DataFrame, DataFrame]:
    """(accepted, late) records of a tumbling window."""
    judged = _judged(df, ts, seq, size, bound, lateness, seen=seen, **kw)
    kept = [*df.columns, "window_end"]
    return judged.filter(~F.col("_late")).select(*kept), judged.filter("_late").select(*kept)


def _crossings(judged: DataFrame, seq: str, size: int, bound: int) -> DataFrame:
    """(window_end, fired_at): the record that moved the watermark across a
    window's last millisecond.

    A record can cross many ends in one jump, but a window holding data starts
    no later than the largest time seen, which is the watermark plus the bound.
    So only about bound / size ends per record need a look, besides the
    record's own, however far it jumps.
    """
    before, after, own = F.col("wm_before"), F.col("wm_after"), F.col("window_end")
    first = window_start(before + 1, size) + size
    last = F.least(window_start(after + 1, size), window_start(before + bound, size) + size)
    none = F.array().cast("array<bigint>")
    step = F.lit(size).cast("long")
    seen = F.when(first <= last, F.sequence(first, last, step)).otherwise(none)
    crosses_own = (own - 1 <= after) & F.coalesce(own - 1 > before, F.lit(True))
    ends = F.array_union(seen, F.when(crosses_own, F.array(own)).otherwise(none))
    moved = F.coalesce(after > before, F.lit(True))
    return judged.filter(moved).select(
        F.col(seq).alias("fired_at"), F.explode(ends).alias("window_end")
    )


def lateness_step(
    df: DataFrame,
    before: DataFrame | None,
    keys: list[str],
    ts: str,
    seq: str,
    value: str,
    size: int,
    bound: int,
    lateness: int,
    seen: int | None = None,
    **kw,
) -> tuple[DataFrame, DataFrame]:
    """(firings, window totals) of the records in ``df``.

    ``before`` holds the totals (keys, window_end, total, n, firing) of windows
    that earlier records left open.
    """
    groups = [*keys, "window_end"]
    # The watermark is formed once and written; four results are drawn from it.
    judged = _judged(df.select(*keys, ts, seq, value), ts, seq, size, bound, lateness, seen=seen, **kw)
    path = fresh_dir(df.sparkSession, "watermarked")
    judged.write.parquet(path)
    judged = df.sparkSession.read.schema(judged.schema).parquet(path)
    accepted = judged.filter(~F.col("_late"))

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*groups).agg(
            F.sum(value).alias("total"),
            F.count("*").alias("n"),
            F.sum(F.col("_after_fire").cast("long")).alias("firing"),
        )

    def merged(fresh: DataFrame) -> DataFrame:
        if before is None:
            return fresh
        sums = [F.sum(c).alias(c) for c in ("total", "n", "firing")]
        return before.unionByName(fresh).groupBy(*groups).agg(*sums)

    on_time = merged(totals(accepted.filter(~F.col("_after_fire"))))
    first = on_time.join(_crossings(judged, seq, size, bound), "window_end")
    again = scan.running(
        accepted,
        groups,
        seq,
        {
            "total": scan.run_sum(value),
            "n": scan.run_count(),
            "firing": scan.run_sum(F.col("_after_fire").cast("long")),
        },
        start=before,
        **kw,
    ).filter("_after_fire")
    columns = [*groups, "firing", "fired_at", "n", "total"]
    fired = first.select(*columns).unionByName(
        again.withColumnRenamed(seq, "fired_at").select(*columns)
    )
    return fired, merged(totals(accepted))


def allowed_lateness(
    df: DataFrame,
    key: Keys,
    ts: str,
    seq: str,
    value: str,
    size: int,
    bound: int,
    lateness: int = 0,
    **kw,
) -> DataFrame:
    """Every firing of a tumbling sum.

    A window fires first (``firing`` 0) when the watermark reaches its last
    millisecond, over the records that came before; each later accepted record
    fires it again with the whole new sum.  ``fired_at`` is the ``seq`` of the
    record that caused the firing.  Windows never reached do not fire.
    """
    fired, _ = lateness_step(
        df, None, as_list(key), ts, seq, value, size, bound, lateness, **kw
    )
    return fired
