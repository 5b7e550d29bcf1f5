"""The operators on Structured Streaming, held to the same SQL as on tables.

Each query feeds a table to a streaming job in several arrivals with a restart
from the checkpoint in between, and gives back everything the job wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggs, changelog, enrich, joins, rolling, scan, windows
from millrace.plans import state
from millrace.plans.common import arrivals, events, money, ms, of_type
from millrace.plans.ingest import GOOD_LINES_SQL, LINE, SENSOR, change_feed, versions
from millrace.plans.registry import SQL, query
from millrace.plans.rows import SPACES
from millrace.plans.windows import BOUND, HOUR, LATENESS, SIZE
from millrace.plans.replay import feed, newest, replay
from millrace.session import fresh_dir
from millrace.sinks import rolling as rolled
from millrace.sources import ingest
from millrace.sources.tables import load
from millrace.streaming import batches, keyed, run, timers
from millrace.streaming import joins as stream_joins


def _fed(spark, sf_dir, transform, *columns, mode="append", **kw):
    table = events(spark, sf_dir).select(*columns)
    return replay(spark, {"events": (table, "event_id")}, transform, mode, **kw)


@query(
    "line_stream",
    f"""SELECT event_id, user_id AS id, epoch_us(ts) // 1000 AS ts_ms, value AS temperature
        FROM events WHERE {GOOD_LINES_SQL}""",
)
def line_stream(spark, sf_dir):
    """Text files arriving in a folder, parsed as they come."""
    path = fresh_dir(spark, "lines")
    lines = events(spark, sf_dir).selectExpr(f"concat(event_id, '|', {LINE}) AS value")
    lines.write.text(f"{path}/in")
    stream = ingest.lines(spark, f"{path}/in", streaming=True, files_per_batch=100)
    fields = stream.select(
        F.substring_index("value", "|", 1).cast("long").alias("event_id"),
        F.substring_index("value", "|", -1).alias("value"),
    )
    good, _ = ingest.parse_delimited(fields, SENSOR, on_error="drop")
    run.drain(good, batches.folder_sink(f"{path}/out"), f"{path}/checkpoint", "append")
    return spark.read.schema(good.schema).option("recursiveFileLookup", True).parquet(f"{path}/out")


# --- built-in streaming aggregates and joins ---------------------------------


@query("stream_word_count", SQL["word_count"])
def stream_word_count(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    written = replay(
        spark,
        {"documents": (docs, "doc_id")},
        lambda s: rolling.word_count(s, "text", SPACES),
        mode="update",
    )
    return newest(written, ["word"])


@query("stream_tumbling_sum", SQL["tumbling_sum"])
def stream_tumbling_sum(spark, sf_dir):
    def transform(stream):
        total = [F.sum("value").alias("total")]
        return windows.window_agg(stream, "user_id", "ts", "1 hour", total, bound="1 hour")

    written = _fed(
        spark, sf_dir, transform, "event_id", "user_id", "ts", "value", mode="update"
    )
    last = newest(written, ["user_id", "window_start"])
    return last.select("user_id", ms("window_start"), money("total", "total"))


@query("stream_sliding_sum", SQL["sliding_sum"])
def stream_sliding_sum(spark, sf_dir):
    def transform(stream):
        return windows.window_agg(
            stream, "user_id", "ts", "6 hours", [F.sum("value").alias("total")],
            slide="2 hours", bound="1 hour",
        )

    written = _fed(
        spark, sf_dir, transform, "event_id", "user_id", "ts", "value", mode="update"
    )
    last = newest(written, ["user_id", "window_start"])
    return last.select("user_id", ms("window_start"), money("total", "total"))


# In append mode a window or session appears once the watermark has passed it.
_FAR = "2100-01-01 00:00:00"
_CLOSING = {"events": {"event_id": 1 << 60, "user_id": -1, "ts": _FAR}}


@query("stream_session_agg", SQL["session_agg"])
def stream_session_agg(spark, sf_dir):
    fields = {"n": ("count", "value"), "total": ("sum", "value"), "top": ("max", "value")}
    written = _fed(
        spark,
        sf_dir,
        lambda s: windows.session_agg(s, "user_id", "ts", "6 hours", fields, bound="1 hour"),
        "event_id", "user_id", "ts", "value", closing=_CLOSING,
    )
    return written.select(
        "user_id", ms("session_start"), ms("session_end"), "n", money("total", "total"), "top"
    )


@query("stream_consecutive_windows", SQL["consecutive_windows"])
def stream_consecutive_windows(spark, sf_dir):
    """The sums of a window all arrive in the batch that closes it, and are ranked there."""
    amount = F.col("value").cast("decimal(20, 6)").alias("value")
    table = events(spark, sf_dir).select("event_id", "user_id", "ts", amount)

    def transform(stream):
        total = [F.sum("value").alias("total")]
        return windows.window_agg(stream, "user_id", "ts", "1 day", total, bound="1 hour")

    base, out = feed(
        spark,
        {"events": (table, "event_id")},
        transform,
        lambda base: batches.ranked_batches(
            ["window_start", "window_end"], "total", "user_id", batches.folder_sink(f"{base}/out")
        ),
        closing=_CLOSING,
    )
    schema = out.schema.add("place", "long").add("batch", "long")
    written = spark.read.schema(schema).parquet(f"{base}/out")
    return written.select("user_id", ms("window_start"), F.col("total").cast("double"), "place")


def _session_sides(spark, sf_dir):
    table = events(spark, sf_dir).filter("event_type IN ('click', 'purchase')")
    return table.select("event_id", "user_id", "event_type", "ts")


def _session_lists(spark, sf_dir, gather):
    def transform(stream):
        first = F.col("event_type") == "click"
        return gather(stream, "user_id", "ts", "12 hours", "event_id", "event_id", first, bound="1 hour")

    return replay(
        spark, {"events": (_session_sides(spark, sf_dir), "event_id")}, transform, closing=_CLOSING
    )


@query("stream_window_join_session", SQL["window_join_session"])
def stream_window_join_session(spark, sf_dir):
    written = _session_lists(spark, sf_dir, stream_joins.session_join_stream)
    return written.select(
        "user_id", ms("session_start"), F.col("first_item").alias("c_id"),
        F.col("second_item").alias("p_id"),
    )


@query("stream_cogroup_session", SQL["cogroup_session"])
def stream_cogroup_session(spark, sf_dir):
    def gather(stream, *args, **kw):
        return stream_joins.session_cogroup_stream(stream, *args, every=5, **kw)

    written = _session_lists(spark, sf_dir, gather)
    return written.select(
        "user_id", ms("session_start"), "fire", "n_first", "n_second",
        F.array_join("first_items", ",").alias("first_items"),
        F.array_join("second_items", ",").alias("second_items"),
    )


@query(
    "stream_window_upsert",
    f"""SELECT user_id, window_start, total FROM (
          SELECT user_id, {HOUR} AS window_start, round(sum(value), 6) AS total
          FROM events GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY window_start DESC) = 1""",
)
def stream_window_upsert(spark, sf_dir):
    """Each batch's window results are upserted by key: a key keeps its newest window."""

    def transform(stream):
        total = [F.sum("value").alias("total")]
        return windows.window_agg(stream, "user_id", "ts", "1 hour", total, bound="1 hour")

    def upserts(base):
        sink = batches.folder_sink(f"{base}/out")
        return lambda batch, batch_id: sink(
            changelog.upsert_latest(batch, "user_id", "window_start"), batch_id
        )

    table = events(spark, sf_dir).select("event_id", "user_id", "ts", "value")
    base, out = feed(
        spark, {"events": (table, "event_id")}, transform, upserts, mode="update"
    )
    written = spark.read.schema(out.schema.add("batch", "long")).parquet(f"{base}/out")
    last = newest(written, ["user_id"])
    return last.select("user_id", ms("window_start"), money("total", "total"))


@query(
    "stream_window_sum_distinct",
    SQL["window_sum_distinct"],
)
def stream_window_sum_distinct(spark, sf_dir):
    def transform(stream):
        return aggs.distinct_agg_stream(
            stream, "event_type", "whole", "sum", "ts", "1 day", "1 hour", "total"
        )

    table = events(spark, sf_dir).select(
        "event_id", "event_type", "ts", F.floor("value").cast("long").alias("whole")
    )
    written = replay(spark, {"events": (table, "event_id")}, transform, mode="update")
    last = newest(written, ["event_type", "window_start"])
    return last.select("event_type", ms("window_start"), "total")


@query("stream_distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def stream_distinct_rows(spark, sf_dir):
    columns = ["user_id", "event_type"]
    written = _fed(
        spark, sf_dir, lambda s: aggs.distinct_stream(s, columns), "event_id", *columns
    )
    return written.select(*columns)


def _sides(spark, sf_dir):
    return {
        "clicks": (of_type(spark, sf_dir, "click", "c"), "c_id"),
        "buys": (of_type(spark, sf_dir, "purchase", "p"), "p_id"),
    }


@query("stream_interval_join", SQL["interval_join"])
def stream_interval_join(spark, sf_dir):
    def transform(clicks, buys):
        return joins.interval_join(
            clicks.withWatermark("c_ts", "1 hour"), buys.withWatermark("p_ts", "1 hour"),
            "user_id", "c_ts", "p_ts", "-12 hours", "12 hours",
        )

    written = replay(spark, _sides(spark, sf_dir), transform)
    return written.select("user_id", "c_id", "p_id")


@query("stream_interval_join_left", SQL["interval_join_left"])
def stream_interval_join_left(spark, sf_dir):
    """A click without purchase appears once no purchase can match any more."""

    def transform(clicks, buys):
        return joins.interval_join(
            clicks.withWatermark("c_ts", "1 hour"), buys.withWatermark("p_ts", "1 hour"),
            "user_id", "c_ts", "p_ts", "-12 hours", "0 hours", how="left",
        )

    closing = {
        "clicks": {"user_id": -1, "c_id": 1 << 60, "c_ts": _FAR},
        "buys": {"user_id": -2, "p_id": 1 << 60, "p_ts": _FAR},
    }
    written = replay(spark, _sides(spark, sf_dir), transform, closing=closing)
    return written.select("user_id", "c_id", F.col("p_id").cast("double"))


@query("stream_broadcast_enrich", SQL["broadcast_enrich"])
def stream_broadcast_enrich(spark, sf_dir):
    """Each micro-batch meets the dimension as it is at that time."""

    def load_dim():
        return versions(spark, sf_dir)

    path = fresh_dir(spark, "enriched")
    table = events(spark, sf_dir).select("user_id", "event_id", "event_type")
    table.write.parquet(f"{path}/in")
    stream = spark.readStream.schema(table.schema).parquet(f"{path}/in")
    writer = enrich.broadcast_enrich(
        stream, load_dim, "user_id", refresh_seconds=30, sink=batches.folder_sink(f"{path}/out"),
        order="version",
    )
    job = writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    job.start().awaitTermination()
    out = enrich.config_join(table, load_dim(), "user_id", "version")
    return spark.read.schema(out.schema).option("recursiveFileLookup", True).parquet(f"{path}/out")


@query("stream_semi_join", SQL["semi_in_subquery"])
def stream_semi_join(spark, sf_dir):
    dim = load(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    written = replay(
        spark,
        {"orders": (orders, "o_orderkey")},
        lambda s: s.join(dim, F.col("o_custkey") == F.col("c_custkey"), "left_semi"),
    )
    return written.select("o_orderkey", "o_totalprice")


# --- keyed state -------------------------------------------------------------


@query("stream_rolling_reduce", SQL["rolling_reduce"])
def stream_rolling_reduce(spark, sf_dir):
    table = events(spark, sf_dir).select("user_id", "event_id", "event_type", ms("ts"), "value")
    rules = {"event_type": "first", "ts": "last", "value": "sum"}
    written = replay(
        spark,
        {"events": (table, "event_id")},
        lambda s: keyed.rolling_reduce_stream(s, "user_id", "event_id", **rules),
    )
    return written.drop("batch").withColumn("value", F.round("value", 6))


@query(
    "stream_rolling_fold",
    """SELECT user_id, event_id, concat(seen, ':', newest) AS acc FROM (
         SELECT user_id, event_id, event_type AS newest,
                sum(length(event_type)) OVER (PARTITION BY user_id ORDER BY event_id
                  ROWS UNBOUNDED PRECEDING) AS seen FROM events)""",
)
def stream_rolling_fold(spark, sf_dir):
    """Any function of (accumulator, record): total text length and newest text."""

    def fn(acc, row):
        seen = int(acc.split(":")[0]) + len(row["event_type"])
        return f"{seen}:{row['event_type']}"

    return _fed(
        spark,
        sf_dir,
        lambda s: keyed.rolling_fold_stream(s, "user_id", "event_id", "0:", fn, "acc string"),
        "event_id", "user_id", "event_type",
    ).drop("batch")


@query("stream_rolling_max_by", "SELECT user_id, event_id, value, event_type FROM (" + SQL["rolling_max_by"] + ")")
def stream_rolling_max_by(spark, sf_dir):
    return _fed(
        spark,
        sf_dir,
        lambda s: keyed.rolling_extreme_stream(s, "user_id", "value", "event_id"),
        "user_id", "event_id", "value", "event_type",
    ).drop("batch")


@query("stream_over_sum_rows", SQL["over_sum_rows"])
def stream_over_sum_rows(spark, sf_dir):
    written = _fed(
        spark,
        sf_dir,
        lambda s: keyed.last_n_stream(s, "user_id", "event_id", "value", 3),
        "event_id", "user_id", "value",
    )
    return written.select("event_id", "user_id", money("sum_value", "total"))


@query("stream_count_tumbling", SQL["count_tumbling"])
def stream_count_tumbling(spark, sf_dir):
    written = _fed(
        spark,
        sf_dir,
        lambda s: keyed.count_window_stream(s, "user_id", "event_id", "value", 3),
        "event_id", "user_id", "value",
    )
    return written.select("user_id", "fire", money("total", "total"))


@query("stream_count_sliding", SQL["count_sliding"])
def stream_count_sliding(spark, sf_dir):
    written = _fed(
        spark,
        sf_dir,
        lambda s: keyed.count_window_stream(s, "user_id", "event_id", "value", 5, slide=2),
        "event_id", "user_id", "value",
    )
    return written.select("user_id", "fire", "n", money("total", "total"))


@query("stream_trigger_count", SQL["trigger_count"])
def stream_trigger_count(spark, sf_dir):
    def transform(stream):
        keyed_rows = stream.withColumn("day", F.window("ts", "1 day").start)
        return keyed.fire_every_stream(keyed_rows, ["event_type", "day"], "event_id", "value", 5)

    written = _fed(spark, sf_dir, transform, "event_id", "event_type", "ts", "value")
    return written.select("event_type", "event_id", "n", money("total", "total"))


@query("stream_retract_group_sum", SQL["retract_group_sum"])
def stream_retract_group_sum(spark, sf_dir):
    return replay(
        spark,
        {"events": (state.whole_values(spark, sf_dir), "event_id")},
        lambda s: keyed.retract_group_stream(s, "user_id", "value", "event_id"),
    ).drop("batch")


@query("stream_top_n_changelog", SQL["top_n_changelog"])
def stream_top_n_changelog(spark, sf_dir):
    return _fed(
        spark,
        sf_dir,
        lambda s: keyed.top_n_stream(s, "user_id", "value", "event_id", 3),
        "event_id", "user_id", "value",
    ).drop("batch")


@query("stream_jump_alert", SQL["jump_alert"])
def stream_jump_alert(spark, sf_dir):
    return _fed(
        spark,
        sf_dir,
        lambda s: keyed.jump_alert_stream(s, "user_id", "event_id", "value", 30.0, first="zero"),
        "event_id", "user_id", "value",
    ).drop("batch")


@query("stream_pattern_times", SQL["pattern_times"])
def stream_pattern_times(spark, sf_dir):
    def transform(stream):
        hits = stream.withColumn("hit", F.col("value") > 23)
        return keyed.pattern_times_stream(hits, "user_id", "event_id", "hit", 2)

    return _fed(spark, sf_dir, transform, "event_id", "user_id", "value").drop("batch")


@query("stream_pattern_times_strict", SQL["pattern_times_strict"])
def stream_pattern_times_strict(spark, sf_dir):
    def transform(stream):
        hits = stream.withColumn("hit", F.col("value") > 23)
        return keyed.pattern_times_stream(
            hits, "user_id", "event_id", "hit", 3, ts="ts", strict=True, within="24 hours"
        )

    return _fed(spark, sf_dir, transform, "event_id", "user_id", "ts", "value").drop("batch")


def _alerts(spark, sf_dir, direction, ttl=None):
    def transform(stream):
        return timers.trend_alert_stream(
            stream, "user_id", "ts", "value", "4 hours", "event_id", direction,
            bound="0 seconds", ttl=ttl,
        )

    written = _fed(
        spark, sf_dir, transform, "event_id", "user_id", "ts", "value", closing=_CLOSING
    )
    return written.select("user_id", ms("armed_at"), ms("alert_at"))


@query("stream_rising_alert", state.all_alerts_sql(""))
def stream_rising_alert(spark, sf_dir):
    return _alerts(spark, sf_dir, "rising")


@query("stream_falling_alert", state.all_alerts_sql("-"))
def stream_falling_alert(spark, sf_dir):
    return _alerts(spark, sf_dir, "falling")


@query("stream_falling_alert_ttl", state.all_alerts_sql("-", ttl_us=43_200_000_000))
def stream_falling_alert_ttl(spark, sf_dir):
    """A value is forgotten twelve hours after it came."""
    return _alerts(spark, sf_dir, "falling", ttl="12 hours")


@query("stream_join_left_changelog", SQL["join_left_changelog"])
def stream_join_left_changelog(spark, sf_dir):
    left, right = state.order_sides(spark, sf_dir)
    written = replay(
        spark,
        {"orders": (left, "lseq"), "lines": (right, "rseq")},
        lambda l, r: stream_joins.changelog_left_join_stream(
            l, r, "o_orderkey", "lseq", "rseq", ttl=None
        ),
    )
    return written.drop("batch").withColumn("rseq", F.col("rseq").cast("double"))


@query(
    "stream_item_counts",
    """SELECT user_id, event_type, event_id, count(*) OVER (
         PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events""",
)
def stream_item_counts(spark, sf_dir):
    """A map per key: how often each kind of event has come."""
    return _fed(
        spark,
        sf_dir,
        lambda s: keyed.item_counts_stream(s, "user_id", "event_type", "event_id"),
        "event_id", "user_id", "event_type",
    ).drop("batch")


@query(
    "stream_window_content",
    f"""SELECT event_type, {HOUR} AS window_start, row_number() OVER (
          PARTITION BY event_type, {HOUR} ORDER BY event_id) AS place, value AS item FROM events""",
)
def stream_window_content(spark, sf_dir):
    """A list per key and window, given in order when the window closes."""
    closing = {"events": {"event_id": 1 << 60, "event_type": "closing", "ts": _FAR}}
    written = _fed(
        spark,
        sf_dir,
        lambda s: timers.window_content_stream(s, "event_type", "ts", "1 hour", "event_id", "value", bound="1 hour"),
        "event_id", "event_type", "ts", "value", closing=closing,
    )
    return written.select("event_type", ms("window_start"), "place", "item")


@query("stream_cdc_snapshot", SQL["cdc_snapshot"])
def stream_cdc_snapshot(spark, sf_dir):
    """Changes arrive out of order, some of them twice; a restart comes in between."""
    feed = change_feed(spark, sf_dir)
    arrival = F.pmod(F.xxhash64("seq"), F.lit(1 << 20))
    again = feed.filter("seq % 5 = 0").withColumn("arrival", F.pmod(arrival * 7, F.lit(1 << 20)))
    written = replay(
        spark,
        {"changes": (feed.withColumn("arrival", arrival).unionByName(again), "arrival")},
        lambda s: changelog.newest_changes(s.drop("arrival"), "id", "seq"),
        mode="update",
        rounds=3,
    )
    return changelog.snapshot(written.drop("batch"), "id", "seq", "op")


@query("stream_change_totals", SQL["change_totals"])
def stream_change_totals(spark, sf_dir):
    """Totals over the changelog of a left join, as both sides arrive."""
    left, right = state.order_sides(spark, sf_dir)

    def transform(orders, lines):
        changes = stream_joins.changelog_left_join_stream(orders, lines, "o_orderkey", "lseq", "rseq", ttl=None)
        return keyed.change_totals_stream(changes, "o_orderkey", "l_quantity")

    written = replay(spark, {"orders": (left, "lseq"), "lines": (right, "rseq")}, transform)
    return newest(written, ["o_orderkey"])


def _evicted(spark, sf_dir, **keep):
    def transform(stream):
        return timers.evict_stream(stream, "event_type", "ts", "1 day", "event_id", "value", bound="1 hour", **keep)

    closing = {"events": {"event_id": 1 << 60, "event_type": "closing", "ts": _FAR}}
    written = _fed(spark, sf_dir, transform, "event_id", "event_type", "ts", "value", closing=closing)
    return written.select("event_type", ms("window_start"), "n", money("total", "total"))


@query("stream_evict_last_n", SQL["evict_last_n"])
def stream_evict_last_n(spark, sf_dir):
    return _evicted(spark, sf_dir, keep_n=10)


@query("stream_evict_within", SQL["evict_within"])
def stream_evict_within(spark, sf_dir):
    return _evicted(spark, sf_dir, keep_within="2 hours")


@query("stream_bucketed_files", SQL["bucketed_files"])
def stream_bucketed_files(spark, sf_dir):
    """Lines in files of a day's bucket, rolled at 64 kB here, written in several batches."""
    path = fresh_dir(spark, "rolled")
    table = events(spark, sf_dir).select("ts", F.col("value").cast("string").alias("value"))
    table.write.option("maxRecordsPerFile", 20_000).parquet(f"{path}/in")
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    writer = rolled.rolling_stream(
        stream, f"{path}/out", f"{path}/checkpoint", "ts", "value", "yyyy-MM-dd--'00'", roll_bytes=1 << 16
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    lines = rolled.read_rolled(spark, f"{path}/out")
    total = F.round(F.sum(F.col("value").cast("double")), 6).alias("total")
    return lines.groupBy("bucket").agg(F.count("*").alias("n"), total)


# --- foreachBatch with a state table -----------------------------------------


@query("stream_rolling_sum", SQL["rolling_sum"])
def stream_rolling_sum(spark, sf_dir):
    table = events(spark, sf_dir).select("user_id", "event_id", "value")
    rules = {"total": scan.run_sum("value")}
    base, out = feed(
        spark,
        {"events": (table, "event_id")},
        lambda s: s,
        lambda base: batches.running_batches(
            "user_id", "event_id", rules, f"{base}/state", batches.folder_sink(f"{base}/out")
        ),
    )
    schema = "user_id long, event_id long, total double, batch long"
    written = spark.read.schema(schema).parquet(f"{base}/out")
    return written.select("user_id", "event_id", money("total", "total"))


@query("stream_late_split", SQL["late_split"])
def stream_late_split(spark, sf_dir):
    table = arrivals(spark, sf_dir).select("event_id", "seq", "ts_ms")
    base, _ = feed(
        spark,
        {"events": (table, "seq")},
        lambda s: s,
        lambda base: batches.late_split_batches(
            "ts_ms", "seq", SIZE, BOUND, LATENESS, f"{base}/state",
            on_time=batches.folder_sink(f"{base}/kept"),
            late=batches.folder_sink(f"{base}/late"),
        ),
    )
    schema = "event_id long, window_end long, batch long"
    kept = spark.read.schema(schema).parquet(f"{base}/kept").withColumn("route", F.lit("kept"))
    late = spark.read.schema(schema).parquet(f"{base}/late").withColumn("route", F.lit("late"))
    return kept.unionByName(late).select("event_id", "window_end", "route")


@query("stream_allowed_lateness", SQL["allowed_lateness"])
def stream_allowed_lateness(spark, sf_dir):
    table = arrivals(spark, sf_dir).select("event_type", "seq", "ts_ms", "value")
    base, _ = feed(
        spark,
        {"events": (table, "seq")},
        lambda s: s,
        lambda base: batches.allowed_lateness_batches(
            "event_type", "ts_ms", "seq", "value", SIZE, BOUND, LATENESS, f"{base}/state",
            batches.folder_sink(f"{base}/out"),
        ),
        rounds=3,
    )
    schema = (
        "event_type string, window_end long, firing long, fired_at long, n long, "
        "total double, batch long"
    )
    written = spark.read.schema(schema).parquet(f"{base}/out")
    return written.drop("batch").withColumn("total", F.round("total", 6))

