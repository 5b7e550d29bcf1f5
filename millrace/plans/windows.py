"""Time, session and count windows, triggers, evictors and late data."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import latedata, scan, windows
from millrace.plans.common import (
    ARRIVALS_SQL,
    HOUR_MS,
    MINUTE_MS,
    arrivals,
    bucket,
    events,
    money,
    ms,
)
from millrace.plans.registry import query
from millrace.plans.tables import _sessions_sql

HOUR = bucket("1 hour")


def _hourly(spark, sf_dir, *aggs, key="user_id", size="1 hour", **kw):
    return windows.window_agg(events(spark, sf_dir), key, "ts", size, list(aggs), **kw)


@query(
    "tumbling_sum",
    f"SELECT user_id, {HOUR} AS window_start, round(sum(value), 6) AS total FROM events GROUP BY ALL",
)
def tumbling_sum(spark, sf_dir):
    out = _hourly(spark, sf_dir, money(F.sum("value"), "total"))
    return out.select("user_id", ms("window_start"), "total")


@query(
    "tumbling_reduce",
    f"""SELECT user_id, {HOUR} AS window_start, min(epoch_us(ts) // 1000) AS first_ts,
               round(sum(value), 6) AS total FROM events GROUP BY ALL""",
)
def tumbling_reduce(spark, sf_dir):
    out = _hourly(
        spark, sf_dir, F.min_by("ts", "event_id").alias("first_ts"), money(F.sum("value"), "total")
    )
    return out.select("user_id", ms("window_start"), ms("first_ts"), "total")


@query(
    "tumbling_offset",
    f"""SELECT user_id, {bucket('1 day', offset='16 hours')} AS window_start,
               count(*) AS n FROM events GROUP BY ALL""",
)
def tumbling_offset(spark, sf_dir):
    """Days of a zone eight hours ahead of UTC."""
    out = _hourly(spark, sf_dir, F.count("*").alias("n"), size="1 day", offset="-8 hours")
    return out.select("user_id", ms("window_start"), "n")


_SLIDES = f"""SELECT user_id, value, event_id, ts,
                     {bucket('2 hours')} - back * 7200000 AS window_start
              FROM events, (SELECT unnest([0, 1, 2]) AS back)"""


@query(
    "sliding_sum",
    f"""SELECT user_id, window_start, round(sum(value), 6) AS total FROM ({_SLIDES})
        GROUP BY user_id, window_start""",
)
def sliding_sum(spark, sf_dir):
    out = _hourly(
        spark, sf_dir, money(F.sum("value"), "total"), size="6 hours", slide="2 hours"
    )
    return out.select("user_id", ms("window_start"), "total")


@query(
    "sliding_reduce",
    f"""SELECT user_id, window_start, max(epoch_us(ts) // 1000) AS last_ts,
               round(sum(value), 6) AS total
        FROM ({_SLIDES}) GROUP BY user_id, window_start""",
)
def sliding_reduce(spark, sf_dir):
    out = _hourly(
        spark,
        sf_dir,
        F.max_by("ts", "event_id").alias("last_ts"),
        money(F.sum("value"), "total"),
        size="6 hours",
        slide="2 hours",
    )
    return out.select("user_id", ms("window_start"), ms("last_ts"), "total")


@query(
    "session_agg",
    f"""WITH {_sessions_sql('events', '6 hours')}
        SELECT user_id, session_start, (epoch_us(max(ts)) + 21600000000) // 1000 AS session_end,
               count(*) AS n, round(sum(value), 6) AS total, max(value) AS top
        FROM sessions GROUP BY user_id, session_start""",
)
def session_agg(spark, sf_dir):
    aggs = {"n": ("count", "value"), "total": ("sum", "value"), "top": ("max", "value")}
    out = windows.session_agg(events(spark, sf_dir), "user_id", "ts", "6 hours", aggs)
    return out.select(
        "user_id", ms("session_start"), ms("session_end"), "n", money("total", "total"), "top"
    )


@query(
    "count_tumbling",
    """SELECT user_id, (pos + 2) // 3 * 3 AS fire, round(sum(value), 6) AS total
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos
             FROM events)
       GROUP BY user_id, fire HAVING count(*) = 3""",
)
def count_tumbling(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "value")
    out = windows.count_window(rows, "user_id", "event_id", 3, {"total": F.sum("value")})
    return out.withColumn("total", F.round("total", 6))


@query(
    "count_sliding",
    """SELECT user_id, pos AS fire, n, total FROM (
         SELECT user_id, row_number() OVER o AS pos, count(*) OVER w AS n,
                round(sum(value) OVER w, 6) AS total
         FROM events
         WINDOW o AS (PARTITION BY user_id ORDER BY event_id),
                w AS (PARTITION BY user_id ORDER BY event_id ROWS 4 PRECEDING))
       WHERE pos % 2 = 0""",
)
def count_sliding(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "value")
    aggs = {"n": F.count("*"), "total": F.sum("value")}
    out = windows.count_window(rows, "user_id", "event_id", 5, aggs, slide=2)
    return out.withColumn("total", F.round("total", 6))


@query(
    "window_min",
    f"SELECT user_id, {HOUR} AS window_start, min(value) AS low FROM events GROUP BY ALL",
)
def window_min(spark, sf_dir):
    out = _hourly(spark, sf_dir, F.min("value").alias("low"))
    return out.select("user_id", ms("window_start"), "low")


@query(
    "window_avg_trunc",
    f"""SELECT event_type, {bucket('1 day')} AS window_start,
               cast(sum(cast(floor(value) AS BIGINT)) // count(*) AS DOUBLE) AS avg_value
        FROM events GROUP BY ALL""",
)
def window_avg_trunc(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("whole", F.floor("value").cast("long"))
    out = windows.window_avg_trunc(rows, "event_type", "ts", "1 day", "whole")
    return out.select("event_type", ms("window_start"), "avg_value")


@query(
    "window_avg_end",
    f"""SELECT event_type, {bucket('1 day')} + 86400000 AS window_end,
               cast(sum(cast(trunc(value) AS BIGINT)) // count(*) AS DOUBLE) AS avg_value
        FROM events GROUP BY ALL""",
)
def window_avg_end(spark, sf_dir):
    out = windows.window_avg_trunc(
        events(spark, sf_dir), "event_type", "ts", "1 day", "value", cast_first=True
    )
    return out.select("event_type", ms("window_end"), "avg_value")


@query(
    "window_count",
    f"SELECT user_id, {HOUR} AS window_start, count(*) AS n FROM events GROUP BY ALL",
)
def window_count(spark, sf_dir):
    out = _hourly(spark, sf_dir, F.count("*").alias("n"))
    return out.select("user_id", ms("window_start"), "n")


@query(
    "window_reduce_format",
    f"""SELECT concat_ws(chr(9), user_id, window_start, total) AS line FROM (
          SELECT user_id, {HOUR} AS window_start,
                 cast(round(sum(value) * 100, 0) AS BIGINT) AS total FROM events GROUP BY ALL)""",
)
def window_reduce_format(spark, sf_dir):
    cents = F.round(F.sum("value") * 100, 0).cast("long").alias("cents")
    out = _hourly(spark, sf_dir, cents)
    line = F.concat_ws("\t", "user_id", F.unix_millis("window_start"), "cents")
    return out.select(line.alias("line"))


def _list_sql(keys: str) -> str:
    return f"""SELECT {keys} {HOUR} AS window_start, concat(event_id, ':', event_type) AS item,
              row_number() OVER (PARTITION BY {keys} {HOUR} ORDER BY event_id) AS place FROM events"""


def _item():
    return F.concat_ws(":", "event_id", "event_type")


@query("window_all_list", _list_sql(""))
def window_all_list(spark, sf_dir):
    out = windows.window_list(events(spark, sf_dir), "ts", "1 hour", "event_id", _item())
    return out.select(ms("window_start"), "place", "item")


@query("hot_items", _list_sql("user_id,"))
def hot_items(spark, sf_dir):
    out = windows.window_list(
        events(spark, sf_dir), "ts", "1 hour", "event_id", _item(), key="user_id"
    )
    return out.select("user_id", ms("window_start"), "place", "item")


@query(
    "trigger_per_element",
    f"""SELECT user_id, event_id, {bucket('1 day')} + 86400000 AS window_end,
               round(avg(value) OVER (PARTITION BY user_id, {bucket('1 day')} ORDER BY event_id
                     ROWS UNBOUNDED PRECEDING), 6) AS mean FROM events""",
)
def trigger_per_element(spark, sf_dir):
    out = windows.fire_every(
        events(spark, sf_dir), "user_id", "ts", "1 day", "event_id", 1,
        {"_sum": scan.run_sum("value")},
    )
    return out.select(
        "user_id", "event_id", ms("window_end"), money(F.col("_sum") / F.col("n"), "mean")
    )


@query(
    "trigger_count",
    f"""SELECT event_type, event_id, n, total FROM (
          SELECT event_type, event_id, row_number() OVER w AS n,
                 round(sum(value) OVER w, 6) AS total FROM events
          WINDOW w AS (PARTITION BY event_type, {bucket('1 day')} ORDER BY event_id
                       ROWS UNBOUNDED PRECEDING))
        WHERE n % 5 = 0""",
)
def trigger_count(spark, sf_dir):
    out = windows.fire_every(
        events(spark, sf_dir), "event_type", "ts", "1 day", "event_id", 5,
        {"total": scan.run_sum("value")},
    )
    return out.select("event_type", "event_id", "n", money("total", "total"))


@query(
    "evict_last_n",
    f"""SELECT event_type, window_start, count(*) AS n, round(sum(value), 6) AS total FROM (
          SELECT *, {bucket('1 day')} AS window_start, row_number() OVER (
            PARTITION BY event_type, {bucket('1 day')} ORDER BY event_id DESC) AS rn FROM events)
        WHERE rn <= 10 GROUP BY event_type, window_start""",
)
def evict_last_n(spark, sf_dir):
    aggs = [F.count("*").alias("n"), money(F.sum("value"), "total")]
    out = windows.evict(
        events(spark, sf_dir), "event_type", "ts", "1 day", "event_id", aggs, keep_n=10
    )
    return out.select("event_type", ms("window_start"), "n", "total")


@query(
    "evict_within",
    f"""SELECT event_type, window_start, count(*) AS n, round(sum(value), 6) AS total FROM (
          SELECT *, {bucket('1 day')} AS window_start, max(ts) OVER (
            PARTITION BY event_type, {bucket('1 day')}) AS newest FROM events)
        WHERE ts >= newest - INTERVAL '2 hours' GROUP BY event_type, window_start""",
)
def evict_within(spark, sf_dir):
    aggs = [F.count("*").alias("n"), money(F.sum("value"), "total")]
    out = windows.evict(
        events(spark, sf_dir), "event_type", "ts", "1 day", "event_id", aggs,
        keep_within="2 hours",
    )
    return out.select("event_type", ms("window_start"), "n", "total")


@query(
    "consecutive_windows",
    f"""SELECT user_id, window_start, cast(total AS DOUBLE) AS total, row_number() OVER (
          PARTITION BY window_start ORDER BY total DESC, user_id) AS place
        FROM (SELECT user_id, {bucket('1 day')} AS window_start,
                     sum(cast(value AS DECIMAL(20, 6))) AS total
              FROM events GROUP BY ALL)""",
)
def consecutive_windows(spark, sf_dir):
    """Decimal values, so that the order of addition decides no rank."""
    amount = F.col("value").cast("decimal(20, 6)").alias("value")
    rows = events(spark, sf_dir).select("user_id", "ts", amount)
    out = windows.consecutive_windows(rows, "user_id", "ts", "1 day", "value")
    return out.select("user_id", ms("window_start"), F.col("total").cast("double"), "place")


@query(
    "sql_tumble",
    f"""SELECT user_id, round(sum(value), 6) AS total, {HOUR} AS w_start,
               {HOUR} + 3600000 AS w_end FROM events GROUP BY ALL""",
)
def sql_tumble(spark, sf_dir):
    return spark.sql(
        """SELECT user_id, round(sum(value), 6) AS total, unix_millis(window.start) AS w_start,
                  unix_millis(window.end) AS w_end
           FROM {t} GROUP BY window(ts, '1 hour'), user_id""",
        t=events(spark, sf_dir),
    )


@query(
    "table_tumble_rowtime",
    f"""SELECT user_id, {HOUR} AS window_start, {HOUR} + 3600000 AS window_end,
               {HOUR} + 3599999 AS rowtime, max(value) AS top FROM events GROUP BY ALL""",
)
def table_tumble_rowtime(spark, sf_dir):
    out = windows.tumble(
        events(spark, sf_dir), "ts", "1 hour", ["user_id"], [F.max("value").alias("top")],
        rowtime=True,
    )
    return out.select(
        "user_id", ms("window_start"), ms("window_end"), ms("rowtime"), "top"
    )


# --- late data ---------------------------------------------------------------

BOUND = 10 * MINUTE_MS
SIZE = HOUR_MS
LATENESS = HOUR_MS

_WM = f"""{ARRIVALS_SQL},
  wm AS (SELECT *, max(ts_ms) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND
                     1 PRECEDING) - {BOUND} AS wm_before,
                max(ts_ms) OVER (ORDER BY seq ROWS UNBOUNDED PRECEDING) - {BOUND} AS wm_after
         FROM arrivals),
  judged AS (SELECT *, ts_ms - ts_ms % {SIZE} + {SIZE} AS window_end FROM wm),
  flagged AS (SELECT *,
      coalesce(window_end - 1 + {LATENESS} <= wm_before, false) AS late,
      coalesce(window_end - 1 <= wm_before, false) AS after_fire FROM judged)"""


@query(
    "late_split",
    f"""WITH {_WM} SELECT event_id, window_end,
          CASE WHEN late THEN 'late' ELSE 'kept' END AS route FROM flagged""",
)
def late_split(spark, sf_dir):
    rows = arrivals(spark, sf_dir).select("event_id", "seq", "ts_ms")
    kept, late = latedata.late_split(rows, "ts_ms", "seq", SIZE, BOUND, LATENESS)
    both = kept.withColumn("route", F.lit("kept")).unionByName(
        late.withColumn("route", F.lit("late"))
    )
    return both.select("event_id", "window_end", "route")


@query(
    "allowed_lateness",
    f"""WITH {_WM},
        ends AS (SELECT e.window_end, min(j.seq) AS fired_at
                 FROM (SELECT DISTINCT window_end FROM flagged) e
                 JOIN flagged j ON j.wm_after >= e.window_end - 1 GROUP BY e.window_end),
        first AS (SELECT event_type, window_end, 0 AS firing, fired_at, count(*) AS n,
                         sum(value) AS total
                  FROM flagged JOIN ends USING (window_end)
                  WHERE NOT late AND NOT after_fire GROUP BY ALL),
        again AS (SELECT event_type, window_end,
                    cast(sum(after_fire::INT) OVER w AS BIGINT) AS firing, seq AS fired_at,
                    count(*) OVER w AS n, sum(value) OVER w AS total, after_fire
                  FROM flagged WHERE NOT late
                  WINDOW w AS (PARTITION BY event_type, window_end ORDER BY seq
                               ROWS UNBOUNDED PRECEDING))
        SELECT event_type, window_end, cast(firing AS BIGINT) AS firing, fired_at, n,
               round(total, 6) AS total
        FROM (SELECT * FROM first
              UNION ALL SELECT * EXCLUDE (after_fire) FROM again WHERE after_fire)""",
)
def allowed_lateness(spark, sf_dir):
    rows = arrivals(spark, sf_dir).select("event_type", "seq", "ts_ms", "value")
    out = latedata.allowed_lateness(
        rows, "event_type", "ts_ms", "seq", "value", SIZE, BOUND, LATENESS
    )
    return out.withColumn("total", F.round("total", 6))
