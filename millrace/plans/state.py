"""Changelogs, alerts and patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import alerts, changelog
from millrace.plans.common import events, ms
from millrace.plans.registry import query
from millrace.sources.tables import load

RETRACT_SQL = """WITH run AS (
  SELECT user_id, event_id, sum(v) OVER w AS new, lag(1) OVER o IS NOT NULL AS has_old,
         sum(v) OVER w - v AS old
  FROM (SELECT user_id, event_id, cast(floor(value) AS BIGINT) AS v FROM events)
  WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING),
         o AS (PARTITION BY user_id ORDER BY event_id))
SELECT true AS flag, user_id, cast(new AS BIGINT) AS value, event_id FROM run
WHERE NOT has_old OR new <> old
UNION ALL
SELECT false, user_id, cast(old AS BIGINT), event_id FROM run WHERE has_old AND new <> old"""


def whole_values(spark, sf_dir):
    return events(spark, sf_dir).select(
        "user_id", "event_id", F.floor("value").cast("long").alias("value")
    )


@query("retract_group_sum", RETRACT_SQL)
def retract_group_sum(spark, sf_dir):
    return changelog.retract_group(whole_values(spark, sf_dir), "user_id", "value", "event_id")


TOP_CHANGES_SQL = """WITH ranked AS (
  -- Earlier records of the key that a record finds ahead of it, and how far a
  -- later record pushes it down, decide when it enters, moves and leaves.
  SELECT a.user_id, a.event_id, a.value,
         count(b.event_id) FILTER (b.value >= a.value) + 1 AS entry_rank
  FROM events a LEFT JOIN events b ON a.user_id = b.user_id AND b.event_id < a.event_id
  GROUP BY ALL),
pushes AS (
  SELECT a.user_id, a.value, b.event_id AS seq,
         a.entry_rank + row_number() OVER (PARTITION BY a.user_id, a.event_id
                                           ORDER BY b.event_id) AS new_rank
  FROM ranked a JOIN events b ON a.user_id = b.user_id AND b.event_id > a.event_id
   AND b.value > a.value
  WHERE a.entry_rank <= 3)
SELECT true AS flag, user_id, value, entry_rank AS rank, event_id AS seq FROM ranked
WHERE entry_rank <= 3
UNION ALL SELECT true, user_id, value, new_rank, seq FROM pushes WHERE new_rank <= 3
UNION ALL SELECT false, user_id, value, new_rank - 1, seq FROM pushes WHERE new_rank <= 4"""


@query("top_n_changelog", TOP_CHANGES_SQL)
def top_n_changelog(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "value")
    return changelog.top_n_changelog(rows, "user_id", "value", "event_id", 3)


LEFT_CHANGES_SQL = """WITH l AS (SELECT o_orderkey, o_orderkey * 16 + 7 AS lseq FROM orders),
  r AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity,
               l_orderkey * 16 + l_linenumber * 2 AS rseq FROM lineitem),
  f AS (SELECT l_orderkey, min(rseq) AS first FROM r GROUP BY l_orderkey)
SELECT true AS flag, o_orderkey, lseq, cast(rseq AS DOUBLE) AS rseq, l_quantity,
       greatest(lseq, rseq) AS seq FROM l JOIN r ON o_orderkey = l_orderkey
UNION ALL SELECT true, o_orderkey, lseq, NULL, NULL, lseq
  FROM l LEFT JOIN f ON o_orderkey = l_orderkey WHERE first IS NULL OR first > lseq
UNION ALL SELECT false, o_orderkey, lseq, NULL, NULL, first
  FROM l JOIN f ON o_orderkey = l_orderkey WHERE first > lseq"""


def order_sides(spark, sf_dir):
    """Orders arrive among their lines: after line 3, before line 4."""
    left = load(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderkey * 16 + 7 AS lseq")
    right = load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey", "l_orderkey * 16 + l_linenumber * 2 AS rseq", "l_quantity"
    )
    return left, right


@query("join_left_changelog", LEFT_CHANGES_SQL)
def join_left_changelog(spark, sf_dir):
    left, right = order_sides(spark, sf_dir)
    out = changelog.changelog_left_join(left, right, "o_orderkey", "lseq", "rseq")
    return out.withColumn("rseq", F.col("rseq").cast("double"))


@query(
    "change_totals",
    """SELECT o_orderkey, count(*) AS n, sum(l_quantity) AS total, min(l_quantity) AS low,
              max(l_quantity) AS high
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""",
)
def change_totals(spark, sf_dir):
    """Aggregates over the changelog of a left join, its withdrawals included."""
    left, right = order_sides(spark, sf_dir)
    changes = changelog.changelog_left_join(left, right, "o_orderkey", "lseq", "rseq")
    return changelog.change_totals(changes, "o_orderkey", "l_quantity")


def jump_sql(previous: str) -> str:
    return f"""SELECT user_id, event_id, previous, value AS current FROM (
      SELECT user_id, event_id, value, {previous} AS previous FROM events
      WINDOW o AS (PARTITION BY user_id ORDER BY event_id))
    WHERE abs(value - previous) > 30"""


@query("jump_alert", jump_sql("lag(value, 1, 0.0) OVER o"))
def jump_alert(spark, sf_dir):
    return alerts.jump_alert(
        events(spark, sf_dir), "user_id", "event_id", "value", 30.0, first="zero"
    )


@query("jump_alert_skip_first", jump_sql("lag(value) OVER o"))
def jump_alert_skip_first(spark, sf_dir):
    return alerts.jump_alert(
        events(spark, sf_dir), "user_id", "event_id", "value", 30.0, first="skip"
    )


def trend_sql(sign: str) -> str:
    return f"""WITH p AS (SELECT *, {sign}(value - lag(value) OVER (
                 PARTITION BY user_id ORDER BY event_id)) AS step FROM events),
      t AS (SELECT *, count(*) FILTER (step < 0) OVER (PARTITION BY user_id ORDER BY event_id
                 ROWS UNBOUNDED PRECEDING) AS trend FROM p),
      g AS (SELECT user_id, trend, min(ts) AS started, min(ts) FILTER (step > 0) AS armed
            FROM t GROUP BY user_id, trend),
      e AS (SELECT *, lead(started) OVER (PARTITION BY user_id ORDER BY trend) AS ended FROM g)
    SELECT user_id, epoch_us(armed) // 1000 AS armed_at,
           epoch_us(armed + INTERVAL '4 hours') // 1000 AS alert_at
    FROM e WHERE armed IS NOT NULL AND (ended IS NULL OR ended >= armed + INTERVAL '4 hours')"""


def _trend(spark, sf_dir, direction):
    out = alerts.trend_alert(
        events(spark, sf_dir), "user_id", "ts", "value", "4 hours", "event_id", direction
    )
    return out.select("user_id", ms("armed_at"), ms("alert_at"))


@query("rising_alert", trend_sql(""))
def rising_alert(spark, sf_dir):
    return _trend(spark, sf_dir, "rising")


@query("falling_alert", trend_sql("-"))
def falling_alert(spark, sf_dir):
    return _trend(spark, sf_dir, "falling")


def all_alerts_sql(sign: str, ttl_us: int | None = None) -> str:
    """Every alert of a trend: each is armed by the first move at or after the
    alert before it.  A value older than ``ttl_us`` is not compared with."""
    fresh = "true" if ttl_us is None else f"epoch_us(ts) - epoch_us(lag(ts) OVER o) <= {ttl_us}"
    return f"""WITH RECURSIVE p AS (SELECT *, epoch_us(ts) AS us,
                 CASE WHEN {fresh} THEN {sign}(value - lag(value) OVER o) END AS step FROM events
                 WINDOW o AS (PARTITION BY user_id ORDER BY event_id)),
      t AS (SELECT *, count(*) FILTER (step < 0) OVER (PARTITION BY user_id ORDER BY event_id
                 ROWS UNBOUNDED PRECEDING) AS trend FROM p),
      g AS (SELECT user_id, trend, min(us) AS started FROM t GROUP BY user_id, trend),
      e AS (SELECT *, lead(started) OVER (PARTITION BY user_id ORDER BY trend) AS ended FROM g),
      moves AS (SELECT user_id, trend, us FROM t WHERE step > 0),
      armed AS (
        SELECT user_id, trend, min(us) AS us FROM moves GROUP BY user_id, trend
        UNION ALL
        SELECT a.user_id, a.trend, (SELECT min(m.us) FROM moves m WHERE m.user_id = a.user_id
                 AND m.trend = a.trend AND m.us >= a.us + 14400000000) AS us
        FROM armed a WHERE a.us IS NOT NULL)
    SELECT user_id, us // 1000 AS armed_at, (us + 14400000000) // 1000 AS alert_at
    FROM armed JOIN e USING (user_id, trend)
    WHERE us IS NOT NULL AND (ended IS NULL OR ended >= us + 14400000000)"""


def _every_alert(spark, sf_dir, direction):
    rows = events(spark, sf_dir).select("user_id", "event_id", "ts", "value")
    out = alerts.trend_alerts(rows, "user_id", "ts", "value", "4 hours", "event_id", direction)
    return out.select("user_id", ms("armed_at"), ms("alert_at"))


@query("rising_alert_all", all_alerts_sql(""))
def rising_alert_all(spark, sf_dir):
    return _every_alert(spark, sf_dir, "rising")


@query("falling_alert_all", all_alerts_sql("-"))
def falling_alert_all(spark, sf_dir):
    return _every_alert(spark, sf_dir, "falling")


PATTERN_SQL = """SELECT user_id, first, last FROM (
  SELECT user_id, event_id AS first, lead(event_id) OVER (
           PARTITION BY user_id ORDER BY event_id) AS last
  FROM events WHERE value > 23) WHERE last IS NOT NULL"""


@query("pattern_times", PATTERN_SQL)
def pattern_times(spark, sf_dir):
    return alerts.pattern_times(
        events(spark, sf_dir), "user_id", "event_id", F.col("value") > 23, 2
    )


@query(
    "pattern_times_strict",
    """SELECT user_id, first, last FROM (
         SELECT user_id, event_id AS first, lead(event_id, 2) OVER w AS last, value,
                lead(value) OVER w AS v2, lead(value, 2) OVER w AS v3,
                ts, lead(ts, 2) OVER w AS last_ts
         FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
       WHERE value > 23 AND v2 > 23 AND v3 > 23 AND last_ts - ts <= INTERVAL '24 hours'""",
)
def pattern_times_strict(spark, sf_dir):
    return alerts.pattern_times(
        events(spark, sf_dir), "user_id", "event_id", F.col("value") > 23, 3,
        ts="ts", strict=True, within="24 hours",
    )
