"""Inputs and SQL snippets the registered queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.tables import load

HOUR_MS = 3_600_000
MINUTE_MS = 60_000


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events")


def of_type(spark: SparkSession, sf_dir: str, kind: str, prefix: str) -> DataFrame:
    """Events of one type with columns user_id, <prefix>_id, <prefix>_ts, <prefix>_value."""
    rows = events(spark, sf_dir).filter(F.col("event_type") == kind)
    return rows.select(
        "user_id",
        F.col("event_id").alias(f"{prefix}_id"),
        F.col("ts").alias(f"{prefix}_ts"),
        F.col("value").alias(f"{prefix}_value"),
    )


def ms(column: str, name: str | None = None) -> Column:
    return F.unix_millis(column).alias(name or column)


def bucket(size: str, ts: str = "ts", offset: str | None = None) -> str:
    """DuckDB: start of the epoch-aligned window holding ``ts``, in milliseconds."""
    origin = "TIMESTAMP '1970-01-01'" + (f" + INTERVAL '{offset}'" if offset else "")
    return f"epoch_ms(time_bucket(INTERVAL '{size}', {ts}, {origin}))"


def money(column: str | Column, name: str) -> Column:
    """A double rounded so that the order of addition does not show."""
    return F.round(F.col(column) if isinstance(column, str) else column, 6).alias(name)


# Late arrivals made from the strictly ordered events: some records come 20 or
# 200 places after their turn.  ``seq`` is unique and orders them by arrival.
_SHIFT = "CASE WHEN event_id % 7 = 3 THEN 20 WHEN event_id % 11 = 5 THEN 200 ELSE 0 END"
_TIE = "CASE WHEN event_id % 7 = 3 THEN 1 WHEN event_id % 11 = 5 THEN 0 ELSE 2 END"
ARRIVAL_SEQ = f"(event_id + {_SHIFT}) * 4 + {_TIE}"


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``seq`` and ``ts_ms``, out of time order."""
    return events(spark, sf_dir).selectExpr(
        "event_id", "user_id", "event_type", "value", "unix_millis(ts) AS ts_ms", "ts",
        f"{ARRIVAL_SEQ} AS seq",
    )


ARRIVALS_SQL = f"""arrivals AS (
  SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ts_ms, ts, {ARRIVAL_SEQ} AS seq
  FROM events)"""
