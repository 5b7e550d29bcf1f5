"""Sources and sinks."""

from __future__ import annotations

import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import changelog, enrich
from millrace.plans.common import events, ms
from millrace.plans.registry import query
from millrace.session import fresh_dir
from millrace.sinks import values
from millrace.sources import ingest
from millrace.sources.tables import load

SENSOR = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("temperature", T.DoubleType()),
    ]
)

# Every 13th line is cut short and every 17th has a word where a number belongs.
LINE = """CASE WHEN event_id % 13 = 5 THEN cast(user_id AS string)
               WHEN event_id % 17 = 3 THEN concat(user_id, ', soon, ', value)
               ELSE concat_ws(', ', user_id, unix_millis(ts), value) END"""
GOOD_LINES_SQL = "event_id % 13 <> 5 AND event_id % 17 <> 3"


@query(
    "src_sequence",
    """SELECT event_id AS value, user_id FROM events
       WHERE event_id > 10 AND event_id % 2 = 0""",
)
def src_sequence(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id")
    top = rows.agg(F.max("event_id")).first()[0] or 0
    doubled = ingest.sequence(spark, 1, top // 2).select((F.col("value") * 2).alias("value"))
    kept = doubled.filter("value > 10")
    return kept.join(rows, kept.value == rows.event_id).select("value", "user_id")


@query(
    "src_text",
    """SELECT value, count(*) AS n FROM
         (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)
       GROUP BY value""",
)
def src_text(spark, sf_dir):
    path = fresh_dir(spark, "text")
    load(spark, sf_dir, "documents").select("text").write.text(path)
    return ingest.lines(spark, path).groupBy("value").agg(F.count("*").alias("n"))


@query(
    "parse_sensor",
    f"""SELECT event_id, user_id AS id, epoch_us(ts) // 1000 AS ts_ms, value AS temperature
        FROM events WHERE {GOOD_LINES_SQL}""",
)
def parse_sensor(spark, sf_dir):
    lines = events(spark, sf_dir).selectExpr("event_id", f"{LINE} AS value")
    good, _ = ingest.parse_delimited(lines, SENSOR, on_error="side")
    return good


@query(
    "parse_sensor_bad",
    f"""SELECT CASE WHEN event_id % 13 = 5 THEN cast(user_id AS varchar)
                    ELSE concat(user_id, ', soon, ', value) END AS value
        FROM events WHERE NOT ({GOOD_LINES_SQL})""",
)
def parse_sensor_bad(spark, sf_dir):
    lines = events(spark, sf_dir).selectExpr("event_id", f"{LINE} AS value")
    _, bad = ingest.parse_delimited(lines, SENSOR, on_error="side")
    return bad


@query(
    "csv_table_ignore_errors",
    f"""SELECT user_id AS id, epoch_us(ts) // 1000 AS ts_ms, value AS temperature, epoch_us(ts) // 1000 AS rt
        FROM events WHERE {GOOD_LINES_SQL}""",
)
def csv_table_ignore_errors(spark, sf_dir):
    lines = events(spark, sf_dir).selectExpr(f"replace({LINE}, ', ', ',') AS value")
    table = ingest.csv_table(lines, SENSOR, rowtime="ts_ms", unit="ms", bound="1 second")
    return table.withColumn("rt", ms("rt"))


@query(
    "json_events",
    r"""SELECT event_id, cast(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k
        FROM events WHERE event_id % 17 <> 3""",
)
def json_events(spark, sf_dir):
    text = "CASE WHEN event_id % 17 = 3 THEN substr(props, 1, 5) ELSE props END AS value"
    lines = events(spark, sf_dir).selectExpr("event_id", text)
    good, _ = ingest.parse_json(lines, T.StructType([T.StructField("k", T.LongType())]))
    return good


@query(
    "to_table",
    """SELECT user_id AS a, epoch_us(ts) // 1000 AS b, value AS c, epoch_us(ts) // 1000 AS rt FROM events""",
)
def to_table(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", ms("ts"), "value")
    table = ingest.to_table(rows, ["a", "b", "c"], rowtime="b", unit="ms", append_as="rt")
    return table.withColumn("rt", ms("rt"))


@query("view_sum", "SELECT round(sum(value), 6) AS total, round(sum(value), 6) AS again FROM events")
def view_sum(spark, sf_dir):
    rows = events(spark, sf_dir)
    rows.createOrReplaceTempView("millrace_view_sum")
    inline = spark.sql("SELECT sum(value) AS total FROM {t}", t=rows)
    viewed = spark.sql("SELECT sum(value) AS again FROM millrace_view_sum")
    return spark.sql(
        "SELECT round(total, 6) AS total, round((SELECT again FROM {v}), 6) AS again FROM {i}",
        v=viewed,
        i=inline,
    )


OP = """CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END"""


def change_feed(spark, sf_dir):
    return events(spark, sf_dir).selectExpr(
        f"{OP} AS op", "event_id AS seq", "user_id AS id", "event_type AS name",
        "props AS description",
    )


@query(
    "cdc_snapshot",
    """SELECT id, seq, name, description FROM (
         SELECT user_id AS id, event_id AS seq, event_type AS name, props AS description,
                row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
         FROM events)
       WHERE rn = 1 AND name <> 'error'""",
)
def cdc_snapshot(spark, sf_dir):
    return changelog.apply_changes(change_feed(spark, sf_dir), "id", "seq", "op")


@query(
    "upsert_latest",
    """SELECT user_id, event_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
)
def upsert_latest(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "value")
    return changelog.upsert_latest(rows, "user_id", "event_id")


@query(
    "kafka_value",
    """SELECT cast(user_id AS varchar) AS key,
              concat(event_id, ',', user_id, ',', event_type, ',', value) AS value FROM events""",
)
def kafka_value(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "event_type", "value")
    return values.kafka_value(rows, key="user_id", format="csv")


@query(
    "to_document_json",
    """SELECT concat('{"sensor_id":"', user_id, '","temperature":"', value, '","ts":"',
                     (epoch_us(ts) // 1000), '"}') AS value FROM events""",
)
def to_document_json(spark, sf_dir):
    mapping = {"sensor_id": "user_id", "temperature": "value", "ts": F.unix_millis("ts")}
    return values.to_document_json(events(spark, sf_dir), mapping)


@query(
    "bucketed_files",
    """SELECT strftime(ts, '%Y-%m-%d--00') AS bucket, count(*) AS n,
              round(sum(value), 6) AS total FROM events GROUP BY 1""",
)
def bucketed_files(spark, sf_dir):
    path = fresh_dir(spark, "buckets")
    values.bucketed_files(
        events(spark, sf_dir).select("event_id", "ts", "value"), path, "ts", "yyyy-MM-dd--'00'"
    )
    written = spark.read.schema("event_id long, value double, bucket string").parquet(path)
    return written.groupBy("bucket").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total")
    )


@query(
    "insert_into",
    """SELECT user_id, count(*) AS n, round(sum(value), 6) AS total
       FROM events WHERE event_type IN ('click', 'view') GROUP BY user_id""",
)
def insert_into(spark, sf_dir):
    path = fresh_dir(spark, "inserted")
    name = "millrace_" + path.rsplit("-", 1)[-1]
    rows = events(spark, sf_dir).select("user_id", "value", "event_type")
    spark.sql(f"CREATE TABLE {name} (user_id BIGINT, value DOUBLE) USING parquet LOCATION '{path}'")
    try:
        for kind in ("click", "view"):
            part = rows.filter(F.col("event_type") == kind).select("user_id", "value")
            part.write.insertInto(name)
    finally:
        # The table is external: the files stay, only the name goes.
        spark.sql(f"DROP TABLE {name}")
    written = spark.read.schema("user_id long, value double").parquet(path)
    return written.groupBy("user_id").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total")
    )


@query(
    "changelog_latest",
    """SELECT user_id, cast(sum(value) AS BIGINT) AS total FROM (
         SELECT user_id, cast(floor(value) AS BIGINT) AS value FROM events) GROUP BY user_id""",
)
def changelog_latest(spark, sf_dir):
    """The add rows of a changelog, overwritten by key, are the final result."""
    rows = events(spark, sf_dir).select(
        "user_id", "event_id", F.floor("value").cast("long").alias("value")
    )
    log = changelog.retract_group(rows, "user_id", "value", "event_id")
    latest = changelog.upsert_latest(log.filter("flag"), "user_id", "event_id")
    return latest.select("user_id", F.col("value").alias("total"))


@query(
    "lookup_join",
    """SELECT event_id, user_id, name FROM events LEFT JOIN
         (SELECT c_custkey, c_name AS name FROM customer WHERE c_mktsegment = 'BUILDING') c
       ON user_id = c_custkey""",
)
def lookup_join(spark, sf_dir):
    dim = load(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    dim = dim.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    return enrich.lookup_join(
        events(spark, sf_dir).select("event_id", "user_id"), dim, "user_id", ["name"]
    )


@query(
    "lookup_join_last_match",
    """SELECT o_orderkey, o_custkey, last_event, last_value FROM orders LEFT JOIN
         (SELECT user_id, event_type AS last_event, value AS last_value FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) e
       ON o_custkey = user_id""",
)
def lookup_join_last_match(spark, sf_dir):
    dim = events(spark, sf_dir).select(
        F.col("user_id").alias("o_custkey"),
        "event_id",
        F.col("event_type").alias("last_event"),
        F.col("value").alias("last_value"),
    )
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return enrich.lookup_join(
        orders, dim, "o_custkey", ["last_event", "last_value"], dim_order="event_id"
    )


@query(
    "broadcast_enrich",
    """SELECT event_id, user_id, event_type, version, c_name, c_nationkey FROM events
       JOIN (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS version FROM customer)
         ON user_id = c_custkey WHERE c_mktsegment = 'MACHINERY'""",
)
def broadcast_enrich(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "event_type")
    return enrich.broadcast_enrich(
        rows, lambda: versions(spark, sf_dir), "user_id", order="version"
    )


def versions(spark, sf_dir):
    """A dimension in which every third key has an older row as well."""
    dim = load(spark, sf_dir, "customer").filter("c_mktsegment = 'MACHINERY'")
    dim = dim.select(F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey")
    second = dim.filter("user_id % 3 = 0").withColumn("version", F.lit(2))
    older = F.when(F.col("user_id") % 3 == 0, "old").otherwise(F.col("c_name"))
    first = dim.withColumns({"version": F.lit(1), "c_name": older})
    return first.unionByName(second)


_LON = "(event_id * 7919) % 36000 / 100.0 - 180"
_LAT = "(event_id * 104729) % 18000 / 100.0 - 90"
_BOX = [
    "n_name AS province",
    "(n_nationkey % 5) * 60.0 - 180 AS lon_lo",
    "(n_nationkey % 5) * 60.0 - 130 AS lon_hi",
    "floor(n_nationkey / 5) * 30.0 - 90 AS lat_lo",
    "floor(n_nationkey / 5) * 30.0 - 50 AS lat_hi",
]


@query(
    "geo_region_join",
    f"""WITH p AS (SELECT event_id, {_LON} AS lon, {_LAT} AS lat FROM events),
             r AS (SELECT {', '.join(_BOX)} FROM nation)
        SELECT event_id, min(province) AS province FROM p LEFT JOIN r
          ON lon >= lon_lo AND lon < lon_hi AND lat >= lat_lo AND lat < lat_hi
        GROUP BY event_id""",
)
def geo_region_join(spark, sf_dir):
    points = events(spark, sf_dir).selectExpr(
        "event_id", f"cast({_LON} AS double) AS lon", f"cast({_LAT} AS double) AS lat"
    )
    regions = load(spark, sf_dir, "nation").selectExpr(*_BOX)
    return enrich.geo_region_join(points, regions, "lon", "lat").select("event_id", "province")


@query(
    "enrich_map",
    """SELECT event_id, user_id, CASE WHEN known THEN concat('user-', user_id) END AS label,
              CASE WHEN known THEN user_id * 2.0 END AS twice
       FROM (SELECT *, user_id % 10 <> 7 AND user_id % 400 <> 13 AS known FROM events)""",
)
def enrich_map(spark, sf_dir):
    """Some calls fail and some never answer in time."""

    def fetch(user_id):
        if user_id % 400 == 13:
            time.sleep(5)
        if user_id % 10 == 7:
            raise ConnectionError("no answer")
        return {"label": f"user-{user_id}", "twice": user_id * 2.0}

    rows = events(spark, sf_dir).select("event_id", "user_id")
    return enrich.enrich_map(
        rows, "user_id", fetch, "label string, twice double", timeout=1.0
    )
