"""Projection, filter, routing, keyed rolling operators, set operations."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from millrace.operators import rolling, rows
from millrace.plans.common import events, money, ms
from millrace.plans.registry import query
from millrace.sources.tables import load


@query("map_project", "SELECT event_id, value * 2 AS twice FROM events")
def map_project(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", (F.col("value") * 2).alias("twice"))


@query("rich_map", "SELECT event_id, concat(event_type, '-ready') AS label FROM events")
def rich_map(spark, sf_dir):
    def apply(suffix: str, batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {"event_id": batch["event_id"], "label": batch["event_type"] + suffix}
        )

    return rows.rich_map(
        events(spark, sf_dir).select("event_id", "event_type"),
        open_=lambda: "-ready",
        apply=apply,
        close=lambda _: None,
        schema="event_id long, label string",
    )


WORDS_SQL = r"""SELECT word FROM (
         SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f\v]+')) AS word FROM documents)
       WHERE word <> ''"""
SPACES = r"[ \t\n\r\f\x0B]+"


@query("flatmap_words", f"SELECT word, count(*) AS n FROM ({WORDS_SQL}) GROUP BY word")
def flatmap_words(spark, sf_dir):
    words = rows.flat_words(load(spark, sf_dir, "documents"), "text", SPACES)
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query("word_count", f"SELECT word, count(*) AS n FROM ({WORDS_SQL}) GROUP BY word")
def word_count(spark, sf_dir):
    return rolling.word_count(load(spark, sf_dir, "documents"), "text", SPACES)


@query("filter_value", "SELECT event_id, value FROM events WHERE value <> 1 AND value > 100")
def filter_value(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "value").filter("value <> 1 AND value > 100")


@query("filter_contains", "SELECT doc_id, n_chars FROM documents WHERE contains(text, 'the')")
def filter_contains(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return docs.filter(F.col("text").contains("the")).select("doc_id", "n_chars")


@query("project_positional", "SELECT l_orderkey, l_partkey FROM lineitem")
def project_positional(spark, sf_dir):
    return rows.project(load(spark, sf_dir, "lineitem"), 0, 1)


def _tagged(spark, sf_dir):
    value = F.col("value")
    rules = {
        "low": value < 10,
        "middle": (value >= 10) & (value < 50),
        "high": value >= 50,
        "round": value == F.floor(value),
    }
    return rows.tag(events(spark, sf_dir).select("event_id", "value"), rules)


@query(
    "split_tag",
    """SELECT event_id, concat(CASE WHEN value < 10 THEN 'low' WHEN value < 50 THEN 'middle'
                               ELSE 'high' END,
                               CASE WHEN value = floor(value) THEN ',round' ELSE '' END) AS tags
       FROM events""",
)
def split_tag(spark, sf_dir):
    return _tagged(spark, sf_dir).select("event_id", F.array_join("tags", ",").alias("tags"))


@query(
    "split_select",
    "SELECT event_id, value FROM events WHERE value >= 50 OR value = floor(value)",
)
def split_select(spark, sf_dir):
    return rows.select_tags(_tagged(spark, sf_dir), "high", "round").select("event_id", "value")


@query(
    "side_output",
    """SELECT 'main' AS route, event_id, value AS v FROM events WHERE value < 2
       UNION ALL SELECT 'side', event_id, value + 100 FROM events WHERE value >= 2""",
)
def side_output(spark, sf_dir):
    main, side = rows.side_output(
        events(spark, sf_dir),
        F.col("value") < 2,
        main=[F.lit("main").alias("route"), F.col("event_id"), F.col("value").alias("v")],
        side=[F.lit("side").alias("route"), F.col("event_id"), (F.col("value") + 100).alias("v")],
    )
    return main.unionByName(side)


@query(
    "where_select",
    "SELECT user_id, value FROM events WHERE user_id = 7 AND event_type <> 'error'",
)
def where_select(spark, sf_dir):
    table = events(spark, sf_dir).where("event_type <> 'error'")
    return table.filter("user_id = 7").select("user_id", "value")


@query(
    "columns_add_drop_rename",
    """SELECT event_id, user_id AS id, value, concat(event_type, '-x') AS tagged FROM events""",
)
def columns_add_drop_rename(spark, sf_dir):
    return (
        events(spark, sf_dir)
        .withColumn("tagged", F.concat("event_type", F.lit("-x")))
        .drop("props", "ts", "event_type")
        .withColumnRenamed("user_id", "id")
    )


@query("row_map", "SELECT event_type AS a, concat('pre-', event_type) AS b FROM events")
def row_map(spark, sf_dir):
    record = F.struct("event_type", F.concat(F.lit("pre-"), "event_type"))
    return rows.row_map(events(spark, sf_dir), record, ["a", "b"])


@query(
    "comap_same",
    """SELECT user_id, concat('click ', value) AS note FROM events WHERE event_type = 'click'
       UNION ALL SELECT user_id, concat('view ', value) FROM events WHERE event_type = 'view'""",
)
def comap_same(spark, sf_dir):
    def note(kind):
        text = F.concat_ws(" ", F.lit(kind), F.col("value").cast("string"))
        return ["user_id", text.alias("note")]

    table = events(spark, sf_dir)
    return rows.comap(
        table.filter("event_type = 'click'"),
        table.filter("event_type = 'view'"),
        note("click"),
        note("view"),
    )


@query(
    "comap_diff",
    """SELECT cast(event_id AS varchar) AS id, event_type AS what FROM events
       UNION ALL SELECT cast(o_orderkey AS varchar), o_orderpriority FROM orders""",
)
def comap_diff(spark, sf_dir):
    return rows.comap(
        events(spark, sf_dir),
        load(spark, sf_dir, "orders"),
        [F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("what")],
        [F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("what")],
    )


@query(
    "observe_count",
    """SELECT count(*) AS num_lines, count(*) FILTER (event_type = 'error') AS num_errors
       FROM events""",
)
def observe_count(spark, sf_dir):
    watched, seen = rows.observed(
        events(spark, sf_dir).select("event_type", "value"),
        "lines",
        num_lines=F.count(F.lit(1)),
        num_errors=F.count_if(F.col("event_type") == "error"),
    )
    watched.write.format("noop").mode("overwrite").save()
    found = seen.get
    return spark.createDataFrame(
        [(found["num_lines"], found["num_errors"])], "num_lines long, num_errors long"
    )


# --- keyed rolling operators -------------------------------------------------


def _keyed(spark, sf_dir):
    return events(spark, sf_dir).select("user_id", "event_id", "value", "event_type")


@query(
    "rolling_sum",
    """SELECT user_id, event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id
         ROWS UNBOUNDED PRECEDING), 6) AS total FROM events""",
)
def rolling_sum(spark, sf_dir):
    table = _keyed(spark, sf_dir).drop("event_type")
    out = rolling.rolling_sum(table, "user_id", "value", "event_id", name="total")
    return out.select("user_id", "event_id", money("total", "total"))


def _extreme_sql(fn: str) -> str:
    w = "(PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)"
    return f"""SELECT user_id, event_id, {fn}(value) OVER {w} AS value,
                      first_value(event_type) OVER {w} AS event_type FROM events"""


@query("rolling_max", _extreme_sql("max"))
def rolling_max(spark, sf_dir):
    return rolling.rolling_max(_keyed(spark, sf_dir), "user_id", "value", "event_id")


@query("rolling_min", _extreme_sql("min"))
def rolling_min(spark, sf_dir):
    return rolling.rolling_min(_keyed(spark, sf_dir), "user_id", "value", "event_id")


def _extreme_by_sql(fn: str, sign: str) -> str:
    w = "(PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)"
    best = f"{fn}({{'v': value, 's': {sign}event_id, 't': event_type}}) OVER {w}"
    return f"""SELECT user_id, event_id, b.v AS value, b.t AS event_type,
                      {sign}b.s AS best_event_id
               FROM (SELECT user_id, event_id, {best} AS b FROM events)"""


@query("rolling_max_by", _extreme_by_sql("max", "-"))
def rolling_max_by(spark, sf_dir):
    return rolling.rolling_max_by(_keyed(spark, sf_dir), "user_id", "value", "event_id")


@query("rolling_min_by", _extreme_by_sql("min", ""))
def rolling_min_by(spark, sf_dir):
    return rolling.rolling_min_by(_keyed(spark, sf_dir), "user_id", "value", "event_id")


@query(
    "rolling_reduce",
    """SELECT user_id, event_id, first_value(event_type) OVER w AS event_type,
              epoch_us(ts) // 1000 AS ts, round(sum(value) OVER w, 6) AS value
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""",
)
def rolling_reduce(spark, sf_dir):
    table = events(spark, sf_dir).select("user_id", "event_id", "event_type", ms("ts"), "value")
    out = rolling.rolling_reduce(
        table, "user_id", "event_id", event_type="first", ts="last", value="sum"
    )
    return out.withColumn("value", F.round("value", 6))


@query(
    "rolling_fold",
    """SELECT l_orderkey, seq,
              concat('start_', string_agg(l_returnflag, '_') OVER (
                PARTITION BY l_orderkey ORDER BY seq ROWS UNBOUNDED PRECEDING)) AS acc
       FROM (SELECT l_orderkey, l_returnflag,
                    (l_orderkey * 8 + l_linenumber) * 8 + row_number() OVER (
                      PARTITION BY l_orderkey, l_linenumber
                      ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS seq
             FROM lineitem)""",
)
def rolling_fold(spark, sf_dir):
    """Fold over the lines of an order; an order has few lines by the data model."""
    from pyspark.sql import Window

    same_line = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
        "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    table = load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_returnflag",
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 8)
        .__add__(F.row_number().over(same_line))
        .cast("long")
        .alias("seq"),
    )
    out = rolling.rolling_fold(table, "l_orderkey", "l_returnflag", "seq", init="start")
    return out.select("l_orderkey", "seq", "acc")


@query(
    "multi_key_sum",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 6) AS total
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def multi_key_sum(spark, sf_dir):
    table = load(spark, sf_dir, "lineitem")
    out = rolling.multi_key_sum(table, ["l_returnflag", "l_linestatus"], "l_quantity")
    return out.withColumn("total", F.round("total", 6))


@query("emit_key", "SELECT user_id AS key FROM events")
def emit_key(spark, sf_dir):
    return events(spark, sf_dir).select(F.col("user_id").alias("key"))


@query(
    "rolling_count",
    """SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n
       FROM events""",
)
def rolling_count(spark, sf_dir):
    table = events(spark, sf_dir).select("user_id", "event_id")
    return rolling.rolling_count(table, "user_id", "event_id")


# --- set operations ----------------------------------------------------------


@query(
    "union_streams",
    """SELECT user_id, value FROM events WHERE event_type = 'click'
       UNION ALL SELECT user_id, value FROM events WHERE value > 50""",
)
def union_streams(spark, sf_dir):
    table = events(spark, sf_dir).select("user_id", "value", "event_type")
    first = table.filter("event_type = 'click'").select("user_id", "value")
    return first.unionByName(table.filter("value > 50").select("user_id", "value"))


@query(
    "union_all",
    "SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier",
)
def union_all(spark, sf_dir):
    first = load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    return first.unionAll(load(spark, sf_dir, "supplier").select("s_nationkey"))
