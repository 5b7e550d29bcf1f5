"""Joins, group-by, OVER windows, top-N and ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.udfs import split_rows
from millrace.operators import aggs, joins, scan
from millrace.plans.common import bucket, events, money, ms, of_type
from millrace.plans.registry import query
from millrace.sources.tables import load

# --- equi-joins --------------------------------------------------------------


@query(
    "join_inner",
    """SELECT l_orderkey, l_linenumber, l_quantity, o_custkey FROM lineitem
       JOIN orders ON l_orderkey = o_orderkey""",
)
def join_inner(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    return joined.drop("o_orderkey")


@query(
    "join_left",
    """SELECT c_custkey, cast(o_orderkey AS DOUBLE) AS o_orderkey, o_totalprice FROM customer
       LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P'""",
)
def join_left(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    orders = orders.select("o_custkey", F.col("o_orderkey").cast("double"), "o_totalprice")
    customers = load(spark, sf_dir, "customer").select("c_custkey")
    return customers.join(
        orders, F.col("c_custkey") == F.col("o_custkey"), "left"
    ).drop("o_custkey")


@query(
    "join_full",
    """SELECT cast(p_partkey AS DOUBLE) AS p_partkey, p_retailprice,
              cast(l_partkey AS DOUBLE) AS l_partkey, total FROM
         (SELECT p_partkey, p_retailprice FROM part WHERE p_size < 25) p
       FULL JOIN (SELECT l_partkey, round(sum(l_quantity), 6) AS total FROM lineitem
                  WHERE l_returnflag = 'R' GROUP BY l_partkey) l
       ON p_partkey = l_partkey""",
)
def join_full(spark, sf_dir):
    parts = load(spark, sf_dir, "part").filter("p_size < 25").select("p_partkey", "p_retailprice")
    lines = load(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    totals = lines.groupBy("l_partkey").agg(money(F.sum("l_quantity"), "total"))
    joined = parts.join(totals, F.col("p_partkey") == F.col("l_partkey"), "full_outer")
    # A nullable number is compared as a double.
    return joined.withColumns({c: F.col(c).cast("double") for c in ("p_partkey", "l_partkey")})


@query(
    "join_group_sum",
    """SELECT c_mktsegment AS name, round(sum(value), 6) AS total, count(*) AS n
       FROM events LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 1000) c
         ON user_id = c_custkey GROUP BY c_mktsegment""",
)
def join_group_sum(spark, sf_dir):
    dim = load(spark, sf_dir, "customer").filter("c_acctbal > 1000")
    dim = dim.select("c_custkey", F.col("c_mktsegment").alias("name"))
    rows = events(spark, sf_dir).select("user_id", "value")
    joined = rows.join(dim, F.col("user_id") == F.col("c_custkey"), "left")
    return joined.groupBy("name").agg(money(F.sum("value"), "total"), F.count("*").alias("n"))


@query(
    "semi_in_subquery",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN
         (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def semi_in_subquery(spark, sf_dir):
    return spark.sql(
        """SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_custkey IN
             (SELECT c_custkey FROM {customer} WHERE c_mktsegment = 'BUILDING')""",
        orders=load(spark, sf_dir, "orders"),
        customer=load(spark, sf_dir, "customer"),
    )


@query(
    "lateral_split",
    """SELECT s_suppkey, word, length(word) AS length FROM
         (SELECT s_suppkey, unnest(string_split(concat(s_name, '#', s_nationkey), '#')) AS word
          FROM supplier)""",
)
def lateral_split(spark, sf_dir):
    table = load(spark, sf_dir, "supplier").select(
        "s_suppkey", F.concat_ws("#", "s_name", "s_nationkey").alias("text")
    )
    out = split_rows(table, "text", "#")
    return out.select("s_suppkey", "word", F.col("length").cast("long"))


@query(
    "lateral_words_sql",
    r"""SELECT p_partkey, word, length(word) AS length FROM
         (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)""",
)
def lateral_words_sql(spark, sf_dir):
    return spark.sql(
        """SELECT p_partkey, word, cast(length(word) AS BIGINT) AS length FROM {part},
             LATERAL explode(split(p_name, ' ')) AS t(word)""",
        part=load(spark, sf_dir, "part"),
    )


# --- joins in time -----------------------------------------------------------


def _clicks(spark, sf_dir):
    return of_type(spark, sf_dir, "click", "c")


def _buys(spark, sf_dir):
    return of_type(spark, sf_dir, "purchase", "p")


_SIDES = """WITH c AS (SELECT user_id, event_id AS c_id, ts AS c_ts, value AS c_value
                       FROM events WHERE event_type = 'click'),
                 p AS (SELECT user_id, event_id AS p_id, ts AS p_ts, value AS p_value
                       FROM events WHERE event_type = 'purchase')"""


@query(
    "interval_join",
    f"""{_SIDES} SELECT c.user_id, c_id, p_id FROM c JOIN p ON c.user_id = p.user_id
        AND p_ts BETWEEN c_ts - INTERVAL '12 hours' AND c_ts + INTERVAL '12 hours'""",
)
def interval_join(spark, sf_dir):
    return joins.interval_join(
        _clicks(spark, sf_dir), _buys(spark, sf_dir), "user_id", "c_ts", "p_ts",
        "-12 hours", "12 hours",
    ).select("user_id", "c_id", "p_id")


@query(
    "interval_join_exclusive",
    f"""{_SIDES} SELECT c.user_id, c_id, p_id FROM c JOIN p ON c.user_id = p.user_id
        AND p_ts > c_ts - INTERVAL '6 hours' AND p_ts < c_ts + INTERVAL '12 hours'""",
)
def interval_join_exclusive(spark, sf_dir):
    return joins.interval_join(
        _clicks(spark, sf_dir), _buys(spark, sf_dir), "user_id", "c_ts", "p_ts",
        "-6 hours", "12 hours", lo_open=True, hi_open=True,
    ).select("user_id", "c_id", "p_id")


@query(
    "interval_join_left",
    f"""{_SIDES} SELECT c.user_id, c_id, cast(p_id AS DOUBLE) AS p_id
        FROM c LEFT JOIN p ON c.user_id = p.user_id AND c_ts BETWEEN p_ts AND p_ts + INTERVAL '12 hours'""",
)
def interval_join_left(spark, sf_dir):
    return joins.interval_join(
        _clicks(spark, sf_dir), _buys(spark, sf_dir), "user_id", "c_ts", "p_ts",
        "-12 hours", "0 hours", how="left",
    ).select("user_id", "c_id", F.col("p_id").cast("double"))


@query(
    "interval_join_asym",
    f"""{_SIDES} SELECT c.user_id, c_id, p_id FROM c LEFT JOIN p ON c.user_id = p.user_id
        WHERE c_ts >= p_ts - INTERVAL '9 hours' AND c_ts < p_ts + INTERVAL '6 hours'""",
)
def interval_join_asym(spark, sf_dir):
    # l >= r - 9h and l < r + 6h, read as a range of r - l: (-6h, 9h].
    return joins.interval_join(
        _clicks(spark, sf_dir), _buys(spark, sf_dir), "user_id", "c_ts", "p_ts",
        "-6 hours", "9 hours", lo_open=True,
    ).select("user_id", "c_id", "p_id")


@query(
    "window_join_tumbling",
    f"""{_SIDES} SELECT c.user_id, c_id, p_id, {bucket('12 hours', 'c_ts')} AS window_start
        FROM c JOIN p ON c.user_id = p.user_id
         AND {bucket('12 hours', 'c_ts')} = {bucket('12 hours', 'p_ts')}""",
)
def window_join_tumbling(spark, sf_dir):
    out = joins.window_join(
        _clicks(spark, sf_dir), _buys(spark, sf_dir), "user_id", "c_ts", "p_ts", "12 hours"
    )
    return out.select("user_id", "c_id", "p_id", ms("window_start"))


def _sessions_sql(source: str, gap: str) -> str:
    return f"""marked AS (
      SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                          <= INTERVAL '{gap}' THEN 0 ELSE 1 END AS fresh FROM {source}),
    numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts
                   ROWS UNBOUNDED PRECEDING) AS session FROM marked),
    sessions AS (SELECT *, epoch_us(min(ts) OVER (PARTITION BY user_id, session)) // 1000
                   AS session_start FROM numbered)"""


@query(
    "window_join_session",
    f"""WITH both_sides AS (SELECT * FROM events WHERE event_type IN ('click', 'purchase')),
        {_sessions_sql('both_sides', '12 hours')}
        SELECT c.user_id, c.session_start, c.event_id AS c_id, p.event_id AS p_id
        FROM sessions c JOIN sessions p ON c.user_id = p.user_id AND c.session = p.session
        WHERE c.event_type = 'click' AND p.event_type = 'purchase'""",
)
def window_join_session(spark, sf_dir):
    left = _clicks(spark, sf_dir).withColumnRenamed("c_ts", "ts")
    right = _buys(spark, sf_dir).withColumnRenamed("p_ts", "ts")
    out = joins.session_join(left, right, "user_id", "ts", "12 hours", "c_id", "p_id")
    return out.select("user_id", ms("session_start"), "c_id", "p_id")


@query(
    "cogroup_session",
    f"""WITH both_sides AS (SELECT * FROM events WHERE event_type IN ('click', 'purchase')),
        {_sessions_sql('both_sides', '12 hours')},
        held AS (SELECT user_id, session_start, row_number() OVER w AS fire,
                   count(*) FILTER (event_type = 'click') OVER w AS n_first,
                   count(*) FILTER (event_type = 'purchase') OVER w AS n_second,
                   coalesce(string_agg(event_id, ',') FILTER (event_type = 'click') OVER w, '')
                     AS first_items,
                   coalesce(string_agg(event_id, ',') FILTER (event_type = 'purchase') OVER w, '')
                     AS second_items FROM sessions
                 WINDOW w AS (PARTITION BY user_id, session ORDER BY event_id
                              ROWS UNBOUNDED PRECEDING))
        SELECT * FROM held WHERE fire % 5 = 0""",
)
def cogroup_session(spark, sf_dir):
    table = events(spark, sf_dir).select(
        "user_id", "ts", "event_id", "event_type", F.col("event_id").alias("item")
    )
    out = joins.session_cogroup(
        table.filter("event_type = 'click'"),
        table.filter("event_type = 'purchase'"),
        "user_id", "ts", "12 hours", "event_id", "item", every=5,
    )
    return out.select(
        "user_id",
        ms("session_start"),
        "fire",
        "n_first",
        "n_second",
        F.array_join("first_items", ",").alias("first_items"),
        F.array_join("second_items", ",").alias("second_items"),
    )


@query(
    "join_then_window",
    f"""SELECT {bucket('1 day')} AS window_start, c_mktsegment, round(sum(value), 6) AS total
        FROM events LEFT JOIN customer ON user_id = c_custkey AND c_acctbal > 0
        GROUP BY ALL""",
)
def join_then_window(spark, sf_dir):
    dim = load(spark, sf_dir, "customer").filter("c_acctbal > 0")
    dim = dim.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    rows = events(spark, sf_dir).select("user_id", "ts", "value")
    out = joins.join_then_window(rows, dim, "user_id", "ts", "1 day", ["c_mktsegment"], "value")
    return out.select(ms("window_start"), "c_mktsegment", money("total", "total"))


# --- aggregates --------------------------------------------------------------


@query("group_sum", "SELECT user_id, round(sum(value), 6) AS total FROM events GROUP BY user_id")
def group_sum(spark, sf_dir):
    return events(spark, sf_dir).groupBy("user_id").agg(money(F.sum("value"), "total"))


@query("agg_avg", "SELECT round(avg(l_quantity), 6) AS mean FROM lineitem")
def agg_avg(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").agg(money(F.avg("l_quantity"), "mean"))


@query("agg_count", "SELECT count(*) AS n, count(value) AS n_values FROM events")
def agg_count(spark, sf_dir):
    return events(spark, sf_dir).agg(
        F.count("*").alias("n"), F.count("value").alias("n_values")
    )


@query(
    "count_distinct",
    """SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders,
              count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag""",
)
def count_distinct(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"),
        F.count_distinct("l_partkey").alias("parts"),
    )


@query(
    "sum_distinct",
    """SELECT l_suppkey, round(sum(DISTINCT l_quantity), 6) AS total FROM lineitem
       GROUP BY l_suppkey""",
)
def sum_distinct(spark, sf_dir):
    table = load(spark, sf_dir, "lineitem").groupBy("l_suppkey")
    return table.agg(money(F.sum_distinct("l_quantity"), "total"))


@query(
    "window_sum_distinct",
    f"""SELECT event_type, {bucket('1 day')} AS window_start,
               cast(sum(DISTINCT cast(floor(value) AS BIGINT)) AS BIGINT) AS total
        FROM events GROUP BY ALL""",
)
def window_sum_distinct(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("whole", F.floor("value").cast("long"))
    out = rows.groupBy(F.window("ts", "1 day"), "event_type").agg(
        F.sum_distinct("whole").alias("total")
    )
    return out.select("event_type", ms("window.start", "window_start"), "total")


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query(
    "over_avg_distinct",
    """SELECT event_id, event_type, round(cast(sum(fresh * whole) OVER w AS DOUBLE)
                / sum(fresh) OVER w, 6) AS mean
       FROM (SELECT event_id, event_type, cast(floor(value) AS BIGINT) AS whole,
               CASE WHEN row_number() OVER (PARTITION BY event_type, floor(value)
                                            ORDER BY event_id) = 1 THEN 1 ELSE 0 END AS fresh
             FROM events)
       WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)""",
)
def over_avg_distinct(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        "event_id", "event_type", F.floor("value").cast("long").alias("whole")
    )
    out = aggs.over_distinct(rows, "event_type", "event_id", "whole", "avg", "mean")
    return out.select("event_id", "event_type", money("mean", "mean"))


@query(
    "weighted_avg",
    """SELECT l_suppkey, cast(sum(v * w) // nullif(sum(w), 0) AS BIGINT) AS mean
       FROM (SELECT l_suppkey, cast(l_extendedprice AS BIGINT) AS v,
                    cast(l_quantity AS BIGINT) AS w
             FROM (SELECT l_suppkey, floor(l_extendedprice) AS l_extendedprice,
                          l_quantity FROM lineitem))
       GROUP BY l_suppkey""",
)
def weighted_avg(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.col("l_extendedprice").cast("long").alias("v"),
        F.col("l_quantity").cast("long").alias("w"),
    )
    return rows.groupBy("l_suppkey").agg(aggs.weighted_avg("v", "w").alias("mean"))


@query(
    "weighted_avg_retract",
    """SELECT l_suppkey, cast(sum(v * w) // nullif(sum(w), 0) AS BIGINT) AS mean
       FROM (SELECT l_suppkey, l_returnflag, cast(floor(l_extendedprice) AS BIGINT) AS v,
                    cast(l_quantity AS BIGINT) AS w FROM lineitem)
       WHERE l_returnflag <> 'R' GROUP BY l_suppkey""",
)
def weighted_avg_retract(spark, sf_dir):
    """Every line is added; returned lines are withdrawn again."""
    rows = load(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_returnflag", F.col("l_extendedprice").cast("long").alias("v"),
        F.col("l_quantity").cast("long").alias("w"),
    )
    entries = rows.withColumn("sign", F.lit(1)).unionByName(
        rows.filter("l_returnflag = 'R'").withColumn("sign", F.lit(-1))
    )
    return entries.groupBy("l_suppkey").agg(aggs.weighted_avg("v", "w", "sign").alias("mean"))


# --- OVER windows, ranks, ordering -------------------------------------------


@query(
    "over_sum_rows",
    """SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts
         ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS total FROM events""",
)
def over_sum_rows(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "value")
    out = aggs.over_rows(rows, "user_id", "event_id", 2, {"total": F.sum("value")})
    return out.select("event_id", "user_id", money("total", "total"))


@query(
    "over_named_window",
    """SELECT event_id, user_id, round(sum(value) OVER w, 6) AS total, max(value) OVER w AS top
       FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def over_named_window(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "value")
    both = {"total": F.sum("value"), "top": F.max("value")}
    out = aggs.over_rows(rows, "user_id", "event_id", 2, both)
    return out.select("event_id", "user_id", money("total", "total"), "top")


@query(
    "over_sum_unbounded",
    """SELECT event_id, event_type, round(sum(value) OVER (PARTITION BY event_type ORDER BY ts
         ROWS UNBOUNDED PRECEDING), 6) AS total FROM events""",
)
def over_sum_unbounded(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "event_type", "value")
    out = scan.running(rows, ["event_type"], "event_id", {"total": scan.run_sum("value")})
    return out.select("event_id", "event_type", money("total", "total"))


@query(
    "rank_over",
    """SELECT event_id, event_type, value,
              rank() OVER (PARTITION BY event_type ORDER BY value DESC) AS rank FROM events""",
)
def rank_over(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "event_type", "value")
    return aggs.rank_over(rows, "event_type", "value")


@query(
    "top_n",
    """SELECT user_id, event_id, value, place FROM (
         SELECT user_id, event_id, value, row_number() OVER (
           PARTITION BY user_id ORDER BY value DESC, event_id) AS place FROM events)
       WHERE place <= 3""",
)
def top_n(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "value")
    out = aggs.top_n(rows, "user_id", "value", 3, "event_id")
    return out.withColumn("place", F.col("place").cast("long"))


@query(
    "order_offset_fetch",
    "SELECT event_id, value FROM events ORDER BY ts DESC, event_id OFFSET 10 LIMIT 50",
)
def order_offset_fetch(spark, sf_dir):
    rows = events(spark, sf_dir).orderBy(F.col("ts").desc(), "event_id")
    return rows.select("event_id", "value").offset(10).limit(50)


@query("order_by_time", "SELECT event_id, epoch_us(ts) // 1000 AS ts FROM events ORDER BY ts")
def order_by_time(spark, sf_dir):
    return events(spark, sf_dir).orderBy("ts").select("event_id", ms("ts"))
