"""Scalar functions, CASE forms, conversions and user-defined functions."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from millrace.functions import udfs
from millrace.functions.scalars import case_list, is_digit, time_of_day
from millrace.plans.common import events
from millrace.plans.registry import query
from millrace.session import configure
from millrace.sources.tables import load


@query("fn_like", "SELECT event_id, event_type FROM events WHERE event_type LIKE 'p%'")
def fn_like(spark, sf_dir):
    return events(spark, sf_dir).filter("event_type LIKE 'p%'").select("event_id", "event_type")


@query("fn_in", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def fn_in(spark, sf_dir):
    rows = events(spark, sf_dir).filter(F.col("event_type").isin("click", "view"))
    return rows.select("event_id", "event_type")


@query("fn_between", "SELECT event_id, value FROM events WHERE value BETWEEN 1 AND 3")
def fn_between(spark, sf_dir):
    rows = events(spark, sf_dir).filter(F.col("value").between(1, 3))
    return rows.select("event_id", "value")


@query(
    "fn_compare",
    """SELECT event_id, value < 5 AS lt, value > 5 AS gt, user_id = 3 AS eq, user_id >= 100 AS ge,
              event_type > 'error' AS after_error FROM events""",
)
def fn_compare(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id",
        (F.col("value") < 5).alias("lt"),
        (F.col("value") > 5).alias("gt"),
        (F.col("user_id") == 3).alias("eq"),
        (F.col("user_id") >= 100).alias("ge"),
        (F.col("event_type") > "error").alias("after_error"),
    )


@query(
    "fn_logical",
    """SELECT event_id FROM events
       WHERE (value > 1 AND value < 30) OR event_type = 'signup'""",
)
def fn_logical(spark, sf_dir):
    low = (F.col("value") > 1) & (F.col("value") < 30)
    return events(spark, sf_dir).filter(low | (F.col("event_type") == "signup")).select("event_id")


@query(
    "fn_arith",
    "SELECT event_id, value + 100 AS plus, round(sqrt(value), 6) AS root FROM events",
)
def fn_arith(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id",
        (F.col("value") + 100).alias("plus"),
        F.round(F.sqrt("value"), 6).alias("root"),
    )


@query("fn_rand", "SELECT event_id, true AS in_range, true AS same_again FROM events")
def fn_rand(spark, sf_dir):
    """Seeded random numbers: what must hold of them, since the values are the engine's own."""
    drawn = events(spark, sf_dir).select("event_id", F.rand(7).alias("r"), F.rand(7).alias("again"))
    return drawn.select(
        "event_id", ((F.col("r") >= 0) & (F.col("r") < 1)).alias("in_range"),
        (F.col("r") == F.col("again")).alias("same_again"),
    )


@query(
    "fn_string",
    """SELECT event_id, upper(event_type) AS up, trim(event_type, 'cw') AS trimmed,
              ltrim(event_type, 'e') AS left_trimmed, rtrim(event_type, 'pk') AS right_trimmed,
              repeat(event_type, 2) AS twice, concat(event_type, '-', user_id) AS joined,
              concat_ws('$', event_type, user_id) AS dollars
       FROM events""",
)
def fn_string(spark, sf_dir):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    return events(spark, sf_dir).select(
        "event_id",
        F.upper(kind).alias("up"),
        F.btrim(kind, F.lit("cw")).alias("trimmed"),
        F.ltrim(kind, F.lit("e")).alias("left_trimmed"),
        F.rtrim(kind, F.lit("pk")).alias("right_trimmed"),
        F.repeat(kind, 2).alias("twice"),
        F.concat(kind, F.lit("-"), user).alias("joined"),
        F.concat_ws("$", kind, user).alias("dollars"),
    )


@query(
    "fn_now",
    """SELECT event_id, true AS same_day, true AS same_moment, true AS same_clock, true AS is_now
       FROM events""",
)
def fn_now(spark, sf_dir):
    """The clock functions agree with each other and with the moment of the call."""
    started = int(time.time())
    now = F.current_timestamp()
    return events(spark, sf_dir).select(
        "event_id",
        (F.current_date() == F.to_date(now)).alias("same_day"),
        (F.localtimestamp().cast("timestamp") == now).alias("same_moment"),
        (time_of_day(now) == F.date_format(now, "HH:mm:ss")).alias("same_clock"),
        F.unix_seconds(now).between(started - 60, started + 86_400).alias("is_now"),
    )


@query(
    "fn_to_temporal",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:%M:%S') AS clock,
              epoch_us(date_trunc('second', ts)) // 1000 AS at FROM events""",
)
def fn_to_temporal(spark, sf_dir):
    text = events(spark, sf_dir).select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text")
    )
    at = F.to_timestamp("text", "yyyy-MM-dd HH:mm:ss")
    return text.select(
        "event_id",
        F.to_date("text", "yyyy-MM-dd HH:mm:ss").cast("string").alias("day"),
        time_of_day(at).alias("clock"),
        F.unix_millis(at).alias("at"),
    )


@query(
    "fn_if",
    "SELECT event_id, CASE WHEN value > 30 THEN 'hot' ELSE 'cold' END AS heat FROM events",
)
def fn_if(spark, sf_dir):
    return events(spark, sf_dir).selectExpr("event_id", "if(value > 30, 'hot', 'cold') AS heat")


@query(
    "fn_case_list",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'browse'
                             WHEN event_type IN ('purchase', 'click') THEN 'buy'
                             ELSE 'other' END AS what FROM events""",
)
def fn_case_list(spark, sf_dir):
    branches = [(["click", "view"], "browse"), (["purchase", "click"], "buy")]
    return events(spark, sf_dir).select(
        "event_id", case_list("event_type", branches, "other").alias("what")
    )


_LEVEL = """CASE WHEN value > 3 AND value < 30 THEN 'high' WHEN value > 30 THEN 'highest'
                 ELSE 'low' END"""


@query("fn_case_search", f"SELECT event_id, {_LEVEL} AS level FROM events")
def fn_case_search(spark, sf_dir):
    return events(spark, sf_dir).selectExpr("event_id", f"{_LEVEL} AS level")


@query(
    "subquery_from",
    f"""SELECT level, count(*) AS n FROM (SELECT {_LEVEL} AS level FROM events
        WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))
        GROUP BY level""",
)
def subquery_from(spark, sf_dir):
    return spark.sql(
        f"""SELECT level, count(*) AS n FROM (SELECT {_LEVEL} AS level FROM {{e}}
            WHERE user_id IN (SELECT c_custkey FROM {{c}} WHERE c_acctbal > 0))
            GROUP BY level""",
        e=events(spark, sf_dir),
        c=load(spark, sf_dir, "customer"),
    )


@query(
    "fn_is_digit",
    """SELECT p_partkey, regexp_matches(replace(p_brand, 'Brand#', ''), '^[0-9]+$') AS brand_digit,
              regexp_matches(p_name, '^[0-9]+$') AS name_digit,
              regexp_matches(cast(p_size AS varchar), '^[0-9]+$') AS size_digit FROM part""",
)
def fn_is_digit(spark, sf_dir):
    return load(spark, sf_dir, "part").select(
        "p_partkey",
        is_digit(F.replace("p_brand", F.lit("Brand#"), F.lit(""))).alias("brand_digit"),
        is_digit("p_name").alias("name_digit"),
        is_digit("p_size").alias("size_digit"),
    )


@query(
    "fn_cast",
    """SELECT event_id, concat(event_type, '=', cast(value AS varchar)) AS text,
              cast(user_id AS varchar) AS user_text FROM events""",
)
def fn_cast(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id",
        F.concat("event_type", F.lit("="), F.col("value").cast("string")).alias("text"),
        F.col("user_id").cast("string").alias("user_text"),
    )


@query(
    "udf_upper",
    """SELECT event_id, upper(event_type) AS one, concat(upper(event_type), '-up') AS two
       FROM events""",
)
def udf_upper(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id",
        udfs.upper_suffix("event_type").alias("one"),
        udfs.upper_suffix("event_type", "-up").alias("two"),
    )


@query(
    "udf_upper_sql",
    """SELECT n_nationkey, upper(n_name) AS one, concat(upper(n_name), '-up') AS two,
              word, cast(length(word) AS BIGINT) AS length
       FROM (SELECT *, unnest(string_split(n_name, '_')) AS word FROM nation)""",
)
def udf_upper_sql(spark, sf_dir):
    """The registered function and table function, called from SQL."""
    udfs.register(configure(spark))
    return spark.sql(
        """SELECT n_nationkey, upper_suffix(n_name) AS one, upper_suffix(n_name, '-up') AS two,
                  word, cast(length AS BIGINT) AS length
           FROM {n}, LATERAL split_words(n_name, '_')""",
        n=load(spark, sf_dir, "nation"),
    )
