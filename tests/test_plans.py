"""What the physical plans must and must not contain."""

import re

import pytest

from millrace import plans

SF = "/root/testdata/sf0.001"
TABLE_QUERIES = [n for n in plans.QUERIES if not n.startswith("stream_") and n != "line_stream"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plan_text(spark):
    return {n: plan_of(plans.QUERIES[n](spark, SF)) for n in TABLE_QUERIES}


def test_no_query_forms_all_pairs(plan_text):
    for name, text in plan_text.items():
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_only_fixed_size_summaries_meet_in_one_task(plan_text):
    """A single partition is used for global aggregates and chunk totals only."""
    allowed = {"agg_avg", "agg_count", "view_sum", "late_split", "allowed_lateness"}
    for name, text in plan_text.items():
        if name not in allowed:
            assert "SinglePartition" not in text, name


@pytest.mark.parametrize("name", ["rolling_sum", "over_sum_unbounded", "retract_group_sum"])
def test_running_windows_are_cut_when_a_key_is_hot(spark, plan_text, small_chunks, name):
    def grouping(text):
        return re.search(r"Window \[sum\(_f_.*?\], \[(.*?)\], \[", text).group(1)

    assert "_chunk" not in grouping(plan_text[name])
    assert "_chunk" in grouping(plan_of(plans.QUERIES[name](spark, SF)))


@pytest.mark.parametrize("name", ["over_sum_rows", "count_tumbling", "pattern_times"])
def test_a_second_window_on_the_same_key_is_not_shuffled_again(plan_text, name):
    """Places and frames share the key's partitioning while no key is hot."""
    assert plan_text[name].count("Exchange hashpartitioning") <= 2


@pytest.mark.parametrize("name", ["top_n", "evict_last_n"])
def test_top_n_is_cut_before_the_shuffle(plan_text, name):
    text = plan_text[name]
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


@pytest.mark.parametrize(
    "name", ["tumbling_sum", "sliding_sum", "session_agg", "word_count", "upsert_latest"]
)
def test_aggregates_combine_before_the_shuffle(plan_text, name):
    assert "partial_" in plan_text[name].split("Exchange", 1)[1]


def test_scans_read_only_what_is_used(plan_text):
    def read(name):
        return re.findall(r"ReadSchema: struct<(.*?)>", plan_text[name])

    assert read("project_positional") == ["l_orderkey:bigint,l_partkey:bigint"]
    assert set(",".join(read("rolling_sum")).split(",")) == {
        "event_id:bigint", "user_id:bigint", "value:double",
    }
    assert "props" not in ",".join(read("trigger_count") + read("tumbling_reduce"))


def test_filters_reach_the_scan(plan_text):
    assert "GreaterThan(value,100.0)" in plan_text["filter_value"]
    assert "EqualTo(user_id,7)" in plan_text["where_select"]
    assert "StringStartsWith(event_type,p)" in plan_text["fn_like"]
    assert "In(event_type, [click,view])" in plan_text["fn_in"]


def test_core_operators_need_no_python(plan_text):
    python = {
        n for n, text in plan_text.items()
        if re.search(r"MapInPandas|PythonEval|EvalPython|FlatMapGroups|PythonUDTF", text)
    }
    assert python == {"rich_map", "enrich_map"}


def test_the_watermark_is_formed_once(spark, monkeypatch):
    """The input is read for the watermark only, whichever way it is cut."""
    from pyspark.sql import functions as F

    from millrace.operators import latedata, scan

    data = spark.range(50).selectExpr("id AS seq", "'k' AS k", "id * 10 AS ts", "1.0 AS v")
    fired = latedata.allowed_lateness(data, "k", "ts", "seq", "v", 100, 20, chunk=scan.Cut(8))
    assert "Range (" not in plan_of(fired)
    assert fired.agg(F.sum("n")).first()[0] == 40
