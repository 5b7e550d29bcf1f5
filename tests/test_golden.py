"""Hand-worked and traced cases, on tables and on streams."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import udfs
from millrace.functions.scalars import case_list, is_digit
from millrace.operators import aggs, alerts, changelog, joins, latedata, rolling, windows
from millrace.operators import rows as rowops
from millrace.plans.replay import replay
from millrace.sources import ingest
from millrace.streaming import joins as stream_joins
from millrace.streaming import keyed, timers

BASE = 1599990790000  # the event times of the windowed cases, in milliseconds

SENSOR_LINES = [
    "sensor_1, 1547718199, 1.0",
    "sensor_6, 1547718201, 1",
    "sensor_7, 1547718202, 2",
    "sensor_10, 1547718205, 3",
    "sensor_1, 1547718206, 2.0",
    "sensor_1, 1547718207, 3.0",
]
SENSOR = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("temperature", T.DoubleType()),
    ]
)


@pytest.fixture
def sensor(spark):
    lines = spark.createDataFrame(
        [(i, line) for i, line in enumerate(SENSOR_LINES)], "seq long, value string"
    )
    good, bad = ingest.parse_delimited(lines, SENSOR)
    assert bad.count() == 0
    return good


@pytest.fixture
def triples(spark):
    data = [
        ("a", 1, "tag1"), ("b", 3, "tag2"), ("a", 3, "tag3"), ("b", 3, "tag1"), ("b", 4, "tag4"),
    ]
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(data)], "seq long, k string, v int, tag string"
    )


@pytest.mark.parametrize("chunk", [1, 2, 1000])
def test_rolling_max_keeps_other_fields_of_the_first_record(triples, chunk):
    out = rolling.rolling_max(triples, "k", "v", "seq", chunk=chunk)
    assert [tuple(r) for r in out.orderBy("seq").collect()] == [
        (0, "a", 1, "tag1"), (1, "b", 3, "tag2"), (2, "a", 3, "tag1"), (3, "b", 3, "tag2"),
        (4, "b", 4, "tag2"),
    ]


@pytest.mark.parametrize("chunk", [1, 2, 1000])
def test_rolling_max_by_takes_the_whole_record(triples, chunk):
    out = rolling.rolling_max_by(triples, "k", "v", "seq", chunk=chunk)
    assert [tuple(r)[:4] for r in out.orderBy("seq").collect()] == [
        (0, "a", 1, "tag1"), (1, "b", 3, "tag2"), (2, "a", 3, "tag3"), (3, "b", 3, "tag2"),
        (4, "b", 4, "tag4"),
    ]


def test_rolling_reduce(sensor):
    out = rolling.rolling_reduce(sensor, "id", "seq", timestamp="last", temperature="sum")
    assert rows(out.filter("id = 'sensor_1'"), "timestamp", "temperature") == [
        (1547718199, 1.0), (1547718206, 3.0), (1547718207, 6.0),
    ]
    assert rows(out.filter("id = 'sensor_7'"), "timestamp", "temperature") == [(1547718202, 2.0)]


@pytest.fixture
def words(spark):
    data = list(enumerate(["aa", "bb", "aa", "dd"]))
    return spark.createDataFrame(data, "seq long, word string")


def test_rolling_fold(words):
    out = rolling.rolling_fold(words, "word", "word", "seq", init="tag")
    assert rows(out, "seq", "acc") == [
        (0, "tag_aa"), (1, "tag_bb"), (2, "tag_aa_aa"), (3, "tag_dd"),
    ]


def test_long_keys_are_given_whole(spark):
    """2,500 records in a key: the full text, the full list and the full firing."""
    data = spark.range(2500).selectExpr(
        "id AS seq", "'k' AS k", "cast(id AS string) AS v", "timestamp_seconds(id % 7) AS ts"
    )
    folded = rolling.rolling_fold(data, "k", "v", "seq", init="i").filter("seq = 2499").first()
    assert folded["acc"] == "_".join(["i", *map(str, range(2500))])
    listed = windows.window_list(data, "ts", "1 hour", "seq", F.col("v"), key="k")
    assert rows(listed, "place", "item") == sorted(
        [(i + 1, str(i)) for i in range(2500)], key=repr
    )
    left, right = data.filter("seq % 2 = 0"), data.filter("seq % 2 = 1")
    fired = joins.session_cogroup(left, right, "k", "ts", "1 hour", "seq", "v", every=2500).first()
    assert fired["first_items"] == [str(i) for i in range(0, 2500, 2)]
    assert fired["second_items"] == [str(i) for i in range(1, 2500, 2)]


def test_small_changes_are_not_rounded_away(spark):
    data = spark.createDataFrame([(i, "a", v) for i, v in enumerate((1e-7, 2e-7, 1e-7))], "seq long, id string, v double")
    totals = [1e-7, 1e-7 + 2e-7, 1e-7 + 2e-7 + 1e-7]
    expected = sorted(
        [(0, True, totals[0])]
        + [(i, flag, totals[i - (not flag)]) for i in (1, 2) for flag in (False, True)], key=repr
    )
    for chunk in (None, 100):
        out = changelog.retract_group(data, "id", "v", "seq", chunk=chunk)
        assert rows(out, "seq", "flag", "v") == expected
    streamed = replay(
        spark, {"t": (data, "seq")}, lambda s: keyed.retract_group_stream(s, "id", "v", "seq")
    )
    assert rows(streamed, "seq", "flag", "v") == expected


def test_rolling_fold_in_segments_joins_to_the_whole_text(spark):
    data = spark.range(25).selectExpr("id AS seq", "'k' AS k", "cast(id AS string) AS v")
    out = rolling.rolling_fold_segments(data, "k", "v", "seq", init="i", segment=10)
    last = {}
    for r in out.orderBy("seq").collect():
        last[r["segment_no"]] = r["acc"]
        assert "_".join(last[s] for s in sorted(last)) == "_".join(
            ["i", *[str(n) for n in range(r["seq"] + 1)]]
        )


def test_rolling_fold_stream(spark, words):
    out = replay(
        spark,
        {"words": (words, "seq")},
        lambda s: keyed.rolling_fold_stream(
            s, "word", "seq", "tag", lambda acc, row: f"{acc}_{row['word']}", "acc string"
        ),
    )
    assert rows(out, "seq", "acc") == [
        (0, "tag_aa"), (1, "tag_bb"), (2, "tag_aa_aa"), (3, "tag_dd"),
    ]


def keyed_words(spark, text):
    return spark.createDataFrame(list(enumerate(text)), "seq long, word string").withColumn(
        "one", F.lit(1.0)
    )


def test_rolling_count(spark):
    out = rolling.rolling_count(keyed_words(spark, "ababca"), "word", "seq", chunk=2)
    assert [(r["word"], r["n"]) for r in out.orderBy("seq").collect()] == [
        ("a", 1), ("b", 1), ("a", 2), ("b", 2), ("c", 1), ("a", 3),
    ]


def test_tags(sensor):
    t = F.col("temperature")
    tagged = rowops.tag(sensor, {"low": t < 1, "middle": (t >= 1) & (t < 3), "high": t >= 3})
    assert rowops.select_tags(tagged, "low").count() == 0
    assert rows(rowops.select_tags(tagged, "middle"), "id", "temperature") == [
        ("sensor_1", 1.0), ("sensor_1", 2.0), ("sensor_6", 1.0), ("sensor_7", 2.0),
    ]
    assert rows(rowops.select_tags(tagged, "high"), "id") == [("sensor_1",), ("sensor_10",)]
    assert rowops.select_tags(tagged, "middle", "high").count() == 6


def test_side_output_with_the_literal_predicate(spark):
    numbers = spark.createDataFrame([(n,) for n in (1, 2, 3, 4)], "v int")
    halves = F.expr("v div 2 = 0")
    main, side = rowops.side_output(numbers, halves, side=[(F.col("v") + 100).alias("v")])
    assert rows(main) == [(1,)]
    assert rows(side) == [(102,), (103,), (104,)]


def test_sequence(spark):
    out = ingest.sequence(spark, 1, 10, partitions=4).selectExpr("value * 2 AS v").filter("v > 10")
    assert rows(out) == [(12,), (14,), (16,), (18,), (20,)]


# --- alerts and patterns -----------------------------------------------------


@pytest.fixture
def trend(spark):
    data = [
        ("a", 0, 1.0), ("a", 1, 2.0), ("a", 3, 2.0), ("a", 4, 3.0), ("a", 7, 1.0),
        ("b", 0, 1.0), ("b", 1, 2.0), ("b", 4, 1.5),
    ]
    table = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(data)], "seq long, k string, s long, v double"
    )
    return table.withColumn("ts", F.timestamp_seconds(F.col("s") + BASE // 1000))


def test_rising_alert(trend):
    out = alerts.trend_alert(trend, "k", "ts", "v", "5 seconds", "seq", chunk=2)
    assert rows(out.select("k", F.unix_seconds("alert_at") - BASE // 1000)) == [("a", 6)]


def test_falling_alert_is_the_mirror_image(trend):
    mirrored = trend.withColumn("v", -F.col("v"))
    out = alerts.trend_alert(mirrored, "k", "ts", "v", "5 seconds", "seq", direction="falling")
    assert rows(out.select("k", F.unix_seconds("alert_at") - BASE // 1000)) == [("a", 6)]


def test_a_null_value_changes_no_trend(trend):
    nulls = trend.withColumns({"seq": F.col("seq") + 0.5, "v": F.lit(None).cast("double")})
    both = trend.unionByName(nulls.withColumn("seq", F.col("seq")), allowMissingColumns=True)
    both = both.withColumn("seq", (F.col("seq") * 2).cast("long"))
    out = alerts.trend_alert(both, "k", "ts", "v", "5 seconds", "seq")
    assert rows(out.select("k", F.unix_seconds("alert_at") - BASE // 1000)) == [("a", 6)]


def test_rising_alert_stream(spark, trend):
    table = trend.select("seq", "k", "ts", "v")
    out = replay(
        spark,
        {"t": (table, "seq")},
        lambda s: timers.trend_alert_stream(
            s, "k", "ts", "v", "5 seconds", "seq", bound="10 seconds"
        ),
    )
    assert rows(out.select("k", F.unix_seconds("alert_at") - BASE // 1000)) == [("a", 6)]


@pytest.fixture
def jumps(spark):
    return spark.createDataFrame(
        [(0, "id", 12.0), (1, "id", 13.0), (2, "id", 30.0)], "seq long, k string, v double"
    )


def test_jump_alert(jumps):
    zero = alerts.jump_alert(jumps, "k", "seq", "v", 10, first="zero", chunk=1)
    assert rows(zero, "k", "previous", "current") == [("id", 0.0, 12.0), ("id", 13.0, 30.0)]
    skip = alerts.jump_alert(jumps, "k", "seq", "v", 10, first="skip", chunk=1)
    assert rows(skip, "k", "previous", "current") == [("id", 13.0, 30.0)]


def test_pattern_times_relaxed_and_strict(spark):
    data = [(0, 25.0), (1, 3.0), (2, 26.0), (3, 27.0), (4, 1.0), (5, 30.0)]
    table = spark.createDataFrame(data, "seq long, v double").withColumn("k", F.lit("x"))
    hot = F.col("v") > 23
    relaxed = alerts.pattern_times(table, "k", "seq", hot, 2, chunk=2)
    assert rows(relaxed, "first", "last") == [(0, 2), (2, 3), (3, 5)]
    strict = alerts.pattern_times(table, "k", "seq", hot, 2, strict=True, chunk=2)
    assert rows(strict, "first", "last") == [(2, 3)]
    single = alerts.pattern_times(table, "k", "seq", hot, 1)
    assert rows(single, "first", "last") == [(0, 0), (2, 2), (3, 3), (5, 5)]


# --- windows -----------------------------------------------------------------


def test_count_window_tumbling(spark):
    out = windows.count_window(
        keyed_words(spark, "abcabad"), "word", "seq", 3, {"n": F.sum("one")}, chunk=2
    )
    assert rows(out, "word", "n") == [("a", 3.0)]


def test_count_window_sliding(spark):
    table = keyed_words(spark, "accdabcccb")
    out = windows.count_window(
        table, "word", "seq", 5, {"n": F.sum("one")}, slide=2, chunk=3
    )
    expected = [("a", 2, 2.0), ("b", 2, 2.0), ("c", 2, 2.0), ("c", 4, 4.0)]
    assert rows(out, "word", "fire", "n") == expected
    once = windows.count_window(table, "word", "seq", 40, {"n": F.sum("one")}, slide=2, chunk=3)
    assert rows(once, "word", "fire", "n") == expected
    streamed = replay(
        spark,
        {"w": (table, "seq")},
        lambda s: keyed.count_window_stream(s, "word", "seq", "one", 5, slide=2),
    )
    assert rows(streamed, "word", "fire", "total") == expected


@pytest.mark.parametrize("records, fires", [(1, []), (2, []), (3, [3]), (6, [3, 6])])
def test_count_window_never_fires_incomplete(spark, records, fires):
    out = windows.count_window(
        keyed_words(spark, "k" * records), "word", "seq", 3, {"n": F.count("*")}, chunk=4
    )
    assert rows(out, "fire", "n") == [(f, 3) for f in fires]


def readings(spark, data):
    """(id, ms, value) with event time and arrival order."""
    table = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(data)], "seq long, id string, ms long, v double"
    )
    return table.withColumn("ts", F.timestamp_millis("ms"))



def test_count_per_window(spark):
    data = [("sensor_1", BASE, 1.0)] * 3 + [("sensor_2", BASE, 1.0)] * 3
    out = windows.window_agg(
        readings(spark, data), "id", "ts", 3, [F.count("*").alias("n")]
    )
    assert rows(out, "id", "n") == [("sensor_1", 3), ("sensor_2", 3)]


def test_reduce_then_format(spark):
    data = [("sensor_1", BASE, v) for v in (1.0, 1.1, 1.2)]
    data += [("sensor_2", BASE, v) for v in (2.0, 2.1)]
    out = windows.window_agg(
        readings(spark, data), "id", "ts", 3,
        [F.min("ms").alias("ms"), F.round(F.sum("v"), 6).alias("v")],
    )
    assert rows(out, "id", "ms", "v") == [("sensor_1", BASE, 3.3), ("sensor_2", BASE, 4.1)]


def test_per_element_trigger(spark):
    from millrace.operators import scan

    table = readings(spark, [("sensor_1", BASE, 1.0), ("sensor_1", BASE, 1.1)])
    out = windows.fire_every(table, "id", "ts", 3, "seq", 1, {"s": scan.run_sum("v")}, chunk=1)
    out = out.select("n", F.unix_millis("window_end"), F.round(F.col("s") / F.col("n"), 6))
    assert rows(out) == [(1, BASE + 2, 1.0), (2, BASE + 2, 1.05)]


def test_tumble_ignores_what_comes_later(spark):
    data = [("sensor_1", BASE, v) for v in (1.0, 1.1, 1.2)]
    table = readings(spark, data)
    out = windows.tumble(
        table, "ts", "2 seconds", ["id"], [F.round(F.sum("v"), 6).alias("v")], rowtime=True
    )
    out = out.select(
        "v", F.unix_millis("window_start"), F.unix_millis("window_end"), F.unix_millis("rowtime")
    )
    assert rows(out) == [(3.3, BASE, BASE + 2000, BASE + 1999)]


@pytest.mark.parametrize(
    "ts, size, start",
    [
        (1599990791000, 3000, 1599990789000),
        (1547718199, 15, 1547718195),
        (1612969009753, 7000, 1612969008000),
    ],
)
def test_window_start(spark, ts, size, start):
    table = spark.createDataFrame([(ts,)], "t long")
    assert rows(table.select(latedata.window_start(F.col("t"), size))) == [(start,)]
    w = F.window(F.timestamp_millis("t"), f"{size} milliseconds")
    assert rows(table.select(F.unix_millis(w.start))) == [(start,)]


def test_over_two_preceding_rows(spark):
    table = readings(spark, [("s", BASE + i, float(v)) for i, v in enumerate((1, 1, 1, 3, 4, 5))])
    out = aggs.over_rows(table, "id", "seq", 2, {"total": F.sum("v")}, chunk=2)
    assert [r["total"] for r in out.orderBy("seq").collect()] == [1, 2, 3, 5, 8, 12]


# --- late data ---------------------------------------------------------------


def late_table(spark, data):
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(data, 1)], "seq long, id string, ts long, v double"
    )


# (id, last four digits of the time, value); the times are 159999079xxxx.
LATE = [
    ("s1", 790000, 1.0), ("s1", 790000, 1.1), ("s1", 790000, 1.2), ("s2", 792000, 2.0),
    ("s2", 792000, 2.1), ("s2", 792500, 2.2), ("s2", 793000, 2.0), ("s1", 790000, 4.1),
    ("s2", 794000, 1.0), ("s1", 790000, 1.0), ("s2", 795000, 1.0), ("s1", 790000, 9.0),
    ("s2", 796000, 1.0), ("s1", 792500, 5.0),
]


def brute_lateness(data, size, bound, lateness):
    """The rules, record by record."""
    top, held, fired, out = None, {}, {}, []
    for seq, (key, ts, value) in enumerate(data, 1):
        before = None if top is None else top - bound
        end = ts - ts % size + size
        late = before is not None and end - 1 + lateness <= before
        if not late:
            held.setdefault((key, end), []).append(value)
            if before is not None and end - 1 <= before:
                fired[(key, end)] = fired.get((key, end), 0) + 1
                out.append((key, end, fired[(key, end)], seq, len(held[(key, end)]),
                            round(sum(held[(key, end)]), 6)))
        top = ts if top is None else max(top, ts)
        for (k, e), values in held.items():
            if e - 1 <= top - bound and (before is None or e - 1 > before):
                out.append((k, e, 0, seq, len(values), round(sum(values), 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("lateness", [0, 500, 2000])
@pytest.mark.parametrize("bound", [0, 1, 1000])
@pytest.mark.parametrize("chunk", [3, 1000])
def test_allowed_lateness_against_record_by_record(spark, chunk, bound, lateness):
    out = latedata.allowed_lateness(
        late_table(spark, LATE), "id", "ts", "seq", "v", 3000, bound, lateness, chunk=chunk
    )
    out = out.select("id", "window_end", "firing", "fired_at", "n", F.round("total", 6))
    assert rows(out) == brute_lateness(LATE, 3000, bound, lateness)


def test_a_time_far_ahead_crosses_only_windows_with_data(spark):
    data = [("s1", 1000, 1.0), ("s2", 5000, 2.0), ("s1", 10**15, 1.0), ("s1", 10**15 + 9, 1.0)]
    for bound in (0, 3000):
        out = latedata.allowed_lateness(
            late_table(spark, data), "id", "ts", "seq", "v", 3000, bound, 0
        )
        out = out.select("id", "window_end", "firing", "fired_at", "n", F.round("total", 6))
        assert rows(out) == brute_lateness(data, 3000, bound, 0)


def test_late_records_go_to_the_side(spark):
    table = late_table(spark, LATE)
    kept, late = latedata.late_split(table, "ts", "seq", 3000, 1000, 0, chunk=4)
    assert kept.count() + late.count() == len(LATE)
    top = brute = None
    expected = []
    for seq, (_, ts, _) in enumerate(LATE, 1):
        if top is not None and ts - ts % 3000 + 2999 <= top - 1000:
            expected.append((seq,))
        top = ts if top is None else max(top, ts)
    assert brute is None
    assert rows(late, "seq") == sorted(expected, key=repr)


# --- changelogs --------------------------------------------------------------


@pytest.fixture
def gains(spark):
    data = [(0, "sensor_1", 1.0), (1, "sensor_2", 1.0), (2, "sensor_1", 9.0)]
    return spark.createDataFrame(data, "seq long, id string, v double")


RETRACTED = [
    (0, True, "sensor_1", 1.0), (1, True, "sensor_2", 1.0), (2, False, "sensor_1", 1.0),
    (2, True, "sensor_1", 10.0),
]


def test_retract_group(spark, gains):
    out = changelog.retract_group(gains, "id", "v", "seq", chunk=1)
    assert rows(out, "seq", "flag", "id", "v") == sorted(RETRACTED, key=repr)
    streamed = replay(
        spark,
        {"g": (gains, "seq")},
        lambda s: keyed.retract_group_stream(s, "id", "v", "seq"),
    )
    assert rows(streamed, "seq", "flag", "id", "v") == sorted(RETRACTED, key=repr)


def test_retract_group_with_nulls(spark):
    data = [(0, "a", None), (1, "a", 2.0), (2, "a", None), (3, "a", 0.0), (4, "a", -2.0)]
    table = spark.createDataFrame(data, "seq long, id string, v double")
    expected = [
        (0, True, None), (1, False, None), (1, True, 2.0), (4, False, 2.0), (4, True, 0.0),
    ]
    for chunk in (1, 100):
        out = changelog.retract_group(table, "id", "v", "seq", chunk=chunk)
        assert rows(out, "seq", "flag", "v") == sorted(expected, key=repr)
    streamed = replay(
        spark, {"t": (table, "seq")}, lambda s: keyed.retract_group_stream(s, "id", "v", "seq")
    )
    assert rows(streamed, "seq", "flag", "v") == sorted(expected, key=repr)


def test_top_n_changelog(spark):
    table = spark.createDataFrame(
        [(0, "sensor_6", 1.1), (1, "sensor_6", 1.2)], "seq long, id string, v double"
    )
    expected = [(0, True, 1.1, 1), (1, False, 1.1, 1), (1, True, 1.1, 2), (1, True, 1.2, 1)]
    for chunk in (1, 1000):
        out = changelog.top_n_changelog(table, "id", "v", "seq", 3, chunk=chunk)
        assert rows(out, "seq", "flag", "v", "rank") == expected
    streamed = replay(
        spark, {"t": (table, "seq")}, lambda s: keyed.top_n_stream(s, "id", "v", "seq", 3)
    )
    assert rows(streamed, "seq", "flag", "v", "rank") == expected


@pytest.fixture
def two_sides(spark):
    left = spark.createDataFrame([(10, "s", 1.0), (60, "t", 4.0)], "lseq long, id string, l double")
    right = spark.createDataFrame(
        [(20, "s", "1.1"), (30, "s", "1.2"), (31, "t", "cc"), (32, "t", "ee"), (33, "t", "ee")],
        "rseq long, id string, r string",
    )
    return left, right


JOINED = [
    (10, True, "s", 1.0, None), (20, False, "s", 1.0, None), (20, True, "s", 1.0, "1.1"),
    (30, True, "s", 1.0, "1.2"), (60, True, "t", 4.0, "cc"), (60, True, "t", 4.0, "ee"),
    (60, True, "t", 4.0, "ee"),
]


def test_left_join_changelog(spark, two_sides):
    left, right = two_sides
    out = changelog.changelog_left_join(left, right, "id", "lseq", "rseq")
    assert rows(out, "seq", "flag", "id", "l", "r") == sorted(JOINED, key=repr)
    streamed = replay(
        spark,
        {"l": (left, "lseq"), "r": (right, "rseq")},
        lambda a, b: stream_joins.changelog_left_join_stream(a, b, "id", "lseq", "rseq", ttl=None),
    )
    assert rows(streamed, "seq", "flag", "id", "l", "r") == sorted(JOINED, key=repr)


def test_apply_changes(spark):
    feed = spark.createDataFrame(
        [("I", 1, 1, "a"), ("I", 2, 2, "b"), ("U", 3, 1, "c"), ("D", 4, 2, "b"), ("I", 5, 3, "d"),
         ("D", 6, 3, "d"), ("I", 7, 3, "e")],
        "op string, seq long, id int, name string",
    )
    assert rows(changelog.apply_changes(feed, "id", "seq", "op"), "id", "name") == [
        (1, "c"), (3, "e"),
    ]


# --- joins -------------------------------------------------------------------


def stamped(spark, data, name, base):
    table = spark.createDataFrame(data, f"id string, {name} long")
    return table.withColumn(f"{name}_ts", F.timestamp_millis(F.col(name) + base))


def test_interval_join_bounds(spark):
    green = stamped(spark, [("sensor_1", 292), ("sensor_2", 293)], "g", 0)
    orange = stamped(spark, [("sensor_1", 291), ("sensor_3", 298), ("sensor_2", 293)], "o", 0)
    out = joins.interval_join(green, orange, "id", "g_ts", "o_ts", -2, 2)
    assert rows(out, "id", "g", "o") == [("sensor_1", 292, 291), ("sensor_2", 293, 293)]


@pytest.mark.parametrize("lo_open", [False, True])
@pytest.mark.parametrize("hi_open", [False, True])
@pytest.mark.parametrize("bin_ms", [None, 1, 3, 50])
def test_interval_join_against_brute_force(spark, lo_open, hi_open, bin_ms):
    lefts, rights = [-7, -2, 0, 3, 5, 9], [-9, -5, -2, 0, 1, 2, 3, 8, 11]
    left = stamped(spark, [("k", n) for n in lefts], "l", 0)
    right = stamped(spark, [("k", n) for n in rights], "r", 0)
    out = joins.interval_join(
        left, right, "id", "l_ts", "r_ts", -3, 2, lo_open=lo_open, hi_open=hi_open, bin=bin_ms
    )
    expected = [
        (a, b)
        for a in lefts
        for b in rights
        if (b - a > -3 if lo_open else b - a >= -3) and (b - a < 2 if hi_open else b - a <= 2)
    ]
    assert rows(out, "l", "r") == sorted(expected, key=repr)


def test_interval_join_left_keeps_rows_without_partner(spark):
    left = stamped(spark, [("a", 0), ("b", 0)], "l", 0)
    right = stamped(spark, [("a", 1)], "r", 0)
    out = joins.interval_join(left, right, "id", "l_ts", "r_ts", 0, 5, how="left")
    assert rows(out, "id", "l", "r") == [("a", 0, 1), ("b", 0, None)]


def test_window_join(spark):
    orange = stamped(spark, [("sensor_1", 290), ("sensor_1", 291), ("sensor_2", 294)], "o", 1567759000)
    green = stamped(spark, [("sensor_1", 292), ("sensor_1", 293)], "g", 1567759000)
    out = joins.window_join(orange, green, "id", "o_ts", "g_ts", 5)
    assert rows(out, "id", "o", "g") == [
        ("sensor_1", o, g) for o in (290, 291) for g in (292, 293)
    ]
    starts = {r[0] for r in out.select(F.unix_millis("window_start")).collect()}
    assert starts == {1567759290}


def test_a_long_session_that_fires_rarely(spark):
    """100,000 elements and two firings: only these carry content."""
    rows_ = spark.range(100_000).selectExpr("'k' AS k", "timestamp_seconds(id) AS ts", "id AS seq", "id AS v")
    left, right = rows_.filter("id % 4 > 0"), rows_.filter("id % 4 = 0")
    out = joins.session_cogroup(left, right, "k", "ts", "1 hour", "seq", "v", every=50_000)
    found = {r["fire"]: r for r in out.collect()}
    assert sorted(found) == [50_000, 100_000]
    for fire, r in found.items():
        assert r["second_items"] == list(range(0, fire, 4)) and r["n_second"] == fire // 4
        assert r["first_items"] == [i for i in range(fire) if i % 4] and r["n_first"] == fire - fire // 4


def test_session_join_and_cogroup(spark):
    def side(data, name):
        table = spark.createDataFrame(data, f"k string, s long, seq long, {name} string")
        return table.withColumn("ts", F.timestamp_seconds("s"))

    left = side([("a", 0, 1, "l1"), ("a", 25, 4, "l2"), ("b", 0, 6, "l3")], "item")
    right = side([("a", 10, 2, "r1"), ("a", 11, 3, "r2"), ("a", 40, 5, "r3")], "item")
    pairs = joins.session_join(
        left.withColumnRenamed("item", "x"), right.withColumnRenamed("item", "y"),
        "k", "ts", "10 seconds", "x", "y",
    )
    assert rows(pairs, "x", "y") == [("l1", "r1"), ("l1", "r2")]
    whole = joins.session_cogroup(left, right, "k", "ts", "10 seconds", "seq", "item")
    found = {
        (r["k"], tuple(r["first_items"]), tuple(r["second_items"])) for r in whole.collect()
    }
    assert found == {
        ("a", ("l1",), ("r1", "r2")), ("a", ("l2",), ()), ("a", (), ("r3",)), ("b", ("l3",), ()),
    }
    fired = joins.session_cogroup(left, right, "k", "ts", "10 seconds", "seq", "item", every=2)
    assert [(r["fire"], r["first_items"], r["second_items"]) for r in fired.collect()] == [
        (2, ["l1"], ["r1"])
    ]
    every = [
        {(r["fire"], tuple(r["first_items"]), tuple(r["second_items"])) for r in f(
            left, right, "k", "ts", "20 seconds", "seq", "item", every=2).collect()}
        for f in (joins.session_cogroup, joins.session_cogroup_steps)
    ]
    assert every[0] == {(2, ("l1",), ("r1",)), (4, ("l1", "l2"), ("r1", "r2"))}
    assert every[1] == {(2, ("l1",), ("r1",)), (4, ("l2",), ("r2",))}


# --- functions ---------------------------------------------------------------


def test_split_rows(spark):
    table = spark.createDataFrame([("sensor_1a_2b_3c",)], "t string")
    assert rows(udfs.split_rows(table, "t", "_"), "word", "length") == [
        ("1a", 2), ("2b", 2), ("3c", 2), ("sensor", 6),
    ]


def test_weighted_avg(spark):
    table = spark.createDataFrame(
        [("x", 10, 1, 1), ("x", 20, 3, 1), ("y", 5, 0, 1), ("z", 10, 1, 1), ("z", 7, 2, 1),
         ("z", 7, 2, -1)],
        "k string, v long, w int, sign int",
    )
    out = table.groupBy("k").agg(aggs.weighted_avg("v", "w", "sign").alias("mean"))
    assert rows(out) == [("x", 17), ("y", None), ("z", 10)]


def test_levels(spark):
    table = spark.createDataFrame([(3.0,), (3.5,), (30.0,), (31.0,)], "t double")
    level = F.when((F.col("t") > 3) & (F.col("t") < 30), "high").when(F.col("t") > 30, "highest")
    assert [r[0] for r in table.orderBy("t").select(level.otherwise("low")).collect()] == [
        "low", "high", "low", "highest",
    ]


def test_case_list_and_is_digit(spark):
    table = spark.createDataFrame([("a",), ("b",), ("c",), ("12",), ("",), (None,)], "t string")
    level = case_list("t", [(["a", "b"], 1), (["b", "c"], 2)], 0)
    assert rows(table.select("t", level)) == [
        ("", 0), ("12", 0), ("a", 1), ("b", 1), ("c", 2), (None, 0),
    ]
    assert rows(table.select("t", is_digit("t"))) == [
        ("", False), ("12", True), ("a", False), ("b", False), ("c", False), (None, None),
    ]


def test_udf_forms_agree(spark):
    udfs.register(spark)
    table = spark.createDataFrame([("ab",), (None,)], "t string")
    column = table.select(udfs.upper_suffix("t"), udfs.upper_suffix("t", "x"))
    sql = spark.sql("SELECT upper_suffix(t), upper_suffix(t, 'x') FROM {t}", t=table)
    assert rows(column) == rows(sql) == [("AB", "ABx"), (None, None)]
