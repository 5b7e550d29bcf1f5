"""Streaming forms: restarts, more rounds, timers by the clock, expiry, late rows."""

import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import alerts, enrich, latedata, rolling, windows
from millrace.plans.replay import feed, newest, replay
from millrace.session import fresh_dir
from millrace.streaming import batches, keyed, timers

BASE = 1_700_000_000


@pytest.fixture
def ticks(spark):
    """60 readings of three keys in time order, one a second."""
    data = [
        (i, "abc"[(i * i + i // 7) % 3], BASE + i, float((i * 37) % 11)) for i in range(60)
    ]
    table = spark.createDataFrame(data, "seq long, k string, s long, v double")
    return table.select("seq", "k", F.timestamp_seconds("s").alias("ts"), "v")


@pytest.mark.parametrize("rounds", [2, 5])
def test_rounds_do_not_change_the_result(spark, ticks, rounds):
    table = ticks.select("seq", "k", "v")
    streamed = replay(
        spark,
        {"t": (table, "seq")},
        lambda s: keyed.rolling_reduce_stream(s, "k", "seq", v="sum"),
        rounds=rounds,
    )
    batch = rolling.rolling_sum(table, "k", "v", "seq", chunk=7)
    assert rows(streamed, "seq", "v") == rows(batch, "seq", "v")


def test_rolling_extremes(spark, ticks):
    table = ticks.select("seq", "k", "v")
    for largest, batch in ((True, rolling.rolling_max_by), (False, rolling.rolling_min_by)):
        streamed = replay(
            spark,
            {"t": (table, "seq")},
            lambda s, largest=largest: keyed.rolling_extreme_stream(
                s, "k", "v", "seq", largest=largest
            ),
        )
        assert rows(streamed, "seq", "v") == rows(batch(table, "k", "v", "seq"), "seq", "v")


def every_alert(data, hold, sign):
    """The alert rule record by record; data is (key, second, value) in order."""
    state, out = {}, []
    for key, at, value in data:
        last, armed = state.get(key, (None, None))
        if armed is not None and armed + hold <= at:
            out.append((key, armed, armed + hold))
            armed = None
        step = 0 if last is None else sign * (value - last)
        if step > 0 and armed is None:
            armed = at
        elif step < 0:
            armed = None
        state[key] = (value, armed)
    return out, {k: armed for k, (_, armed) in state.items() if armed is not None}


@pytest.mark.parametrize("direction, sign", [("rising", 1), ("falling", -1)])
def test_alerts_fire_again_after_an_alert(spark, direction, sign):
    values = [1, 2, 3, 4, 5, 6, 7, 3, 4, 4, 4, 5, 6, 1, 0, -1, -2, -3, -4, -4, -5]
    data = [("a", i, float(v)) for i, v in enumerate(values)]
    table = spark.createDataFrame(
        [(i, k, s + BASE, v) for i, (k, s, v) in enumerate(data)],
        "seq long, k string, s long, v double",
    ).select("seq", "k", F.timestamp_seconds("s").alias("ts"), "v")
    streamed = replay(
        spark,
        {"t": (table, "seq")},
        lambda s: timers.trend_alert_stream(
            s, "k", "ts", "v", "2 seconds", "seq", direction, bound="0 seconds"
        ),
    ).select("k", F.unix_seconds("armed_at") - BASE, F.unix_seconds("alert_at") - BASE)
    expected, pending = every_alert(data, 2, sign)
    # An alert still pending at the end is due after the last watermark.
    assert all(armed + 2 > len(values) - 1 for armed in pending.values())
    assert rows(streamed) == sorted(expected, key=repr)
    everything = sorted(
        [*expected, *[(k, a, a + 2) for k, a in pending.items()]], key=repr
    )
    for chunk in (1, 2, 3, 5, 100, None):
        whole = alerts.trend_alerts(
            table, "k", "ts", "v", "2 seconds", "seq", direction, chunk=chunk
        ).select("k", F.unix_seconds("armed_at") - BASE, F.unix_seconds("alert_at") - BASE)
        assert rows(whole) == everything
    first_only = alerts.trend_alert(table, "k", "ts", "v", "2 seconds", "seq", direction)
    found = set(rows(first_only.select("k", F.unix_seconds("armed_at") - BASE)))
    assert found <= {(k, a) for k, a, _ in expected} | set(pending.items())


@pytest.mark.parametrize("hold", [1, 4, 9])
@pytest.mark.parametrize("chunk", [1, 4, 13])
def test_every_alert_in_chunks_of_long_trends(spark, hold, chunk):
    """Long rises, so that whole chunks pass without a drop; two keys, gaps, equal values."""
    import random

    rng = random.Random(hold * 100 + chunk)
    data, at, level = [], 0, {"a": 0, "b": 0}
    for _ in range(160):
        at += rng.choice([1, 1, 1, 2, 6])
        k = rng.choice("aab")
        level[k] += rng.choice([1, 1, 1, 1, 1, 0, 2] + [-3] * (rng.random() < 0.3))
        data.append((k, at, float(level[k])))
    table = spark.createDataFrame(
        [(i, k, s + BASE, v) for i, (k, s, v) in enumerate(data)],
        "seq long, k string, s long, v double",
    ).withColumn("ts", F.timestamp_seconds("s"))
    out = alerts.trend_alerts(table, "k", "ts", "v", f"{hold} seconds", "seq", chunk=chunk)
    expected, pending = every_alert(data, hold, 1)
    expected += [(k, a, a + hold) for k, a in pending.items()]
    assert rows(
        out.select("k", F.unix_seconds("armed_at") - BASE, F.unix_seconds("alert_at") - BASE)
    ) == sorted(expected, key=repr)


def test_alerts_of_a_key_that_only_rises(spark, monkeypatch):
    """One trend of 3,000 moves, which is most of the table, is linked and followed in pieces."""
    from millrace.operators import scan

    monkeypatch.setattr(scan, "HOT_ROWS", 200)
    monkeypatch.setattr(scan, "CHUNK_ROWS", 100)
    data = [("a", i, float(i)) for i in range(3001)] + [("b", i, float(i % 7)) for i in range(300)] + [(None, i, float(i)) for i in range(9)]
    table = spark.createDataFrame(
        [(i, k, s + BASE, v) for i, (k, s, v) in enumerate(data)], "seq long, k string, s long, v double"
    ).withColumn("ts", F.timestamp_seconds("s"))
    out = alerts.trend_alerts(table, "k", "ts", "v", "2 seconds", "seq")
    expected, pending = every_alert(data, 2, 1)
    expected += [(k, a, a + 2) for k, a in pending.items()]
    assert rows(
        out.select("k", F.unix_seconds("armed_at") - BASE, F.unix_seconds("alert_at") - BASE)
    ) == sorted(expected, key=repr)
    assert "InPandas" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hold", [0, 3])
def test_alerts_at_equal_times(spark, hold):
    data = [("a", i // 3, float(v)) for i, v in enumerate([1, 2, 3, 4, 5, 6, 2, 3, 3, 4, 1, 2, 3, 4, 5, 6, 7, 8])]
    table = spark.createDataFrame(
        [(i, k, s + BASE, v) for i, (k, s, v) in enumerate(data)], "seq long, k string, s long, v double"
    ).withColumn("ts", F.timestamp_seconds("s"))
    out = alerts.trend_alerts(table, "k", "ts", "v", f"{hold} seconds", "seq")
    state, expected = [None, None], []
    for _, at, value in data:  # as every_alert, but a due alert and the move that meets it are one record
        last, armed = state
        step = 0 if last is None else value - last
        if armed is not None and armed + hold <= at and step:
            expected.append(("a", armed, armed + hold))
            armed = None
        if step > 0 and armed is None:
            armed = at
        elif step < 0:
            armed = None
        state = [value, armed]
    if state[1] is not None:
        expected.append(("a", state[1], state[1] + hold))
    assert rows(out.select("k", F.unix_seconds("armed_at") - BASE, F.unix_seconds("alert_at") - BASE)) == sorted(expected, key=repr)


@pytest.mark.parametrize("n, chunk, fan", [(1, 3, 2), (3, 4, 2), (3, 1, 3), (5, 256, 256)])
def test_top_n_changes_over_many_blocks(spark, monkeypatch, n, chunk, fan):
    """A key with most of the rows; lists are merged over several levels."""
    import random

    from millrace.operators import changelog, scan

    monkeypatch.setattr(scan, "HOT_ROWS", 30)
    monkeypatch.setattr(scan, "CHUNK_ROWS", 11)
    monkeypatch.setattr(changelog, "BLOCK", fan)
    draw = random.Random(n * 10 + chunk)
    data = [(i, draw.choice(["a", "a", "b", None]), None if draw.random() < 0.1 else float(draw.randint(0, 30))) for i in range(160)]
    df = spark.createDataFrame(data, "seq long, k string, v double")
    out = changelog.top_n_changelog(df, "k", "v", "seq", n, chunk=chunk)
    tops, expected = {}, []
    for seq, k, v in data:
        if v is None:
            continue
        expected += [(flag, k, u, rank, at) for flag, u, rank, at in keyed._enter(tops.setdefault(k, []), v, seq, n)]
    assert rows(out) == sorted(expected, key=repr)


def test_changes_that_come_late_or_twice(spark):
    from millrace.operators import changelog

    feed_ = [(0, "a", 5, "U", "x"), (1, "a", 3, "I", "old"), (2, "b", 1, "I", "y"), (3, "b", 4, "D", None), (4, "b", 2, "U", "late"),
             (5, "a", 5, "U", "x"), (6, "c", 9, "D", None), (7, "c", 8, "I", "z"), (8, "d", 1, "I", "w")]
    table = spark.createDataFrame(feed_, "at long, k string, seq long, op string, v string")
    for rounds in (1, 3, 9):
        written = replay(
            spark, {"t": (table, "at")}, lambda s: changelog.newest_changes(s.drop("at"), "k", "seq"), mode="update", rounds=rounds
        )
        found = changelog.snapshot(written.drop("batch"), "k", "seq", "op")
        assert rows(found, "k", "seq", "v") == [("a", 5, "x"), ("d", 1, "w")]
    assert rows(changelog.apply_changes(table.drop("at"), "k", "seq", "op"), "k", "seq", "v") == [("a", 5, "x"), ("d", 1, "w")]


@pytest.mark.parametrize("rounds", [1, 4])
def test_totals_of_changes(spark, rounds):
    """Additions and withdrawals, the extremes among them, and a key that loses all its rows."""
    import random

    from millrace.operators import changelog

    draw, live, data = random.Random(rounds), {}, []
    for i in range(120):
        k = draw.choice("abc")
        held = live.setdefault(k, [])
        if held and draw.random() < 0.45:
            data.append((i, k, False, held.pop(draw.randrange(len(held)))))
        else:
            held.append(draw.choice([None, 1.0, 2.0, 5.0, 9.0, 9.0]))
            data.append((i, k, True, held[-1]))
    data += [(200, "gone", True, 4.0), (300, "gone", False, 4.0)]
    table = spark.createDataFrame(data, "seq long, k string, flag boolean, v double")
    expected = []
    for k, held in live.items():
        known = [v for v in held if v is not None]
        if held:
            expected.append((k, len(held), sum(known) if known else None, min(known, default=None), max(known, default=None)))
    whole = changelog.change_totals(table, "k", "v")
    assert rows(whole, "k", "n", "total", "low", "high") == sorted(expected, key=repr)
    written = replay(spark, {"t": (table, "seq")}, lambda s: keyed.change_totals_stream(s, "k", "v"), rounds=rounds)
    last = newest(written, ["k"])
    assert rows(last.filter("n > 0"), "k", "n", "total", "low", "high") == sorted(expected, key=repr)
    empty = sorted(["gone", *(k for k, held in live.items() if not held)])
    assert rows(last.filter("n = 0"), "k", "total", "low", "high") == [(k, None, None, None) for k in empty]


@pytest.mark.parametrize("keep", [{"keep_n": 3}, {"keep_within": "4 seconds"}])
def test_evictors_on_a_stream(spark, ticks, keep):
    table = ticks.unionByName(
        spark.createDataFrame([(1 << 40, "z", BASE + 1000, 0.0)], "seq long, k string, s long, v double")
        .select("seq", "k", F.timestamp_seconds("s").alias("ts"), "v")
    )
    rounds_ = {}
    for rounds in (1, 6):
        written = replay(
            spark, {"t": (ticks, "seq")},
            lambda s: timers.evict_stream(s, "k", "ts", "10 seconds", "seq", "v", bound="0 seconds", **keep),
            rounds=rounds, closing={"t": {"seq": 1 << 40, "k": "z", "ts": "2100-01-01 00:00:00"}},
        )
        rounds_[rounds] = rows(written, "k", "window_start", "n", "total", "low", "high")
    aggs = [F.count("*").alias("n"), F.sum("v").alias("total"), F.min("v").alias("low"), F.max("v").alias("high")]
    whole = windows.evict(table.filter("k <> 'z'"), "k", "ts", "10 seconds", "seq", aggs, **keep)
    assert rounds_[1] == rounds_[6] == rows(whole, "k", "window_start", "n", "total", "low", "high")
    with pytest.raises(ValueError):
        timers.evict_stream(ticks, "k", "ts", "10 seconds", "seq", "v", bound="0 seconds")


def test_rows_without_partner_are_withdrawn_once():
    """Partners come, expire and come again; state in lists in place of the store."""
    from pyspark.sql import types as T

    from millrace.streaming.joins import Unmatched

    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("flag", "k", "l", "seq")])
    job = Unmatched(schema, [T.StructField("l", T.LongType())], 100)

    class Value:
        held = None

        def get(self):
            return self.held

        def update(self, value):
            self.held = value

    class Entries(list):
        get = list.copy
        appendList = list.extend

    class Clock:
        now = 0

        def getCurrentProcessingTimeInMs(self):
            return self.now

    job._alone, job._partner, clock = Entries(), Value(), Clock()
    found = []
    arrivals = [(0, 1, True, 10), (90, 2, False, None), (95, 3, True, 11), (192, 4, False, None), (193, 5, True, 12), (293, 6, True, 13), (294, 7, False, None)]
    for now, seq, is_left, lv in arrivals:
        clock.now = now
        found += [tuple(r) for r in job.handleInputRows((7,), iter([{"_seq": seq, "_is_left": is_left, "l": lv}]), clock)]
    assert found == [(True, 7, 10, 1), (False, 7, 10, 2), (True, 7, 13, 6), (False, 7, 13, 7)]
    assert job._alone == [] and job._partner.held == (294,)


def _two_sides(spark):
    left = spark.range(60).selectExpr("id % 7 AS k", "id * 3 AS lseq", "id AS l")
    right = spark.range(40).selectExpr("(id * id) % 9 AS k", "id * 4 + 1 AS rseq", "id AS r")
    return left, right


@pytest.mark.parametrize("rounds", [1, 4])
def test_left_join_of_streams_as_changes(spark, rounds):
    from millrace.operators import changelog
    from millrace.streaming import joins

    left, right = _two_sides(spark)
    whole = changelog.changelog_left_join(left, right, "k", "lseq", "rseq")
    streamed = replay(
        spark, {"l": (left, "lseq"), "r": (right, "rseq")},
        lambda a, b: joins.changelog_left_join_stream(a, b, "k", "lseq", "rseq", ttl=None), rounds=rounds,
    )
    assert rows(streamed, *whole.columns) == rows(whole)


def test_left_join_of_streams_with_a_ttl(spark):
    from millrace.operators import changelog
    from millrace.streaming import joins

    left, right = _two_sides(spark)
    whole = changelog.changelog_left_join(left, right, "k", "lseq", "rseq")
    path, streams = fresh_dir(spark, "ttl"), []
    for name, table in (("l", left), ("r", right)):
        table.write.parquet(f"{path}/{name}")
        streams.append(spark.readStream.schema(table.schema).parquet(f"{path}/{name}"))
    out = joins.changelog_left_join_stream(*streams, "k", "lseq", "rseq", ttl="1 hour").select(*whole.columns)
    assert running(spark, out, path, 90, lambda df: df.count() >= whole.count()) == rows(whole)


def test_old_last_value_is_forgotten(spark):
    data = [(0, "a", BASE, 1.0), (1, "a", BASE + 100, 2.0), (2, "a", BASE + 101, 3.0),
            (3, "a", BASE + 110, 3.0)]
    table = spark.createDataFrame(data, "seq long, k string, s long, v double").select(
        "seq", "k", F.timestamp_seconds("s").alias("ts"), "v"
    )
    streamed = replay(
        spark,
        {"t": (table, "seq")},
        lambda s: timers.trend_alert_stream(
            s, "k", "ts", "v", "5 seconds", "seq", bound="0 seconds", ttl="30 seconds"
        ),
    )
    # The rise at 100 s is measured against a value older than 30 s, so it does not count.
    assert rows(streamed.select(F.unix_seconds("armed_at") - BASE)) == [(101,)]


def running(spark, stream, path, seconds, ready):
    """Run a job that never ends by itself until its output is ready."""
    job = (
        stream.writeStream.outputMode("append")
        .foreachBatch(batches.folder_sink(f"{path}/out"))
        .option("checkpointLocation", f"{path}/check")
        .start()
    )
    try:
        until = time.monotonic() + seconds
        while time.monotonic() < until and job.isActive:
            try:
                found = spark.read.schema(stream.schema).option(
                    "recursiveFileLookup", True
                ).parquet(f"{path}/out")
                if ready(found):
                    return rows(found)
            except Exception as error:  # noqa: BLE001 - nothing written yet
                if "PATH_NOT_FOUND" not in str(error):
                    raise
            time.sleep(0.5)
    finally:
        job.stop()
    raise AssertionError("no output in time")


def test_processing_time_timer(spark):
    path = fresh_dir(spark, "clock")
    table = spark.createDataFrame(
        [(0, "a", 1.0), (1, "a", 2.0), (2, "b", 2.0), (3, "b", 1.0)], "seq long, k string, v double"
    ).withColumn("ts", F.timestamp_seconds(F.lit(BASE)))
    table.write.parquet(f"{path}/in")
    stream = spark.readStream.schema(table.schema).parquet(f"{path}/in")
    out = timers.trend_alert_stream(
        stream, "k", "ts", "v", "1 second", "seq", bound=None, time_mode="processing"
    ).select("k")
    assert running(spark, out, path, 60, lambda df: df.count() > 0) == [("a",)]


def test_state_with_ttl_runs(spark, ticks):
    path = fresh_dir(spark, "ttl")
    table = ticks.select("seq", "k", "v")
    table.write.parquet(f"{path}/in")
    stream = spark.readStream.schema(table.schema).parquet(f"{path}/in")
    out = keyed.rolling_reduce_stream(stream, "k", "seq", ttl="1 hour", v="sum")
    found = running(spark, out, path, 60, lambda df: df.count() == 60)
    assert len(found) == 60


def test_late_batches_match_the_table_form(spark):
    data = [
        (i, "ab"[i % 2], BASE * 1000 + 700 * i - (4000 if i % 5 == 3 else 0), float(i))
        for i in range(40)
    ]
    table = spark.createDataFrame(data, "seq long, k string, t long, v double")
    whole = latedata.allowed_lateness(table, "k", "t", "seq", "v", 3000, 1000, 2000, chunk=5)
    base, _ = feed(
        spark,
        {"t": (table, "seq")},
        lambda s: s,
        lambda base: batches.allowed_lateness_batches(
            "k", "t", "seq", "v", 3000, 1000, 2000, f"{base}/state",
            batches.folder_sink(f"{base}/out"),
        ),
        rounds=6,
    )
    written = spark.read.schema(whole.schema).option("recursiveFileLookup", True).parquet(
        f"{base}/out"
    )
    assert rows(written, *whole.columns) == rows(whole)
    assert whole.filter("firing > 0").count() > 0


def test_update_mode_shows_late_rows_within_the_bound(spark):
    """A record one batch behind still changes its window; the newest result counts."""
    data = [(0, BASE + 1, 1.0), (1, BASE + 12, 1.0), (2, BASE + 2, 5.0), (3, BASE + 13, 1.0)]
    table = spark.createDataFrame(data, "seq long, s long, v double").select(
        "seq", F.timestamp_seconds("s").alias("ts"), "v"
    )

    def total(bound):
        written = replay(
            spark,
            {"t": (table, "seq")},
            lambda s: windows.window_agg(
                s, [], "ts", "10 seconds", [F.sum("v").alias("v")], bound=bound
            ),
            mode="update",
        )
        return [v for _, _, v in rows(newest(written, ["window_start", "window_end"]))]

    assert sorted(total("1 minute")) == [2.0, 6.0]
    assert sorted(total("0 seconds")) == [1.0, 2.0]


def test_stream_enrichment_uses_the_newest_dimension(spark):
    path = fresh_dir(spark, "dim")
    spark.range(4).withColumnRenamed("id", "k").write.parquet(f"{path}/in")
    versions = iter(["old", "new"])

    def load():
        return spark.createDataFrame([(1, next(versions))], "k long, name string")

    stream = spark.readStream.schema("k long").parquet(f"{path}/in")
    writer = enrich.broadcast_enrich(
        stream, load, "k", refresh_seconds=0, sink=batches.folder_sink(f"{path}/out")
    )
    job = writer.option("checkpointLocation", f"{path}/check").trigger(availableNow=True).start()
    job.awaitTermination()
    out = spark.read.schema("k long, name string").parquet(f"{path}/out/batch=0")
    assert rows(out) == [(1, "new")]
    with pytest.raises(ValueError):
        enrich.broadcast_enrich(stream, lambda: None, "k")


def test_results_that_change_are_refused_in_append_mode(spark, ticks):
    """A result that is not final cannot be appended: Spark says so before anything runs."""
    from pyspark.errors import AnalysisException

    from millrace.operators import changelog

    for transform in (
        lambda s: s.groupBy("k").agg(F.sum("v").alias("v")),
        lambda s: changelog.newest_changes(s, "k", "seq"),
    ):
        with pytest.raises(AnalysisException):
            replay(spark, {"t": (ticks, "seq")}, transform, mode="append")


def test_silent_keys_are_forgotten(spark):
    """A key that comes again after more than ``retain`` starts anew, and the state does not keep it."""
    from millrace.operators import scan

    data = [(i, "busy", 1.0) for i in range(0, 90, 2)] + [(1, "quiet", 10.0), (71, "quiet", 1.0), (41, "often", 5.0), (61, "often", 6.0), (81, "often", 7.0)]
    table = spark.createDataFrame(data, "seq long, k string, v double")
    for retain, expected in ((30, [1.0, 10.0]), (None, [10.0, 11.0])):
        base, _ = feed(
            spark, {"t": (table, "seq")}, lambda s: s,
            lambda base, retain=retain: batches.running_batches(
                "k", "seq", {"total": scan.run_sum("v")}, f"{base}/state", batches.folder_sink(f"{base}/out"), retain=retain
            ),
            rounds=9,
        )
        found = spark.read.schema("seq long, k string, total double").option("recursiveFileLookup", True).parquet(f"{base}/out")
        assert sorted(r["total"] for r in found.filter("k = 'quiet'").collect()) == expected
        assert sorted(r["total"] for r in found.filter("k = 'often'").collect()) == [5.0, 11.0, 18.0]


def test_an_item_is_forgotten_by_itself():
    """Entries of a map, in a dict in place of the store: the ones a batch does not have are not touched."""
    from pyspark.sql import types as T

    from millrace.streaming.keyed import ItemCounts

    class Entries(dict):
        touched = set()

        def getValue(self, key):
            self.touched.add(key)
            return self[key]

        def containsKey(self, key):
            self.touched.add(key)
            return key in self

        def updateValue(self, key, value):
            self[key] = value

    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("k", "item", "seq", "n")])
    job = ItemCounts(schema, T.StructField("item", T.StringType()), "seq", None)
    job._counts = Entries({("a",): (4,), ("b",): (2,)})
    found = [tuple(r) for r in job.handleInputRows(("x",), iter([{"item": i, "seq": s} for s, i in ((3, "a"), (1, "c"), (2, "a"))]), None)]
    assert found == [("x", "c", 1, 1), ("x", "a", 2, 5), ("x", "a", 3, 6)]
    assert job._counts == {("a",): (6,), ("b",): (2,), ("c",): (1,)} and job._counts.touched == {("a",), ("c",)}


def _packed_job(job):
    """A bucket's operator with lists in place of the store, and what a batch of rows gives."""
    from millrace.streaming import buckets

    class Held(list):
        get, appendList = list.__iter__, list.extend

        def appendValue(self, entry):
            self.append(entry)

    class Value:
        held = None

        def get(self):
            return self.held

        def update(self, entry):
            self.held = entry

    class Handle:
        def getListState(self, name, schema):
            return Held()

        def getValueState(self, name, schema):
            return Value()

    job.init(Handle())

    def batch(*rows):
        packs = [(0, buckets.packed(list(zip(*part)))[0]) for part in (rows[::2], rows[1::2]) if part]
        return sorted((tuple(r) for out in job.handleInputRows((0,), iter(packs), None) for r in zip(*buckets.unpacked(out))), key=repr)

    return batch


def test_a_bucket_joins_all_its_keys(monkeypatch):
    """Keys of one bucket keep apart over batches, however small the entries of the state are."""
    from millrace.streaming import buckets
    from millrace.streaming.joins import BucketJoin

    monkeypatch.setattr(buckets, "ENTRY", 1)
    batch = _packed_job(BucketJoin(1, 1))
    assert batch(("a", 5, True, "a5", None), ("b", 3, True, "b3", None), ("b", 2, False, None, "b2"), (None, 1, True, "n", None)) == sorted(
        [(True, "a", "a5", None, 5), (True, "b", "b3", "b2", 3), (True, None, "n", None, 1)], key=repr
    )
    assert batch(("a", 8, False, None, "a8"), ("a", 7, False, None, "a7"), ("a", 6, True, "a6", None), ("b", 9, True, "b9", None)) == sorted(
        [(False, "a", "a5", None, 7), (True, "a", "a6", None, 6), (False, "a", "a6", None, 7), (True, "b", "b9", "b2", 9)]
        + [(True, "a", left, right, seq) for left in ("a5", "a6") for right, seq in (("a7", 7), ("a8", 8))],
        key=repr,
    )
    assert batch(("a", 10, True, "late", None)) == [(True, "a", "late", "a7", 10), (True, "a", "late", "a8", 10)]


def test_a_bucket_totals_all_its_keys():
    from millrace.streaming.keyed import BucketTotals

    batch = _packed_job(BucketTotals(1))
    assert batch(("a", True, 2.0), ("b", True, None), ("a", True, 5.0)) == [("a", 2, 7.0, 2.0, 5.0), ("b", 1, None, None, None)]
    for n in (2, 1):  # NaN is found again
        assert str(batch(*[("c", n > 1, float("nan"))] * n)) == f"[('c', {n}, nan, nan, nan)]"
    assert batch(("a", False, 5.0)) == [("a", 1, 2.0, 2.0, 2.0)]
    assert batch(("b", False, None), ("a", False, 2.0)) == [("a", 0, None, None, None), ("b", 0, None, None, None)]


def test_streams_without_a_ttl_keep_state_by_buckets(spark):
    """Before, every key cost calls of its own to the state store, and the pairs a join with state of its own."""
    from millrace.streaming import buckets, joins

    left, right = _two_sides(spark)
    path = fresh_dir(spark, "plans")
    streams = []
    for name, table in (("l", left), ("r", right)):
        table.write.parquet(f"{path}/{name}")
        streams.append(spark.readStream.schema(table.schema).parquet(f"{path}/{name}"))
    out = joins.changelog_left_join_stream(*streams, "k", "lseq", "rseq", ttl=None)
    names = {f.name: f.dataType for f in out.schema}
    value = next(n for n, kind in names.items() if n not in ("flag", "k", "seq") and buckets.fits(kind) and kind.typeName() != "string")
    plan = keyed.change_totals_stream(out, "k", value)._jdf.queryExecution().analyzed().toString()
    assert plan.count("TransformWithState") == 2 and plan.count("_bucket") > 2 and "Join" not in plan
