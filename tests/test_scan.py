"""The chunked scan against plain Python, over awkward inputs."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import aggs, scan


def brute(data, include_current=True):
    """Per record: count, sum, min, max, first, last of its key so far."""
    held, out = {}, {}
    for seq, key, value in sorted(data, key=lambda r: r[0]):
        seen = held.setdefault(key, [])
        if include_current:
            seen.append(value)
        known = [v for v in seen if v is not None]
        out[seq] = (
            len(seen) or None,
            sum(known) if known else None,
            min(known, default=None),
            max(known, default=None),
            seen[0] if seen else None,
            seen[-1] if seen else None,
        )
        if not include_current:
            seen.append(value)
    return out


def run_all(df, **kw):
    rules = {
        "n": scan.run_count(),
        "total": scan.run_sum("v"),
        "low": scan.run_min("v"),
        "high": scan.run_max("v"),
        "head": scan.run_first("v"),
        "tail": scan.run_last("v"),
    }
    out = scan.running(df, ["k"], "seq", rules, **kw)
    return {r["seq"]: tuple(r[c] for c in rules) for r in out.collect()}


def sample(size, seed, hot):
    rng = random.Random(seed)
    data = []
    for seq in range(-size // 2, size - size // 2):
        key = "hot" if rng.random() < hot else rng.choice(["a", "b", None, "c"])
        data.append((seq, key, rng.choice([None, *range(-5, 6)])))
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("include_current", [True, False])
@pytest.mark.parametrize("chunk", [1, 7, 10_000])
@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
def test_running_matches_plain_python(spark, chunk, hot, include_current):
    data = sample(200, 3, hot)
    df = spark.createDataFrame(data, "seq long, k string, v long")
    found = run_all(df, chunk=chunk, include_current=include_current)
    assert found == brute(data, include_current)


def test_running_continues_from_a_start(spark):
    data = sorted(sample(120, 9, 0.3))
    first, second = data[:50], data[50:]
    head = spark.createDataFrame(first, "seq long, k string, v long")
    start = head.groupBy("k").agg(
        F.count("*").alias("n"), F.sum("v").alias("total"), F.min("v").alias("low"),
        F.max("v").alias("high"), F.min_by("v", "seq").alias("head"),
        F.max_by("v", "seq").alias("tail"),
    )
    rest = spark.createDataFrame(second, "seq long, k string, v long")
    expected = brute(data)
    assert run_all(rest, chunk=9, start=start) == {s: expected[s] for s, _, _ in second}


@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_only_hot_keys_are_cut(spark, monkeypatch, hot):
    """The measured cut: none, some or all keys hot, and many chunks per key."""
    for rows_, chunk_, chunks_ in ((10_000, 5, 100), (60, 5, 100), (4, 2, 100), (60, 1, 8)):
        monkeypatch.setattr(scan, "HOT_ROWS", rows_)
        monkeypatch.setattr(scan, "CHUNK_ROWS", chunk_)
        monkeypatch.setattr(scan, "MAX_CHUNKS", chunks_)
        data = sample(200, 3, hot)
        df = spark.createDataFrame(data, "seq long, k string, v long")
        cut = scan.measure(df, ["k"], "seq")
        sizes = {k: sum(1 for _, k2, _ in data if k2 == k) for _, k, _ in data}
        hot = sum(1 for n in sizes.values() if n > rows_)
        assert cut.whole if not hot else cut.cuts.count() == hot
        assert run_all(df) == brute(data)
        assert run_all(df, include_current=False) == brute(data, False)


@pytest.mark.parametrize("shape", ["outlier", "bursts"])
def test_chunks_hold_alike_many_rows(spark, monkeypatch, shape):
    """An outlier or bursts in the order column make no chunk large."""
    monkeypatch.setattr(scan, "HOT_ROWS", 500)
    monkeypatch.setattr(scan, "CHUNK_ROWS", 100)
    places = {
        "outlier": "CASE WHEN id = 0 THEN 1000000000000000 ELSE id END",
        "bursts": "(id div 997) * 3600000000 + id % 997",
    }[shape]
    df = spark.range(6000).selectExpr(f"{places} AS seq", "if(id % 10 < 8, 'hot', concat('k', id)) AS k", "id AS v")
    cut = scan.measure(df, ["k"], "seq")
    sizes = cut.mark(df, ["k"], "seq").filter("_hot").groupBy("_chunk").count().collect()
    assert 40 <= len(sizes) <= 60 and max(r["count"] for r in sizes) <= 200
    out = scan.running(df, ["k"], "seq", {"n": scan.run_count(), "t": scan.run_sum("v")})
    held, expected = {}, {}
    for r in sorted(df.collect(), key=lambda r: r["seq"]):
        n, t = held.get(r["k"], (0, 0))
        held[r["k"]] = expected[r["seq"], r["k"]] = (n + 1, t + r["v"])
    assert {(r["seq"], r["k"]): (r["n"], r["t"]) for r in out.collect()} == expected


def test_start_reaches_cold_and_hot_keys(spark, monkeypatch):
    data = sorted(sample(160, 9, 0.6))
    first, second = data[:60], data[60:]
    head = spark.createDataFrame(first, "seq long, k string, v long").groupBy("k")
    start = head.agg(F.count("*").alias("n"), F.max("v").alias("high")).cache()
    rest = spark.createDataFrame(second, "seq long, k string, v long")
    expected = brute(data)
    for hot_rows in (10, 30, 10_000):
        monkeypatch.setattr(scan, "HOT_ROWS", hot_rows)
        monkeypatch.setattr(scan, "CHUNK_ROWS", 7)
        rules = {"n": scan.run_count(), "high": scan.run_max("v")}
        out = scan.running(rest, ["k"], "seq", rules, start=start)
        found = {r["seq"]: (r["n"], r["high"]) for r in out.collect()}
        assert found == {s: (expected[s][0], expected[s][3]) for s, _, _ in second}


def test_global_scan(spark, monkeypatch):
    df = spark.range(50).selectExpr("id AS seq", "(id * 7) % 50 AS v")
    for hot_rows in (0, 1000):
        monkeypatch.setattr(scan, "HOT_ROWS", hot_rows)
        monkeypatch.setattr(scan, "CHUNK_ROWS", 6)
        out = scan.running(df, [], "seq", {"top": scan.run_max("v")})
        expected = [(s, max((i * 7) % 50 for i in range(s + 1))) for s in range(50)]
        assert rows(out, "seq", "top") == sorted(expected, key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "seq long, k string, v long")
    assert run_all(df) == {}
    assert aggs.rank_over(df.withColumn("v", F.col("v").cast("double")), "k", "v").count() == 0


def test_order_column_that_is_no_integer_needs_a_chunk(spark):
    df = spark.createDataFrame([(1.5, "a", 1)], "seq double, k string, v long")
    with pytest.raises(ValueError, match="chunk"):
        scan.position(df, ["k"], "seq")


@pytest.mark.parametrize("before", [0, 1, 4])
@pytest.mark.parametrize("block", [5, 6, 1000])
def test_row_frame_crosses_blocks(spark, before, block):
    df = spark.range(40).selectExpr("id AS seq", "'k' AS k", "id AS v")
    placed = scan.position(df, ["k"], "seq", chunk=7)
    out = scan.row_frame(
        placed, ["k"], "pos", before, lambda framed, _: {"s": F.sum("v").over(framed)}, block=block
    )
    assert rows(out, "v", "s") == sorted(
        [(v, sum(range(max(0, v - before), v + 1))) for v in range(40)], key=repr
    )


@pytest.fixture
def task_rows(monkeypatch):
    """Rows in each range of every table that is cut into ranges."""
    found, cut = [], scan.in_sorted_parts

    def counted(*args):
        made = cut(*args)
        found.append([n for (n,) in made.groupBy("_part").count().select("count").collect()])
        return made

    monkeypatch.setattr(scan, "in_sorted_parts", counted)
    return found


@pytest.mark.parametrize("hot", [10, 1000])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_with_ties_over_ranges(spark, monkeypatch, task_rows, hot, descending):
    rng = random.Random(5)
    data = [(i, rng.choice(["a", "a", "a", "b", None, f"c{i}"]), rng.choice([None, *map(float, range(40))])) for i in range(300)]
    df = spark.createDataFrame(data, "id long, k string, v double")
    monkeypatch.setattr(scan, "HOT_ROWS", hot)
    monkeypatch.setattr(scan, "CHUNK_ROWS", 12)
    out = aggs.rank_over(df, "k", "v", descending=descending)

    def before(v, w):  # whether a row of value v stands before one of value w
        if v is None or w is None:
            return v is None and w is not None if not descending else v is not None and w is None
        return v > w if descending else v < w

    expected = [(i, 1 + sum(1 for _, k2, v2 in data if k2 == k and before(v2, v))) for i, k, v in data]
    assert rows(out, "id", "rank") == sorted(expected, key=repr)
    assert bool(task_rows) == (hot == 10)
    assert all(n <= 24 for found in task_rows for n in found)


@pytest.mark.parametrize("equal", [False, True])
def test_places_in_a_hot_group(spark, monkeypatch, task_rows, equal):
    """One group holds a third of the rows, with all its values equal or not; no range holds over two chunks."""
    rng = random.Random(9)
    data = [(i, "hot" if i % 3 == 0 else f"k{i % 50}", 1.0 if equal else float(rng.randint(0, 99))) for i in range(900)]
    df = spark.createDataFrame(data, "id long, k string, v double")
    monkeypatch.setattr(scan, "HOT_ROWS", 100)
    monkeypatch.setattr(scan, "CHUNK_ROWS", 30)
    out = scan.places(df, ["k"], ["v", "id"])
    groups = {}
    for i, k, v in sorted(data, key=lambda r: (r[2], r[0])):
        groups.setdefault(k, []).append(i)
    expected = [(i, n + 1) for ids in groups.values() for n, i in enumerate(ids)]
    assert rows(out, "id", "place") == sorted(expected, key=repr)
    assert len(task_rows) == 1 and len(task_rows[0]) == 10 and max(task_rows[0]) <= 60


def test_hot_keys_are_cut_by_size_class(spark, monkeypatch):
    """A huge key has many chunks, and a key that is just hot has few."""
    monkeypatch.setattr(scan, "HOT_ROWS", 50)
    monkeypatch.setattr(scan, "CHUNK_ROWS", 20)
    df = spark.range(2100).selectExpr("id AS seq", "CASE WHEN id % 21 = 0 THEN 'small' ELSE 'huge' END AS k")
    cut = scan.measure(df, ["k"], "seq")
    chunks = {r["k"]: len(r["_cuts"]) + 1 for r in cut.cuts.collect()}
    assert 3 <= chunks["small"] <= 8 and 90 <= chunks["huge"] <= 110
    placed = scan.position(df, ["k"], "seq")
    assert placed.groupBy("k").agg(F.max("pos"), F.countDistinct("pos"), F.count("*")).filter("k = 'huge'").first()[1:] == (2000, 2000, 2000)


def test_results_do_not_depend_on_partitioning(spark):
    data = sample(300, 21, 0.5)
    df = spark.createDataFrame(data, "seq long, k string, v long")
    assert run_all(df.repartition(1), chunk=11) == run_all(df.repartition(13), chunk=29)


def test_distinct_fold(spark):
    data = sample(150, 2, 0.4)
    df = spark.createDataFrame(data, "seq long, k string, v long")
    for agg in ("sum", "count", "avg"):
        out = aggs.over_distinct(df, "k", "seq", "v", agg, "d", chunk=13)
        held, expected = {}, []
        for seq, key, value in sorted(data, key=lambda r: r[0]):
            seen = held.setdefault(key, set())
            if value is not None:
                seen.add(value)
            total = sum(seen) if seen else None
            expected.append(
                (seq, {"sum": total, "count": len(seen),
                       "avg": total / len(seen) if seen else None}[agg])
            )
        assert rows(out, "seq", "d") == sorted(expected, key=repr)
