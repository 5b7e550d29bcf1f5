"""Parsing policies, option builders, files, documents and upserts."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import enrich, windows
from millrace.operators import rows as rowops
from millrace.session import fresh_dir, shared_dir
from millrace.sinks import upsert, values
from millrace.sources import external, ingest
from millrace.streaming import batches, run

SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("v", T.DoubleType()),
    ]
)
LINES = ["a, 1, 2.5", "b,x,1", "c, 2", "", "d,3,4,extra"]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame([(line,) for line in LINES] + [(None,)], "value string")


def test_bad_lines_go_to_the_side(lines):
    good, bad = ingest.parse_delimited(lines, SCHEMA, on_error="side")
    assert rows(good) == [("a", 1, 2.5), ("d", 3, 4.0)]
    assert rows(bad) == sorted([("b,x,1",), ("c, 2",), ("",), (None,)], key=repr)


def test_bad_lines_can_be_dropped_or_fail(lines):
    good, bad = ingest.parse_delimited(lines, SCHEMA, on_error="drop")
    assert bad is None and good.count() == 2
    good, _ = ingest.parse_delimited(lines, SCHEMA, on_error="fail")
    with pytest.raises(Exception, match="malformed line"):
        good.collect()
    with pytest.raises(ValueError):
        ingest.parse_delimited(lines, SCHEMA, on_error="ignore")


def test_separator_is_plain_text(spark):
    df = spark.createDataFrame([("a|1|2",)], "value string")
    good, _ = ingest.parse_delimited(df, SCHEMA, sep="|")
    assert rows(good) == [("a", 1, 2.0)]


def test_malformed_json_is_counted(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([('{"k": 1}',), ("{",), ('{"k": 2}',)], "value string")
    watch = Observation("json")
    good, _ = ingest.parse_json(df, T.StructType([T.StructField("k", T.LongType())]), observation=watch)
    assert rows(good) == [(1,), (2,)]
    assert watch.get == {"records": 3, "bad": 1}


def test_json_policies(spark):
    df = spark.createDataFrame(
        [('{"k": 1}',), ('{"k"',), (None,), ('{"other": 2}',)], "value string"
    )
    schema = T.StructType([T.StructField("k", T.LongType())])
    good, bad = ingest.parse_json(df, schema, on_error="side")
    assert rows(good) == sorted([(1,), (None,)], key=repr)
    assert rows(bad) == sorted([('{"k"',), (None,)], key=repr)


def test_csv_table_ignores_half_parsed_lines(spark):
    df = spark.createDataFrame([("a,1,2.5",), ("bad",), ("b,x,1",)], "value string")
    table = ingest.csv_table(df, SCHEMA, rowtime="ts", unit="s", view="csv_view")
    assert rows(table.select("id", F.unix_millis("rt"))) == [("a", 1000)]
    assert spark.table("csv_view").count() == 1


def test_time_unit_is_explicit(spark):
    df = spark.createDataFrame([(1,)], "t long")
    table = ingest.to_table(df, ["at"], rowtime="at", unit="s")
    assert rows(table.select(F.unix_millis("at"))) == [(1000,)]
    with pytest.raises(ValueError):
        ingest.to_table(df, ["at"], rowtime="at", unit="minutes")


def test_kafka_options():
    options = external.kafka_options("a, b", "host:1", starting="earliest", failOnDataLoss="false")
    assert options == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    for bad in [("", "host:1", "latest"), ("a", "", "latest"), ("a", "h:1", "middle")]:
        with pytest.raises(ValueError):
            external.kafka_options(*bad)


def test_jdbc_options():
    assert external.jdbc_options("jdbc:x://h/db", "t", user="u") == {
        "url": "jdbc:x://h/db", "dbtable": "t", "user": "u",
    }
    split = external.jdbc_options(
        "jdbc:x://h/db", "t", partition_column="id", bounds=(0, 9), partitions=3
    )
    assert split["numPartitions"] == "3" and split["upperBound"] == "9"
    with pytest.raises(ValueError):
        external.jdbc_options("jdbc:x://h/db", "t", partition_column="id")
    with pytest.raises(ValueError):
        external.jdbc_options("http://h", "t")


def test_arrival_stamp(spark):
    df = ingest.stamp_arrival(spark.range(3))
    out = windows.window_agg(df, [], "arrived", "1 hour", [F.count("*").alias("n")])
    assert sum(r["n"] for r in out.collect()) == 3


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_message_values(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    assert rows(values.kafka_value(df, key="k")) == [("a", "a,1")]
    assert rows(values.kafka_value(df, format="json")) == [(None, '{"k":"a","n":1}')]
    with pytest.raises(ValueError):
        values.kafka_value(df, format="avro")


def test_documents_overwrite_a_repeated_batch(spark):
    path = fresh_dir(spark, "docs")
    write = values.write_documents(path, {"sensor_id": "k", "n": "n"})
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    for _ in range(2):
        write(df, 0)
    found = [json.loads(r[0]) for r in spark.read.text(f"{path}/batch=0").collect()]
    assert sorted(found, key=repr) == [{"sensor_id": "a", "n": "1"}, {"sensor_id": "b", "n": "2"}]


def test_bucketed_stream_writes_buckets(spark):
    path = fresh_dir(spark, "buckets")
    df = spark.createDataFrame([(0,), (61,), (62,)], "s long").withColumn(
        "ts", F.timestamp_seconds("s")
    )
    df.write.parquet(f"{path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{path}/in")
    writer = values.bucketed_stream(stream, f"{path}/out", f"{path}/check", "ts", max_records=1)
    job = writer.trigger(availableNow=True).start()
    job.awaitTermination()
    out = spark.read.parquet(f"{path}/out").groupBy("bucket").count()
    assert rows(out) == [("1970-01-01--0000", 1), ("1970-01-01--0001", 2)]


class FakeDatabase:
    """Just enough of a DB-API connection to see what an upsert does."""

    def __init__(self):
        self.table, self.log, self.commits, self.closed = {}, [], 0, 0

    def connect(self):
        return self

    cursor = connect

    def execute(self, sql, values):
        self.log.append(sql.split()[0])
        if sql.startswith("UPDATE"):
            *rest, key = values
            self.rowcount = int(key in self.table)
            if self.rowcount:
                self.table[key] = tuple(rest)
        else:
            key, *rest = values
            self.table[key] = tuple(rest)

    def commit(self):
        self.commits += 1

    def close(self):
        self.closed += 1


def test_upsert_updates_then_inserts():
    db = FakeDatabase()
    data = [{"id": "a", "v": 1}, {"id": "b", "v": 2}, {"id": "a", "v": 3}]
    for _ in range(2):
        upsert.upsert_rows(data, db.connect, "t", ["id", "v"], ["id"], commit_rows=2)
    assert db.table == {"a": (3,), "b": (2,)}
    assert db.log[:5] == ["UPDATE", "INSERT", "UPDATE", "INSERT", "UPDATE"]
    assert db.log.count("INSERT") == 2
    assert db.commits == 4 and db.closed == 2


def test_upsert_of_nothing_opens_no_connection():
    upsert.upsert_rows([], None, "t", ["id", "v"], ["id"])


def test_upsert_statements():
    assert upsert.statements("t", ["a", "b", "c"], ["a", "c"], mark="%s") == (
        "UPDATE t SET b = %s WHERE a = %s AND c = %s",
        "INSERT INTO t (a, b, c) VALUES (%s, %s, %s)",
    )


def test_rich_map_opens_and_closes_once_per_partition(spark, tmp_path):
    log = str(tmp_path / "log")

    def note(word):
        with open(log, "a") as out:
            out.write(word + "\n")

    df = rowops.rich_map(
        spark.range(10).repartition(2),
        open_=lambda: note("open") or 5,
        apply=lambda plus, batch: batch.assign(id=batch["id"] + plus),
        close=lambda _: note("close"),
        schema="id long",
    )
    assert rows(df) == sorted([(n + 5,) for n in range(10)], key=repr)
    words = open(log).read().split()
    assert words.count("open") == words.count("close") == 2


def test_slow_and_failing_calls_keep_their_rows(spark):
    def fetch(k):
        import time

        if k == 1:
            raise OSError("down")
        if k == 2:
            time.sleep(1.5)
        return {"name": f"n{k}"}

    df = spark.createDataFrame([(0,), (1,), (2,), (0,), (None,)], "k long")
    out = enrich.enrich_map(df, "k", fetch, "name string", capacity=2, timeout=0.5, tasks=3)
    found = dict(rows(out.filter("k IS NOT NULL").distinct()))
    assert found == {0: "n0", 1: None, 2: None}
    assert out.count() == 5


def test_hung_calls_take_no_others_place(spark):
    def fetch(k):
        import time

        time.sleep(30 if k < 2 else 0)
        return {"name": f"n{k}"}

    df = spark.range(12).withColumnRenamed("id", "k")
    out = enrich.enrich_map(df, "k", fetch, "name string", capacity=2, timeout=1.0, tasks=1)
    assert dict(rows(out)) == {k: f"n{k}" if k > 1 else None for k in range(12)}


def test_dimension_has_one_row_per_key(spark):
    dim = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 1)], "k int, name string, at int")
    df = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    assert rows(enrich.config_join(df, dim, "k", "at"), "k", "name") == [(1, "new"), (1, "new")]
    assert rows(enrich.config_join(df, dim.select("k").union(dim.select("k")), "k")) == [(1,), (1,)]


def test_interval_join_says_which_joins_it_knows(spark):
    from millrace.operators import joins

    df = spark.createDataFrame([], "k int, ts timestamp")
    with pytest.raises(ValueError, match="inner or left"):
        joins.interval_join(df, df.withColumnRenamed("ts", "t2"), "k", "ts", "t2", 0, 1, how="right")


def test_lookup_keeps_one_row_per_input(spark):
    dim = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "k int, name string, at int")
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    out = enrich.lookup_join(df, dim, "k", ["name"], dim_order="at")
    assert rows(out) == sorted([(1, "new"), (2, None), (None, None)], key=repr)


def test_dimension_is_read_again_when_old(spark):
    reads = []

    def load():
        reads.append(1)
        return spark.range(len(reads))

    kept = enrich.Refreshing(load, seconds=3600)
    assert kept.get().count() == kept.get().count() == 1
    assert len(reads) == 1
    always = enrich.Refreshing(load, seconds=0)
    assert always.get().count() == 2 and always.get().count() == 3


def test_regions_without_match_give_null(spark):
    regions = spark.createDataFrame(
        [("in", 0.0, 10.0, 0.0, 10.0), ("also", 5.0, 15.0, 5.0, 15.0)],
        "province string, lon_lo double, lon_hi double, lat_lo double, lat_hi double",
    )
    points = spark.createDataFrame(
        [(1.0, 1.0), (6.0, 6.0), (10.0, 9.0), (-3.0, 0.0), (None, 1.0)], "lon double, lat double"
    )
    out = enrich.geo_region_join(points, regions, "lon", "lat", cell=4.0)
    assert rows(out) == sorted(
        [(1.0, 1.0, "in"), (6.0, 6.0, "also"), (10.0, 9.0, "also"), (-3.0, 0.0, None),
         (None, 1.0, None)],
        key=repr,
    )


def test_running_batches_survive_a_repeated_batch(spark):
    from millrace.operators import scan

    path = fresh_dir(spark, "batches")
    write = batches.running_batches(
        "k", "seq",
        {"s": scan.run_sum("v"), "n": scan.run_count(), "top": scan.run_max("v"),
         "head": scan.run_first("v"), "tail": scan.run_last("v")},
        f"{path}/state", batches.folder_sink(f"{path}/out"),
    )
    parts = [
        [(0, "a", 1), (1, "b", 2), (2, "a", 3)], [(3, "a", 1)], [(4, "b", 5), (5, "a", 0)],
    ]
    for number, part in enumerate(parts):
        df = spark.createDataFrame(part, "seq long, k string, v long")
        write(df, number)
        write(df, number)
    out = spark.read.schema(
        "seq long, k string, v long, s long, n long, top long, head long, tail long"
    ).parquet(*[f"{path}/out/batch={n}" for n in range(3)])
    assert rows(out, "seq", "s", "n", "top", "head", "tail") == [
        (0, 1, 1, 1, 1, 1), (1, 2, 1, 2, 2, 2), (2, 4, 2, 3, 1, 3), (3, 5, 3, 3, 1, 1),
        (4, 7, 2, 5, 2, 5), (5, 5, 4, 3, 1, 0),
    ]


def test_append_output_rejects_changing_results(spark):
    path = fresh_dir(spark, "append")
    spark.range(3).write.parquet(f"{path}/in")
    stream = spark.readStream.schema("id long").parquet(f"{path}/in")
    with pytest.raises(Exception, match="[Aa]ppend"):
        run.drain(
            stream.groupBy("id").count(), batches.folder_sink(f"{path}/out"),
            f"{path}/check", "append",
        )


def test_files_are_rolled_by_size_and_committed_once(spark, tmp_path):
    """Files of one size, a batch that is repeated, and a task's leftovers that do not count."""
    from millrace.sinks import rolling

    lines = spark.range(4000).selectExpr("timestamp_seconds(id * 60) AS ts", "lpad(id, 9, '0') AS value")
    lines = lines.unionByName(spark.sql("SELECT timestamp_seconds(0) AS ts, CAST(NULL AS STRING) AS value"))
    lines.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out, check = f"{tmp_path}/out", f"{tmp_path}/check"

    def run():
        writer = rolling.rolling_stream(stream, out, check, "ts", "value", "yyyy-MM-dd", roll_bytes=500)
        writer.trigger(availableNow=True).start().awaitTermination()

    run()
    files = rolling.committed(spark, out).collect()
    assert len(list((tmp_path / "out" / "_commits").glob("*.json"))) == 3
    assert sum(f["rows"] for f in files) == 4000 and max(f["bytes"] for f in files) == 500
    assert all((tmp_path / "out" / f["file"]).stat().st_size == f["bytes"] for f in files)
    found = rolling.read_rolled(spark, out)
    expected = lines.filter("value IS NOT NULL").selectExpr("date_format(ts, 'yyyy-MM-dd') AS bucket", "value")
    assert rows(found) == rows(expected)
    # The last batch is done again: Spark's note of its end is lost.
    commits = tmp_path / "check" / "commits"
    for name in ("2", ".2.crc"):
        (commits / name).unlink(missing_ok=True)
    before = sorted(f["file"] for f in files)
    run()
    assert sorted(f["file"] for f in rolling.committed(spark, out).collect()) == before
    (tmp_path / "out" / "bucket=1970-01-01" / "part-left.txt").write_text("never committed\n")
    assert rows(rolling.read_rolled(spark, out)) == rows(expected)


def test_files_are_rolled_by_age(tmp_path):
    from millrace.sinks import rolling

    writer = rolling.RollingWriter(str(tmp_path), 1 << 30, 0.0)
    made = writer.write(iter([{"bucket": "a", "value": "x"}, {"bucket": "a", "value": "yy"}, {"bucket": "b", "value": ""}]))
    assert [(f["file"].split("/")[0], f["bytes"], f["rows"]) for f in made.files] == [("bucket=a", 2, 1), ("bucket=a", 3, 1), ("bucket=b", 1, 1)]
    writer.abort([made, None], 0)
    assert not list(tmp_path.rglob("*.txt"))
