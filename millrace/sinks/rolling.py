"""Text files below time buckets, rolled by size and age, each batch committed as a whole.

Tasks write files of their own; a file is closed and the next one begun once it
has ``roll_bytes`` or has been open for ``roll_seconds``, and when the task
ends.  The batch's files count from the moment its list is in ``_commits``: one
JSON file per batch, put in place by renaming.  A batch that is repeated after a
failure finds its list and leaves the first files as they are; files of tasks
or batches that failed are in no list, and are removed when Spark says so.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.types import StructType

ROLL_BYTES, ROLL_SECONDS = 400 << 20, 20 * 60
#: Buckets that a task writes at once; the one begun first gives way to another.
OPEN = 64


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


def _opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(path)


class _Part:
    """The open file of a bucket."""

    def __init__(self, fs: pyarrow.fs.FileSystem, base: str, bucket: str):
        self.name = f"bucket={bucket}/part-{uuid.uuid4().hex}.txt"
        fs.create_dir(f"{base}/bucket={bucket}", recursive=True)
        self.stream = fs.open_output_stream(f"{base}/{self.name}")
        self.bytes = self.rows = 0
        self.since = time.monotonic()

    def put(self, line: bytes) -> None:
        self.stream.write(line)
        self.bytes += len(line)
        self.rows += 1

    def close(self) -> dict:
        self.stream.close()
        return {"file": self.name, "bytes": self.bytes, "rows": self.rows}


class RollingWriter(DataSourceStreamWriter):
    def __init__(self, path: str, roll_bytes: int, roll_seconds: float):
        self.path, self.roll_bytes, self.roll_seconds = path, roll_bytes, roll_seconds

    def write(self, iterator: Iterator) -> Written:
        fs, base = _opened(self.path)
        open_: dict[str, _Part] = {}
        files = []
        for row in iterator:
            bucket = row["bucket"]
            part = open_.get(bucket)
            if part is None:
                if len(open_) == OPEN:
                    files.append(open_.pop(next(iter(open_))).close())
                part = open_[bucket] = _Part(fs, base, bucket)
            part.put(row["value"].encode() + b"\n")
            if part.bytes >= self.roll_bytes or time.monotonic() - part.since >= self.roll_seconds:
                files.append(open_.pop(bucket).close())
        return Written(files + [p.close() for p in open_.values()])

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        fs, base = _opened(self.path)
        place = f"{base}/_commits/{batchId}.json"
        if fs.get_file_info(place).type == pyarrow.fs.FileType.File:
            self.abort(messages, batchId)  # committed before the failure
            return
        fs.create_dir(f"{base}/_commits", recursive=True)
        fresh = f"{base}/_commits/.{batchId}-{uuid.uuid4().hex}"
        with fs.open_output_stream(fresh) as out:
            for message in messages:
                for entry in message.files if message else []:
                    out.write(json.dumps(entry).encode() + b"\n")
        fs.move(fresh, place)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        fs, base = _opened(self.path)
        for message in messages:
            for entry in message.files if message else []:
                fs.delete_file(f"{base}/{entry['file']}")


class RollingText(DataSource):
    """``format("rolling_text")``: options path, roll_bytes and roll_seconds; columns bucket and value."""

    @classmethod
    def name(cls) -> str:
        return "rolling_text"

    def streamWriter(self, schema: StructType, overwrite: bool) -> RollingWriter:
        if schema.fieldNames() != ["bucket", "value"]:
            raise ValueError("rolling_text takes the columns bucket and value")
        return RollingWriter(
            self.options["path"], int(self.options.get("roll_bytes", ROLL_BYTES)),
            float(self.options.get("roll_seconds", ROLL_SECONDS)),
        )


def rolling_stream(
    df: DataFrame, path: str, checkpoint: str, ts: str, value: str, pattern: str = "yyyy-MM-dd--HHmm",
    roll_bytes: int = ROLL_BYTES, roll_seconds: float = ROLL_SECONDS, spread: int = 4,
):
    """A writer of the text column ``value`` to files below ``bucket=<time>``; start it with a trigger.

    A bucket's rows of one batch are written by ``spread`` tasks; null values are
    left out, as they are no line.
    """
    df.sparkSession.dataSource.register(RollingText)
    rows = df.select(F.date_format(ts, pattern).alias("bucket"), F.col(value).cast("string").alias("value"))
    rows = rows.filter("bucket IS NOT NULL AND value IS NOT NULL")
    dealt = rows.repartition("bucket", F.pmod(F.xxhash64("value"), F.lit(spread)))
    return (
        dealt.writeStream.format("rolling_text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("roll_bytes", str(roll_bytes))
        .option("roll_seconds", str(roll_seconds))
        .outputMode("append")
    )


def committed(spark: SparkSession, path: str) -> DataFrame:
    """``file, bytes, rows`` of all files that count."""
    return spark.read.schema("file string, bytes long, rows long").json(f"{path}/_commits")


def read_rolled(spark: SparkSession, path: str) -> DataFrame:
    """``bucket, value``: the lines of the files that count; files in no list are passed over."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "part-*.txt").text(path)
    name = F.regexp_extract(F.input_file_name(), "bucket=[^/]*/part-[^/]*$", 0)
    bucket = F.regexp_extract("_file", "bucket=([^/]*)/", 1)
    known = committed(spark, path).select(F.col("file").alias("_known"))
    rows = lines.withColumn("_file", name)
    return rows.join(known, F.col("_file") == F.col("_known"), "left_semi").select(bucket.alias("bucket"), "value")
