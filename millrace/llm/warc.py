"""WARC archives as a Spark data source named ``warc``, for reading and writing.

Reading plans partitions from the archives' sizes (and, for archives written
here, from split points in their manifest), parses a record's headers first,
and decides by them: a record that the pushed filters reject, or whose payload
the schema does not ask for, is passed over without decoding its payload.
Plain archives are passed over by Content-Length.  Archives of one gzip member
per record are passed over by the member's length where the ``sl`` extra field
gives it, as it does in archives written here, and inflated otherwise.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)

from millrace.llm.common import prepared, settle
from millrace.session import fresh_dir

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, "
    "refers_to string, content_type string, content_length long, headers map<string,string>, payload binary"
)
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "content_type": "content-type",
}
MANIFEST = "_manifest.json"
BATCH, SPLIT, ROLL = 8 << 20, 16 << 20, 512 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- records


def parse_headers(head: bytes) -> dict[str, str]:
    """Names in lower case; a folded line continues the one before; the last of a repeated name counts."""
    found, name = {}, None
    for line in head.split(b"\r\n")[1:]:
        text = line.decode("utf-8", "replace")
        if name and text[:1] in (" ", "\t"):
            found[name] += " " + text.strip()
        elif ":" in text:
            name, value = text.split(":", 1)
            name = name.strip().lower()
            found[name] = value.strip()
    return found


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """What follows the HTTP headers in an HTTP message, else the whole block."""
    if headers.get("content-type", "").startswith("application/http"):
        at = block.find(b"\r\n\r\n")
        return block[at + 4 :] if at >= 0 else b""
    return block


class Archive:
    """Records of one stretch of an archive, headers first."""

    def __init__(self, file, start: int, stop: int) -> None:
        self.file, self.at, self.stop = file, start, stop

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def records(self, wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
        """``wanted(headers)`` says None (leave out), False (headers only) or True (payload as well)."""
        while self.at < self.stop:
            magic = self._read(self.at, 3)
            if not magic:
                return
            if magic[:1] in (b"\r", b"\n"):
                self.at += 1
            elif magic == b"\x1f\x8b\x08":
                yield from self._member(wanted)
            else:
                yield from self._plain(wanted)

    def _plain(self, wanted):
        head, size = b"", 4096
        while b"\r\n\r\n" not in head:
            more = self._read(self.at, size)
            if len(more) == len(head):
                raise ValueError(f"a record at {self.at} ends in its headers")
            head, size = more, size * 4
        body = head.index(b"\r\n\r\n") + 4
        headers = parse_headers(head[: body - 4])
        length = int(headers.get("content-length", 0))
        choice = wanted(headers)
        if choice is not None:
            yield headers, payload_of(headers, self._read(self.at + body, length)) if choice else None
        self.at += body + length + 4

    def _member(self, wanted):
        head = self._read(self.at, 4096)
        known = _member_length(head)
        inflate = zlib.decompressobj(31)
        out, read, limit = b"", 0, known or self.stop + (1 << 62)
        block = head[:limit]
        while block:
            out += inflate.decompress(block, 65_536) if b"\r\n\r\n" not in out else b""
            read += len(block)
            while inflate.unconsumed_tail and b"\r\n\r\n" not in out:
                out += inflate.decompress(inflate.unconsumed_tail, 65_536)
            if b"\r\n\r\n" in out or inflate.eof:
                break
            block = self._read(self.at + read, min(65_536, limit - read))
        if b"\r\n\r\n" not in out:
            raise ValueError(f"a member at {self.at} has no record")
        body = out.index(b"\r\n\r\n") + 4
        headers = parse_headers(out[: body - 4])
        length = int(headers.get("content-length", 0))
        choice = wanted(headers)
        if not (choice is None or not choice) or known is None:
            parts, have = [out], len(out)
            while not inflate.eof:
                rest = inflate.unconsumed_tail or self._read(self.at + read, min(1 << 20, limit - read))
                if not inflate.unconsumed_tail:
                    read += len(rest)
                if not rest:
                    raise ValueError(f"a member at {self.at} is cut off")
                part = inflate.decompress(rest, 1 << 20)
                if choice and have < body + length:
                    parts.append(part)
                    have += len(part)
            out = b"".join(parts) if choice else out
        if choice is not None:
            yield headers, payload_of(headers, out[body : body + length]) if choice else None
        self.at += known if known is not None else read - len(inflate.unused_data)


def _member_length(head: bytes) -> int | None:
    """The compressed length from the ``sl`` field of a gzip member's header."""
    if len(head) < 12 or not head[3] & 4:
        return None
    extra = head[12 : 12 + struct.unpack("<H", head[10:12])[0]]
    while len(extra) >= 4:
        size = struct.unpack("<H", extra[2:4])[0]
        if extra[:2] == b"sl" and size == 8:
            return struct.unpack("<I", extra[4:8])[0]
        extra = extra[4 + size :]
    return None


def member(record: bytes, level: int = 4) -> bytes:
    """One gzip member with its lengths in an ``sl`` extra field (left out beyond 4 GB)."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    whole = 24 + len(body) + 8
    if max(whole, len(record)) < 1 << 32:
        extra = b"sl" + struct.pack("<HII", 8, whole, len(record))
        return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + tail
    return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + body + tail


def record(row: dict) -> bytes:
    """The bytes of one record; a revisit has the HTTP headers but no payload."""
    kind = row["record_type"]
    block = row.get("payload") or b""
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {row['record_id']}", f"WARC-Date: {row['date']}"]
    if row.get("target_uri") is not None:
        lines.append(f"WARC-Target-URI: {row['target_uri']}")
    if row.get("payload_digest") is not None:
        lines.append(f"WARC-Payload-Digest: {row['payload_digest']}")
    if row.get("refers_to") is not None:
        lines.append(f"WARC-Refers-To: {row['refers_to']}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += [f"{name}: {value}" for name, value in row.get("headers") or ()]
    if kind in ("response", "revisit"):
        lines.append("Content-Type: application/http; msgtype=response")
        block = _HTTP + block
    lines.append(f"Content-Length: {len(block)}")
    clean = [re.sub(r"[\r\n]+", " ", line) for line in lines]
    return "\r\n".join(["WARC/1.1", *clean, "", ""]).encode() + block + b"\r\n\r\n"


# ---------------------------------------------------------------- data source


@dataclass
class Stretch(InputPartition):
    parts: list = field(default_factory=list)  # (file, start, stop)


class WarcReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options) -> None:
        self.names = [f.name for f in schema.fields]
        self.path, self.split = options["path"], int(options.get("splitBytes", SPLIT))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(f, (EqualTo, In, StringStartsWith, IsNull, IsNotNull)):
                self.tests.append((type(f).__name__, HEADERS[name], getattr(f, "value", None)))
            else:
                yield f

    def _wanted(self, headers: dict[str, str]) -> bool | None:
        for kind, name, value in self.tests:
            have = headers.get(name)
            fits = {
                "EqualTo": lambda: have is not None and have == value,
                "In": lambda: have is not None and have in value,
                "StringStartsWith": lambda: have is not None and have.startswith(value),
                "IsNull": lambda: have is None,
                "IsNotNull": lambda: have is not None,
            }[kind]
            if not fits():
                return None
        return "payload" in self.names

    def partitions(self) -> list[Stretch]:
        """Stretches of about ``splitBytes``; small archives go together, others are cut where the manifest allows."""
        fs, path = opened(self.path)
        if fs.get_file_info(f"{path}/{MANIFEST}").type == pyarrow.fs.FileType.File:
            with fs.open_input_file(f"{path}/{MANIFEST}") as file:
                known = [(f"{path}/{n}", size, cuts) for n, size, cuts in json.loads(file.read())]
        else:
            info = fs.get_file_info(path)
            found = [info] if info.type == pyarrow.fs.FileType.File else fs.get_file_info(pyarrow.fs.FileSelector(path, recursive=True))
            known = [(f.path, f.size, []) for f in found if re.search(r"\.warc(\.gz)?$", f.path)]
        out, current, filled = [], [], 0
        for name, size, cuts in sorted(known):
            edges = [0, *cuts, size]
            for a, b in zip(edges, edges[1:]):
                if current and filled + b - a > self.split:
                    out.append(Stretch(0))
                    out[-1].parts, current, filled = current, [], 0
                if b > a:
                    current.append((name, a, b))
                    filled += b - a
        if current:
            out.append(Stretch(0))
            out[-1].parts = current
        return out

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if partition is None or not partition.parts:
            return
        fs, _ = opened(self.path)
        rows, held = [], 0
        for name, start, stop in partition.parts:
            with fs.open_input_file(name) as file:
                for headers, payload in Archive(file, start, stop).records(self._wanted):
                    rows.append((headers, payload))
                    held += 512 + len(payload or b"")
                    if held > BATCH:
                        yield self._batch(rows)
                        rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list) -> pa.RecordBatch:
        columns = []
        for name in self.names:
            if name == "payload":
                columns.append(pa.array([p for _, p in rows], pa.binary()))
            elif name == "headers":
                columns.append(pa.array([list(h.items()) for h, _ in rows], pa.map_(pa.string(), pa.string())))
            elif name == "content_length":
                columns.append(pa.array([int(h.get("content-length", 0)) for h, _ in rows], pa.int64()))
            else:
                columns.append(pa.array([h.get(HEADERS[name]) for h, _ in rows], pa.string()))
        return pa.RecordBatch.from_arrays(columns, names=self.names)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Every task writes archives of its own; only those that the commit lists in the manifest count."""

    def __init__(self, options) -> None:
        self.path = options["path"]
        self.gzip = options.get("compression", "gzip") == "gzip"
        self.split, self.roll = int(options.get("splitBytes", SPLIT)), int(options.get("rollBytes", ROLL))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, path = opened(self.path)
        fs.create_dir(path, recursive=True)
        files, out, at, cut = [], None, 0, 0
        try:
            for batch in iterator:
                for i in range(batch.num_rows):
                    row = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
                    data = record(row)
                    data = member(data) if self.gzip else data
                    if out is None or at + len(data) > self.roll and at:
                        if out is not None:
                            out.close()
                            files[-1][1] = at
                        name = f"part-{uuid.uuid4().hex}.warc{'.gz' if self.gzip else ''}"
                        out, at, cut = fs.open_output_stream(f"{path}/{name}", compression=None), 0, 0
                        files.append([name, 0, []])
                    if at - cut >= self.split:
                        files[-1][2].append(at)
                        cut = at
                    out.write(data)
                    at += len(data)
        finally:
            if out is not None:
                out.close()
        if files:
            files[-1][1] = at
        return Written(files)

    def commit(self, messages: list) -> None:
        fs, path = opened(self.path)
        fs.create_dir(path, recursive=True)
        listed = [f for m in messages if m is not None for f in m.files]
        if fs.get_file_info(f"{path}/{MANIFEST}").type == pyarrow.fs.FileType.File:
            with fs.open_input_file(f"{path}/{MANIFEST}") as file:
                listed = json.loads(file.read()) + listed
        with fs.open_output_stream(f"{path}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages: list) -> None:
        fs, path = opened(self.path)
        for m in messages:
            for name, *_ in m.files if m is not None else ():
                fs.delete_file(f"{path}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to a folder; choose a new one")
        return WarcWriter(self.options)


def registered(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark


# ---------------------------------------------------------------- pages to archives and back


def _urn(key: Column, uid: Column) -> Column:
    known = F.concat(F.lit("<urn:page:"), key.cast("string"), F.lit(">"))
    return F.coalesce(known, F.concat(F.lit("<urn:row:"), uid.cast("string"), F.lit(">")))


def page_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least: int = 100, date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """One record per page, as the writer takes them.

    Of equal payloads of at least ``least`` bytes, the one with the smallest id
    is a response and the others revisit it; rows that repeat the smallest id
    are all responses, and so is every row where no id is known.  A null id
    among known ones revisits.  A null payload is empty; a null url is left
    out; white space and control characters in a url are percent-encoded as
    one ``%20``.  Other columns are ignored.

    Only digests and ids are shuffled to find equal payloads.  The table of
    shared digests is written, so Spark knows its size when it chooses between
    broadcasting it and shuffling the pages; a hot digest is then split by AQE.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(f"`{id_col}`").cast("long").alias("key"),
        F.regexp_replace(F.col(f"`{url_col}`"), r"[\x00-\x20\x7f]+", "%20").alias("target_uri"),
        payload.alias("payload"),
    ).withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    shared = rows.filter(F.col("size") >= least).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    shared = settle(shared.filter("n > 1 and first is not null").select("digest", "first"), "shared-payloads")
    rows = rows.join(shared, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    size = F.struct(F.lit("X-Payload-Bytes").alias("name"), F.col("size").cast("string").alias("value"))
    return rows.select(
        _urn(F.col("key"), F.col("uid")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit(date).alias("date"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(again, F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))).alias("refers_to"),
        F.map_from_entries(F.array(size)).alias("headers"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_archives(records: DataFrame, path: str, compression: str = "gzip") -> None:
    registered(records.sparkSession)
    records.write.format("warc").option("compression", compression).mode("append").save(path)


def read_archives(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """Records below ``path``; leave ``payload`` out of ``schema`` and no payload is decoded."""
    return registered(spark).read.format("warc").schema(schema).load(path)


def pages_of(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` from records read back.

    A response's length and digest are those of the payload found in the
    archive, a revisit's those its headers give.
    """
    here = F.col("record_type") == "response"
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) as long)")
    return records.filter(F.col("record_type").isin("response", "revisit")).select(
        number("record_id").alias("page_id"),
        F.when(here, F.octet_length("payload").cast("long"))
        .otherwise(F.col("headers")["x-payload-bytes"].cast("long"))
        .alias("payload_bytes"),
        F.when(here, F.sha2("payload", 256)).otherwise(F.substring("payload_digest", 8, 64)).alias("payload_digest"),
        "record_type",
        F.when(~here, number("refers_to")).alias("refers_to"),
    )


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Write a record per page to a new folder of the shared one, and read the archives back."""
    spark = prepared(pages.sparkSession)
    path = fresh_dir(spark, "archives")
    write_archives(page_records(pages, **columns), path)
    return pages_of(read_archives(spark, path))
