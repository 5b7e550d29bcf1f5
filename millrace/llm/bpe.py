"""Byte-level BPE of whole texts by overlapping chunks.

A long text is cut into chunks that overlap.  Chunks are pre-tokenised in
parallel; where the boundaries of two neighbours coincide inside the overlap,
they coincide from there on, because a match of the pattern only looks ahead.
The text is cut at such places and the pieces are encoded independently.
Neighbours whose boundaries never meet (one endless pre-token) stay one piece.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import numbered, tidy

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Characters of a chunk, and of its overlap with the next.
CHUNK, OVERLAP = 32_768, 512

_ENCODINGS: dict[str, tiktoken.Encoding] = {}


def encoding(path: str) -> tiktoken.Encoding:
    """The encoder of a rank file, kept by the worker."""
    if path not in _ENCODINGS:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _ENCODINGS[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def _boundaries(overlap: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(PATTERN)
        for batch in batches:
            heads, tails = [], []
            for text, first, last, size in zip(*(batch[c].to_pylist() for c in ("chunk", "first", "last", "size"))):
                found = [m.end() for m in pattern.finditer(text)]
                # A later character could prolong what touches the end, and the white space before it.
                sure = found if last else [b for b in found[:-2] if b < len(text)]
                heads.append([] if first else [0, *(b for b in sure if b <= overlap)])
                tails.append([] if last else [b - size for b in sure if b >= size])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "head", "tail"],
            )

    return find


def text_pieces(rows: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``uid, doc_id, piece_no, piece``: texts cut where pre-tokens end; pieces in order give the text."""
    length = F.length("text")
    count = F.greatest(F.lit(1), F.ceil(length / F.lit(chunk)).cast("int"))
    cut = rows.withColumn("n", count).select("uid", "doc_id", "text", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
    chunks = cut.select(
        "uid", "doc_id", F.col("k").alias("chunk_no"),
        F.substring("text", F.col("k") * chunk + 1, F.lit(chunk + overlap)).alias("chunk"),
        (F.col("k") == 0).alias("first"), (F.col("k") == F.col("n") - 1).alias("last"), F.lit(chunk).alias("size"),
    )
    kind = "uid long, doc_id long, chunk_no int, chunk string, first boolean, last boolean, size int"
    # chunks of one text go to different tasks
    spread = chunks.repartition("uid", "chunk_no")
    marked = spread.mapInArrow(_boundaries(overlap), f"{kind}, head array<int>, tail array<int>")
    order = Window.partitionBy("uid").orderBy("chunk_no")
    # the least place at which both neighbours have a boundary; null: they never meet
    meets = F.array_min(F.array_intersect(F.lag("tail").over(order), "head"))
    synced = marked.withColumn("meets", meets).withColumn("start", F.when(F.col("first"), F.lit(0)).otherwise(F.col("meets")))
    synced = synced.withColumn("next", F.lead("meets").over(order))
    piece_no = F.sum(F.col("start").isNotNull().cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    start = F.coalesce("start", F.lit(0))
    stop = F.when(F.col("last"), F.length("chunk")).otherwise(F.col("size") + F.coalesce("next", F.lit(0)))
    parts = synced.withColumns({"piece_no": piece_no, "from": start, "to": stop}).select(
        "uid", "doc_id", "chunk_no", "piece_no",
        F.substring("chunk", F.col("from") + 1, F.col("to") - F.col("from")).alias("part"),
    )
    whole = parts.groupBy("uid", "doc_id", "piece_no").agg(
        F.array_sort(F.collect_list(F.struct("chunk_no", "part"))).alias("parts")
    )
    return whole.select("uid", "doc_id", "piece_no", F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("piece"))


ENCODED = "uid long, doc_id long, piece_no long, ids array<int>"


def _encoder(path: str):
    @tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                rows = batch.slice(i, 512)
                ids = [codec.encode_ordinary(t or "") for t in rows["piece"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows["uid"], rows["doc_id"], rows["piece_no"], pa.array(ids, pa.list_(pa.int32()))],
                    names=["uid", "doc_id", "piece_no", "ids"],
                )

    return encode


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    ranks: str = RANKS, chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """``uid, doc_id, piece_no, ids``: the ids of every whole text, in pieces.

    A text of at most one chunk is one piece and is encoded where it was read;
    the pieces of a longer one are spread.  Null and empty texts are one piece
    without ids.  Repeated rows stay apart by ``uid``; other columns are
    ignored.  Rows of one ``uid`` are in order within a partition.
    """
    rows = numbered(docs, id_col, text_col)
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    small = rows.filter(F.length("text") <= chunk).select("uid", "doc_id", F.lit(1).cast("long").alias("piece_no"), F.col("text").alias("piece"))
    pieces = text_pieces(rows.filter(F.length("text") > chunk), chunk, overlap)
    pieces = pieces.repartition("uid", "piece_no")
    large = pieces.mapInArrow(_encoder(ranks), ENCODED)
    large = large.repartition("uid").sortWithinPartitions("uid", "piece_no")
    return small.mapInArrow(_encoder(ranks), ENCODED).unionByName(large)


def _decoder(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(path)
        for batch in batches:
            out = [codec.decode_bytes(ids) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["uid"], batch["doc_id"], batch["piece_no"], pa.array(out, pa.binary())],
                names=["uid", "doc_id", "piece_no", "bytes"],
            )

    return decode


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``uid, doc_id, piece_no, bytes``: the bytes of the ids, piece by piece."""
    return encoded.mapInArrow(_decoder(ranks), "uid long, doc_id long, piece_no long, bytes binary")


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digester(path: str):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(path)
        current, state = None, None

        def closed():
            return (state[0], state[1], state[2].hexdigest(), state[3].hexdigest())

        for batch in batches:
            done = []
            for uid, doc, ids in zip(batch["uid"].to_pylist(), batch["doc_id"].to_pylist(), batch["ids"]):
                ids = ids.values.to_numpy().tolist()
                if uid != current or state is None:
                    if state is not None:
                        done.append(closed())
                    current, state = uid, [doc, 0, hashlib.sha256(), hashlib.sha256()]
                if ids:
                    state[2].update(((" " if state[1] else "") + " ".join(map(str, ids))).encode())
                    state[3].update(codec.decode_bytes(ids))
                    state[1] += len(ids)
            yield _digest_rows(done)
        if state is not None:
            yield _digest_rows([closed()])

    return digest


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
    columns = zip(*rows) if rows else ((), (), (), ())
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def digests(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Per document the number of ids, SHA-256 of the ids joined by spaces, and of the decoded bytes.

    Reads the pieces of a document one after the other, as ``encode`` leaves
    them, and holds one piece at a time.
    """
    return encoded.mapInArrow(_digester(ranks), DIGESTS)
