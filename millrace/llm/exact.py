"""Exact duplicates by content-defined chunk recipes.

A normalised text is cut where a rolling hash of its last 16 bytes is zero in
its top bits, so equal stretches get equal chunks wherever they stand.  Every
chunk is named by a 64-bit fingerprint, which is verified against SHA-256: were
two different chunks ever to share a fingerprint, they get numbered variants.
A text is then the ordered list of its verified identifiers, and only these
short lists are shuffled and compared; texts are read once and never moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import numbered, settle, tidy
from millrace.llm.words import U64, raw, runs

MIN_CHUNK, AVERAGE_BITS, MAX_CHUNK = 1024, 12, 65_536

_GEAR = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

RECIPE = "uid long, doc_id long, text_sha256 string, chunks array<long>, digests array<binary>"


def boundaries(data: np.ndarray) -> np.ndarray:
    """Places after which a chunk may end: a hash of the last 16 bytes has zero top bits."""
    rolled = _GEAR[data]
    for k in (1, 2, 4, 8):
        grown = rolled.copy()
        grown[k:] += rolled[:-k] << U64(k)
        rolled = grown
    return np.flatnonzero(rolled >> U64(64 - AVERAGE_BITS) == 0) + 1


def chunk_ends(length: int, candidates: list[int]) -> list[int]:
    """Ends of the chunks of one text: candidates kept within the least and the largest size."""
    ends, last = [], 0
    for c in [*candidates, length]:
        while c - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last)
        if c - last >= MIN_CHUNK and c < length:
            ends.append(c)
            last = c
    if last < length or not ends:
        ends.append(length)
    return ends


@tidy
def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = raw(batch["text"])
        wholes, chunks, digests = [], [], []
        for i, j in runs(at):
            part = _LOWER[data[at[i] : at[j]]]
            places = boundaries(part) if len(part) > MIN_CHUNK else np.zeros(0, np.int64)
            view = memoryview(part)
            for a, b in zip((at[i:j] - at[i]).tolist(), (at[i + 1 : j + 1] - at[i]).tolist()):
                found = places[np.searchsorted(places, a + MIN_CHUNK) : np.searchsorted(places, b)]
                ends = chunk_ends(b - a, (found - a).tolist())
                pieces = [view[a + s : a + e] for s, e in zip([0, *ends], ends)]
                wholes.append(hashlib.sha256(view[a:b]).hexdigest())
                chunks.append([xxhash.xxh3_64_intdigest(p) - (1 << 63) for p in pieces])
                digests.append([hashlib.sha256(p).digest() for p in pieces])
        yield pa.RecordBatch.from_arrays(
            [
                batch["uid"],
                batch["doc_id"],
                pa.array(wholes, pa.string()),
                pa.array(chunks, pa.list_(pa.int64())),
                pa.array(digests, pa.list_(pa.binary())),
            ],
            names=["uid", "doc_id", "text_sha256", "chunks", "digests"],
        )


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its chunks' fingerprints and SHA-256 digests, in order."""
    return numbered(docs, id_col, text_col).mapInArrow(_recipes, RECIPE)


def verified(made: DataFrame) -> DataFrame:
    """Recipes with ``variants``: (place, number) of the chunks whose fingerprint is shared by
    different chunks.  As a rule empty; two recipes are equal iff both lists are."""
    parts = made.select("uid", F.posexplode(F.arrays_zip("chunks", "digests")).alias("place", "chunk"))
    parts = parts.select("uid", "place", F.col("chunk.chunks").alias("chunk"), F.col("chunk.digests").alias("digest"))
    kinds = parts.groupBy("chunk", "digest").agg(F.lit(1).alias("one"))
    clashing = kinds.groupBy("chunk").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("chunk")
    number = F.row_number().over(Window.partitionBy("chunk").orderBy("digest"))
    named = kinds.join(clashing, "chunk", "left_semi").select("chunk", "digest", number.alias("variant"))
    fixes = (
        parts.join(named, ["chunk", "digest"])
        .groupBy("uid")
        .agg(F.array_sort(F.collect_list(F.struct("place", "variant"))).alias("variants"))
    )
    none = F.expr("cast(array() as array<struct<place:int,variant:int>>)")
    return made.join(fixes, "uid", "left").withColumn("variants", F.coalesce("variants", none))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``uid, doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty, and empty texts are one group.  The row with the largest id stays
    (null ids count as smallest; of rows that repeat the largest id, the first
    in reading order).  ``keep_id`` is null only if all ids of the group are.
    Other columns of ``docs`` are ignored, whatever their names.

    A group may hold any share of all rows: its size and largest id are
    pre-aggregated, and a large group of the join back is split by AQE.
    """
    made = settle(recipes(docs, id_col, text_col), "recipes")
    known = verified(made).select(
        "uid", "doc_id", "text_sha256", "variants", "chunks", F.xxhash64("chunks", "variants").alias("recipe")
    )
    key = ["recipe", "chunks", "variants"]
    groups = known.groupBy(*key).agg(
        F.max(F.struct("doc_id", -F.col("uid"))).alias("stays"), F.count("*").alias("group_size")
    )
    return known.join(groups, key).select(
        "uid",
        "doc_id",
        F.col("stays.doc_id").alias("keep_id"),
        "group_size",
        (F.col("uid") == -F.col("stays.col2")).alias("kept"),
        "text_sha256",
    )
