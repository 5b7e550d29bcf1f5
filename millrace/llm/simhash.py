"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit of a fingerprint gets a nonzero vector of RADIUS + 1 bits; for every
nonzero vector there is a table, whose mask takes the bits whose vector has an
odd product with it.  The vectors of RADIUS differing bits never span the whole
space, so some table's mask holds none of them: two fingerprints within the
radius agree on that table's key, always.

Fingerprints alone in all their buckets have no partner.  The others are
verified inside their buckets without looking at pairs: two of them differ in
at most two bits exactly if one word lies within one bit of both, so each
member names the words within one bit of it that its bucket allows, and those
that name the same word are linked.  A word is named by 65 fingerprints at
most, so no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import numbered, settle, tidy
from millrace.llm.graph import components
from millrace.llm.slices import LOWER, SPACE, slices, spans

WORDS, SEED = 3, 42
BITS, RADIUS = 64, 2
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def masks(bits: int = BITS, radius: int = RADIUS) -> list[int]:
    """The bits that each table looks at; every choice of ``radius`` bits misses one of them."""
    kinds = (1 << (radius + 1)) - 1
    vectors = [i % kinds + 1 for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1) for v in range(1, kinds + 1)]


def _joined(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words lower-cased with one space between, and where they start and end now."""
    sizes = ends - starts
    to = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    out = np.full(int(sizes.sum()) + len(sizes), 32, np.uint8)
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(to, sizes) + inside] = LOWER[part[np.repeat(starts, sizes) + inside]]
    return out.tobytes(), to, to + sizes


def _votes(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit set."""
    out = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), BLOCK):
        part = np.array(hashes[k : k + BLOCK], "<u8").view(np.uint8).reshape(-1, 8)
        out += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return out


def _prints(words: int):
    digest = xxhash.xxh64_intdigest

    @tidy
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
        for batch in batches:
            n = batch.num_rows
            votes, shingles, seen = np.zeros((n, BITS), np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for i, j, part, bounds, fresh, last in slices(batch["text"], SPACE, words - 1):
                starts, ends, first = spans(part, bounds, SPACE)
                text, to, till = _joined(part, starts, ends)
                new = np.searchsorted(ends, fresh, "right")  # words before this were in the slice before
                for k in range(i, j):
                    a, b = int(first[k - i]), int(first[k - i + 1])
                    low = max(a, int(new) - words + 1)
                    top = max(low, b - words + 1)
                    seen[k] += b - max(a, int(new))
                    if last and 0 < seen[k] < words:
                        pairs = [(to[a], till[b - 1])]
                    else:
                        pairs = zip(to[low:top].tolist(), till[low + words - 1 : top + words - 1].tolist())
                    found = [digest(text[x:y], SEED) for x, y in pairs]
                    shingles[k] += len(found)
                    votes[k] += _votes(found)
            value = ((2 * votes > shingles[:, None]) * weights).sum(axis=1, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(value.view(np.int64))], names=["doc_id", "fp"])

    return work


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``doc_id, fp`` of every row: the bits set in over half of its shingles' hashes, as a signed long.

    Words are runs of bytes other than 0x09 to 0x0D and 0x20, A-Z lower-cased;
    shingles are joined by one space and hashed by XXH64.  Fewer words are one
    shingle, and null, empty and blank texts have fingerprint zero.
    """
    rows = numbered(docs, id_col, text_col).select("doc_id", "text")
    return rows.mapInArrow(_prints(words), "doc_id long, fp long")


def links(prints: DataFrame) -> DataFrame:
    """``a, b``: fingerprints of ``prints(fp)``, all different, in stars that connect all within the radius."""
    keys = [F.struct(F.lit(v).alias("place"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for v, m in enumerate(masks())]
    tables = prints.select("fp", F.explode(F.array(*keys)).alias("t")).select("fp", "t.place", "t.key")
    shared = tables.groupBy("place", "key").agg(F.count("*").alias("n")).filter("n > 1").select("place", "key")
    members = tables.join(shared, ["place", "key"], "left_semi")
    free = [[0, *(_signed(1 << i) for i in range(BITS) if not m >> i & 1)] for m in masks()]
    allowed: Column = F.get(F.array(*[F.lit(x).cast("array<bigint>") for x in free]), F.col("place"))
    named = members.select("fp", F.explode(F.transform(allowed, lambda b: F.col("fp").bitwiseXOR(b))).alias("word"))
    meetings = named.groupBy("word").agg(F.collect_set("fp").alias("near")).filter(F.size("near") > 1)
    stars = meetings.select(F.explode("near").alias("a"), F.array_min("near").alias("b")).filter("a <> b").distinct()
    return stars.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def near_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Documents are linked when their fingerprints differ in two bits or fewer,
    blank ones included; ``component_id`` is the smallest id reachable.  Rows
    that repeat an id or a text are documents of their own; null ids count as
    larger than all others, and are the component's id only where it has no
    other.  An empty table gives an empty one.  Other columns, whatever their
    names, are ignored.
    """
    made = settle(fingerprints(docs, id_col, text_col, words), "fingerprints")
    prints = settle(made.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(settle(links(prints.select("fp")), "links"))
    placed = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    found = placed.select("fp", "root").join(named, "root").select("fp", "component_id")
    shown = F.lower(F.lpad(F.hex("fp"), BITS // 4, "0")).alias("fingerprint")
    return made.join(found, "fp").select("doc_id", shown, "component_id")
