"""Phrase collocations by Rabin-Karp fingerprints.

Prefix polynomials over the words of a text give the fingerprint of every
n-gram by one subtraction.  Level by level, from single words to the longest
phrase, tasks hash the n-grams whose two parts one word shorter are frequent,
and a shuffle adds up the fingerprints.  Which fingerprints are frequent is kept
as bits of a filter of fixed size, broadcast to the next level; a bit that is
set by chance only lets an n-gram through, so nothing frequent is lost, however
full the filter is.

Fingerprints may clash and the filter may err, so both only choose.  In a last
pass the n-grams they chose are materialised as text, with a pointer to where
they occur, and counted again by text: these counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from millrace.llm.common import numbered, settle, tidy
from millrace.llm.slices import LOWER, slices, spans
from millrace.llm.words import U64, _power, mix, word_hashes

LONGEST, LEAST, FIRST, COVERED = 5, 100, 2000, 100
UNKNOWN = "und"
#: Binary logarithm of the filter's bits: 16 MB, whatever the corpus has.
FILTER = 27
#: Bytes of text worked on at once, and counted phrases that a task holds.
RUN, HELD = 2 << 20, 1 << 19
#: Text for one task that adds counts up.
PART_BYTES = 32 << 20

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(10, 14)]] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True


class Grams:
    """The words of a slice, and the fingerprints of its n-grams."""

    def __init__(self, part: np.ndarray, bounds: np.ndarray, fresh: int, tongues: np.ndarray):
        self.part = part
        self.starts, self.ends, first = spans(part, bounds, _GAP)
        self.row = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
        breaks = np.cumsum(_BREAK[part], dtype=np.int64)
        self.piece = (breaks[self.starts] if len(part) else self.starts) + self.row * (len(part) + 1)
        self.fresh = self.ends > fresh
        hashes = word_hashes(part, self.starts, self.ends)
        n = len(hashes)
        self.total = np.concatenate([[U64(0)], np.cumsum(hashes * _power(0, n), dtype=np.uint64)])
        self.back = _power(1, n)
        self.tongue = tongues[self.row] if n else hashes

    def of(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of the n-grams at every word, and which of them lie in one piece and are new."""
        n = max(0, len(self.starts) - size + 1)
        if not n:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        sums = (self.total[size : size + n] - self.total[:n]) * self.back[:n]
        whole = self.piece[:n] == self.piece[size - 1 : size - 1 + n]
        return mix(sums + self.tongue[:n] + U64(size)), whole

    def codes(self) -> pa.DictionaryArray:
        """Every word as the number of its text."""
        sizes = self.ends - self.starts
        at = np.concatenate([[0], np.cumsum(sizes)])
        flat = LOWER[self.part[np.repeat(self.starts - at[:-1], sizes) + np.arange(at[-1])]]
        words = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(flat)])
        return words.dictionary_encode()

    def spaced(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with a space behind each, and where they start."""
        sizes = self.ends - self.starts + 1
        at = np.concatenate([[0], np.cumsum(sizes)])
        place = np.repeat(self.starts - at[:-1], sizes) + np.arange(at[-1])
        flat = LOWER[self.part[np.minimum(place, len(self.part) - 1)]] if len(sizes) else self.part[:0].copy()
        flat[at[1:] - 1] = 32
        return flat, at


def _passing(grams: Grams, size: int, known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of one size, and which have two parts that may be frequent."""
    prints, good = grams.of(size)
    if size > 1 and len(prints):
        shorter, _ = grams.of(size - 1)
        both = _has(known, shorter)
        n = len(prints)
        good = good & both[:n] & both[1 : n + 1]
    return prints, good


def _has(known: np.ndarray, prints: np.ndarray) -> np.ndarray:
    slot = prints & U64((len(known) << 3) - 1)
    return (known[slot >> U64(3)] >> (slot & U64(7)).astype(np.uint8) & 1).astype(bool)


def _tongues(batch: pa.RecordBatch) -> np.ndarray:
    """A hash of every row's lang."""
    kinds = batch["lang"].dictionary_encode()
    hashes = np.array([xxh64_intdigest(x) for x in kinds.dictionary.to_pylist()], np.uint64)
    return hashes[kinds.indices.to_numpy()]


def _counter(size: int, known: Broadcast | None):
    @tidy
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tongues = _tongues(batch)
            for i, j, part, bounds, fresh, _ in slices(batch["text"], _GAP, size - 1, RUN):
                grams = Grams(part, bounds, fresh, tongues[i:j])
                prints, good = _passing(grams, size, known.value if known else None)
                good = good & grams.fresh[size - 1 :] if len(good) else good
                found, n = np.unique(prints[good], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["fp", "n"])

    return work


def _tellings(grams: Grams, langs: np.ndarray, longest: int, known: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Size by size, of every n-gram that the filter chose: the place of its first word, and its times.

    N-grams are told apart by their words, not by fingerprints: an n-gram's
    number stands for its shorter part's number and the number of its last word.
    """
    coded = grams.codes()
    texts, code = len(coded.dictionary), coded.indices.to_numpy().astype(np.int64)
    lang = langs[grams.row].astype(np.int64)
    number, chosen = lang, np.ones(len(code) + 1, bool)  # of what comes before the last word
    for size in range(1, longest + 1):
        prints, good = _passing(grams, size, known)
        chosen = good & _has(known, prints) & chosen[: len(prints)] & chosen[1 : len(prints) + 1]
        at = np.flatnonzero(chosen)
        if not len(at):
            return
        keys = number[at] * (texts + 1) + code[at + size - 1]
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        times = np.bincount(which[grams.fresh[at + size - 1]], minlength=len(first))
        number = np.zeros(len(prints), np.int64)
        number[at] = which
        yield size, at[first][times > 0], times[times > 0]


def _added(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row per lang and phrase, with the sum of their times and the least row number."""
    sums = pa.Table.from_batches(held).group_by(["lang", "phrase", "size"], use_threads=False).aggregate([("f", "sum"), ("uid", "min")])
    columns = [sums[c].combine_chunks() for c in ("lang", "phrase", "size", "f_sum", "uid_min")]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "size", "f", "uid"])


def _together(batches: Iterator[pa.RecordBatch], most: int = HELD) -> Iterator[pa.RecordBatch]:
    """The counts of a whole task added up; what has over ``most`` rows even so goes out and starts anew."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows > most:
            held = [_added(held)]
            rows = held[0].num_rows
            if 2 * rows > most:
                yield held[0]
                held, rows = [], 0
    if held:
        yield _added(held)


def _phrases(spaced: tuple[np.ndarray, np.ndarray], first: np.ndarray, size: int) -> pa.Array:
    """The n-grams of ``size`` words that begin at the words ``first``, as text."""
    flat, at = spaced
    lengths = at[first + size] - at[first] - 1  # without the space behind the last word
    ends = np.concatenate([[0], np.cumsum(lengths)])
    data = flat[np.arange(ends[-1]) + np.repeat(at[first] - ends[:-1], lengths)]
    texts = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
    return texts.cast(pa.binary()).cast(pa.string())


TOLD = "part int, counts binary"


def _dealt(batch: pa.RecordBatch, parts: int) -> pa.RecordBatch:
    """One row per part: the counts of its phrases as an Arrow stream."""
    named = pa.Table.from_batches([batch]).select(["lang", "phrase"]).to_pydict()
    part = np.fromiter((crc32((p or "").encode(), crc32(x.encode())) % parts for x, p in zip(named["lang"], named["phrase"])), np.int64, batch.num_rows)
    order = np.argsort(part, kind="stable")
    used, first = np.unique(part[order], return_index=True)
    sorted_, edges = batch.take(pa.array(order)), np.append(first, len(part)).tolist()
    rows = []
    for low, high in zip(edges, edges[1:]):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as stream:
            stream.write_batch(sorted_.slice(low, high - low))
        rows.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(rows, pa.binary())], names=["part", "counts"])


def _teller(longest: int, known: Broadcast, parts: int):
    def slices_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tongues, kinds = _tongues(batch), batch["lang"].dictionary_encode()
            names, langs = kinds.dictionary, kinds.indices.to_numpy()
            uids = batch["uid"].to_numpy()
            for i, j, part, bounds, fresh, _ in slices(batch["text"], _GAP, longest - 1, RUN):
                grams = Grams(part, bounds, fresh, tongues[i:j])
                words = np.bincount(langs[i:j][grams.row[grams.fresh]], minlength=len(names))
                has = np.flatnonzero(words)
                nothing = pa.nulls(len(has), pa.string()), pa.nulls(len(has), pa.int64())
                yield _counts(names.take(pa.array(has)), nothing[0], 0, words[has], nothing[1])
                spaced = grams.spaced()
                for size, first, times in _tellings(grams, langs[i:j], longest, known.value):
                    row = grams.row[first]
                    yield _counts(names.take(pa.array(langs[i:j][row])), _phrases(spaced, first, size), size, times, pa.array(uids[i + row]))

    @tidy
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(slices_of(batches)):
            yield _dealt(batch, parts)

    return work


def _counts(lang: pa.Array, phrase: pa.Array, size: int, times: np.ndarray, uid: pa.Array) -> pa.RecordBatch:
    columns = [lang.cast(pa.string()), phrase, pa.array(np.full(len(lang), size, np.int32)), pa.array(times.astype(np.int64)), uid]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "size", "f", "uid"])


def _adder(least: int):
    @tidy
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All counts of a part added up: phrases that occur ``least`` times, and the langs' numbers of words."""
        held, rows, limit = [], 0, HELD
        for batch in batches:
            for counts in batch["counts"]:
                held.extend(pa.ipc.open_stream(counts.as_buffer()))
                rows += held[-1].num_rows
                if rows > limit:
                    held = [_added(held)]
                    rows = held[0].num_rows
                    limit = max(HELD, 2 * rows)
        if held:
            sums = _added(held)
            enough = (sums["f"].to_numpy() >= least) | (sums["size"].to_numpy() == 0)
            yield sums.filter(pa.array(enough))

    return work


def _bits(frequent: DataFrame, known: np.ndarray) -> np.ndarray:
    """``known`` with the bits of ``frequent(fp)``: rows of 4 kB, at most as many as the filter has."""
    slot = F.col("fp").bitwiseAND(F.lit((len(known) << 3) - 1)) + 1
    parts = frequent.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    known = known.copy()
    for row in parts.toLocalIterator():
        bits = np.frombuffer(row.bits, np.uint8)
        at = (row.bucket - 1) * len(bits)
        known[at : at + len(bits)] |= bits[: len(known) - at]
    return known


def frequent_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
    longest: int = LONGEST, least: int = LEAST, filter_bits: int = FILTER,
) -> DataFrame:
    """``lang, phrase, size, f, uid``: every phrase of up to ``longest`` words that occurs ``least`` times in a lang.

    ``uid`` is the row number of a document that has it.  One more row per
    lang, of size 0, has the number of its words.
    """
    rows = docs.withColumn("_lang", F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)))
    rows = numbered(rows.withColumn("_id", F.lit(0)), "_id", text_col, "_lang")
    rows = rows.select("uid", "text", F.col("_lang").alias("lang"))
    spark = docs.sparkSession
    known, sent = np.zeros(1 << (filter_bits - 3), np.uint8), None
    for size in range(1, longest + 1):
        counted = rows.select("text", "lang").mapInArrow(_counter(size, sent), "fp long, n long")
        frequent = counted.groupBy("fp").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        known = _bits(frequent.select("fp"), known)
        if sent is not None:
            sent.unpersist()
        sent = spark.sparkContext.broadcast(known)
    # a task's counts go out as one row for each part, and each part is added up by one task
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // PART_BYTES + 1)
    told = rows.mapInArrow(_teller(longest, sent, parts), TOLD).repartition(parts, "part").select("counts")
    return settle(told.mapInArrow(_adder(least), "lang string, phrase string, size int, f long, uid long"), "phrases")


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(38,0)")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST,
    least: int = LEAST, first: int = FIRST, covered: int = COVERED, filter_bits: int = FILTER,
) -> DataFrame:
    """The ``first`` best phrases of every lang: ``lang, rank, phrase, a, l, r, n, score, uid``.

    Texts are lower-cased (A-Z) and split at ``. , ; : ! ?`` and 0x0A to 0x0D
    into pieces, these at spaces and tabs into words.  A phrase of 2 to
    ``longest`` words that occurs at least ``least`` times, ``a``, is scored at
    its worst cut by ``1000 a n / (l r)``, rounded down: ``l`` and ``r`` are the
    counts of its parts, ``n`` of all words.  Phrases inside a longer one that
    has at least ``covered`` percent of their count are left out.  Ties go to
    the larger count, then to the phrase first in byte order.  Scores are exact
    for counts up to 2**55.  Null texts are empty, a null lang is ``und``; repeated rows count again; an empty table
    gives an empty one.  Other columns, whatever their names, are ignored.
    """
    known = frequent_phrases(docs, text_col, lang_col, longest, least, filter_bits)
    words = known.filter("size = 0").select("lang", F.col("f").alias("n"))
    counts = known.filter("size > 0").select("lang", "phrase", "f")
    found = known.filter("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), "uid")
    found = found.withColumn("w", F.split("phrase", " "))

    # counts of the two parts at every cut
    part = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"left": part(F.lit(1), F.col("k")), "right": part(F.col("k") + 1, F.col("size") - F.col("k"))})
    lefts = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).join(words, "lang")
    score = F.call_function("div", _wide("a") * 1000 * _wide("n"), _wide("l") * _wide("r"))
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase").agg(worst, F.first("a").alias("a"), F.first("n").alias("n"), F.first("uid").alias("uid"))

    # what a longer phrase covers
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: part(i, n)),
        )
    )
    inside = found.filter("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("f"))
    most = inside.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    open_ = best.join(most, ["lang", "phrase"], "left").filter(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * covered))

    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = open_.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "uid")
