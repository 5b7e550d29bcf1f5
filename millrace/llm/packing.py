"""Packing token sequences by best-fit decreasing, exactly and at any size.

Documents are tokenised once, in place; a document longer than a sequence is
first cut into full ones, and what remains is one piece.  Best-fit decreasing
then only depends on how many pieces there are of each length: at most one
number per length.  That histogram is packed on the driver, with runs of like
windows instead of single ones, so the plan's size depends on the sequence
length and not on the input.  Pieces find their place by their rank among the
pieces of their length.  Token ids are never shuffled.
"""

from __future__ import annotations

import itertools
import os
import string
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import numbered, settle, tidy
from millrace.llm.words import EXACT_BYTE, U64, raw, runs, word_hashes

SEQUENCE = 4096
END = 2
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Words a worker remembers, and the longest of them in bytes.
REMEMBERED, LONGEST = 600_000, 48
#: Words in one call of the tokenizer, and bytes of text that are taken apart at once.
TOGETHER, RUN = 1024, 2 << 20

_MARK, _LETTER, _SECOND = np.zeros((3, 256), bool)
_MARK[[*string.punctuation.encode()]] = _LETTER[65:91] = _LETTER[97:123] = True
#: Second bytes of the letters U+00C0 to U+00FF, after 0xC3, and of the capitals among them.
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False
_CAPITAL = _SECOND & (np.arange(256) < 0x9F)


def _latin(data: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Bytes that end a letter U+00C0 to U+00FF, of those with these ``second`` bytes."""
    out = second[data]
    out[:1] = False
    out[1:] &= data[:-1] == 0xC3
    return out


class Pool:
    """An array that grows at its end in place."""

    def __init__(self, kind: type) -> None:
        self.room, self.n = np.empty(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        end = self.n + len(more)
        if end > len(self.room):
            wider = np.empty(max(end, 2 * len(self.room)), self.room.dtype)
            wider[: self.n] = self.room[: self.n]
            self.room = wider
        self.room[self.n : end] = more
        self.n = end


def _runs(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of runs that begin at ``first``, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Memory:
    """Words with their ids, found by a sorted array of 64-bit hashes and compared byte by byte.

    Of words with one hash the first is remembered.  Most words of a corpus
    come once: when there are too many, those stay that were found most often.
    """

    def __init__(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.text, self.ids = Pool(np.uint8), Pool(np.uint32)
        #: Per slot, where text and ids begin and how long they are.
        self.first, self.length, self.id_first, self.id_length = (Pool(np.int32) for _ in range(4))
        self.found = Pool(np.int32)

    def find(self, data: np.ndarray, at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The slot of every word ``data[at[i]:at[i + 1]]``, -1 for words that are not remembered."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        slot = np.where(self.keys[place] == hashes, self.slots[place], -1)
        size = np.diff(at)
        slot[(slot >= 0) & (self.length.room[slot] != size)] = -1
        same = np.flatnonzero((slot >= 0) & (size > 0))
        if len(same):
            each = size[same]
            differ = data[_runs(at[:-1][same], each)] != self.text.room[_runs(self.first.room[slot[same]], each)]
            wrong = np.add.reduceat(differ, np.cumsum(each) - each, dtype=np.int64) > 0
            slot[same[wrong]] = -1
        self.found.room[slot[slot >= 0]] += 1
        return slot

    def trimmed(self, most: int) -> Memory:
        """At most ``most`` words, those that the most batches had."""
        out, found = Memory(), self.found.room[: self.found.n]
        kept = np.flatnonzero(found)
        if len(kept) > most:
            kept = np.sort(kept[np.argpartition(found[kept], -most)[-most:]])
        if len(kept):
            size, id_size = self.length.room[kept], self.id_length.room[kept]
            hashes = np.empty(self.first.n, np.uint64)
            hashes[self.slots] = self.keys
            at = np.concatenate([[0], np.cumsum(size)])
            text = self.text.room[_runs(self.first.room[kept], size)]
            ids = self.ids.room[_runs(self.id_first.room[kept], id_size)]
            out.add(text, at, hashes[kept], ids, id_size, np.arange(len(kept)))
        return out

    def add(self, data: np.ndarray, at: np.ndarray, hashes: np.ndarray, ids: np.ndarray, id_sizes: np.ndarray, which: np.ndarray) -> None:
        """Remember the words that ``which`` names; ``ids`` has all words' ids in order."""
        _, once = np.unique(hashes[which], return_index=True)
        which = which[once]
        place = np.searchsorted(self.keys, hashes[which])
        new = np.append(self.keys, U64(0))[place] != hashes[which]
        new |= place == len(self.keys)
        which, place = which[new], place[new]
        slots = self.first.n + np.arange(len(which))
        self.keys, self.slots = np.insert(self.keys, place, hashes[which]), np.insert(self.slots, place, slots)
        size, id_size = np.diff(at)[which], id_sizes[which]
        self.first.add(self.text.n + np.cumsum(size) - size)
        self.length.add(size)
        self.id_first.add(self.ids.n + np.cumsum(id_size) - id_size)
        self.id_length.add(id_size)
        self.found.add(np.zeros(len(which), np.int32))
        self.text.add(data[_runs(at[:-1][which], size)])
        self.ids.add(ids[_runs((np.cumsum(id_sizes) - id_sizes)[which], id_size)])


class WordTokens:
    """Token ids of whole texts, from the ids of their words.

    The tokenizer drops white space, and neither its pre-tokens nor its added
    tokens span it, so a text's ids are those of its stretches between white
    space, one after the other.  Each distinct stretch of a batch is encoded
    once; short ones are remembered, up to REMEMBERED.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        pa.set_cpu_count(1)
        self.tokenizer = Tokenizer.from_file(path)
        self.memory = Memory()
        # the same model for words of small letters, on which the rest of the tokenizer does nothing
        self.simple = Tokenizer.from_file(path)
        self.simple.normalizer = normalizers.Sequence([])
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.simple.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), byte_level])
        vocabulary = self.tokenizer.get_vocab()
        #: Which ids end a word.
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def lookup(self, kinds: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct stretches, one after the other, and how many each has.

        The tokenizer lower-cases, and marks at the end, after a letter, are a
        pre-token of their own.  So Latin letters are lower-cased in stretches
        that cannot hold an added token, and their marks are looked up by
        themselves, which leaves far fewer words.
        """
        data, at = raw(kinds)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(kinds), np.int64)
        size = np.diff(at)
        opens = np.concatenate([[0], np.cumsum(data == ord("<"))])
        plain = opens[at[1:]] == opens[at[:-1]]
        # where the marks at a stretch's end begin
        stop = np.maximum.accumulate(np.where(_MARK[data], 0, np.arange(1, len(data) + 1)))[np.maximum(at[1:] - 1, 0)]
        tail = np.flatnonzero(plain & (stop < at[1:]) & (stop > at[:-1]))
        before = stop[tail] - 1
        tail = tail[(_LETTER[data] | _latin(data, _SECOND))[before]]
        text = data + np.uint8(32) * (((data >= 65) & (data <= 90) | _latin(data, _CAPITAL)) & np.repeat(plain, size))
        core, first = size.copy(), at[:-1].copy()
        core[tail] = stop[tail] - first[tail]
        core, first = np.append(core, size[tail] - core[tail]), np.append(first, stop[tail])
        ends = np.concatenate([[0], np.cumsum(core)])
        words = pa.Array.from_buffers(pa.large_string(), len(core), [None, pa.py_buffer(ends), pa.py_buffer(text[_runs(first, core)])])
        words = words.dictionary_encode()
        codes = words.indices.to_numpy().astype(np.int64)
        ids, sizes = self.ids_of(words.dictionary)
        codes, marks = codes[: len(size)], codes[len(size) :]
        wanted = np.insert(codes, tail + 1, marks)
        each = sizes[codes]
        each[tail] += sizes[marks]
        return _gathered(ids, sizes, wanted), each

    def ids_of(self, kinds: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, one after the other, and how many each has; words are remembered."""
        data, at = raw(kinds)
        hashes = word_hashes(np.append(data, np.uint8(0)), at[:-1], at[1:], EXACT_BYTE)  # the last word may be empty
        slot = self.memory.find(data, at, hashes)
        new = np.flatnonzero(slot < 0)
        ids, sizes = self.encoded(kinds.take(pa.array(new)))
        every = np.zeros(len(kinds), np.int64)
        known = np.flatnonzero(slot >= 0)
        every[known], every[new] = self.memory.id_length.room[slot[known]], sizes
        to = np.cumsum(every) - every
        out = np.empty(int(every.sum()), np.uint32)
        out[_runs(to[known], every[known])] = self.memory.ids.room[_runs(self.memory.id_first.room[slot[known]], every[known])]
        out[_runs(to[new], sizes)] = ids
        short = new[np.diff(at)[new] <= LONGEST]
        if len(self.memory.keys) + len(short) > REMEMBERED:
            self.memory = self.memory.trimmed(REMEMBERED // 2)
        self.memory.add(data, at, hashes, out, every, short[: REMEMBERED // 2])
        return out, every

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The tokenizer's ids of words.

        Words of small Latin letters are one pre-token each, and the last token
        of a pre-token is one that ends a word: such words are encoded many at a
        time and told apart by these tokens.
        """
        simple = pc.match_substring_regex(words, "^[a-zß-öø-ÿ]+$").to_numpy(zero_copy_only=False)
        sizes = np.zeros(len(words), np.int64)
        made: list[np.ndarray] = []
        for kind in (True, False):
            of = np.flatnonzero(simple == kind)
            for i in range(0, len(of), TOGETHER):
                some = words.take(pa.array(of[i : i + TOGETHER])).to_pylist()
                found = self._together(some) if kind else None
                if found is None:
                    each = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                    n = np.fromiter(map(len, each), np.int64, len(each))
                    found = np.fromiter(itertools.chain.from_iterable(each), np.uint32, int(n.sum())), n
                made.append(found[0])
                sizes[of[i : i + TOGETHER]] = found[1]
        order = np.concatenate([np.flatnonzero(simple), np.flatnonzero(~simple)])
        out = np.empty(int(sizes.sum()), np.uint32)
        if made:
            out[_runs((np.cumsum(sizes) - sizes)[order], sizes[order])] = np.concatenate(made)
        return out, sizes

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of one-pre-token words from a single call; None if they cannot be told apart."""
        (found,) = self.simple.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words) or stops[-1] != len(ids):
            return None
        return ids, np.diff(stops, prepend=0)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) in order, and the n + 1 bounds of the texts in them."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        ids, sizes = self.lookup(coded.dictionary)
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])
        return _gathered(ids, sizes, codes), ends[split.offsets.to_numpy() - split.offsets[0].as_py()]


def _gathered(pool: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The runs of ``pool`` (of the given sizes) named by ``wanted``, one after the other."""
    first, each = np.cumsum(sizes) - sizes, sizes[wanted]
    ends = np.cumsum(each)
    out = np.empty(int(ends[-1]) if len(ends) else 0, pool.dtype)
    for i in range(0, len(wanted), 1 << 17):
        part = slice(i, i + (1 << 17))
        out[int(ends[i] - each[i]) : ends[part][-1]] = pool[_runs(first[wanted[part]], each[part])]
    return out


_TOKENS: dict[str, WordTokens] = {}

PIECES = "uid long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cutter(path: str, sequence: int, end: int):
    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _TOKENS:
            _TOKENS[path] = WordTokens(path)
        for batch in (b.slice(i, j - i) for b in batches for i, j in runs(raw(b["text"])[1], RUN)):
            ids, at = _TOKENS[path].encode(batch["text"])
            owner, start, length, crc = [], [], [], []
            whole = np.diff(at) + 1
            for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                own = np.append(ids[a:b], np.uint32(end)).astype("<u4")
                for s in range(0, len(own), sequence):
                    piece = own[s : s + sequence]
                    owner.append(i)
                    start.append(s)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece))
            owner = np.array(owner, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["uid"].take(pa.array(owner)),
                    batch["doc_id"].take(pa.array(owner)),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array(whole[owner], pa.int64()),
                ],
                names=["uid", "doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return cut


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    vocabulary: str = VOCABULARY, sequence: int = SEQUENCE, end: int = END,
) -> DataFrame:
    """Every document's tokens, closed by ``end``, cut into full sequences and a rest."""
    return numbered(docs, id_col, text_col).mapInArrow(_cutter(vocabulary, sequence, end), PIECES)


class Room:
    """A segment tree over remaining capacities: which have an open window, and the tightest that fits."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.some = [False] * (2 * self.leaves)
        self.open: dict[int, list[tuple[int, int]]] = {}

    def put(self, left: int, first: int, count: int) -> None:
        """``count`` windows from number ``first`` on have ``left`` tokens left."""
        self.open.setdefault(left, []).append((first, count))
        at = self.leaves + left
        while at and not self.some[at]:
            self.some[at] = True
            at //= 2

    def take(self, least: int) -> tuple[int, int, int] | None:
        """Windows with the smallest remaining capacity of at least ``least``."""
        at = self.leaves + least
        if not self.some[at]:
            while at > 1 and (at % 2 or not self.some[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.some[2 * at] else 2 * at + 1
        left = at - self.leaves
        first, count = self.open[left].pop()
        if not self.open[left]:
            self.some[at] = False
            while at > 1 and not (self.some[at] or self.some[at ^ 1]):
                at //= 2
                self.some[at] = False
        return left, first, count


def best_fit(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing for ``counts[length]`` pieces of each length.

    Rows (length, rank, sequence, windows, each, offset): the pieces of that
    length from ``rank`` on fill ``windows`` sequences from ``sequence`` on,
    ``each`` to a sequence, starting at ``offset`` there.  Like pieces follow
    each other into the tightest window until it is too small, as they would
    one by one.  A window's room at least halves with every kind of piece it
    takes, so there are at most 13 rows per run of windows, and a length makes
    at most two new runs: the rows are bounded by the capacity alone.
    """
    room, rows, opened = Room(capacity), [], 0
    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        while done < total:
            found = room.take(length)
            if found is None:
                left, first = capacity, opened
                windows = -(-(total - done) // (capacity // length))
                opened += windows
            else:
                left, first, windows = found
            fits = left // length
            full = min(windows, (total - done) // fits)
            if full:
                rows.append((length, done, first, full, fits, capacity - left))
                room.put(left - fits * length, first, full)
                done += full * fits
            if full < windows:
                rest = min(total - done, fits - 1)
                if rest:
                    rows.append((length, done, first + full, 1, rest, capacity - left))
                    room.put(left - rest * length, first + full, 1)
                    done += rest
                if windows - full - bool(rest):
                    room.put(left, first + full + bool(rest), windows - full - bool(rest))
    return np.array(rows, np.int64).reshape(-1, 6)


PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _placer(rows: np.ndarray):
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    rows = rows[order]
    keys = rows[:, 0] * (1 << 48) + rows[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            row = rows[np.searchsorted(keys, length * (1 << 48) + rank, "right") - 1]
            inside = rank - row[:, 1]
            out = [batch[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            out += [pa.array(row[:, 2] + inside // row[:, 4]), pa.array(row[:, 5] + inside % row[:, 4] * length)]
            yield pa.RecordBatch.from_arrays(out, names=[c.split()[0] for c in PLACED.split(", ")])

    return place


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    vocabulary: str = VOCABULARY, sequence: int = SEQUENCE, end: int = END,
) -> DataFrame:
    """One row per piece: its place in its document and in its sequence.

    Ids are the library's own for the plain call, added tokens in a text
    included.  Null and empty texts are the end token alone; repeated rows and ids are
    documents of their own; other columns are ignored.  No documents give no
    rows.  What reaches the driver is one count per length, ``sequence`` at
    most; a length may have any share of the pieces, since ranks are counted
    per input partition and added up.
    """
    cut = pieces(docs, id_col, text_col, vocabulary, sequence, end).withColumn("part", F.spark_partition_id())
    cut = settle(cut, "pieces")
    counts = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    sizes = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start", "uid"))
    ranked = (
        cut.withColumn("place", place)
        .join(before, ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("place") - F.lit(1))
        .drop("place", "before", "part", "uid")
    )
    return ranked.mapInArrow(_placer(best_fit(sizes, sequence)), PLACED)
