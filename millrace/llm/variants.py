"""Spelling variants by finite-state composition.

The pairs of words one edit apart are what the composition of the vocabulary's
minimal acceptor, a transducer that makes one edit, and the acceptor again
accepts.  It is enumerated in partitions by initial state: a partition is a
state of the acceptor that a prefix of PREFIX code points leads to, with the
words behind it.  Words of at least 2 * PREFIX + 1 code points that are one edit
apart share their first or their last PREFIX, so the edits that change a prefix
are found in the same way in the acceptor of the reversed words.

A partition of more than GROUP words is never gathered.  Its edits right at the
initial state are found by joining words with one code point left out, and the
rest in the partitions one code point further on.  Words of over LONG code
points, whose states would be as many as their code points, are joined like
that at every place, by fingerprints from prefix polynomials, and compared.

Every pair is found once: an edit counts where the two words first differ.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import numbered, settle, tidy
from millrace.llm.slices import SPACE, slices
from millrace.llm.words import U64, _power, mix, runs

SHORTEST, LEAST, TIMES, EVERY = 7, 2, 10, 31
PREFIX, GROUP, LONG = 3, 8192, 64

_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def _counter(shortest: int, every: int):
    @tidy
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[bytes] = Counter()
            ids = batch["doc_id"].to_pylist()
            for i, j, part, bounds, fresh, _ in slices(batch["text"], SPACE, 0):
                data = part.tobytes().lower()  # of bytes: A-Z only
                for k in range(i, j):
                    runs = Counter(_RUN.findall(data, int(bounds[k - i]), int(bounds[k - i + 1])))
                    seed = zlib.crc32(b"%s:" % ("" if ids[k] is None else str(ids[k])).encode())
                    for run, n in runs.items():
                        if len(run) < shortest:
                            continue
                        h = zlib.crc32(run, seed)
                        if h % every == 0:
                            points = run.decode()
                            at = h % len(points)
                            run = (points[:at] + points[at + 1 :]).encode()
                        found[run] += n
            words, n = list(found.keys()), list(found.values())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

    return work


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shortest: int = SHORTEST, least: int = LEAST, every: int = EVERY,
) -> DataFrame:
    """``id, word, n``: the words of all texts, with a slip of the pen in every ``every``-th run of letters."""
    rows = numbered(docs, id_col, text_col).select("doc_id", "text")
    counted = rows.mapInArrow(_counter(shortest, every), "word string, n long")
    words = counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    words = words.filter(F.char_length("word") >= shortest)
    return settle(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")


class Acceptor:
    """The minimal acceptor of sorted words: per state its arcs, and whether a word ends there."""

    def __init__(self, words: list[str], skip: int):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        path: list[tuple[dict[str, int], list[bool]]] = [({}, [False])]
        last = ""

        def close(depth: int) -> None:
            """States below ``depth`` of the last word get no more arcs: merge them with equal ones."""
            while len(path) > depth + 1:
                arcs, end = path.pop()
                path[-1][0][last[skip + len(path) - 1]] = self._state(arcs, end[0], known)

        for word in words:
            same = skip
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            close(same - skip if last else 0)
            path.extend(({}, [False]) for _ in word[same:])
            path[-1][1][0] = True
            last = word
        close(0)
        self.start = self._state(path[0][0], path[0][1][0], known)

    def _state(self, arcs: dict[str, int], end: bool, known: dict[tuple, int]) -> int:
        key = (end, *arcs.items())
        if key not in known:
            known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(end)
        return known[key]


def pairs(words: list[str], skip: int) -> Iterator[tuple[str, str]]:
    """All pairs of sorted words that share ``skip`` code points and differ by one edit after them, once each."""
    made = Acceptor(words, skip)
    arcs, final = made.arcs, made.final
    common: dict[tuple[int, int], list[str]] = {}

    def rest(p: int, q: int) -> list[str]:
        """What both states accept."""
        key = (p, q) if p < q else (q, p)
        found = common.get(key)
        if found is None:
            found = [""] if final[p] and final[q] else []
            a, b = arcs[p], arcs[q]
            if len(b) < len(a):
                a, b = b, a
            for c, to in a.items():
                if c in b:
                    found += [c + x for x in rest(to, b[c])]
            common[key] = found
        return found

    stack = [(made.start, words[0][:skip] if words else "")]
    while stack:
        q, prefix = stack.pop()
        out = list(arcs[q].items())
        for i, (c, to) in enumerate(out):
            stack.append((to, prefix + c))
            for d, other in out[i + 1 :]:  # c becomes d
                for x in rest(to, other):
                    yield prefix + c + x, prefix + d + x
            # c is left out, and the words differ from here on
            if final[to] and final[q]:
                yield prefix + c, prefix
            for d, other in out:
                if d != c and d in arcs[to]:
                    for x in rest(arcs[to][d], other):
                        yield prefix + c + d + x, prefix + d + x


NEAR = "id long, n_near long, form_n long, form string"


def _better(n: int, word: str, held: list) -> None:
    held[0] += 1
    if n > held[1] or n == held[1] and word < held[2]:
        held[1], held[2] = n, word


def _enumerate(prefix: int):
    def work(table: pa.Table) -> pa.Table:
        """How many near words every word of a partition has in it, and the most frequent of them."""
        back, depth = table["back"][0].as_py(), table["depth"][0].as_py()
        words = table["word"].to_pylist()
        turned = [w[::-1] for w in words] if back else words
        of = dict(zip(turned, zip(table["id"].to_pylist(), words, table["n"].to_pylist())))
        near: dict[int, list] = {}
        for a, b in pairs(sorted(turned), depth):
            if back and a[: -prefix - 1 : -1] == b[: -prefix - 1 : -1]:
                continue  # found among the words with this prefix
            (i, v, n), (j, w, m) = of[a], of[b]
            _better(m, w, near.setdefault(i, [0, -1, ""]))
            _better(n, v, near.setdefault(j, [0, -1, ""]))
        rows = [(i, *held) for i, held in near.items()]
        columns = list(zip(*rows)) or [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.table({c: pa.array(v, k) for c, v, k in zip(("id", "n_near", "form_n", "form"), columns, kinds)})

    return work


#: Places for an edit that are worked on at once.
PLACES = 1 << 18


def _left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of every word, and of it without the code point at each place from ``low`` to before ``high``."""
    for batch in batches:
        words, ids = batch["word"].to_pylist(), batch["id"].to_numpy()
        low, high = (batch[c].to_numpy().astype(np.int64) for c in ("low", "high"))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for i, j in runs(np.concatenate([[0], np.cumsum(sizes + high - low)]), PLACES):
            points = np.frombuffer("".join(words[i:j]).encode("utf-32-le"), np.uint32).astype(np.uint64)
            total = np.concatenate([[U64(0)], np.cumsum(mix(points) * _power(0, len(points)), dtype=np.uint64)])
            back = _power(1, len(points) + 2)
            size = sizes[i:j]
            first = np.cumsum(size) - size
            end = first + size
            each = high[i:j] - low[i:j]
            word = np.repeat(np.arange(j - i), each)
            place = np.arange(len(word)) - np.repeat(np.cumsum(each) - each - low[i:j], each)
            at, start = first[word] + place, first[word]
            # what comes after the place moves one to the front: divided by the base once more
            left = (total[at] - total[start]) * back[start]
            right = (total[end[word]] - total[at + 1]) * back[start + 1]
            whole = mix((total[end] - total[first]) * back[first] + size.astype(np.uint64))
            keys = np.concatenate([whole, mix(left + right + (size[word] - 1).astype(np.uint64))])
            places = np.concatenate([np.full(j - i, -1), place])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(places), pa.array(np.concatenate([ids[i:j], ids[i:j][word]]))],
                names=["key", "place", "id"],
            )


def _joined(words: DataFrame, asked: DataFrame) -> DataFrame:
    """``a, b``: verified pairs of near words, from the places ``asked(id, word, low, high)`` for an edit.

    Words that agree with one place left out are at most as many as there are
    letters, so these joins give little beside the pairs.
    """
    made = settle(asked.mapInArrow(_left_out, "key long, place long, id long"), "left-out")
    whole = made.filter("place < 0").select("key", F.col("id").alias("b"))
    short = made.filter("place >= 0")
    other = short.select("key", "place", F.col("id").alias("b"))
    changed = short.join(other, ["key", "place"]).filter("id < b").select(F.col("id").alias("a"), "b")
    longer = short.join(whole, "key").filter("id <> b").select(F.col("id").alias("a"), "b")
    found = changed.unionByName(longer).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = words.select(F.col("id").alias("a"), F.col("word").alias("v"), F.col("n").alias("v_n"))
    right = words.select(F.col("id").alias("b"), F.col("word").alias("w"), F.col("n").alias("w_n"))
    return found.join(left, "a").join(right, "b").filter(F.levenshtein("v", "w", 1) == 1)


def _both_ways(found: DataFrame) -> DataFrame:
    one = F.lit(1).cast("long").alias("n_near")
    there = found.select(F.col("a").alias("id"), one, F.col("w_n").alias("form_n"), F.col("w").alias("form"))
    back = found.select(F.col("b").alias("id"), one, F.col("v_n").alias("form_n"), F.col("v").alias("form"))
    return there.unionByName(back)


def near_words(words: DataFrame, prefix: int = PREFIX, group: int = GROUP, long: int = LONG) -> DataFrame:
    """``id, n_near, form_n, form`` of the words of ``words(id, word, n)`` with near words: how many, and the most frequent.

    Words must be different and have at least ``2 * prefix + 1`` code points.
    """
    size = F.char_length("word")
    parts = []

    # 1. pairs with a word of more than `long` code points
    tall = words.filter(size >= long)
    asked = tall.select("id", "word", F.lit(0).alias("low"), size.alias("high"))
    found = _joined(tall, asked).filter(F.greatest(F.char_length("v"), F.char_length("w")) > long)
    parts.append(_both_ways(found))

    # 2. the others, from the front and from the back
    short = words.filter(size <= long)
    live = short.withColumn("back", F.lit(False)).unionByName(short.withColumn("back", F.lit(True)))
    depth = prefix
    while True:
        turned = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
        placed = live.withColumns({"depth": F.lit(depth), "state": F.substring(turned, 1, depth)})
        sizes = placed.groupBy("back", "state").agg(F.count("*").alias("words")).filter("words > 1")
        sizes = settle(sizes, "states")
        fits = placed.join(sizes.filter(F.col("words") <= group).select("back", "state"), ["back", "state"])
        parts.append(fits.groupBy("back", "state").applyInArrow(_enumerate(prefix), NEAR))
        large = sizes.filter(F.col("words") > group).select("back", "state")
        if not large.limit(1).count():
            break
        crowd = settle(placed.join(large, ["back", "state"], "left_semi"), "crowds")
        at = F.when(F.col("back"), size - depth - 1).otherwise(F.lit(depth))
        inside = size > depth
        low, high = F.when(inside, at).otherwise(0), F.when(inside, at + 1).otherwise(0)
        asked = crowd.select("back", "id", "word", low.alias("low"), high.alias("high"))
        for back in (False, True):
            found = _joined(short, asked.filter(F.col("back") == back).drop("back"))
            v, w = (F.reverse(c) if back else F.col(c) for c in ("v", "w"))
            first = (F.substring(v, 1, depth) == F.substring(w, 1, depth)) & (F.substring(v, 1, depth + 1) != F.substring(w, 1, depth + 1))
            if back:
                first = first & (F.substring("v", 1, prefix) != F.substring("w", 1, prefix))
            parts.append(_both_ways(found.filter(first)))
        live = crowd.filter(size > depth).drop("depth", "state")
        depth += 1

    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    best = F.min(F.struct((-F.col("form_n")).alias("minus"), "form"))
    joined = every.groupBy("id").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return joined.select("id", "n_near", (-F.col("best.minus")).alias("form_n"), "best.form")


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST,
    least: int = LEAST, times: int = TIMES, every: int = EVERY, group: int = GROUP, long: int = LONG,
) -> DataFrame:
    """Every word of the texts with the word it is a variant of: ``word, form, root, n, n_near, form_n``.

    A word is a run of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased, of
    at least ``shortest`` code points, that occurs ``least`` times or more.  In a
    run whose CRC-32 with its document's id ``every`` divides, one code point is
    left out first.  Near words differ by one code point inserted, deleted or
    replaced; ``form`` is the most frequent of them (ties: the first in code
    point order), if it occurs ``times`` times as often; ``root`` is where the
    forms end.  Null and empty texts have no words, and a null id reads as
    empty; rows that repeat count again; an empty table gives an empty one.
    Other columns, whatever their names, are ignored.
    """
    words = vocabulary(docs, id_col, text_col, shortest, least, every)
    found = words.join(near_words(words, (shortest - 1) // 2, group, long), "id", "left").drop("id")
    real = F.col("form_n") >= F.col("n") * times
    found = found.withColumns({"form": F.when(real, F.col("form")), "form_n": F.when(real, F.col("form_n"))})
    found = settle(found.withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long"))), "variants")
    # forms occur ever more often, so chains are short; each round doubles the steps taken
    chains = settle(found.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = chains.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = chains.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = settle(moved, "roots")
        chains = moved.drop("moved")
        if not moved.filter("moved").limit(1).count():
            break
    out = found.join(chains, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")
