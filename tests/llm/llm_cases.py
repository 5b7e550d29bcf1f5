"""Awkward documents and brute-force versions the operators are held to."""

from __future__ import annotations

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns an operator could trip over, since it uses such names inside.
CLASH = ["uid", "key", "kept", "shingles", "class", "place", "part", "length", "n", "component_id", "_millrace_uid"]


def prose(seed: int, n: int, words: int = 4000) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(words)}" for _ in range(n))


def changed(text: str, seed: int, share: float) -> str:
    draw = random.Random(seed)
    return " ".join(f"x{draw.randrange(9999)}" if draw.random() < share else w for w in text.split(" "))


def awkward() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows and ids."""
    long = prose(1, 60_000)
    base = prose(2, 300)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", "en", "a", 4),
        (4, "one two", "en", "a", 7),
        (5, "One  two", "en", "a", 8),
        (6, long, "en", "b", len(long)),
        (7, long.upper(), "en", "b", len(long)),
        (8, base, "de", "b", len(base)),
        (8, base, "de", "b", len(base)),
        (9, base, None, "b", len(base)),
        (None, base, "de", None, None),
        (None, None, None, None, None),
        (10, "12345 !!! ???", "en", "c", 13),
        (11, "\x00 nul é ÀÉ 日本 🙂 " + base, "fr", "c", 1),
        (12, "a" * 100_000, "fr", "c", 100_000),
    ]
    rows += [(100 + i, changed(base, i, 0.01 * (i % 12)), "de", "b", 1) for i in range(40)]
    rows += [(200 + i, prose(300 + i, 120) + " " + prose(77, 70) + " " + prose(500 + i, 90), "es", "d", 1) for i in range(12)]
    return rows


def frame(spark, rows, clash: bool = False):
    df = spark.createDataFrame(rows, DOC)
    if clash:
        for c in CLASH:
            df = df.withColumn(c, df["source"])
    return df


def words(text: str | None) -> list[bytes]:
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    return (text or "").encode().translate(lower).split()


def shingle_set(text: str | None, size: int = 5) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute_components(rows: list[tuple], percent: int = 75) -> list[int | None]:
    """The component id of every row, by comparing all pairs."""
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    ids: dict[int, int | None] = {}
    for i, r in enumerate(rows):
        known = [x for x in (ids.get(find(i)), r[0]) if x is not None]
        ids[find(i)] = min(known) if known else None
    return [ids[find(i)] for i in range(len(rows))]
