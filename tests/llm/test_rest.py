"""Shards, archives, languages, licences and neighbours."""

import hashlib
import math
import random
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import awkward, frame, prose
from pyspark.sql import functions as F

from millrace.llm import ann, langid, license, shard, warc
from millrace.session import fresh_dir


# ---------------------------------------------------------------- shards


@pytest.mark.parametrize("clash", [False, True])
def test_shards(spark, clash):
    rows = awkward() + [(7777, "same", None, None, None)] * 300
    df = frame(spark, rows, clash)
    got = shard.assign(df, 40).collect()
    size = lambda t: len((t or "").encode())
    expected = Counter((r[0], size(r[1]) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expected
    slots, home = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        home[r.doc_id].add((r.shard, r.grown_shard))
        assert r.law == "key" and 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in home.values())
    assert shard.assign(frame(spark, []), 40).collect() == []


def test_jump_is_even_and_moves_the_least(spark):
    walks = spark.range(40_000).select(*[shard.jump(F.col("id"), n).alias(f"n{n}") for n in (1, 7, 8, 9)]).collect()
    for r in walks:
        assert r.n1["shard"] == 0
        assert r.n7["grown"] == r.n8["shard"] and r.n8["grown"] == r.n9["shard"]
        assert r.n8["shard"] in (r.n7["shard"], 7)
    counts = Counter(r.n8["shard"] for r in walks)
    assert set(counts) == set(range(8)) and max(counts.values()) < 1.06 * 5000 < 1.12 * min(counts.values())
    moved = sum(r.n8["shard"] != r.n9["shard"] for r in walks)
    assert abs(moved / 40_000 - 1 / 9) < 0.01
    with pytest.raises(ValueError):
        shard.jump(F.col("id"), 0)


# ---------------------------------------------------------------- archives

PAGE = "page_id long, url string, html string"


def pages():
    big, other = "<p>" + "x" * 200, "<p>é" + "y" * 96
    return [
        (5, "http://a/1", big), (3, "http://a/2", big), (9, None, big), (None, "http://a/3 b\r\nEvil: 1", big),
        (1, "http://b/", "short"), (2, "http://b/", "short"), (4, "u", None), (6, "u", ""), (7, "u", other), (8, "u", other),
        (8, "u", other), (None, "u", "z" * 150), (None, "u", "z" * 150), (10, "u", "a\r\n\r\nWARC/1.1\r\n\r\n" * 2000),
    ]


def expected_pages(rows):
    first = {}
    for page, _, html in rows:
        text = (html or "").encode()
        if len(text) >= 100 and page is not None:
            first[text] = min(first.get(text, page), page)
    out = Counter()
    for page, _, html in rows:
        text = (html or "").encode()
        again = text in first and page != first[text]
        kind = "revisit" if again else "response"
        out[(page, len(text), hashlib.sha256(text).hexdigest(), kind, first[text] if again else None)] += 1
    return out


def test_round_trip(spark):
    df = spark.createDataFrame(pages(), PAGE).withColumn("uid", F.lit("x")).withColumn("digest", F.lit("y"))
    got = Counter(tuple(r) for r in warc.round_trip(df).collect())
    assert got == expected_pages(pages())
    assert warc.round_trip(spark.createDataFrame([], PAGE)).collect() == []


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_records_in_archives(spark, compression):
    path = fresh_dir(spark, "archives")
    records = warc.page_records(spark.createDataFrame(pages(), PAGE))
    warc.write_archives(records, path, compression)
    back = warc.read_archives(spark, path)
    assert Counter(tuple(r) for r in warc.pages_of(back).collect()) == expected_pages(pages())
    revisits = warc.read_archives(spark, path, "record_type string, record_id string").filter("record_type = 'revisit'")
    assert revisits.count() == sum(n for k, n in expected_pages(pages()).items() if k[3] == "revisit")
    one = back.filter((F.col("record_type") == "response") & F.col("record_id").startswith("<urn:page:10")).collect()
    assert [bytes(r.payload).decode() for r in one] == ["a\r\n\r\nWARC/1.1\r\n\r\n" * 2000]
    assert "evil" not in {k for r in back.collect() for k in r.headers}
    warc.write_archives(records, path, compression)
    assert back.sparkSession.read.format("warc").load(path).count() == 2 * len(pages())


def test_payloads_that_are_not_wanted_stay_compressed(monkeypatch):
    import io
    import zlib as z

    rows = [{"record_type": t, "record_id": f"<{i}>", "date": "d", "payload": random.Random(i).randbytes(200_000)} for i, t in enumerate(["response", "resource"] * 5)]
    data = b"".join(warc.member(warc.record(r)) for r in rows)
    read = []

    class File(io.BytesIO):
        def read(self, n=-1):
            out = super().read(n)
            read.append(len(out))
            return out

    wanted = lambda h: True if h["warc-type"] == "resource" else None
    got = list(warc.Archive(File(data), 0, len(data)).records(wanted))
    assert [p for _, p in got] == [r["payload"] for r in rows[1::2]]
    assert sum(read) < 0.6 * len(data)
    plain = b"".join(z.compress(warc.record(r), wbits=31) for r in rows)  # members without lengths
    assert [p for _, p in warc.Archive(io.BytesIO(plain), 0, len(plain)).records(wanted)] == [p for _, p in got]
    with pytest.raises(ValueError):
        list(warc.Archive(io.BytesIO(plain[:-100_000]), 0, len(plain)).records(wanted))


def test_filters_reach_the_reader(spark):
    from pyspark.sql.datasource import EqualTo, GreaterThan, StringStartsWith

    reader = warc.WarcReader(spark.createDataFrame([], "record_type string").schema, {"path": "/"})
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("content_length",), 5), StringStartsWith(("target_uri",), "http://a")]))
    assert [type(f).__name__ for f in left] == ["GreaterThan"]
    assert reader._wanted({"warc-type": "response", "warc-target-uri": "http://a/1"}) is False
    assert reader._wanted({"warc-type": "response"}) is None


# ---------------------------------------------------------------- languages

SYLLABLES = {"aa": "the and ing er on at", "ab": "the und ung er ein ich", "ba": "que les tion eau oi ment", "bb": "que los cion ado oz ente"}


def speech(lang: str, seed: int, n: int = 120) -> str:
    draw = random.Random(f"{lang}{seed}")
    parts = SYLLABLES[lang].split()
    return " ".join("".join(draw.choices(parts, k=draw.randint(1, 3))) for _ in range(n))


def test_languages(spark):
    rows = [(i, speech(lang, i), lang, "s", 1) for i, lang in enumerate(sorted(SYLLABLES) * 60)]
    more = [(9001, None, "aa", None, 0), (9002, "", "aa", None, 0), (9003, "123 !?", "ba", None, 0), (9004, "the", None, None, 0), (None, speech("ba", 5), None, None, 0), (9005, speech("bb", 7, 30_000), None, None, 0), (9004, "the", None, None, 0)]
    df = frame(spark, rows + more, clash=True)
    got = langid.identify(df, sample=40).collect()
    assert len(got) == len(rows + more)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert np.mean([by[r[0]][0].lang_pred == r[2] for r in held]) > 0.97
    assert [by[i][0].lang_pred for i in (9001, 9002, 9003)] == ["und"] * 3
    assert by[9005][0].lang_pred == "bb" and by[None][0].lang_pred == "ba"
    assert by[9004][0][2:] == by[9004][1][2:]


def test_families_and_lack_of_labels(spark):
    profile = lambda *on: np.bincount(on, minlength=8).astype(float)
    assert langid.families({"a": profile(1, 2), "b": profile(5, 6), "c": profile(1, 2, 2), "d": profile(5, 6, 6)}) == [["a", "c"], ["b", "d"]]
    rows = [(i, speech("aa", i), None, None, 1) for i in range(5)]
    assert {r.lang_pred for r in langid.identify(frame(spark, rows)).collect()} == {"und"}
    rows = [(i, speech("aa", i), "aa", None, 1) for i in range(20)]
    assert {(r.lang_pred, r.score) for r in langid.identify(frame(spark, rows)).collect()} == {("aa", 1.0)}
    assert langid.identify(frame(spark, [])).collect() == []


# ---------------------------------------------------------------- licences


def test_licences(spark):
    filler = prose(4, 400)
    mit = license.TEMPLATES[3][1].replace(", ", ",\n * ")
    files = [
        ("r/a/x.c", "// Licensed under the Apache License, Version 2.0.\n" + filler),
        ("r/a/y.c", filler + "\n### Released under&&& the MIT License***"),
        ("r/a/z.c", filler), ("r/a/b/c/w.c", filler), ("r/LICENSE", filler + "\n" + mit + "\n" + filler),
        ("r/a/b/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
        ("r/top.c", filler), ("s/none.c", filler), ("alone", filler), ("r/LICENSES", filler), ("r/n.c", None),
        (None, "Released under the MIT License."), (None, filler), ("r/e.c", ""), ("r//d/f.c", filler),
        ("q/gpl.txt", "This work is licensed under the GNU General Public License, version 3."), ("q/f.c", filler),
        ("t/LICENSE", "Licensed under CC BY-NC 4.0."), ("t/NOTICE", "Licensed under CC BY 4.0."), ("t/x", filler),
        ("r/a/z.c", filler),
    ]
    df = spark.createDataFrame(files, "path string, text string").withColumn("uid", F.lit(1)).withColumn("dir", F.lit("q"))
    found = defaultdict(list)
    for r in license.scan_files(df).collect():
        found[r.path].append((r.licence, r.origin, r.from_dir))
    assert len(sum(found.values(), [])) == len(files)
    assert found["r/a/x.c"] == [("Apache-2.0", "header", None)]
    assert found["r/a/y.c"] == [("MIT", "header", None)]
    assert found["r/a/z.c"] == [("MIT", "inherited", "r")] * 2
    assert found["r/LICENSE"] == [("MIT", "file", None)]
    assert found["r/a/b/c/w.c"] == [("GPL-3.0", "inherited", "r/a/b")]
    assert found["r/top.c"] == found["r/n.c"] == found["r/e.c"] == found["r//d/f.c"] == [("MIT", "inherited", "r")]
    assert found["s/none.c"] == found["alone"] == [(None, None, None)]
    assert sorted(found[None], key=repr) == sorted([("MIT", "header", None), (None, None, None)], key=repr) or ("MIT", "file", None) in found[None]
    assert found["q/gpl.txt"] == [("GPL-3.0", "file", None)] and found["q/f.c"] == [("GPL-3.0", "inherited", "q")]
    assert found["t/x"] == [("CC-BY-4.0", "inherited", "t")]
    assert license.scan_files(df.limit(0)).collect() == []


def test_a_run_goes_on_over_blank_and_weak_lines(spark):
    own = [("Own", "amber birch cedar dahlia elm fir gorse hazel iris juniper kale larch")]
    text = "amber birch cedar dahlia\n\n//\nelm fir gorse hazel\nof\niris juniper kale larch\n" + prose(3, 50)
    rows = spark.createDataFrame([(1, text)], "uid long, text string")
    (got,) = license.scan_texts(rows, own).collect()
    assert [(f.licence, f.first_line, f.last_line) for f in got.found] == [("Own", 0, 5)]


def commented(text: str, width: int = 70) -> str:
    """A block comment of paragraphs with blank lines between them."""
    parts = [textwrap.fill(part, width) for part in text.split("\n\n")]
    return "/*\n" + "\n".join(" * " + line for line in "\n\n".join(parts).split("\n")) + "\n */\n"


def test_standard_headers_and_full_texts(spark):
    gnu = (
        "This {0} is free software{3} you can redistribute it and/or modify it under the terms of the GNU {1}General Public "
        "License as published by the Free Software Foundation{4} either version {2} of the License, or (at your option) any "
        "later version.\n\nThis {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1}General Public License "
        "for more details.\n\nYou should have received a copy of the GNU {1}General Public License along with this {0}{5}"
    )
    old, new = "; if not, write to the Free Software Foundation.", ". If not, see <https://www.gnu.org/licenses/>."
    apache = license.TEMPLATES[1][1] + "\n\nUnless required by applicable law or agreed to in writing, software"
    headers = {
        "GPL-2.0": gnu.format("program", "", "2", ";", ";", old),
        "GPL-3.0": gnu.format("program", "", "3", ":", ",", new),
        "LGPL-2.1": gnu.format("library", "Lesser ", "2.1", ";", ";", old),
        "LGPL-3.0": gnu.format("library", "Lesser ", "3", ":", ",", new),
        "AGPL-3.0": gnu.format("program", "Affero ", "3", ":", ",", new),
        "Apache-2.0": apache,
    }
    files = [(f"{n}/a.c", commented("Copyright (C) 2020 A. Writer\n\n" + t) + prose(5, 300)) for n, t in headers.items()]
    full = {n: t for n, t in license.TEMPLATES if n in license.FULL_TEXTS}  # the last of a name is its full text
    files += [(f"{n}/LICENSE", t) for n, t in full.items()]
    files += [(f"{n}/b.c", commented("Copyright (c) 2020, A. Writer\n\n" + full[n])) for n in ("BSD-2-Clause", "BSD-3-Clause", "MIT", "ISC")]
    found = license.scan_files(spark.createDataFrame(files, "path string, text string")).collect()
    assert len(found) == len(files)
    assert not [(r.path, r.licence, r.similarity) for r in found if r.licence != r.path.split("/")[0]]
    assert all(r.origin == "file" for r in found if r.path.endswith("LICENSE"))


def test_no_line_is_passed_over_that_reaches_the_threshold():
    known = license.Templates(license.TEMPLATES)
    draw = random.Random(0)
    weights = license.idf(1000, np.array([draw.choice([0, 3, 50, 900]) for _ in known.words], float))
    weighted = known.counts * weights
    strong = license.strong_terms(weighted, 0.7)
    unit = weighted / np.linalg.norm(weighted, axis=1, keepdims=True)
    for _ in range(3000):
        text = np.array([draw.random() < 0.1 and not strong[t] for t in range(len(weights))]) * weights
        assert (unit @ text <= 0.7 * max(np.linalg.norm(text), 1e-9)).all()


# ---------------------------------------------------------------- neighbours

VECTOR = "vec_id long, embedding array<float>"


def brute_nearest(rows, k=5, every=50):
    good = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for a, (q, v) in enumerate(good):
        if q is None or q % every:
            continue
        x = np.array(v, np.float32).astype(float)
        scored = []
        for b, (i, w) in enumerate(good):
            if a != b and len(v) == len(w):
                y = np.array(w, np.float32).astype(float)
                scored.append((-(x @ y) / math.sqrt(x @ x) / math.sqrt(y @ y), i if i is not None else 1 << 60))
        out.setdefault(q, []).append(sorted((round(s, 9), i) for s, i in scored)[:k])
    return out


def test_nearest(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=16).astype(np.float32).tolist()) for i in range(600)]
    hot = rows[0][1]
    rows += [(1000 + i, hot) for i in range(120)] + [(2000 + i, [2 * x for x in hot]) for i in range(20)]
    rows += [(3000, None), (3050, []), (3100, [0.0] * 16), (3150, [None] * 16), (3200, [float("nan")] * 16), (3250, [float("inf")] * 16)]
    rows += [(4000, [1.0, 2.0, 3.0]), (4050, [1.0, 2.0, 3.5]), (4100, [1.0] * 7), (None, hot), (50, draw.normal(size=16).tolist())]
    df = spark.createDataFrame(rows, VECTOR).withColumn("who", F.lit(1)).withColumn("bucket", F.lit(2))
    got = defaultdict(list)
    for r in ann.nearest(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((round(-r.score, 9), r.vec_id if r.vec_id is not None else 1 << 60))
    expected = brute_nearest(rows)
    hits = total = 0
    for q, lists in expected.items():
        want = Counter(x for part in lists for x in part)
        hits += sum((want & Counter(got[q])).values())
        total += sum(want.values())
        assert len(got[q]) == sum(map(len, lists))
    assert hits / total >= 0.9
    assert got[4000] == expected[4000][0] and not got[4100] and not set(got) & {3000, 3050, 3100, 3150, 3200, 3250}
    assert [i for _, i in got[1000]] == [0, 1001, 1002, 1003, 1004]
    assert ann.nearest(df.limit(0)).collect() == []


def test_a_vector_moves_once_whatever_its_buckets(spark, monkeypatch):
    """Before, a vector went to ten buckets and a query to 400."""
    draw, moved = np.random.default_rng(3), []
    df = spark.createDataFrame([(i, draw.normal(size=16).astype(np.float32).tolist()) for i in range(2000)], VECTOR)
    kind = type(df)

    def counted(self, *to, deal=kind.repartition):
        moved.append(self.count())
        return deal(self, *to)

    monkeypatch.setattr(kind, "repartition", counted)
    assert ann.nearest(df, every=100).count() == 100
    assert moved and max(moved) <= 2000 + 20 * 2 * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("probes", [3, None])
def test_an_index_visits_what_lies_in_the_probed_buckets(probes):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(300, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = ann._Index(x, np.arange(300), 2, 3, 0.5, probes)
    met = index.visited(x[:20])
    want = np.ones((20, 300), bool)
    if probes:
        want[:] = False
        for table in range(2):
            homes = np.floor(ann.places(x, table, 3, 0.5))
            steps = ann.probe_steps(ann.places(x[:20], table, 3, 0.5), probes)
            want |= (steps[:, :, None] == homes).all(axis=3).any(axis=1)
    assert (met == want).all() and met[np.arange(20), np.arange(20)].all()
    scores = np.where(want, x[:20] @ x.T, -2)
    a, b, score = index.best(x[:20], 4)
    for q in range(20):
        best = [n for n in np.argsort(-scores[q], kind="stable")[:4].tolist() if scores[q, n] > -2]
        assert set(best) == set(b[a == q].tolist()) and np.allclose(score[a == q], scores[q, b[a == q]])


def test_probes_are_in_order_of_success():
    at = np.array([[0.1, 0.45, 0.8]])
    steps = ann.probe_steps(at, 27)[0]
    inside = at[0] - np.floor(at[0])
    cost = [sum(inside[k] ** 2 if d == -1 else (1 - inside[k]) ** 2 if d == 1 else 0 for k, d in enumerate(s)) for s in steps]
    assert steps[0].tolist() == [0, 0, 0] and cost == sorted(cost) and len({tuple(s) for s in steps}) == 27
