"""Exact, near-duplicate and passage deduplication against brute force."""

import hashlib
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import exact, graph, minhash, sketch, substring
from millrace.llm import words as W
from millrace.llm.common import CLEANUP, numbered, settle, without
from millrace.llm.graph import components
from millrace.session import shared_dir
from llm_cases import awkward, brute_components, changed, frame, prose, shingle_set, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("clash", [False, True])
def test_exact_duplicates(spark, clash):
    rows = awkward()
    got = exact.exact_duplicates(frame(spark, rows, clash)).drop("uid").collect()
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[(text or "").translate(LOWER)].append(doc)
    expected = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            expected[(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_chunks_are_cut_by_content():
    draw = np.random.default_rng(0)
    text = draw.integers(97, 123, 300_000).astype(np.uint8)
    moved = np.concatenate([draw.integers(97, 123, 777).astype(np.uint8), text])

    def chunks(data):
        ends = exact.chunk_ends(len(data), exact.boundaries(data).tolist())
        assert ends[-1] == len(data) and all(b - a <= exact.MAX_CHUNK for a, b in zip([0, *ends], ends))
        return [data[a:b].tobytes() for a, b in zip([0, *ends], ends)]

    assert len(set(chunks(text)) & set(chunks(moved))) > 0.9 * len(chunks(text))
    assert exact.chunk_ends(0, []) == [0]
    assert exact.chunk_ends(3 * exact.MAX_CHUNK, [])[-1] == 3 * exact.MAX_CHUNK


def test_clashing_fingerprints_are_told_apart(spark):
    made = spark.createDataFrame(
        [(1, 1, "x", [5], [b"a"]), (2, 2, "y", [5], [b"b"]), (3, 3, "x", [5], [b"a"]), (4, 4, "z", [6], [b"c"])],
        exact.RECIPE,
    )
    found = {r.uid: (r.chunks, r.variants) for r in exact.verified(made).collect()}
    assert found[1] == found[3] != found[2]
    assert found[4][1] == []


@pytest.mark.parametrize("clash", [False, True])
def test_near_duplicates(spark, clash):
    rows = awkward()
    got = minhash.near_duplicates(frame(spark, rows, clash)).orderBy("uid").collect()
    assert len(got) == len(rows)
    expected = Counter(
        (r[0], len(shingle_set(r[1])), c, r[0] == c) for r, c in zip(rows, brute_components(rows))
    )
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == expected


def test_links_that_no_hub_shows(spark):
    """A chain and a crowd around the threshold: members that are only linked to each other."""
    rows, text = [], prose(9, 200)
    for i in range(60):
        rows.append((i, text, None, None, None))
        text = changed(text, i, 0.02)
    base = prose(10, 150)
    crowd = [(1000 + i, changed(base, 50 + i, 0.035), None, None, None) for i in range(80)]
    rows += crowd + [(2000 + r[0], changed(r[1], r[0], 0.01), None, None, None) for r in crowd[:30]]
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    expected = {r[0]: c for r, c in zip(rows, brute_components(rows))}
    assert {r.doc_id: r.component_id for r in got} == expected
    assert sum(r.chosen for r in got) == len(set(expected.values()))


def test_open_buckets_are_found_once(spark, monkeypatch):
    """What is still open in a bucket is written before several steps read it."""
    plans = []

    def noted(df, label):
        plans.append((label, df._jdf.queryExecution().optimizedPlan().toString()))
        return settle(df, label)

    monkeypatch.setattr(minhash, "settle", noted)
    base = prose(10, 150)
    rows = [(i, changed(base, 50 + i, 0.035), None, None, None) for i in range(40)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == {r[0]: c for r, c in zip(rows, brute_components(rows))}
    joins = [(label, len(re.findall(r"LeftSemi, \(key#", plan))) for label, plan in plans]
    assert [label for label, n in joins if n] == ["open"] * 3
    assert all(n <= 1 for _, n in joins)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7), (300, 301), (301, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 150: 100, 200: 100, 300: 300, 301: 300}


def test_sketch_estimates_similarity():
    draw = np.random.default_rng(1)
    common = draw.integers(0, 2**63, 600, dtype=np.uint64)
    a = np.unique(np.concatenate([common, draw.integers(0, 2**63, 200, dtype=np.uint64)]))
    b = np.unique(np.concatenate([common, draw.integers(0, 2**63, 200, dtype=np.uint64)]))
    one = np.array([5], np.uint64)
    made = sketch.sketch(np.concatenate([a, b, one, one[:0]]), np.cumsum([0, len(a), len(b), 1, 0]), 1024)
    assert (made[:3] != sketch.EMPTY).all() and (made[3] == sketch.EMPTY).all()
    assert abs((made[0] == made[1]).mean() - 0.6) < 0.06


def test_words_match_their_definition():
    import pyarrow as pa

    texts = ["a b", None, "", "ab", " x\ty\x0bz\r\n", "É é", "A B C D E F a b c d e", "ab c", "a bc", "word" * 70_000]
    for i, j, found, at in W.shingles(pa.array(texts), 2):
        for k in range(i, j):
            part = found[at[k - i] : at[k - i + 1]]
            assert len(set(part.tolist())) == len(shingle_set(texts[k], 2))
    sets = {}
    for i, j, found, at in W.shingles(pa.array(texts), 2):
        for k in range(i, j):
            sets[k] = frozenset(found[at[k - i] : at[k - i + 1]].tolist())
    assert sets[7] != sets[8]


def brute_repeats(rows, least=50):
    """Per row number the words that lie in an equal run of ``least`` words of an earlier row."""
    seen, need = {}, defaultdict(set)
    for k, r in enumerate(rows):
        w = words(r[1])
        for i in range(len(w) - least + 1):
            first = seen.setdefault(tuple(w[i : i + least]), k)
            if first != k:
                need[k].update(range(i, i + least))
    return need


@pytest.mark.parametrize("clash", [False, True])
def test_repeated_passages(spark, clash):
    rows = [r for r in awkward() if r[0] not in (6, 7, 12)]
    rows.append((900, prose(900, 30) + " " + changed(prose(901, 200), 5, 0.01), None, None, None))
    rows.append((901, prose(901, 200), None, None, None))
    rows.append((902, prose(902, 40) + " " + " ".join(prose(903, 60).split() * 2), None, None, None))
    df = frame(spark, rows, clash).coalesce(1)
    got = substring.repeated_passages(df).collect()
    covered = defaultdict(set)
    for r in got:
        assert r.end_word - r.start_word >= 50 and r.match_end - r.match_start >= 50 and r.uid > r.match_uid
        mine = shingle_set(b" ".join(words(rows[r.uid][1])[r.start_word : r.end_word]).decode())
        theirs = shingle_set(b" ".join(words(rows[r.match_uid][1])[r.match_start : r.match_end]).decode())
        assert len(mine & theirs) / len(mine | theirs) == pytest.approx(r.similarity) and r.similarity >= 0.75
        covered[r.uid].update(range(r.start_word, r.end_word))
    for k, need in brute_repeats(rows).items():
        assert need <= covered[k]
    assert any(rows[r.uid][0] == 901 and rows[r.match_uid][0] == 900 for r in got)
    assert not [r for r in got if rows[r.uid][0] == 902]

    cut = substring.cut_passages(df, substring.repeated_passages(df))
    assert cut.columns == df.columns and cut.count() == len(rows)
    left = [(r.doc_id, r.text) for r in cut.collect()]
    assert not brute_repeats(left)
    assert sum(t is None for _, t in left) == sum(r[1] is None for r in rows)


@pytest.mark.parametrize("longer_first", [False, True])
@pytest.mark.parametrize("between", [2, 40])
def test_a_passage_is_found_beside_a_longer_variant(longer_first, between):
    """The earlier text has the passage, and a wider variant of it that is not similar enough."""
    passage, other = np.arange(46), np.arange(1000, 2000)
    variant = np.concatenate([passage[:14], other[:9], passage[18:28], other[9:18], passage[32:]])
    parts = [variant, other[100 : 100 + between], passage]
    b = np.concatenate(parts if longer_first else parts[::-1])
    a = np.concatenate([other[500:530], passage, other[600:630]])
    got = substring.passages(a, b, np.ones(len(a), bool), np.ones(len(b), bool), 46, 75)
    (start, end, there, stop, alike), = got
    assert (start, end) == (30, 76) and alike == 1.0
    assert b[there:stop].tolist() == passage.tolist()


@pytest.mark.parametrize("few", [substring.FEW, 2])
def test_passages_that_no_first_document_has(spark, monkeypatch, few):
    """Variants below the threshold are read before equal passages, and are first in their groups."""
    monkeypatch.setattr(substring.hidden_pairs, "__defaults__", (few, 400))
    rows = []
    for f in range(30):
        base = prose(7000 + f, 60).split()
        for v in range(10):  # six of the ten tenths, others in every variant
            draw = np.random.default_rng(100 * f + v)
            held = set(draw.permutation(10)[:7].tolist())
            text = [w if i // 6 in held else f"y{f}_{v}_{i}" for i, w in enumerate(base)]
            rows.append((len(rows), prose(8000 + 100 * f + v, 80) + " " + " ".join(text), None, None, None))
        for v in range(3):
            rows.append((len(rows), prose(20_000 + 10 * f + v, 80) + " " + " ".join(base), None, None, None))
    df = frame(spark, rows).coalesce(1)
    covered = defaultdict(set)
    for r in substring.repeated_passages(df).collect():
        covered[r.uid].update(range(r.start_word, r.end_word))
    need = brute_repeats(rows)
    assert len(need) == 60
    assert all(words <= covered[k] for k, words in need.items())


def test_nobody_is_a_guest_of_those_before(spark, monkeypatch):
    """Who asks sits with ``few`` others in reading order, and only earlier documents come."""
    monkeypatch.setattr(substring.hidden_pairs, "__defaults__", (4, 400))
    seats = []

    def noted(df, label):
        made = settle(df, label)
        if label == "seats":
            seats.extend(made.select("table", "uid", "asks").collect())
        return made

    monkeypatch.setattr(substring, "settle", noted)
    base = prose(600, 60).split()
    rows = []
    for v in range(60):
        held = set(np.random.default_rng(v).permutation(10)[:7].tolist())
        text = [w if i // 6 in held else f"y{v}_{i}" for i, w in enumerate(base)]
        rows.append((v, prose(700 + v, 60) + " " + " ".join(text), None, None, None))
    rows += [(60 + v, prose(800 + v, 60) + " " + " ".join(base), None, None, None) for v in range(40)]
    covered = defaultdict(set)
    for r in substring.repeated_passages(frame(spark, rows).repartition(3, "doc_id")).collect():
        covered[r.doc_id].update(range(r.start_word, r.end_word))
    assert sum(set(range(60, 120)) <= covered[60 + v] for v in range(40)) >= 39
    tables = defaultdict(list)
    for r in seats:
        tables[r.table].append(r)
    asking = [[r.uid for r in t if r.asks] for t in tables.values()]
    assert len(asking) > 4 and max(map(len, asking)) <= 4
    assert all(r.uid <= max(x.uid for x in t if x.asks) for t in tables.values() for r in t)


def test_texts_move_in_rounds_and_nothing_stays_that_is_not_read(spark, monkeypatch):
    """Rounds bound what is on disk at once; the words found are the same, and only passages are left."""
    monkeypatch.setattr(substring.hidden_pairs, "__defaults__", (4, 400))
    labels = []

    def noted(df, label):
        labels.append(label)
        return settle(df, label)

    monkeypatch.setattr(substring, "settle", noted)
    base = prose(900, 60).split()
    rows = []
    for v in range(60):
        held = set(np.random.default_rng(v).permutation(10)[:7].tolist())
        text = [w if i // 6 in held else f"y{v}_{i}" for i, w in enumerate(base)]
        rows.append((v, prose(1000 + v, 60) + " " + " ".join(text), None, None, None))
    rows += [(60 + v, prose(1100 + v, 60) + " " + " ".join(base), None, None, None) for v in range(40)]
    docs = frame(spark, rows).coalesce(1)
    top, covered = shared_dir(spark), {}
    for most in (substring.ROUND_BYTES, 1 << 10):
        monkeypatch.setattr(substring, "ROUND_BYTES", most)
        before, words = set(os.listdir(top)), defaultdict(set)
        labels.clear()
        for r in substring.repeated_passages(docs).collect():
            words[r.doc_id].update(range(r.start_word, r.end_word))
        covered[most] = words
        assert {x.rsplit("-", 1)[0] for x in set(os.listdir(top)) - before} == {"passages"}
    assert covered[1 << 10] == covered[256 << 20] != {}
    assert labels.count("opened") == substring.ZONE_ROUNDS and labels.count("passages") > 2
    assert substring._rounds(0, 0) == 1 and substring._rounds(5 << 30, 1 << 30) == 5


def test_a_copy_of_a_copy_is_linked_with_the_copy(spark):
    """The second text repeats the first and the third the second, which is too far from the first."""
    rows = []
    for f in range(20):
        base = prose(30_000 + f, 100).split()
        for v, places in enumerate([(), (32, 75), (12, 32, 55, 75)]):
            text = [f"z{f}_{i}" if i in places else w for i, w in enumerate(base)]
            rows.append((len(rows), prose(40_000 + 10 * f + v, 80) + " " + " ".join(text), None, None, None))
    got = {(r.uid, r.match_uid) for r in substring.repeated_passages(frame(spark, rows).coalesce(1)).collect()}
    assert got == {pair for k in range(0, len(rows), 3) for pair in ((k + 1, k), (k + 2, k + 1))}


def test_zones_hold_every_stretch_with_enough_marks():
    draw = np.random.default_rng(11)
    for trial in range(40):
        at = np.cumsum([0, *draw.integers(0, 60, 4)])
        marked, free = draw.random(at[-1]) < 0.7, draw.random(at[-1]) < 0.1
        need = np.zeros(at[-1], bool)
        for low, high in zip(at, at[1:]):
            for i in range(low, high - 9):
                for j in range(i + 10, high + 1):
                    need[i:j] |= 100 * marked[i:j].sum() >= 75 * (marked[i:j] | ~free[i:j]).sum()
        zone = substring._zones(marked, free, at, 10, 75)
        assert not (need & ~zone).any()
        if trial % 2:
            assert not substring._zones(np.zeros_like(marked), np.zeros_like(free), at, 10, 75).any()


def test_compact_windows_are_the_trees_intervals():
    draw = np.random.default_rng(3)
    hashes = draw.integers(0, 2**63, 500, dtype=np.uint64)
    at = np.array([0, 0, 130, 140, 500])
    got = set(zip(*(x.tolist() for x in substring.compact_windows(hashes, at, 12))))
    expected = set()

    def split(low, high):
        if high - low >= 12:
            c = low + int(np.argmin(hashes[low:high]))
            expected.add((low, c, high))
            split(low, c)
            split(c + 1, high)

    for low, high in zip(at, at[1:]):
        split(int(low), int(high))
    assert got == expected


def test_row_numbers_stay_when_executors_come_or_go(spark, tmp_path):
    """Cores registered at planning give Spark its default number of splits."""
    path, cores = str(tmp_path / "docs"), "spark.sql.leafNodeDefaultParallelism"
    rows = [(i, prose(i, 400), None, None, None) for i in range(6000)]
    frame(spark, rows).coalesce(1).write.option("parquet.block.size", 1 << 20).parquet(path)
    session = spark.newSession()
    numbers, dropped = [], None
    for n in (16, 2):
        session.conf.set(cores, n)
        docs = numbered(session.read.parquet(path), "doc_id", "text")
        numbers.append({r.doc_id: r.uid for r in docs.select("doc_id", "uid").collect()})
        if dropped is None:
            dropped = session.createDataFrame([(u,) for d, u in numbers[0].items() if d % 3 == 0], "uid long")
    assert numbers[0] == numbers[1]
    left = without(session.read.parquet(path), dropped)
    assert {r.doc_id for r in left.select("doc_id").collect()} == {i for i in range(6000) if i % 3}


def test_empty_tables(spark):
    none = frame(spark, [])
    assert exact.exact_duplicates(none).collect() == []
    assert minhash.near_duplicates(none).collect() == []
    assert substring.repeated_passages(none).collect() == []


@pytest.mark.parametrize("length, changes", [(50, 0), (50, 1), (55, 1), (60, 2), (100, 3), (200, 6)])
def test_similar_passages_are_aligned_whatever_is_changed(length, changes):
    """Passages of similarity 0.75 and more among other words; changes at their edges are no exception."""
    draw = np.random.default_rng(length + changes)
    size, least = 5, 46
    for trial in range(60):
        passage = draw.integers(1 << 40, 1 << 50, length)
        other = passage.copy()
        where = draw.choice(length, changes, replace=False)
        if changes and trial % 2:
            where[0] = draw.choice([0, 1, 2, length - 1, length - 2, length - 3])
        other[where] = draw.integers(1 << 51, 1 << 52, changes)
        texts = []
        for middle in (passage, other):
            whole = np.concatenate([draw.integers(0, 1 << 39, 60), middle, draw.integers(0, 1 << 39, 60)])
            grams = [tuple(whole[i : i + size]) for i in range(len(whole) - size + 1)]
            texts.append(np.array([hash(g) & ((1 << 62) - 1) for g in grams], np.uint64))
        a, b = texts
        sets = [set(t[60 : 60 + length - size + 1].tolist()) for t in texts]
        both = len(sets[0] & sets[1])
        if 100 * both < 75 * len(sets[0] | sets[1]):
            continue
        found = substring.passages(a, b, np.ones(len(a), bool), np.ones(len(b), bool), least, 75)
        assert found, (trial, where)
        for s, e, t, u, alike in found:
            x, y = set(a[s:e].tolist()), set(b[t:u].tolist())
            assert e - s >= least and u - t >= least and alike == len(x & y) / len(x | y) >= 0.75


def test_parts_without_windows_cost_no_row():
    used, edges = substring._used_parts(np.array([3, 3, 900, 2999]))
    assert used == [3, 900, 2999] and edges.tolist() == [0, 2, 3, 4]
    rows = [pa.array([1, 2], pa.int64()), pa.array([prose(1, 80), prose(2, 60) + " " + prose(1, 80)])]
    batch = pa.RecordBatch.from_arrays(rows, names=["uid", "text"])
    made = [r for b in substring._signer(5, 50, 8, 3000)(iter([batch])) for r in b.to_pylist()]
    assert 0 < len(made) < 60 and all(r["sig"] for r in made)
    assert len(made[0]["later"]) > 0 and all(not r["later"] for r in made[1:])
    blank = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array(["a b"])], names=["uid", "text"])
    assert sum(b.num_rows for b in substring._signer(5, 50, 8, 3000)(iter([blank]))) == 0


def test_a_window_is_one_member_of_its_group(spark):
    """A text that repeats a word has a window of the same signature at nearly every place."""
    sig, uid = np.array([5] * 9 + [7] * 2, np.uint64), np.array([1] * 4 + [2] * 5 + [1, 1])
    bit, high = np.array([1] * 9 + [0, 0], np.uint8), np.array([0, 0, 0, 0, 0, 1, 1, 0, 1, 30, 60], np.int32)
    low = np.array([0] * 9 + [10, 40], np.int32)
    batch = substring._packed(np.zeros(11, np.int64), [sig, uid, bit, low, high], substring.OPENED)
    got = [tuple(r.values()) for b in substring._members(iter([batch])) for r in b.to_pylist()]
    assert sorted(got) == [(5, 1, 1, 0, 0), (5, 2, 1, 0, 1), (7, 1, 0, 10, 30), (7, 1, 0, 40, 60)]


def test_only_passages_with_a_needed_place_are_looked_for():
    draw = np.random.default_rng(5)
    hits = 0
    for trial in range(60):
        a = draw.integers(0, 10**6, 400)
        b = a.copy()
        changed_at = draw.choice(400, 70, replace=False)
        b[changed_at] = draw.integers(10**6, 2 * 10**6, 70)
        needed = np.zeros(400, bool)
        needed[draw.choice(400, 12, replace=False)] = True
        every = np.ones(400, bool)
        whole = substring.passages(a, b, every, every, 46, 75)
        _, number = np.unique(np.concatenate([a, b]), return_inverse=True)
        got = substring._alike(number[:400], number[400:], None, None, 46, 75, needed)
        assert got == [x for x in whole if needed[x[0] : x[1]].any()]
        hits += len(whole) > len(got) > 0
    assert hits > 3


def test_shuffled_data_goes_with_the_step_that_needed_it(spark):
    """Before, shuffle files stayed until the driver collected its garbage."""
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    rows = spark.range(5000).groupBy((F.col("id") % 97).alias("k")).agg(F.sum("id").alias("n"))
    rows.count()
    kept = held.size()
    assert settle(rows, "sums").count() == 97
    assert held.size() <= kept and spark.conf.get(CLEANUP, "false") == "false"


def test_copies_that_ask_cost_no_row_for_every_pair():
    """Twelve near copies in one meeting: each names a passage as long as it has words in no other."""
    base = prose(50_000, 120).split()
    texts = [" ".join(f"k{v}" if i == 5 + v else w for i, w in enumerate(base)) for v in range(12)]
    windows = [[{"sig": j, "bit": 1 << j, "open": True} for j in range(3)]] * 12
    table = pa.table({
        "uid": pa.array(range(12), pa.int64()), "id": pa.array(range(12), pa.int64()), "text": texts, "asks": [True] * 12, "guest": [True] * 12,
        "windows": windows, "runs": [[{"low": 0, "high": 116}]] * 12, "tried": pa.array([None] * 12, pa.list_(pa.int64())),
    })
    got = substring._meeting(5, 50, 75, 3)(table).to_pylist()
    assert {r["later"] for r in got} == set(range(1, 12)) and len(got) < 30
    assert all(min(r["start_word"] for r in got if r["later"] == k) == 0 for k in range(1, 12))
    assert all(max(r["end_word"] for r in got if r["later"] == k) == 120 for k in range(1, 12))


def test_a_round_of_components_shuffles_little(spark, monkeypatch):
    """Links are written without a shuffle, and the shuffles of a round are few: each costs all its partitions' tasks."""
    shuffles = []

    def counted(df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles.append(plan.count("Exchange hashpartitioning"))
        return settle(df, label)

    monkeypatch.setattr(graph, "settle", counted)
    links = [(1, 2), (2, 1), (2, 3), (3, 4), (9, 8), (8, 7), (7, 7), (7, 9), (2, 3)]
    got = sorted(tuple(r) for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == [(1, 1), (2, 1), (3, 1), (4, 1), (7, 7), (8, 7), (9, 7)]
    assert shuffles[0] == 0 and max(shuffles) <= 6
