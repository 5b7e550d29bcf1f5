"""Spelling variants, phrases and SimHash against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from llm_cases import awkward, changed, frame, prose, words

from millrace.llm import phrases, simhash, slices, variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(params=[1 << 20, 300])
def run_bytes(request, monkeypatch):
    """With 300, most texts come in several slices."""
    monkeypatch.setattr(slices, "RUN_BYTES", request.param)
    monkeypatch.setattr(phrases, "RUN", request.param)
    return request.param


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) == len(b):
        return i < len(a) and a[i + 1 :] == b[i + 1 :]
    return len(b) == len(a) + 1 and a[i:] == b[i + 1 :]


def brute_variants(rows, every=31):
    n = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    vocabulary = [w for w, k in n.items() if len(w) >= 7 and k >= 2]
    out = {}
    for w in vocabulary:
        around = sorted((-n[v], v) for v in vocabulary if abs(len(v) - len(w)) < 2 and near(v, w))
        form = around[0][1] if around and -around[0][0] >= 10 * n[w] else None
        out[w] = [form, None, n[w], len(around), n[form] if form else None]
    for w in vocabulary:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def letters(seed: int, n: int, size: int = 7, alphabet: str = "abé") -> list[str]:
    draw = np.random.default_rng(seed)
    return ["".join(draw.choice(list(alphabet), draw.integers(size, size + 3))) for _ in range(n)]


def variant_rows():
    rows = awkward()
    rows += [(300 + i, " ".join(letters(i, 60)), "en", "s", 1) for i in range(30)]
    long = "".join(letters(99, 12, 7, "xyz"))
    texts = [long, long + "q", long[:40] + "Q" + long[41:], long[1:], long[:64], long[:65], long[:63], "Straße wörterbuch WÖRTERBUCH wörterbüch"]
    rows += [(400, " ".join(texts * 2), "de", "s", 1), (401, "commonly-used " * 600 + "commonlx commonlx comonly comonly omonly", "en", "s", 1)]
    rows += [(None, "commonly uncommonly uncommonly", None, None, None)] * 2
    return rows


@pytest.mark.parametrize("group, long", [(8192, 64), (3, 64), (8192, 8), (2, 9)])
def test_spelling_variants(spark, group, long):
    rows = variant_rows()
    got = variants.spelling_variants(frame(spark, rows, clash=True), group=group, long=long).collect()
    assert len({r.word for r in got}) == len(got)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute_variants(rows)


def test_words_in_slices(spark, run_bytes):
    rows = [r for r in variant_rows() if run_bytes > 1000 or r[0] not in (6, 7)]
    got = variants.vocabulary(frame(spark, rows), every=5).collect()
    assert {r.word: r.n for r in got} == {w: v[2] for w, v in brute_variants(rows, every=5).items()}


def test_acceptor_is_minimal_and_pairs_are_found_once():
    found = sorted(set(letters(5, 400, 3, "ab") + letters(6, 300, 4, "abc")))
    by = defaultdict(list)
    for w in found:
        by[w[:2]].append(w)
    for start, group in by.items():
        got = list(variants.pairs(group, 2))
        assert len(got) == len(set(map(frozenset, got)))
        assert set(map(frozenset, got)) == {frozenset((a, b)) for a in group for b in group if a < b and near(a, b)}
        made = variants.Acceptor(group, 2)
        tails = [{w[k:] for w in group if w.startswith(p)} for p, k in {(w[:k], k) for w in group for k in range(2, len(w) + 1)}]
        assert len(made.arcs) == len(set(map(frozenset, tails)))


def test_no_words(spark):
    assert variants.spelling_variants(frame(spark, [])).collect() == []
    assert variants.spelling_variants(frame(spark, [(1, "one two", None, None, None), (2, None, None, None, None)])).collect() == []


def brute_phrases(rows, least, first, longest=5):
    n, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    found = {k: v for k, v in f.items() if v >= least and len(k[1]) > 1}
    out = defaultdict(list)
    for (lang, w), a in found.items():
        inside = lambda v: any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
        if any(g == lang and len(v) > len(w) and b >= a and inside(v) for (g, v), b in found.items()):
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), a, l, r, n[lang], score))
    return {(lang, i + 1): (x[2].decode(), *x[3:]) for lang, some in out.items() for i, x in enumerate(sorted(some)[:first])}


@pytest.mark.parametrize("bits", [27, 10, 16])
def test_phrases(spark, run_bytes, bits):
    rows = [r for r in awkward() if run_bytes > 1000 or r[0] not in (6, 7, 12)]
    rows += [(700 + i, f"of the same KIND, of the same kind; New York. a a a a a {i}\tof the new york", "en", None, None) for i in range(9)]
    rows += [(720, "é à é à é à: x\x0by z x\x0by z " * 5, None, None, None)]
    for least in (4, 9) if bits == 10 else (5,):
        got = phrases.collocations(frame(spark, rows, clash=True), least=least, first=50, filter_bits=bits).collect()
        told = {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got}
        assert len(told) == len(got) and told == brute_phrases(rows, least, 50)


def test_no_phrases(spark):
    assert phrases.collocations(frame(spark, [])).collect() == []
    assert phrases.collocations(frame(spark, [(1, None, None, None, None), (2, "a b", "", None, None)])).collect() == []


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 1 << 55
    rows = [("en", None, 0, 3 * big, None), ("en", "a", 1, big, 1), ("en", "b", 1, big - 1, 1), ("en", "a b", 2, big - 7, 1)]
    known = spark.createDataFrame(rows, "lang string, phrase string, size int, f long, uid long")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *a, **k: known)
    (got,) = phrases.collocations(frame(spark, [])).collect()
    assert got.score == 1000 * (big - 7) * 3 * big // (big * (big - 1))


def brute_prints(rows):
    out = []
    for _, text, *_ in rows:
        w = words(text)
        each = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in each]
        out.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    return out


def brute_links(prints):
    """Of all different fingerprints, which are connected by steps of two bits at most."""
    kinds = sorted(set(prints))
    root = {k: k for k in kinds}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in kinds:
        for b in kinds:
            if a < b and (a ^ b).bit_count() <= 2:
                root[find(b)] = find(a)
    return {k: find(k) for k in kinds}


def test_fingerprints_and_components(spark, run_bytes):
    rows = [r for r in awkward() if run_bytes > 1000 or r[0] not in (6, 7)]
    rows += [(800 + i, changed(prose(4, 400), i, 0.003 * (i % 5)), "en", "s", 1) for i in range(60)]
    prints = brute_prints(rows)
    roots, least = brute_links(prints), {}
    for (doc, *_), p in zip(rows, prints):
        some = [x for x in (least.get(roots[p]), doc) if x is not None]
        least[roots[p]] = min(some) if some else None
    expected = Counter((doc, f"{p:016x}", least[roots[p]]) for (doc, *_), p in zip(rows, prints))
    got = simhash.near_fingerprints(frame(spark, rows, clash=True)).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == expected
    assert len(set(least.values())) < len(set(prints))


def test_every_pair_within_the_radius_shares_a_table():
    masks = simhash.masks()
    assert len(masks) == 7 and all(28 <= m.bit_count() <= 40 for m in masks)
    for i in range(64):
        for j in range(64):
            assert any(m & (1 << i | 1 << j) == 0 for m in masks)


def test_links_of_a_crowd(spark):
    """All fingerprints of one neighbourhood, and strangers."""
    draw = np.random.default_rng(3)
    some = [0, (1 << 64) - 1, *(int(x) for x in draw.integers(0, 1 << 63, 30))]
    some += [x ^ 1 << i ^ 1 << j for x in some[:4] for i in range(0, 64, 3) for j in range(0, 64, 5)]
    some += [some[2] ^ 0b111 << 40, some[2] ^ 0b11111 << 40]
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in set(some)]
    got = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    mask = (1 << 64) - 1
    root = {x: x for x in set(some)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in got:
        assert bin((r.a ^ r.b) & mask).count("1") <= 2
        root[find(r.a & mask)] = find(r.b & mask)
    expected = brute_links(some)
    same = defaultdict(set)
    for x in root:
        same[expected[x]].add(find(x))
    assert all(len(s) == 1 for s in same.values()) and len(same) == len({find(x) for x in root})


def test_empty_tables(spark):
    assert simhash.near_fingerprints(frame(spark, [])).collect() == []


def test_slices_give_every_word_once():
    text = "".join(f"w{i}{' ' * (i % 4 + 1)}" for i in range(400)) + "x" * 500 + " end"
    for most in (20, 50, 300):
        for carry in (0, 1, 3):
            seen = []
            for _, _, part, bounds, fresh, last in slices.slices(pa.array([text, "", None, "a b"]), slices.SPACE, carry, most):
                starts, ends, _ = slices.spans(part, bounds, slices.SPACE)
                spoken = [part[a:b].tobytes().decode() for a, b in zip(starts, ends)]
                new = int(np.searchsorted(ends, fresh, "right"))
                assert not seen or fresh == 0 or spoken[:new][-carry:] == seen[-carry:][-new:] or carry == 0
                seen += spoken[new:]
            assert seen == text.split() + ["a", "b"]


@pytest.mark.parametrize("places", [1 << 18, 5])
def test_words_with_a_place_left_out(monkeypatch, places):
    """Equal fingerprints exactly where the words are equal, in whatever runs they are worked on."""
    monkeypatch.setattr(variants, "PLACES", places)
    found = [*letters(3, 40, 1, "abß"), "", "x"]
    low = [0 if i % 3 else min(1, len(w)) for i, w in enumerate(found)]
    high = [max(lo, len(w) - i % 2) for i, (w, lo) in enumerate(zip(found, low))]
    columns = [pa.array(range(len(found)), pa.int64()), pa.array(found), pa.array(low, pa.int32()), pa.array(high, pa.int32())]
    batch = pa.RecordBatch.from_arrays(columns, names=["id", "word", "low", "high"])
    rows = [r for b in variants._left_out(iter([batch])) for r in b.to_pylist()]
    expected = [(i, p) for i in range(len(found)) for p in [-1, *range(low[i], high[i])]]
    assert sorted((r["id"], r["place"]) for r in rows) == sorted(expected)
    texts = defaultdict(set)
    for r in rows:
        w, p = found[r["id"]], r["place"]
        texts[r["key"]].add(w if p < 0 else w[:p] + w[p + 1 :])
    assert all(len(t) == 1 for t in texts.values()) and len(texts) == len(set().union(*texts.values()))


def test_counts_of_a_task_go_out_once():
    kinds = [("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("f", pa.int64()), ("uid", pa.int64())]
    rows = [("en", f"w{i % 7}", 1, 2, 100 - i) for i in range(50)] + [("en", None, 0, 9, None)] * 3
    batches = [pa.RecordBatch.from_pylist([dict(zip(dict(kinds), r)) for r in rows[i::5]], pa.schema(kinds)) for i in range(5)]
    for most, least_rows in ((1000, 8), (10, 9)):
        out = [r for b in phrases._together(iter(batches), most) for r in b.to_pylist()]
        total = Counter()
        for r in out:
            total[r["phrase"]] += r["f"]
        assert total == {None: 27} | {f"w{k}": 2 * len(range(k, 50, 7)) for k in range(7)}
        assert len(out) == 8 if most == 1000 else len(out) >= least_rows
    assert {(r["phrase"], r["uid"]) for r in next(phrases._together(iter(batches))).to_pylist()} >= {("w0", 51), ("w1", 57)}


def test_phrase_counts_go_out_as_one_row_for_each_part(spark):
    """Before, every phrase was a row of every task's output."""
    draw = np.random.default_rng(3)
    texts = [" ".join(f"W{i}" for i in draw.integers(0, 30, 400)) + "." for _ in range(40)]
    uids = list(range(40))
    known = spark.sparkContext.broadcast(np.full(1 << 10, 255, np.uint8))
    batch = pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(texts), pa.array(["en", "de"] * 20)], names=["uid", "text", "lang"])
    out = list(phrases._teller(2, known, 6)(iter([batch])))
    assert sum(b.num_rows for b in out) <= 6
    got = {(r["lang"], r["phrase"]): r["f"] for b in phrases._adder(1)(iter(out)) for r in b.to_pylist()}
    expected = Counter()
    for lang, text in zip(["en", "de"] * 20, texts):
        tokens = text[:-1].lower().split()
        expected[lang, None] += len(tokens)
        expected.update((lang, " ".join(tokens[i : i + n])) for n in (1, 2) for i in range(len(tokens) - n + 1))
    assert got == dict(expected)
