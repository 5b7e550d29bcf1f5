"""Packing and byte-level BPE against the tokenizer libraries."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import awkward, frame
from tokenizers import Tokenizer

from millrace.llm import bpe, packing

ODD = [
    "a\x0bb  c", "x\x1cy\x1dz\x1e1\x1f2", "ΟΔΥΣΣΕΥΣ Σ ΑΣ.", "é ́x", "don't I'LL we've",
    "<|endoftext|> a<|startoftext|>b", "x<|ENDOFTEXT|>y <|endoftext|><|endoftext|>", " nb sp　x", "İSTANBUL ǅ ﬁ", "日本語 テスト123", "", "   ",
    "a\x00b", "﻿bom 🙂🙂", "1234 5.6e7 x_y", "\x85next line", None, "w" * 5000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.VOCABULARY)


def test_ids_of_words_are_the_tokenizers(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    codec = packing.WordTokens(packing.VOCABULARY)
    draw = random.Random(1)
    texts = ODD + ["the cat sat on the mat " * 20, "The mat THE MAT", "one <|endoftext|> two <|endoftext|>"]
    texts += ["End. end, END; End: eND! end? end.. end.) (end). e.g. it's. don't! x<|endoftext|>. é. ÉCOLE, Straße. ÷ø a÷b Ünder ＡＢ. ΣΑΣ. aΣ. ﬁn. I. ×", ". , ;", "a.", "."]
    texts += [" ".join("".join(draw.choice(list("abcéÀß'.,!?ΣA1")) for _ in range(draw.randint(1, 6))) for _ in range(400))]
    texts += ["".join(draw.choice(["a", "B", "é", " ", "<|", "endoftext", "|>", "<|endoftext|>", "'", "\n", "１", "ß"]) for _ in range(30)) for _ in range(300)]
    for part in (texts, texts[::-1], texts[:3]):
        ids, at = codec.encode(pa.array(part, pa.string()))
        for text, a, b in zip(part, at, at[1:]):
            assert ids[a:b].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def one_by_one(lengths, capacity):
    """Best-fit decreasing, a piece at a time."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(left) if r >= n]
        if fits:
            left[min(fits, key=lambda i: left[i])] -= n
        else:
            left.append(capacity - n)
    return sorted(left)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_decreasing_in_runs(seed):
    draw = random.Random(seed)
    capacity = draw.choice([1, 16, 100, 127, 128])
    lengths = [draw.randint(1, capacity) for _ in range(draw.choice([1, 50, 900]))] + [capacity] * 3
    rows = packing.best_fit(Counter(lengths), capacity)
    fill, seen = defaultdict(list), Counter()
    for length, rank, first, windows, each, offset in rows.tolist():
        assert rank == seen[length]
        seen[length] += windows * each
        for w in range(windows):
            fill[first + w] += [(offset + k * length, length) for k in range(each)]
    assert sum(seen.values()) >= len(lengths)
    assert {k: v for k, v in seen.items()} == Counter(lengths)
    left = []
    for pieces in fill.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
        left.append(capacity - end)
    assert sorted(left) == one_by_one(lengths, capacity)


@pytest.mark.parametrize("clash", [False, True])
def test_pack(spark, tokenizer, clash):
    rows = awkward()
    got = packing.pack(frame(spark, rows, clash)).collect()
    expected = Counter()
    for r in rows:
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4")
        for s in range(0, len(ids), 4096):
            piece = ids[s : s + 4096]
            expected[(r[0], s, len(piece), zlib.crc32(piece), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == expected
    fill = defaultdict(list)
    for r in got:
        fill[r.sequence_id].append((r.offset, r.length))
    assert sorted(fill) == list(range(len(fill)))
    for pieces in fill.values():
        assert [o for o, _ in sorted(pieces)] == np.cumsum([0, *(n for _, n in sorted(pieces))])[:-1].tolist()
        assert sum(n for _, n in pieces) <= 4096


@pytest.mark.parametrize("chunk, overlap", [(bpe.CHUNK, bpe.OVERLAP), (97, 20), (300, 40)])
def test_encode_and_decode(spark, chunk, overlap):
    rows = [r for r in awkward() if chunk > 1000 or r[0] not in (6, 7, 12)]
    rows += [(5000 + i, t, None, None, None) for i, t in enumerate(ODD)]
    rows += [(6000, " " * 3000 + "x", None, None, None), (6001, "it's  \n\n  we're 12345 !!!" * 300, None, None, None)]
    df = frame(spark, rows, clash=True)
    codec = bpe.encoding(bpe.RANKS)
    encoded = bpe.encode(df, chunk=chunk, overlap=overlap)
    expected = Counter()
    for r in rows:
        ids = codec.encode_ordinary(r[1] or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        expected[(r[0], len(ids), sha(" ".join(map(str, ids)).encode()), sha((r[1] or "").encode()))] += 1
    got = bpe.digests(encoded).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == expected
    parts = defaultdict(dict)
    for r in bpe.decode(encoded).collect():
        parts[r.uid][r.piece_no] = bytes(r.bytes)
    whole = Counter(b"".join(p for _, p in sorted(d.items())).decode() for d in parts.values())
    assert whole == Counter(r[1] or "" for r in rows)
    if chunk < 1000:
        assert max(map(len, parts.values())) > 10


def test_empty_tables(spark):
    assert packing.pack(frame(spark, [])).collect() == []
    assert bpe.digests(bpe.encode(frame(spark, []))).collect() == []


def test_words_with_one_hash_are_told_apart(monkeypatch):
    """A hash that knows three values only: most words clash, and none gets another's ids."""
    memory = packing.Memory()
    words = ["a", "bb", "", "cc", "bb", "ddd", "a"]
    data, at = packing.raw(pa.array(words))
    hashes = np.array([len(w) % 3 for w in words], np.uint64)
    memory.add(data, at, hashes, np.arange(7, dtype=np.uint32), np.ones(7, np.int64), np.array([0, 1, 2, 3]))
    slot = memory.find(data, at, hashes)
    found = [int(memory.ids.room[memory.id_first.room[s]]) if s >= 0 else None for s in slot]
    assert found == [0, 1, 2, None, 1, None, 0]


def test_words_with_marks_and_capitals_are_one_word():
    """A word is encoded once, whatever marks follow it and however it is written; marks are words of their own."""
    codec = packing.WordTokens(packing.VOCABULARY)
    assert codec.encode(pa.array(["x \u3000", "", None, " "]))[1].tolist()[-3:] == [len(codec.encode(pa.array(["x \u3000"]))[0])] * 3
    codec = packing.WordTokens(packing.VOCABULARY)
    texts = ["Äßé äßé$$$ ÄSSÉ ÄßÉ.!! äßé&&& ÄSSÉ###", "ÄßÉ!!", "×!! a÷$ !! 1!!"]
    ids, at = codec.encode(pa.array(texts))
    plain = Tokenizer.from_file(packing.VOCABULARY)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    # two words, $$$ .!! &&& ### !!, and three that do not end in a letter and marks, or begin with marks
    assert len(codec.memory.keys) == 10


def test_words_found_most_often_stay(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 40)
    codec = packing.WordTokens(packing.VOCABULARY)
    for i in range(4):
        codec.encode(pa.array([("often here " if i < 3 else "") + " ".join(f"{w}{w}{'abcd'[i]}" for w in "klmnopqrst")]))
    tried = []
    monkeypatch.setattr(codec, "encoded", lambda words: tried.append(words.to_pylist()) or (np.zeros(0, np.uint32), np.zeros(0, np.int64)))
    codec.encode(pa.array(["here often"]))
    assert tried == [[]]
    assert len(codec.memory.keys) <= 40
