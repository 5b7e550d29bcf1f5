"""Language identification in two steps: the family, then a language within it.

Texts are counted into hashed byte trigrams of their words.  Languages with
alike trigram profiles form families, found from the labelled texts.  A linear
support vector machine decides between every two families, and one between
every two languages of a family; only the winning family's machines vote on
the language.  The machines learn from a bounded sample of whole labelled
texts, each in a task of its own; prediction reads every whole text once.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import numbered, settle, tidy
from millrace.llm.words import raw, runs

#: Hash buckets of trigrams, and labelled texts of a language that are learned from (expected number).
DIMS, SAMPLE = 4096, 1000
UNKNOWN = "und"

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[b for b in range(128) if not chr(b).isalpha()]] = 32  # what is no letter parts words


@dataclass
class Counts:
    """Trigram counts of texts: ``at`` bounds each text's buckets, which ascend, in ``bucket`` and ``n``."""

    at: np.ndarray
    bucket: np.ndarray
    n: np.ndarray

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """For each text, its shares times the weights of their buckets (DIMS x columns), in double.

        A text's terms are added in the order of its buckets, whatever the texts
        beside it: equal texts get equal sums.
        """
        out = np.zeros((len(self.at) - 1, weights.shape[1]))
        some = np.flatnonzero(np.diff(self.at))
        if len(some):
            total = np.add.reduceat(self.n, self.at[some]).astype(float)
            for k in range(weights.shape[1]):
                terms = self.n * weights[:, k].astype(float)[self.bucket]
                out[some, k] = np.add.reduceat(terms, self.at[some]) / total
        return out


def trigram_counts(data: np.ndarray, at: np.ndarray) -> Counts:
    """Counts of hashed trigrams; words are parted by one blank, texts by two.

    What this takes grows with the texts' bytes, not with their number.
    """
    n = len(at) - 1
    plain = _PLAIN[data]
    owner = np.repeat(np.arange(n), np.diff(at))
    blank = plain == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # the first blank of a run stays
    plain, owner = plain[keep], owner[keep]
    sizes = np.bincount(owner, minlength=n)
    ends = np.cumsum(sizes + 2)
    padded = np.full(int(ends[-1]) if n else 0, 32, np.uint32)
    padded[np.arange(len(plain)) + 2 * owner + 1] = plain
    place = np.repeat(np.arange(n), sizes + 2)
    code = padded[:-2] | padded[1:-1] << np.uint32(8) | padded[2:] << np.uint32(16)
    bucket = (code * np.uint32(2654435761)) >> np.uint32(20)
    within = (place[:-2] == place[2:]) & (code != 0x202020)
    flat = place[:-2][within] * DIMS + bucket[within]
    if n * DIMS <= 4 * len(flat):
        dense = np.bincount(flat, minlength=n * DIMS)
        keys = np.flatnonzero(dense)
        times = dense[keys]
    else:
        keys, times = np.unique(flat, return_counts=True)
    return Counts(np.searchsorted(keys, np.arange(n + 1) * DIMS), keys % DIMS, times)


def counted(column: pa.Array) -> Iterator[tuple[int, int, Counts]]:
    data, at = raw(column)
    for i, j in runs(at):
        yield i, j, trigram_counts(data[at[i] : at[j]], at[i : j + 1] - at[i])


def shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


# ---------------------------------------------------------------- learning


def families(profiles: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages grouped by average-link clustering of their profiles into about sqrt(n) families."""
    groups = [[name] for name in sorted(profiles)]
    unit = {n: np.sqrt(p) / max(np.linalg.norm(np.sqrt(p)), 1e-12) for n, p in profiles.items()}
    while len(groups) > max(1, round(len(profiles) ** 0.5)):
        alike = lambda a, b: np.mean([unit[x] @ unit[y] for x in a for y in b])
        a, b = max(itertools.combinations(range(len(groups)), 2), key=lambda p: alike(groups[p[0]], groups[p[1]]))
        groups[a] += groups.pop(b)
    return [sorted(g) for g in groups]


def support_vector_machine(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Weights on trigram shares and a bias, by dual coordinate descent with hinge loss.

    Shares are weighted by the root of how common they are; what is learned is
    folded back, so that a margin is ``shares @ weights + bias``.
    """
    scale = 1 / np.sqrt(x.mean(axis=0) + 1e-6)
    x = np.hstack([x * scale, np.ones((len(x), 1), np.float32)]).astype(np.float32)
    norm = np.sqrt((x[:, :-1] ** 2).sum(axis=1).mean())
    x[:, :-1] /= max(norm, 1e-12)
    square = (x**2).sum(axis=1)
    dual, weights = np.zeros(len(x)), np.zeros(x.shape[1], np.float32)
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)):
            slope = y[i] * float(x[i] @ weights) - 1
            new = min(max(dual[i] - slope / square[i], 0.0), cost)
            if new != dual[i]:
                weights += np.float32((new - dual[i]) * y[i]) * x[i]
                moved = max(moved, abs(new - dual[i]))
                dual[i] = new
        if moved < 1e-3:
            break
    return weights[:-1] * scale / max(norm, 1e-12), float(weights[-1])


FEATURES = "lang string, buckets array<int>, counts array<float>"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, counts in counted(batch["text"]):
            at = pa.array(counts.at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["lang"].slice(i, j - i),
                    pa.ListArray.from_arrays(at, pa.array(counts.bucket, pa.int32())),
                    pa.ListArray.from_arrays(at, pa.array(counts.n, pa.float32())),
                ],
                names=["lang", "buckets", "counts"],
            )


def _dense(table: pa.Table) -> np.ndarray:
    out = np.zeros((table.num_rows, DIMS), np.float32)
    for i, (b, c) in enumerate(zip(table["buckets"].to_pylist(), table["counts"].to_pylist())):
        out[i, b] = c
    return shares(out)


def _profile(table: pa.Table) -> pa.Table:
    mean = _dense(table).mean(axis=0)
    return pa.table({"lang": table["lang"].slice(0, 1), "mean": pa.array([mean.tolist()], pa.list_(pa.float32()))})


def _learn(table: pa.Table) -> pa.Table:
    order = table.select(["positive", "lang", "buckets"]).to_pylist()
    table = table.take(sorted(range(table.num_rows), key=lambda i: repr(order[i])))  # shuffles change the order
    y = np.where(table["positive"].to_numpy(), 1.0, -1.0)
    weights, bias = support_vector_machine(_dense(table), y)
    return pa.table(
        {
            "contest": table["contest"].slice(0, 1),
            "weights": pa.array([weights.tolist()], pa.list_(pa.float32())),
            "bias": pa.array([bias], pa.float64()),
        }
    )


@dataclass
class Model:
    """Families, the contests (family against family, then language against language), their weights."""

    families: list[list[str]]
    contests: list[tuple]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, counts: Counts) -> tuple[np.ndarray, np.ndarray]:
        """Languages and scores of texts given by their trigram counts.

        The most votes win; between equal votes the surer side, and between
        equally sure ones the first by name.
        """
        n = len(counts.at) - 1
        if not self.families:
            return np.full(n, UNKNOWN, object), np.zeros(n)
        margins = counts.sums(self.weights) + self.bias
        chance = 1 / (1 + np.exp(-2 * margins))

        def stage(kind: str, names: list) -> tuple[np.ndarray, np.ndarray]:
            votes, sure = np.zeros((n, len(names))), np.zeros((n, len(names)))
            for k, (what, a, b) in enumerate(self.contests):
                if what == kind:
                    votes[:, names.index(a)] += chance[:, k] >= 0.5
                    votes[:, names.index(b)] += chance[:, k] < 0.5
                    sure[:, names.index(a)] += chance[:, k]
                    sure[:, names.index(b)] += 1 - chance[:, k]
            best = np.argmax(votes + sure / len(names), axis=1)
            return best, sure[np.arange(n), best] / (len(names) - 1) if len(names) > 1 else np.ones(n)

        family, score = stage("family", list(range(len(self.families))))
        lang, score = np.full(n, UNKNOWN, object), score.copy()
        for f, names in enumerate(self.families):
            best, sure = stage(f"in {f}", names)
            mine = family == f
            lang[mine] = np.array(names, object)[best[mine]]
            score[mine] *= sure[mine]
        return lang, score


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from ``uid, text, lang``; a language has about ``sample`` texts, chosen by the row's hash.

    Rows whose label is null are not learned from.  Without labels the model
    knows no language; with one, it always answers that.  What reaches the
    driver is a profile per language and the weights per contest.
    """
    labelled = labelled.filter("lang is not null")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], [], np.zeros((DIMS, 0)), np.zeros(0))
    draw = F.pmod(F.xxhash64("uid", F.lit("sample")), F.lit(1 << 30))
    share = F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, int(min(1.0, sample / n) * (1 << 30)))])
    chosen = labelled.filter(draw < share[F.col("lang")]).select("lang", "text")
    chosen = settle(chosen.mapInArrow(_features, FEATURES), "language-sample")
    profiles = chosen.groupBy("lang").applyInArrow(_profile, "lang string, mean array<float>").collect()
    grouped = families({r["lang"]: np.array(r["mean"], np.float32) for r in profiles})
    contests = [("family", a, b) for a, b in itertools.combinations(range(len(grouped)), 2)]
    contests += [(f"in {f}", a, b) for f, names in enumerate(grouped) for a, b in itertools.combinations(names, 2)]
    sides = [
        (k, lang, positive)
        for k, (kind, a, b) in enumerate(contests)
        for positive, side in ((True, a), (False, b))
        for lang in (grouped[side] if kind == "family" else [side])
    ]
    weights, bias = np.zeros((DIMS, len(contests)), np.float32), np.zeros(len(contests))
    if contests:
        spark = labelled.sparkSession
        known = spark.createDataFrame(sides, "contest int, lang string, positive boolean")
        learned = chosen.join(F.broadcast(known), "lang").groupBy("contest")
        for r in learned.applyInArrow(_learn, "contest int, weights array<float>, bias double").collect():
            weights[:, r["contest"]], bias[r["contest"]] = r["weights"], r["bias"]
    return Model(grouped, contests, weights, bias)


# ---------------------------------------------------------------- prediction


def _has_letter(texts: list[str | None]) -> np.ndarray:
    return np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)


def _predictor(model: Model, text_col: str, names: list[str]):
    @tidy
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch[text_col]
            lang, score = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            for i, j, counts in counted(texts):
                lang[i:j], score[i:j] = model.predict(counts)
            known = _has_letter(texts.to_pylist())
            lang[~known], score[~known] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang.tolist(), pa.string()), pa.array(score, pa.float64())], names=names
            )

    return predict


def annotate(df: DataFrame, model: Model, text_col: str, lang_name: str, score_name: str) -> DataFrame:
    """``df`` with two more columns; a text that is null or has no letter is ``und`` with score 0."""
    schema = T.StructType(
        [*df.schema.fields, T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType())]
    )
    return df.mapInArrow(_predictor(model, text_col, schema.names), schema)


def lettered(df: DataFrame, text_col: str) -> DataFrame:
    """Rows whose text is not null and has a letter."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_has_letter(batch[text_col].to_pylist()), pa.bool_()))

    return df.mapInArrow(keep, df.schema)


def held_out(doc_id, parts: int = 4, left_out: int = 2):
    """Whether a row is kept from learning: crc32 of its id as text, modulo ``parts``.  A null id never is."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(parts)) == left_out, F.lit(False))


def labelled_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows that may be learned from: not held out, with an id, a text and a label."""
    rows = numbered(docs, id_col, text_col, lang_col).withColumnRenamed(lang_col, "lang")
    return rows.filter("doc_id is not null and text is not null and lang is not null").filter(~held_out(F.col("doc_id")))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """One row per document: ``uid, doc_id, held_out, lang_pred, score``.

    Learns from the rows that are not held out; id, label and source take no
    part in a prediction.  Null texts and texts without a letter are ``und``
    with score 0, and so is everything where there are no labels.  Equal texts
    get equal answers; votes that tie go to the surer language, then to the
    first by name.  An empty table gives an empty one.  Extra columns are ignored.
    """
    model = train(labelled_rows(docs, id_col, text_col, lang_col), sample)
    rows = numbered(docs, id_col, text_col).withColumn("held_out", held_out(F.col("doc_id")))
    return annotate(rows, model, "text", "lang_pred", "score").select("uid", "doc_id", "held_out", "lang_pred", "score")
