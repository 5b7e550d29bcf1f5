"""Nearest neighbours by cosine with multiprobe p-stable hashing.

Unit vectors are projected on ``functions`` Gaussian directions per table and
cut into steps of ``width``; on unit vectors the order by distance is the order
by cosine.  A query visits, per table, the ``probes`` buckets with the best
estimated chance: those reached by moving coordinates one step to the side
whose border is near, in the order of the squared distances to the borders.
Candidates of all tables are merged after exact reranking in double precision.

The rows are dealt to parts of bounded size and each part is indexed by itself,
all tables at once; every query comes to every part.  So vectors do not travel
bucket by bucket, and a bucket may hold any share of all rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import prepared, settle, tidy
from millrace.llm.words import U64, salted

TABLES, FUNCTIONS, WIDTH, PROBES = 10, 4, 1.0, 40
#: Vectors (in double precision) of a part on average, and scores that are held at once.
PART_BYTES, SCORES = 64 << 20, 1 << 21


def unit(column: pa.Array) -> np.ndarray:
    """Vectors of one length, as rows of length 1."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def places(x: np.ndarray, table: int, functions: int, width: float) -> np.ndarray:
    """Coordinates of the projections in steps of ``width``; their floor is the bucket."""
    draw = np.random.default_rng([table, x.shape[1], functions])
    directions = draw.normal(size=(x.shape[1], functions))
    return x @ directions / width + draw.uniform(0, 1, functions)


def bucket_keys(steps: np.ndarray, table: int, dim: int) -> np.ndarray:
    """A 64-bit key per row of whole coordinates (last axis), another one for every table."""
    key = np.full(steps.shape[:-1], U64(table * 1_000_003 + dim))
    for k in range(steps.shape[-1]):
        key = salted(key ^ steps[..., k].astype(np.int64).view(np.uint64), k)
    return key.view(np.int64)


def probe_steps(at: np.ndarray, probes: int) -> np.ndarray:
    """For every row the whole coordinates (rows x probes x functions) of its best buckets, best first."""
    functions = at.shape[1]
    home = np.floor(at)
    inside = at - home
    cost = np.stack([np.zeros_like(inside), inside**2, (1 - inside) ** 2])  # stay, step down, step up
    moves = np.array(list(itertools.product((0, 1, 2), repeat=functions)))
    total = sum(cost[moves[:, k], :, k] for k in range(functions)).T
    best = np.argsort(total, axis=1, kind="stable")[:, :probes]
    return home[:, None, :] + np.array([0, -1, 1])[moves[best]]


def _by_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    for batch in batches:
        dims = batch["dim"].to_numpy()
        for dim in np.unique(dims):
            yield pa.Table.from_batches([batch]).filter(pa.array(dims == dim)).combine_chunks()


class _Index:
    """Unit vectors of one length, and per table their numbers by bucket."""

    def __init__(self, x: np.ndarray, who: np.ndarray, tables: int, functions: int, width: float, probes: int | None) -> None:
        self.x, self.who, self.shape, self.probes, self.tables = x, who, (functions, width), probes, []
        for table in range(tables if probes else 0):
            keys = bucket_keys(np.floor(places(x, table, functions, width)), table, x.shape[1])
            order = np.argsort(keys, kind="stable")
            known, first = np.unique(keys[order], return_index=True)
            self.tables.append((known, np.append(first, len(keys)), order.astype(np.int32)))

    def visited(self, asked: np.ndarray) -> np.ndarray:
        """Which vectors (columns) lie in a bucket that a query (row) visits; all without ``probes``."""
        if not self.probes:
            return np.ones((len(asked), len(self.x)), bool)
        met = np.zeros((len(asked), len(self.x)), bool)
        for table, (known, first, order) in enumerate(self.tables):
            steps = probe_steps(places(asked, table, *self.shape), self.probes)
            keys = bucket_keys(np.ascontiguousarray(steps), table, asked.shape[1])
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            rows, probe = np.nonzero(known[at] == keys)
            at = at[rows, probe]
            sizes = first[at + 1] - first[at]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            met[np.repeat(rows, sizes), order[np.arange(total) + np.repeat(first[at] - (ends - sizes), sizes)]] = True
        return met

    def best(self, asked: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, number and score of each query's k best visited vectors, and of all that may equal the least of these."""
        met = self.visited(asked)
        scores = asked @ self.x.T
        scores[~met] = -np.inf
        if scores.shape[1] > k:
            least = np.partition(scores, -k, axis=1)[:, -k][:, None]
            met &= scores >= least - 1e-12
        a, b = np.nonzero(met)
        # summed alike for a pair wherever it is met
        return a, b, (asked[a] * self.x[b]).sum(axis=1)


def _searcher(tables: int, functions: int, width: float, probes: int | None, k: int):
    """Takes the vectors of a part, then every query, and gives each query's k best of the part."""

    @tidy
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, known = None, {}, {}
        for batch in batches:
            parts, asks = batch["part"].to_numpy(), batch["asks"].to_numpy(zero_copy_only=False)
            change = np.flatnonzero((parts[1:] != parts[:-1]) | (asks[1:] != asks[:-1])) + 1
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
            for i, j in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
                if parts[i] != now:
                    now, held, known = parts[i], {}, {}
                for rows in _by_dim([batch.slice(i, j - i)]):
                    x, who, dim = unit(rows["vector"].chunk(0)), rows["who"].to_numpy(), rows["dim"][0].as_py()
                    if not asks[i]:
                        held.setdefault(dim, []).append((x, who))
                        continue
                    if dim in held:
                        all_x, all_who = (np.concatenate(c) for c in zip(*held.pop(dim)))
                        known[dim] = _Index(all_x, all_who, tables, functions, width, probes)
                    if dim not in known:
                        continue
                    index = known[dim]
                    for low in range(0, len(x), step := max(1, SCORES // len(index.x))):
                        a, b, score = index.best(x[low : low + step], k)
                        found.append((who[low + a], index.who[b], score))
            columns = [np.concatenate(c) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "who", "score"])

    return work


def _search(candidates: DataFrame, queries: DataFrame, searcher) -> DataFrame:
    """``query, who, score``: every query meets every part of the candidates.

    A candidate moves once, whatever the number of its buckets, and a query once
    for each part, whatever the number of those it visits.
    """
    total = candidates.agg(F.sum(F.col("dim").cast("long"))).first()[0] or 0
    parts = max(total * 8 // PART_BYTES + 1, 2 * candidates.sparkSession.sparkContext.defaultParallelism)
    columns = ["part", "asks", "who", "dim", "vector"]
    own = F.pmod(F.xxhash64("who"), F.lit(parts)).cast("int")
    rows = candidates.withColumns({"part": own, "asks": F.lit(False)}).select(columns)
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1).cast("int")))
    asks = queries.withColumns({"part": every, "asks": F.lit(True)}).select(columns)
    # a few times the parts, so that seldom two share a task
    both = rows.unionByName(asks).repartition(4 * parts, "part").sortWithinPartitions("part", "asks")
    return both.mapInArrow(searcher, "query long, who long, score double")


def nearest(
    vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding",
    tables: int = TABLES, functions: int = FUNCTIONS, width: float = WIDTH, probes: int = PROBES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest found, by cosine.

    Queries are the rows whose id is divisible by ``every``; candidates are all
    rows but the query's own.  Rows whose vector is null, empty, zero or holds
    nulls, NaN or infinities take no part; vectors of different lengths are
    never neighbours.  Ties go to the smaller id.  Rows with a null id are
    candidates only, and last among ties.  Repeated ids and vectors are rows of
    their own.  A query for which the tables gave fewer than ``k`` rows is
    compared with all of them.  Other columns are ignored.

    Of equal vectors only the ``k + 1`` smallest ids can be anyone's result, so
    no more are indexed; equal queries are asked once.
    """
    if functions > 8:
        raise ValueError("probe sequences are enumerated for at most 8 functions a table")
    prepared(vectors.sparkSession)
    x = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(
        F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("vector")
    )
    rows = rows.filter(F.col("vector").isNotNull() & (F.size("vector") > 0))
    rows = rows.filter(~F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    rows = rows.filter(F.exists("vector", lambda v: v != 0)).withColumn("dim", F.size("vector"))
    place = F.row_number().over(Window.partitionBy("vector").orderBy(F.asc_nulls_last("vec_id"), "uid"))
    kept = settle(rows.withColumn("place", place).filter(F.col("place") <= k + 1), "vectors")
    # equal queries are one, named by the first of the equal rows
    asking = rows.filter(F.col("vec_id") % every == 0).select("uid", "vec_id", "vector", "dim")
    first = kept.filter("place = 1").select(F.col("uid").alias("who"), "vector")
    asking = settle(asking.join(first, "vector").select("uid", "vec_id", "who", "vector", "dim"), "queries")
    asks = asking.dropDuplicates(["who"]).select("who", "vector", "dim")

    # what was single precision moves as that
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    moved = F.col("vector").cast("array<float>" if single else "array<double>").alias("vector")
    everyone, asks = kept.select(F.col("uid").alias("who"), "dim", moved), asks.select("who", "dim", moved)
    found = _search(everyone, asks, _searcher(tables, functions, width, probes, k + 1))
    found = settle(_best(found, kept, k + 1), "neighbours")

    # too few found: compare with every row
    enough = found.groupBy("query").agg(F.count("*").alias("n")).filter(F.col("n") > k).select(F.col("query").alias("who"))
    lacking = asks.join(enough, "who", "left_anti")
    if lacking.limit(1).count():
        whole = _best(_search(everyone, lacking, _searcher(tables, functions, width, None, k + 1)), kept, k + 1)
        found = found.join(lacking.select(F.col("who").alias("query")), "query", "left_anti").unionByName(whole)

    own = asking.select(F.col("who").alias("query"), F.col("uid").alias("own"), F.col("vec_id").alias("query_id"))
    mine = own.join(found, "query").filter(F.col("own") != F.col("who"))
    order = Window.partitionBy("own").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "who")
    mine = mine.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return mine.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _best(scored: DataFrame, kept: DataFrame, k: int) -> DataFrame:
    """The k best distinct candidates of every query, with their ids."""
    named = scored.distinct().join(kept.select(F.col("uid").alias("who"), "vec_id"), "who")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "who")
    return named.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")
