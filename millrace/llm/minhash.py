"""Near-duplicates on word shingles by fast similarity sketching, banding and exact verification.

1. Documents with equal shingle sets are one class from here on.
2. Every class is sketched (see ``sketch``) and banded; classes that share a
   band's key are in one bucket.
3. In every bucket the classes are compared with its hub, the one with most
   company over all its buckets: as many comparisons as members.  Links are
   confirmed on the full sets, and linked classes are one component.
4. A bucket that still has several components may hide links between members
   that are not its hub.  Those members are kept whose shingles that occur in
   another such member could still suffice for a link, and what is left of a
   bucket is compared in blocks of bounded size.  Only links leave a block.

A pair at the threshold shares no band with probability
``(1 - 0.75**4)**32``, 5 in a million.  Apart from that no link is lost: a
pair that was not compared is in one component already, or cannot be a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import sketch
from millrace.llm.common import numbered, settle, tidy
from millrace.llm.graph import stars
from millrace.llm.words import U64, distinct, mix, salted, shingles

WORDS, PERCENT = 5, 75
SKETCH, BAND_ROWS = 128, 4
#: Shingles in a block of members that are compared with another block.
BLOCK = 1 << 15

SKETCHED = "uid long, doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values))


def _sketcher(size: int, dims: int, rows: int):
    @tidy
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, found, at in shingles(batch["text"], size):
                values, at = distinct(found, at)
                counts = np.diff(at)
                keys = sketch.bands(sketch.sketch(values, at, dims), rows)
                sums = []
                for salt in (11, 12):
                    total = np.concatenate([[U64(0)], np.cumsum(salted(values, salt), dtype=np.uint64)])
                    sums.append(_signed(mix(total[at[1:]] - total[at[:-1]] + counts.astype(np.uint64))))
                flat = _signed(keys[counts > 0].reshape(-1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["uid"].slice(i, j - i),
                        batch["doc_id"].slice(i, j - i),
                        pa.array(counts.astype(np.int64)),
                        *map(pa.array, sums),
                        _lists(flat, np.concatenate([[0], np.cumsum((counts > 0) * keys.shape[1])])),
                    ],
                    names=["uid", "doc_id", "n_shingles", "set_a", "set_b", "bands"],
                )

    return work


def _sets(size: int):
    @tidy
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, found, at in shingles(batch["text"], size):
                values, at = distinct(found, at)
                yield pa.RecordBatch.from_arrays(
                    [batch["uid"].slice(i, j - i), _lists(_signed(values), at)], names=["uid", "shingles"]
                )

    return work


def _fits(n: Column | str, m: Column | str, percent: int) -> Column:
    """Sizes of two sets that may be as similar as asked."""
    n, m = (F.col(x) if isinstance(x, str) else x for x in (n, m))
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _linked(common: Column, n: Column, m: Column, percent: int) -> Column:
    return common * 100 >= (n + m - common) * percent


def star_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links ``a, b`` between each bucket's hub and its other members."""
    company = members.groupBy("uid").agg(F.sum(F.col("size") - 1).alias("company"))
    rated = members.join(company, "uid")
    hubs = rated.groupBy("key").agg(F.max(F.struct("company", -F.col("uid"), "n")).alias("hub"))
    hubs = hubs.select("key", (-F.col("hub.col2")).alias("hub"), F.col("hub.n").alias("hub_n"))
    pairs = members.join(hubs, "key").filter(F.col("uid") != F.col("hub")).filter(_fits("n", "hub_n", percent))
    pairs = pairs.select(F.col("uid").alias("a"), F.col("hub").alias("b")).distinct()
    left = sets.select(F.col("uid").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("uid").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.filter(_linked(common, F.size("sa"), F.size("sb"), percent)).select("a", "b")


def _compare(percent: int):
    def work(table: pa.Table) -> pa.Table:
        """Links across components between the members of two blocks, or within one."""
        uid, root = table["uid"].to_numpy(), table["root"].to_numpy()
        block, n = table["block"].to_numpy(), table["n"].to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(uid)), n)
        values = table["shingles"].combine_chunks().flatten().to_numpy()
        _, column, times = np.unique(values, return_inverse=True, return_counts=True)
        shared = times > 1  # what only one member has is in no intersection
        keep = shared[column]
        owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        common = np.zeros((len(uid), len(uid)), np.float32)
        kinds = int(shared.sum())
        width = max(1, (8 << 20) // max(1, len(uid)))
        for low in range(0, kinds, width):
            start, stop = np.searchsorted(column, [low, low + width])
            part = np.zeros((len(uid), min(width, kinds - low)), np.float32)
            part[owner[start:stop], column[start:stop] - low] = 1
            common += part @ part.T
        union = n[:, None] + n[None, :] - common
        good = (100 * common >= percent * union) & (root[:, None] != root[None, :]) & (uid[:, None] < uid[None, :])
        if block.min() != block.max():  # pairs within a block are compared where it is alone
            good &= block[:, None] != block[None, :]
        a, b = np.nonzero(good)
        return pa.table({"a": pa.array(uid[a]), "b": pa.array(uid[b])})

    return work


def _open(live: DataFrame) -> DataFrame:
    """Rows of buckets with members of several components; written, since all that follows reads them several times."""
    keys = live.groupBy("key").agg(F.expr("min(root) <> max(root)").alias("mixed")).filter("mixed").select("key")
    return settle(live.join(keys, "key", "left_semi"), "open")


def hidden_links(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Confirmed links ``a, b`` between members of a bucket that are in different components."""
    named = members.join(roots.select(F.col("node").alias("uid"), "root"), "uid", "left")
    named = settle(named.withColumn("root", F.coalesce("root", "uid")).select("key", "uid", "n", "root"), "members")
    live = _open(named)
    for _ in range(2):
        # shingles that no other candidate has cannot be common
        own = live.select("uid").distinct().join(sets, "uid").select("uid", F.explode("shingles").alias("shingle"))
        shared = own.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1").select("shingle")
        most = own.join(shared, "shingle").groupBy("uid").agg(F.count("*").alias("most"))
        # a common set of `most` bounds the size of a partner: most / (n + m - most) >= percent / 100
        bound = F.floor(F.col("most") * (100 + percent) / percent).cast("long") - F.col("n")
        rated = live.join(most, "uid").withColumn("partner", bound)
        ranges = rated.groupBy("key").agg(F.min("n").alias("least"), F.max("partner").alias("widest"))
        live = rated.join(ranges, "key").filter("partner >= least and n <= widest").select("key", "uid", "n", "root")
        live = _open(settle(live, "candidates"))
    # what hangs together over buckets is dealt to blocks; blocks meet where a bucket has members of both
    first = live.groupBy("key").agg(F.min("uid").alias("first"))
    families = stars(live.join(first, "key").select(F.col("uid").alias("a"), F.col("first").alias("b")), "families")
    families = families.select(F.col("node").alias("uid"), F.col("root").alias("family"))
    people = live.select("uid", "n", "root").distinct().join(families, "uid", "left").withColumn("family", F.coalesce("family", "uid"))
    weights = people.groupBy("family").agg(F.ceil(F.sum("n") / F.lit(block)).alias("blocks"))
    people = people.join(weights, "family")
    people = settle(
        people.select("uid", "n", "root", F.xxhash64("family", F.pmod(F.xxhash64("uid"), "blocks")).alias("block")), "blocks"
    )
    homes = live.select("key", "uid").join(people.select("uid", "block"), "uid").select("key", "block").distinct()
    meetings = homes.join(homes.withColumnRenamed("block", "other"), "key").filter("block <= other")
    meetings = meetings.select(F.col("block").alias("low"), F.col("other").alias("high")).distinct()
    guests = meetings.select("low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
    guests = guests.join(people, "block").join(sets, "uid")
    return guests.groupBy("low", "high").applyInArrow(_compare(percent), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = WORDS, percent: int = PERCENT, dims: int = SKETCH, band_rows: int = BAND_ROWS,
) -> DataFrame:
    """One row per document: ``uid, doc_id, n_shingles, component_id, kept, chosen``.

    Two documents are linked when their sets of ``words``-word shingles have a
    Jaccard similarity of at least ``percent``; ``component_id`` is the
    smallest id reachable.  Null and empty texts, and texts of white space,
    have no shingles and are linked with nothing.  Shorter texts are one
    shingle.  Rows that repeat an id or a text are documents of their own;
    null ids count as larger than all others, and are the component's id only
    where it has no other.  ``kept`` says that id and component id are equal;
    ``chosen`` holds for exactly one row of every component, and for every row
    without shingles.
    Shingles are compared by 64-bit fingerprints.  Other columns are ignored.
    """
    rows = numbered(docs, id_col, text_col)
    made = settle(rows.mapInArrow(_sketcher(words, dims, band_rows), SKETCHED), "sketches")

    # 1. classes of equal sets, each with the first of its rows
    same = ["set_a", "set_b", "n_shingles"]
    full = made.filter("n_shingles > 0")
    stays = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "uid")
    classes = full.groupBy(*same).agg(F.min("uid").alias("class"), F.min(stays).alias("least"))
    classes = settle(classes, "classes")

    # 2. buckets of at least two classes
    firsts = full.join(classes.select(F.col("class").alias("uid")), "uid", "left_semi")
    keys = firsts.select("uid", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = settle(keys.join(buckets, "key"), "buckets")

    # 3. and 4. links
    wanted = rows.join(members.select("uid").distinct(), "uid", "left_semi")
    sets = settle(wanted.mapInArrow(_sets(words), "uid long, shingles array<long>"), "sets")
    links = settle(star_links(members, sets, percent), "links")
    roots = stars(links)
    more = settle(hidden_links(members, roots, sets, percent), "links")
    if more.limit(1).count():
        roots = stars(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    grouped = classes.join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "class"))
    least = grouped.groupBy("root").agg(F.min("least").alias("stays"))
    named = grouped.join(least, "root").select(
        *same, F.col("stays.doc_id").alias("component_id"), F.col("stays.uid").alias("stays")
    )
    linked = full.select("uid", "doc_id", *same).join(named, same)
    alone = made.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    alone = alone.withColumn("stays", F.col("uid"))
    columns = ["uid", "doc_id", "n_shingles", "component_id", "stays"]
    out = linked.select(*columns).unionByName(alone.select(*columns))
    same_id = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.withColumns({"kept": same_id, "chosen": F.col("uid") == F.col("stays")}).drop("stays")
