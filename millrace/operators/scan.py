"""Running aggregates, row numbers and row frames that survive a hot key.

A plain ``Window.partitionBy(key)`` sorts a whole key in one task, which is
right for most keys and fatal for a hot one.  :func:`measure` counts the rows
per key and names the hot ones; the rows of a hot key are cut along the order
column into chunks, and three steps give the same values:

1. each (key, chunk) is reduced to one total - map-side partial aggregation;
2. the totals of the earlier chunks are combined per key - one row per chunk;
3. that carry enters its chunk as one extra row ahead of the data, and an
   ordinary window over (key, chunk) finishes the job.

Data rows are shuffled once, by (key, chunk).  Chunks are cut where the rows
are: at quantiles of the hot key's own order column, so neither an outlier nor a
burst makes a chunk large.  A chunk holds about CHUNK_ROWS rows, more only for a
key beyond MAX_CHUNKS times that, or if all keys together need over MAX_CUTS.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.functions.arith import floor_div
from millrace.session import fresh_dir

HOT_ROWS = 1 << 20
CHUNK_ROWS = 1 << 18
MAX_CHUNKS = 1 << 16
MAX_CUTS = 1 << 22

_HOT = "_hot"
_CARRY = "_carry"
_CHUNK = "_chunk"
_BEFORE_ALL = -(1 << 62)


@dataclass(frozen=True)
class Rule:
    """How one column is folded along the order: sum, min, max, first or last."""

    kind: str
    value: Column
    before: bool = False  # over the rows before the current one


def run_sum(value: str | Column) -> Rule:
    return Rule("sum", _col(value))


def run_count(value: str | Column | None = None) -> Rule:
    if value is None:
        return Rule("sum", F.lit(1).cast("long"))
    return Rule("sum", F.when(_col(value).isNotNull(), 1).otherwise(0).cast("long"))


def run_min(value: str | Column) -> Rule:
    return Rule("min", _col(value))


def run_max(value: str | Column) -> Rule:
    return Rule("max", _col(value))


def run_first(value: str | Column) -> Rule:
    """Value of the first row, also when that value is null."""
    return Rule("first", F.struct(_col(value).alias("v")))


def run_last(value: str | Column) -> Rule:
    """Value of the newest row, also when that value is null."""
    return Rule("last", F.struct(_col(value).alias("v")))


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


@dataclass(frozen=True)
class Cut:
    """How keys are cut into chunks.

    ``width`` cuts every key evenly by the value of the order column.  ``cuts``
    holds the hot keys, each with the sorted places where its chunks begin; a
    list stands for the one key of a global scan.  With neither no key is cut.
    """

    width: int | None = None
    cuts: DataFrame | list[int] | None = None

    @property
    def whole(self) -> bool:
        return self.width is None and self.cuts is None

    def mark(self, df: DataFrame, keys: Sequence[str], seq: str | None = None) -> DataFrame:
        """Add ``_hot``, whether the row's key is cut, and with ``seq`` its ``_chunk``."""
        at = F.col(seq) if seq else F.lit(None).cast("long")
        if self.whole:
            return df.withColumns({_HOT: F.lit(False), _CHUNK: F.lit(0).cast("long")})
        if self.width is not None:
            return df.withColumns({_HOT: F.lit(True), _CHUNK: floor_div(at, self.width)})
        if isinstance(self.cuts, list):
            places = F.lit(self.cuts).cast("array<bigint>")
            return df.withColumns({_HOT: F.lit(True), _CHUNK: _passed(places, at)})
        # One row per hot key and a place per CHUNK_ROWS rows: MAX_CUTS places, 32 MB, at most.
        hot = F.broadcast(
            self.cuts.select(*[F.col(k).alias(f"_hk{i}") for i, k in enumerate(keys)], "_cuts")
        )
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_hk{i}"))
        known = F.col("_cuts").isNotNull()
        number = F.when(known, _passed(F.col("_cuts"), at)).otherwise(F.lit(0).cast("long"))
        marked = df.join(hot, same, "left")
        return marked.select(*[F.col(f"`{c}`") for c in df.columns], known.alias(_HOT), number.alias(_CHUNK))


def _passed(places: Column, at: Column) -> Column:
    """How many of the sorted ``places`` are at or below ``at``, by binary search."""

    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.shiftright(low + high, 1)
        right = (low < high) & (F.get(places, middle) <= at)
        left = (low < high) & ~right
        return F.struct(
            F.when(right, middle + 1).otherwise(low).alias("low"),
            F.when(left, middle).otherwise(high).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.size(places).alias("high"))
    steps = F.array_repeat(F.lit(0), MAX_CHUNKS.bit_length())
    return F.aggregate(steps, start, halve, lambda state: state["low"].cast("long"))


def _check_integer(df: DataFrame, seq: str) -> None:
    kind = df.schema[seq].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long"):
        raise ValueError(f"order column {seq} is {kind}: pass chunk= as a monotone column")


def measure(df: DataFrame, keys: Sequence[str], seq: str) -> Cut:
    """Count the rows per key and cut the hot keys at quantiles of ``seq``.

    One pre-aggregated count over the key columns, and, if a key is hot, one
    pre-aggregated sketch over the hot keys' order column.  Three numbers come
    to the driver; the cuts are a small table in the shared folder.
    """
    _check_integer(df, seq)
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > HOT_ROWS)
    hot = counts.agg(F.count("*"), F.max("_n"), F.sum("_n")).first()
    if not hot[0]:
        return Cut()
    target = max(CHUNK_ROWS, -(-hot[2] // MAX_CUTS))
    most = min(MAX_CHUNKS, -(-hot[1] // target))
    if most < 2:
        return Cut()

    def quantiles(n: int) -> Column:
        return F.percentile_approx(seq, F.lit([i / n for i in range(1, n)]), 10 * n)

    if not keys:
        return Cut(cuts=sorted(set(df.agg(quantiles(most)).first()[0])))
    own = F.least(F.lit(MAX_CHUNKS), F.ceil(F.col("_n") / F.lit(target))).cast("int")
    names = [f"_hk{i}" for i in range(len(keys))]
    named = counts.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], own.alias("_own"))
    named = written(named.withColumn("_class", F.ceil(F.log2(F.greatest("_own", F.lit(2)))).cast("int")), "hot")
    # One sketch per size class, so that a huge key does not cost the others its many quantiles.
    parts = []
    for (size,) in sorted(named.select("_class").distinct().collect()):
        mine = F.broadcast(named.filter(F.col("_class") == size).drop("_class"))
        found = df.select(*keys, seq).join(mine, same_row(keys, names)).groupBy(*keys)
        parts.append(found.agg(quantiles(1 << size).alias("_q"), F.first("_own").alias("_own"), F.lit(1 << size).alias("_all")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    # A key of fewer chunks takes every so manieth quantile.
    picked = F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("_own") - 1, F.lit(1))),
        lambda i: F.element_at("_q", F.greatest(F.lit(1), F.floor(i * F.col("_all") / F.col("_own"))).cast("int")).cast("long"),
    )
    cuts = every.select(*keys, F.array_sort(F.array_distinct(picked)).alias("_cuts"))
    return Cut(cuts=written(cuts, "cuts"))


def _over(rule: Rule, column: str, window: WindowSpec) -> Column:
    if rule.kind == "first":
        return F.first(column, ignorenulls=True).over(window)
    if rule.kind == "last":
        return F.last(column, ignorenulls=True).over(window)
    return getattr(F, rule.kind)(column).over(window)


def _total(rule: Rule, column: str, order: Column) -> Column:
    # The bare value, not its struct, keeps numbers in a hash aggregate.
    if rule.kind == "first":
        return F.struct(F.min_by(f"{column}.v", order).alias("v"))
    if rule.kind == "last":
        return F.struct(F.max_by(f"{column}.v", order).alias("v"))
    return getattr(F, rule.kind)(column)


def running(
    df: DataFrame,
    keys: Sequence[str],
    seq: str | Sequence[str],
    rules: dict[str, Rule],
    *,
    chunk: int | Column | Cut | None = None,
    include_current: bool = True,
    start: DataFrame | None = None,
) -> DataFrame:
    """Add one column per rule: its fold over the key's rows up to this one.

    ``seq`` must order the rows of a key without ties; its first column is cut
    into chunks.  ``chunk`` says how: None measures the keys first, a
    :class:`Cut` reuses a measurement, a number cuts every key at that width,
    and a column that never decreases along the order is the chunk itself.
    ``start`` holds folds of rows that came before ``df``: the keys and one
    column per rule, at most one row per key.
    """
    keys = list(keys)
    order = [seq] if isinstance(seq, str) else list(seq)
    folds = {name: f"_f_{name}" for name in rules}
    if not isinstance(chunk, (Column, Cut)):
        if chunk is None:
            chunk = measure(df, keys, order[0])
        else:
            _check_integer(df, order[0])
            chunk = Cut(chunk)
    whole = isinstance(chunk, Cut) and chunk.whole
    columns = df.columns
    base = df.withColumns({folds[n]: r.value for n, r in rules.items()})
    if isinstance(chunk, Column):
        base = base.withColumns({_HOT: F.lit(True), _CHUNK: chunk.cast("long")})
    elif not whole or start is not None:
        base = chunk.mark(base, keys, order[0])
    carries = []

    if start is not None:
        earlier_folds = (
            start.withColumn(_HOT, F.lit(True)) if isinstance(chunk, Column) else chunk.mark(start, keys)
        )
    if not whole:
        by = F.col(order[0]) if len(order) == 1 else F.struct(*order)
        totals = (
            base.filter(_HOT)
            .groupBy(*keys, _CHUNK)
            .agg(*[_total(r, folds[n], by).alias(folds[n]) for n, r in rules.items()])
        )
        if start is not None:
            totals = totals.unionByName(
                _started(earlier_folds.filter(_HOT), keys, rules, base, _BEFORE_ALL)
            )
        earlier = (
            Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        )
        carry = totals.select(
            *keys, _CHUNK, *[_over(r, folds[n], earlier).alias(folds[n]) for n, r in rules.items()]
        )
        carries.append(carry.filter(" or ".join(f"`{f}` is not null" for f in folds.values())))
    if start is not None:
        carries.append(_started(earlier_folds.filter(~F.col(_HOT)), keys, rules, base, 0))

    rows = base.withColumn(_CARRY, F.lit(1))
    for carry in carries:
        rows = rows.unionByName(carry.withColumn(_CARRY, F.lit(0)), allowMissingColumns=True)
    groups = [*keys, _CHUNK] if carries else keys
    ordered = Window.partitionBy(*groups).orderBy(*([_CARRY] if carries else []), *order)

    def inside(rule: Rule) -> WindowSpec:
        return ordered.rowsBetween(
            Window.unboundedPreceding, 0 if include_current and not rule.before else -1
        )

    done = rows.withColumns({f"_o_{n}": _over(r, folds[n], inside(r)) for n, r in rules.items()})
    out = {
        n: F.col(f"_o_{n}.v") if r.kind in ("first", "last") else F.col(f"_o_{n}")
        for n, r in rules.items()
    }
    kept = [c for c in columns if c not in rules]
    return done.filter(F.col(_CARRY) == 1).select(*kept, *[c.alias(n) for n, c in out.items()])


def _started(start: DataFrame, keys, rules: dict[str, Rule], base: DataFrame, chunk: int):
    """Folds from before the data as totals of a chunk."""
    kinds = dict(base.dtypes)
    folds = []
    for n, r in rules.items():
        value = F.struct(F.col(n).alias("v")) if r.kind in ("first", "last") else F.col(n)
        folds.append(value.cast(kinds[f"_f_{n}"]).alias(f"_f_{n}"))
    return start.select(*keys, F.lit(chunk).cast("long").alias(_CHUNK), *folds)


def position(
    df: DataFrame,
    keys: Sequence[str],
    seq: str | Sequence[str],
    *,
    name: str = "pos",
    chunk: int | Column | Cut | None = None,
) -> DataFrame:
    """Add the 1-based place of each row within its key."""
    return running(df, keys, seq, {name: run_count()}, chunk=chunk)


def previous(
    df: DataFrame,
    keys: Sequence[str],
    seq: str | Sequence[str],
    values: dict[str, str | Column],
    *,
    chunk: int | Column | Cut | None = None,
) -> DataFrame:
    """Add the value each expression had on the key's preceding row."""
    rules = {name: run_last(value) for name, value in values.items()}
    return running(df, keys, seq, rules, chunk=chunk, include_current=False)


def row_frame(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    before: int,
    exprs: Callable[[WindowSpec, WindowSpec], dict[str, Column]],
    *,
    block: int | None = None,
) -> DataFrame:
    """Window expressions over the ``before`` preceding rows and the current one.

    ``pos`` is the dense place from :func:`position`.  Places are cut into
    blocks; the last ``before`` rows of a block are also sent to the next one,
    so every frame is complete inside one bounded group.  ``exprs`` receives
    the framed window and the bare ordered window (for lag and lead back).
    """
    block = max(block or CHUNK_ROWS, before + 1)
    number = floor_div(F.col(pos) - 1, block)
    to_next = floor_div(F.col(pos) - 1 + before, block)
    rows = df.withColumn("_block", F.explode(F.sequence(number, to_next)))
    ordered = Window.partitionBy(*keys, "_block").orderBy(pos)
    framed = ordered.rowsBetween(-before, 0)
    done = rows.withColumns(exprs(framed, ordered))
    return done.filter(F.col("_block") == number).drop("_block")


def written(df: DataFrame, label: str) -> DataFrame:
    """The table written to the shared folder and read again: computed once, whoever reads it."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same_row(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equal columns, nulls being equal to nulls."""
    same = F.lit(True)
    for a, b in zip(left, right):
        same = same & F.col(a).eqNullSafe(F.col(b))
    return same


def by_size(df: DataFrame, groups: Sequence[str]) -> tuple[DataFrame, DataFrame | None, int]:
    """Rows of ordinary groups, rows of hot ones, and into how many ranges the latter are to be cut.

    One pre-aggregated count per group; two numbers come to the driver.  The
    hot groups' names are written, so that Spark knows their size.
    """
    counts = df.groupBy(*groups).agg(F.count("*").alias("_n")).filter(F.col("_n") > HOT_ROWS)
    number, total = counts.agg(F.count("*"), F.sum("_n")).first()
    if not number:
        return df, None, 0
    names = [f"_hot_{i}" for i in range(len(groups))]
    hot = written(counts.select(*[F.col(g).alias(n) for g, n in zip(groups, names)]), "hot")
    same = same_row(groups, names)
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi"), -(-total // CHUNK_ROWS)


def places(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "place") -> DataFrame:
    """Add the 1-based place of every row in its group, by ascending ``order``, which must not tie.

    Groups of ordinary size take Spark's own row number.  Hot ones are cut into
    ranges at splitters that Spark samples from them, also between equal values
    of the first order columns; a row's place is its place in its range after
    the counts of the ranges before.
    """
    groups, order = list(groups), list(order)
    cold, hot, parts = by_size(df, groups)
    number = F.row_number().over(Window.partitionBy(*groups).orderBy(*order)).cast("long")
    placed = cold.withColumn(name, number)
    if hot is None:
        return placed
    cut = in_sorted_parts(hot, [*groups, *order], parts)
    rest = position(cut, groups, order, name=name, chunk=F.col("_part")).drop("_part")
    return placed.unionByName(rest)


def in_sorted_parts(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """The table cut into ranges of ``order``, with the range number as ``_part``.

    For order columns without a natural chunk, such as doubles.  Spark samples
    the columns and cuts ranges of even size, also through the middle of a hot
    key.  The result is a table written to the shared folder, because range
    numbers must not change between the two readings of a scan.
    """
    cut = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return written(cut.withColumn("_part", F.spark_partition_id().cast("long")), "sorted")
