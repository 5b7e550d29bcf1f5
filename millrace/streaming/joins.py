"""Session joins and co-groups of streams, and their left join as a changelog."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.durations import millis, text
from millrace.operators.rolling import Keys, as_list
from millrace.streaming import buckets


def _closed_sessions(df, key: Keys, ts, gap, seq, item, first: Column, bound) -> DataFrame:
    """Sessions over both inputs' elements once they are closed, with their elements in order.

    ``df`` holds both inputs; ``first`` says which rows are the first input's.
    A session's elements become one row, which is what a co-group gives.
    """
    keys = as_list(key)
    if bound is not None:
        df = df.withWatermark(ts, text(bound))
    element = F.struct(F.col(seq).alias("seq"), first.alias("first"), F.col(item).alias("item"))
    window = F.session_window(ts, text(gap)).alias("w")
    held = df.groupBy(window, *keys).agg(F.array_sort(F.collect_list(element)).alias("held"))
    return held.select(*keys, F.col("w.start").alias("session_start"), "held")


def _items(held: Column, first: bool) -> Column:
    kept = F.filter(held, lambda e: e["first"] if first else ~e["first"])
    return F.transform(kept, lambda e: e["item"])


def session_join_stream(
    df: DataFrame, key: Keys, ts: str, gap, seq: str, item: str, first: Column, bound=None
) -> DataFrame:
    """(keys, session_start, first_item, second_item): the pairs of a session, when it closes."""
    out = _closed_sessions(df, key, ts, gap, seq, item, first, bound)
    out = out.withColumn("first_item", F.explode(_items(F.col("held"), True)))
    out = out.withColumn("second_item", F.explode(_items(F.col("held"), False)))
    return out.drop("held")


def session_cogroup_stream(
    df: DataFrame, key: Keys, ts: str, gap, seq: str, item: str, first: Column,
    every: int | None = None, bound=None,
) -> DataFrame:
    """Both groups of a session side by side, given when it closes.

    With ``every`` there is a row for each ``every``-th element, with all
    elements up to it, as :func:`millrace.operators.joins.session_cogroup` gives.
    """
    out = _closed_sessions(df, key, ts, gap, seq, item, first, bound)
    size = F.size("held")
    if every is None:
        out = out.withColumn("fire", size)
    else:
        out = out.filter(size >= every)
        out = out.withColumn("fire", F.explode(F.sequence(F.lit(every), size, F.lit(every))))
    shown = F.slice("held", 1, F.col("fire"))
    return out.select(
        *as_list(key), "session_start", F.col("fire").cast("long").alias("fire"),
        F.size(_items(shown, True)).cast("long").alias("n_first"),
        F.size(_items(shown, False)).cast("long").alias("n_second"),
        _items(shown, True).alias("first_items"), _items(shown, False).alias("second_items"),
    )


class Unmatched(StatefulProcessor):
    """Says when a left row is out without a partner, and withdraws it when its first partner comes.

    Such rows are entries of a list, each with a ttl of its own; the list is
    emptied by the first partner, and rows that find a partner never enter it.
    Beside it a key has one number, when its newest partner came.
    """

    def __init__(self, schema: T.StructType, left: list, ttl):
        self._row = Row(*schema.fieldNames())
        self._left, self._ttl = T.StructType(left), ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._alone = handle.getListState("alone", self._left, self._ttl)
        self._partner = handle.getValueState("partner", "at long", self._ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = 0 if self._ttl is None else timerValues.getCurrentProcessingTimeInMs()
        names, new = self._left.fieldNames(), []
        last = self._partner.get()
        last = None if last is None or self._ttl is not None and now - last[0] >= self._ttl else last[0]
        matched = last is not None
        for row in sorted(rows, key=lambda r: r["_seq"]):
            if row["_is_left"]:
                if not matched:
                    new.append(tuple(row[name] for name in names))
                    yield self._row(True, *key, *new[-1], row["_seq"])
                continue
            if not matched:
                for held in [*self._alone.get(), *new]:
                    yield self._row(False, *key, *held, row["_seq"])
                self._alone.clear()
                new, matched = [], True
            last = now
        if new:
            self._alone.appendList(new)
        if matched and last == now:
            self._partner.update((now,))

    def close(self) -> None:
        pass


class BucketJoin(StatefulProcessor):
    """The changelog of a left join, for ever and for a bucket of keys at once.

    Rows are (key, _seq, _is_left, left columns, right columns).  A batch adds
    its rows to its side's list, in entries of bounded size, and the keys that
    have got their first partner to another.  Entries are read one by one and
    only if the other side has new rows, so that a key with very many rows takes
    no more memory than those of one batch.
    """

    def __init__(self, lefts: int, rights: int):
        self._edge, self._nulls = 3 + lefts, (None,) * rights

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._partners = handle.getListState("partners", "keys binary")
        self._held = {True: handle.getListState("lefts", "rows binary"), False: handle.getListState("rights", "rows binary")}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from buckets.told(self._changes(buckets.rows_of(rows)))

    def _changes(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        nulls, edge = self._nulls, self._edge
        new: dict[bool, dict] = {True: {}, False: {}}  # by side and key, (seq, columns)
        for row in rows:
            side = row[2]
            new[side].setdefault(row[0], []).append((row[1], row[3:edge] if side else row[edge:]))
        lefts, rights = new[True], new[False]
        first = {name: min(seq for seq, _ in own) for name, own in rights.items()}
        matched = {name for entry in self._partners.get() for name in buckets.unpacked(entry)}

        def pair(name, left, right):
            return (True, name, *left[1], *right[1], _greatest(left[0], right[0]))

        for name, own in lefts.items():
            for left in own:
                # at the same time the left row is the first
                if name not in matched and (name not in rights or left[0] <= first[name]):
                    yield (True, name, *left[1], *nulls, left[0])
                    if name in rights:
                        yield (False, name, *left[1], *nulls, first[name])
                if name is not None:
                    for right in rights.get(name, ()):
                        yield pair(name, left, right)
        for entry in self._held[True].get() if rights else ():
            for name, left in buckets.unpacked(entry):
                if name in rights:
                    if name not in matched:
                        yield (False, name, *left[1], *nulls, first[name])
                    if name is not None:
                        for right in rights[name]:
                            yield pair(name, left, right)
        for entry in self._held[False].get() if lefts else ():
            for name, right in buckets.unpacked(entry):
                if name in lefts and name is not None:
                    for left in lefts[name]:
                        yield pair(name, left, right)

        for side, keys in new.items():
            entries = [(name, row) for name, own in keys.items() for row in own]
            if entries:
                size = buckets.ENTRY
                self._held[side].appendList([buckets.packed(entries[i : i + size]) for i in range(0, len(entries), size)])
        partners = [name for name in rights if name not in matched]
        if partners:
            self._partners.appendValue(buckets.packed(partners))

    def close(self) -> None:
        pass


def _greatest(a, b):
    return a if b is None or a is not None and a > b else b


class Pairs(StatefulProcessor):
    """Pairs of both sides' rows; each row is an entry of its side's list, with a ttl of its own."""

    def __init__(self, schema: T.StructType, left: list, right: list, ttl: int):
        self._row, self._ttl = Row(*schema.fieldNames()), ttl
        self._sides = {True: T.StructType(left), False: T.StructType(right)}

    def init(self, handle: StatefulProcessorHandle) -> None:
        names = {True: "lefts", False: "rights"}
        self._held = {side: handle.getListState(names[side], kind, self._ttl) for side, kind in self._sides.items()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows = sorted(rows, key=lambda r: r["_seq"])
        come = {row["_is_left"] for row in rows}
        # A side is read if a row of the other has come.
        known = {side: [tuple(r) for r in self._held[side].get()] if (not side) in come else [] for side in (True, False)}
        new: dict[bool, list] = {True: [], False: []}
        for row in rows:
            side = row["_is_left"]
            mine = tuple(row[name] for name in self._sides[side].fieldNames())
            for other in (*known[not side], *new[not side]):
                yield self._row(True, *key, *(mine + other if side else other + mine), row["_seq"])
            new[side].append(mine)
        for side, entries in new.items():
            if entries:
                self._held[side].appendList(entries)

    def close(self) -> None:
        pass


def changelog_left_join_stream(
    left: DataFrame,
    right: DataFrame,
    key: str,
    lseq: str,
    rseq: str,
    *,
    ttl: int | str | None,
) -> DataFrame:
    """(flag, key, left columns, right columns, seq): false withdraws, true adds.

    Every row of both sides is a state entry of its own, kept for ``ttl``; None
    keeps rows for ever and must be asked for.  For ever, rows are kept by
    buckets of keys (see :mod:`millrace.streaming.buckets`); where a column has a
    type that does not go there, the pairs are Spark's own join of two streams.
    With a ttl, which is a time of the clock and not of the rows, they come from
    lists whose entries expire, and left rows without a partner, and their
    withdrawal, need only those rows and the right side's numbers.
    """
    lefts = [f for f in left.schema.fields if f.name != key]
    rights = [f for f in right.schema.fields if f.name != key]
    last = None if ttl is None else millis(ttl)
    mode = "None" if ttl is None else "ProcessingTime"
    flag, seq = T.StructField("flag", T.BooleanType()), T.StructField("seq", T.LongType())
    sides = left.withColumns({"_seq": F.col(lseq).cast("long"), "_is_left": F.lit(True)})
    others = right.withColumns({"_seq": F.col(rseq).cast("long"), "_is_left": F.lit(False)})

    kinds = [f.dataType for f in (*lefts, *rights)]
    same = left.schema[key].dataType == right.schema[key].dataType
    if last is None and same and buckets.fits(left.schema[key].dataType) and buckets.carries(*kinds):
        names = [f.name for f in (*lefts, *rights)]
        both = sides.unionByName(others, allowMissingColumns=True)
        both = both.select(key, "_seq", "_is_left", *names)
        whole = T.StructType([flag, left.schema[key], *lefts, *rights, seq])
        found = buckets.dealt(both, key).transformWithState(BucketJoin(len(lefts), len(rights)), buckets.DATA, "Append", mode)
        return buckets.spread(found, whole)

    if last is None:
        columns = [key, *[f.name for f in lefts], *[f.name for f in rights]]
        pairs = left.join(right.withColumnRenamed(key, "_rk"), F.col(key) == F.col("_rk"))
        pairs = pairs.select(F.lit(True).alias("flag"), *columns, F.greatest(lseq, rseq).cast("long").alias("seq"))
    else:
        whole = T.StructType([flag, left.schema[key], *lefts, *rights, seq])
        both = sides.unionByName(others, allowMissingColumns=True)
        pairs = both.groupBy(key).transformWithState(Pairs(whole, lefts, rights, last), whole, "Append", mode)

    schema = T.StructType([flag, left.schema[key], *lefts, seq])
    tagged = sides.unionByName(others.select(key, "_seq", "_is_left"), allowMissingColumns=True)
    processor = Unmatched(schema, lefts, last)
    alone = tagged.groupBy(key).transformWithState(processor, schema, "Append", mode)
    alone = alone.withColumns({f.name: F.lit(None).cast(f.dataType) for f in rights})
    return pairs.unionByName(alone)
