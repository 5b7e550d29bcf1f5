"""Per-record operators on streams, one small state per key.

Rows of a key are taken in the order of ``seq`` within each micro-batch, and
micro-batches are taken as they arrive.  Every operator has a ``ttl``: state
that was not written for that long is forgotten (processing time, as Spark
counts it); without one, state lives as long as the job.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.durations import millis
from millrace.operators.rolling import Keys, as_list
from millrace.streaming import buckets

Step = Callable[[tuple | None, Row], tuple[tuple, list[tuple]]]


class Fold(StatefulProcessor):
    """Folds a key's rows with ``step(state, row) -> (state, outputs)``."""

    def __init__(self, state: T.StructType, output: T.StructType, seq: str, step: Step, ttl):
        self._schema, self._seq, self._step, self._ttl = state, seq, step, ttl
        self._row = Row(*output.fieldNames())

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("fold", self._schema, self._ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self._state.get() if self._state.exists() else None
        for row in sorted(rows, key=lambda r: r[self._seq]):
            state, outputs = self._step(state, row)
            for out in outputs:
                yield self._row(*key, *out)
        if state is not None:
            self._state.update(tuple(state))

    def close(self) -> None:
        pass


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType) for n in names]


def fold(
    df: DataFrame,
    key: Keys,
    seq: str,
    state: str | T.StructType,
    output: T.StructType,
    step: Step,
    ttl: int | str | None = None,
) -> DataFrame:
    """General keyed fold: ``output`` lists the columns after the key.

    Pass only the columns the step reads: all of them travel to Python.
    """
    keys = as_list(key)
    schema = T.StructType(_fields(df, keys) + output.fields)
    state = T._parse_datatype_string(state) if isinstance(state, str) else state
    # State that expires is a processing-time notion in Spark.
    mode = "None" if ttl is None else "ProcessingTime"
    processor = Fold(state, schema, seq, step, None if ttl is None else millis(ttl))
    return df.groupBy(*keys).transformWithState(processor, schema, "Append", mode)


def _struct(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


_COMBINE: dict[str, Callable] = {
    "first": lambda old, new: old,
    "last": lambda old, new: new,
    "sum": lambda old, new: new if old is None else old if new is None else old + new,
    "min": lambda old, new: new if old is None else old if new is None else min(old, new),
    "max": lambda old, new: new if old is None else old if new is None else max(old, new),
}


def rolling_reduce_stream(
    df: DataFrame, key: Keys, seq: str, ttl=None, **rules: str
) -> DataFrame:
    """Updated record per arriving record; rules are first, last, sum, min or max."""
    names = list(rules)
    combine = [_COMBINE[rules[n]] for n in names]

    def step(state, row):
        new = [row[n] for n in names]
        held = new if state is None else [f(o, v) for f, o, v in zip(combine, state, new)]
        return tuple(held), [(row[seq], *held)]

    fields = T.StructType(_fields(df, names))
    output = T.StructType(_fields(df, [seq]) + fields.fields)
    read = df.select(*as_list(key), seq, *names)
    return fold(read, key, seq, fields, output, step, ttl)


def rolling_fold_stream(
    df: DataFrame, key: Keys, seq: str, initial: object, fn: Callable, result: str, ttl=None
) -> DataFrame:
    """Fold with any function ``fn(acc, row)``; ``result`` is the DDL of one column."""
    state = _struct(result)
    output = T.StructType(_fields(df, [seq]) + state.fields)

    def step(held, row):
        acc = fn(initial if held is None else held[0], row)
        return (acc,), [(row[seq], acc)]

    return fold(df, key, seq, state, output, step, ttl)


def rolling_extreme_stream(
    df: DataFrame, key: Keys, value: str, seq: str, largest: bool = True, ttl=None
) -> DataFrame:
    """The whole record of the running extreme; a tie keeps the earlier record."""
    keys = as_list(key)
    names = [c for c in df.columns if c not in {*keys, seq}]
    at = names.index(value)
    fields = T.StructType(_fields(df, names))

    def step(state, row):
        new = tuple(row[n] for n in names)
        if new[at] is not None:
            better = state is None or state[at] is None or (
                new[at] > state[at] if largest else new[at] < state[at]
            )
            state = new if better else state
        shown = state if state is not None else (None,) * len(names)
        return state, [(row[seq], *shown)]

    return fold(df, key, seq, fields, T.StructType(_fields(df, [seq]) + fields.fields), step, ttl)


def last_n_stream(
    df: DataFrame, key: Keys, seq: str, value: str, n: int, agg: str = "sum", ttl=None
) -> DataFrame:
    """sum, min, max, count or avg over the last n records of the key."""
    from statistics import fmean

    fn = {"sum": sum, "min": min, "max": max, "count": len, "avg": fmean}[agg]
    state = _struct("held array<double>")
    output = T.StructType(_fields(df, [seq]) + _struct(f"{agg}_{value} double").fields)

    def step(held, row):
        kept = [*(held[0] if held else []), row[value]][-n:]
        known = [float(v) for v in kept if v is not None]
        return (kept,), [(row[seq], float(fn(known)) if known or agg == "count" else None)]

    return fold(df.select(*as_list(key), seq, value), key, seq, state, output, step, ttl)


def count_window_stream(
    df: DataFrame, key: Keys, seq: str, value: str, size: int, slide: int | None = None, ttl=None
) -> DataFrame:
    """(key, fire, n, total): count windows, tumbling or sliding."""
    every = slide or size
    state = _struct("seen long, held array<double>")

    def step(held, row):
        seen, kept = (held[0], list(held[1])) if held else (0, [])
        seen, kept = seen + 1, [*kept, row[value]][-size:]
        total = float(sum(v for v in kept if v is not None))
        fires = [(seen, len(kept), total)] if seen % every == 0 else []
        return (seen, kept), fires

    read = df.select(*as_list(key), seq, value)
    return fold(read, key, seq, state, _struct("fire long, n long, total double"), step, ttl)


def fire_every_stream(
    df: DataFrame, keys: Sequence[str], seq: str, value: str, every: int, ttl=None
) -> DataFrame:
    """(keys, seq, n, total) at every ``every``-th element; give the window as a key."""
    output = T.StructType(_fields(df, [seq]) + _struct("n long, total double").fields)

    def step(held, row):
        n, total = held if held else (0, 0.0)
        n, total = n + 1, total + (row[value] or 0.0)
        return (n, total), [(row[seq], n, total)] if n % every == 0 else []

    read = df.select(*keys, seq, value)
    return fold(read, list(keys), seq, _struct("n long, total double"), output, step, ttl)


def retract_group_stream(df: DataFrame, key: Keys, value: str, seq: str, ttl=None) -> DataFrame:
    """Running sum as (key, flag, value, seq): false withdraws, true adds."""
    kind = df.schema[value].dataType
    state = T.StructType([T.StructField("total", kind)])
    output = T.StructType(
        [T.StructField("flag", T.BooleanType()), T.StructField(value, kind)] + _fields(df, [seq])
    )

    def step(held, row):
        if held is None:
            return (row[value],), [(True, row[value], row[seq])]
        old = held[0]
        new = _COMBINE["sum"](old, row[value])
        if new == old:
            return (old,), []
        return (new,), [(False, old, row[seq]), (True, new, row[seq])]

    return fold(df.select(*as_list(key), seq, value), key, seq, state, output, step, ttl)


def _enter(top: list[tuple[float, int]], value: float, seq: int, n: int):
    """Put a value into a list of the best n; gives the entries this causes.

    ``top`` holds (-value, seq) in ascending order and is changed in place.
    """
    place = bisect.bisect(top, (-value, seq))
    if place >= n:
        return []
    gone = [(False, -v, rank, seq) for rank, (v, _) in enumerate(top[place:], place + 1)]
    top.insert(place, (-value, seq))
    del top[n:]
    return gone + [(True, -v, rank, seq) for rank, (v, _) in enumerate(top[place:], place + 1)]


def top_n_stream(df: DataFrame, key: Keys, value: str, seq: str, n: int, ttl=None) -> DataFrame:
    """Changes of a top-n list as (key, flag, value, rank, seq)."""
    state = _struct("best array<struct<v: double, s: long>>")
    output = _struct(f"flag boolean, `{value}` double, `rank` long, seq long")

    def step(held, row):
        top = [(b[0], b[1]) for b in held[0]] if held else []
        entries = [] if row[value] is None else _enter(top, float(row[value]), row[seq], n)
        return (top,), entries

    return fold(df.select(*as_list(key), seq, value), key, seq, state, output, step, ttl)


def jump_alert_stream(
    df: DataFrame, key: Keys, seq: str, value: str, threshold: float, first: str = "skip", ttl=None
) -> DataFrame:
    """(key, seq, previous, current) where the value moved by more than a threshold."""
    start = {"skip": None, "zero": (0.0,)}[first]
    output = T.StructType(_fields(df, [seq]) + _struct("previous double, current double").fields)

    def step(held, row):
        before, now = held or start, row[value]
        jumped = (
            before is not None
            and before[0] is not None
            and now is not None
            and abs(now - before[0]) > threshold
        )
        return (now,), [(row[seq], before[0], now)] if jumped else []

    read = df.select(*as_list(key), seq, value)
    return fold(read, key, seq, _struct("last double"), output, step, ttl)


def pattern_times_stream(
    df: DataFrame,
    key: Keys,
    seq: str,
    hit: str,
    times: int,
    ts: str | None = None,
    strict: bool = False,
    within: int | str | None = None,
    ttl=None,
) -> DataFrame:
    """(key, first, last) of ``times`` records whose boolean column ``hit`` is true."""
    limit = None if within is None else millis(within) * 1000
    output = T.StructType(
        [T.StructField(n, df.schema[seq].dataType) for n in ("first", "last")]
    )

    def micros(row):
        return int(row[ts].timestamp() * 1_000_000) if ts else 0

    def step(held, row):
        run = [(r[0], r[1]) for r in held[0]] if held else []
        if not row[hit]:
            return ([] if strict else run,), []
        run = [*run, (row[seq], micros(row))]
        if len(run) < times:
            return (run,), []
        fits = limit is None or run[-1][1] - run[0][1] <= limit
        found = [(run[0][0], run[-1][0])] if fits else []
        return (run[1:],), found

    read = df.select(*as_list(key), seq, hit, *([ts] if ts else []))
    return fold(read, key, seq, _struct("run array<struct<s: long, t: long>>"), output, step, ttl)


class ChangeTotals(StatefulProcessor):
    """Count, sum, least and largest value of a key's rows, under additions and withdrawals.

    Each value's number of rows is an entry of a map, so a batch writes only the
    values it touches.  The map's keys are read again only when the least or
    largest value has lost its last row.
    """

    def __init__(self, schema: T.StructType, kind: T.DataType, ttl):
        self._row, self._ttl = Row(*schema.fieldNames()), ttl
        self._value = T.StructType([T.StructField("v", kind)])
        self._totals = T.StructType(
            [T.StructField("n", T.LongType()), T.StructField("total", schema["total"].dataType)]
            + [T.StructField(c, kind) for c in ("low", "high")]
        )

    def init(self, handle: StatefulProcessorHandle) -> None:
        times = T.StructType([T.StructField("n", T.LongType())])
        self._times = handle.getMapState("times", self._value, times, self._ttl)
        self._held = handle.getValueState("totals", self._totals, self._ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        moved: dict = {}
        change = 0
        for row in rows:
            sign = 1 if row["flag"] else -1
            change += sign
            if row["value"] is not None:
                moved[row["value"]] = moved.get(row["value"], 0) + sign
        n, total, low, high = self._held.get() if self._held.exists() else (0, None, None, None)
        gone = False
        for value, by in moved.items():
            if not by:
                continue
            held = self._times.getValue((value,)) if self._times.containsKey((value,)) else (0,)
            total = (value - value if total is None else total) + value * by
            if held[0] + by:
                self._times.updateValue((value,), (held[0] + by,))
                low = value if low is None or value < low else low
                high = value if high is None or value > high else high
            else:
                self._times.removeKey((value,))
                gone = gone or value == low or value == high
        if gone:
            known = [k[0] for k in self._times.keys()]
            low, high = min(known, default=None), max(known, default=None)
            total = total if known else None
        self._held.update((n + change, total, low, high))
        yield self._row(*key, n + change, total, low, high)

    def close(self) -> None:
        pass


class BucketTotals(StatefulProcessor):
    """What :class:`ChangeTotals` gives, for ever and for a bucket of keys at once.

    Rows are (keys, flag, value).  Of every key there are the totals and each
    value's number of rows.
    """

    def __init__(self, keys: int):
        self._keys = keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._held = handle.getValueState("totals", "held binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from buckets.told(self._totals(buckets.rows_of(rows)))

    def _totals(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        at = self._keys
        come: dict = {}
        for row in rows:
            come.setdefault(row[:at], []).append((1 if row[at] else -1, row[at + 1]))
        held = self._held.get()
        known = {} if held is None else buckets.unpacked(held)
        for name, changes in come.items():
            n, total, low, high, times = known.get(name, (0, None, None, None, {}))
            moved: dict = {}
            for sign, value in changes:
                n += sign
                if value is not None:
                    # NaN is no key: it differs from itself
                    value = value if value == value else "nan"
                    moved[value] = moved.get(value, 0) + sign
            gone = False
            for entry, by in moved.items():
                if not by:
                    continue
                value, left = (float("nan") if entry == "nan" else entry), times.get(entry, 0) + by
                total = (value - value if total is None else total) + value * by
                if left:
                    times[entry] = left
                    low = value if low is None or value < low else low
                    high = value if high is None or value > high else high
                else:
                    del times[entry]
                    gone = gone or value == low or value == high
            if gone:
                values = [float("nan") if entry == "nan" else entry for entry in times]
                low, high = min(values, default=None), max(values, default=None)
                total = total if values else None
            known[name] = (n, total, low, high, times)
            yield (*name, n, total, low, high)
        self._held.update(buckets.packed(known))

    def close(self) -> None:
        pass


def change_totals_stream(df: DataFrame, key: Keys, value: str, flag: str = "flag", ttl=None) -> DataFrame:
    """(key, n, total, low, high) of a changelog's rows, anew whenever a batch changes a key.

    ``flag`` says whether a row is added or withdrawn; a withdrawal may come
    before or with what it withdraws, as long as both come.  A key whose rows
    are all withdrawn is given with ``n`` 0.  Null values count in ``n`` only.
    """
    keys = as_list(key)
    kind = df.schema[value].dataType
    wide = T.DoubleType() if isinstance(kind, (T.FloatType, T.DoubleType)) else kind if isinstance(kind, T.DecimalType) else T.LongType()
    totals = [T.StructField("n", T.LongType()), T.StructField("total", wide)]
    schema = T.StructType(_fields(df, keys) + totals + [T.StructField(c, kind) for c in ("low", "high")])
    read = df.select(*keys, df[flag].alias("flag"), df[value].alias("value"))
    numeric = isinstance(kind, (T.IntegralType, T.FloatType, T.DoubleType, T.DecimalType))
    if ttl is None and numeric and buckets.fits(*[df.schema[k].dataType for k in keys]):
        found = buckets.dealt(read, *keys).transformWithState(BucketTotals(len(keys)), buckets.DATA, "Append", "None")
        return buckets.spread(found, schema)
    processor = ChangeTotals(schema, kind, None if ttl is None else millis(ttl))
    return read.groupBy(*keys).transformWithState(processor, schema, "Append", "None" if ttl is None else "ProcessingTime")


class ItemCounts(StatefulProcessor):
    """Counts per item of a key, each an entry of a map: a batch reads and writes the items it has."""

    def __init__(self, schema: T.StructType, item: T.StructField, seq: str, ttl):
        self._row, self._seq, self._ttl = Row(*schema.fieldNames()), seq, ttl
        self._item = T.StructType([item])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._counts = handle.getMapState("counts", self._item, "n long", self._ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held: dict = {}
        for row in sorted(rows, key=lambda r: r[self._seq]):
            item = row[self._item[0].name]
            if item not in held:
                held[item] = self._counts.getValue((item,))[0] if self._counts.containsKey((item,)) else 0
            held[item] += 1
            yield self._row(*key, item, row[self._seq], held[item])
        for item, n in held.items():
            self._counts.updateValue((item,), (n,))

    def close(self) -> None:
        pass


def item_counts_stream(df: DataFrame, key: Keys, item: str, seq: str, ttl=None) -> DataFrame:
    """(key, item, seq, n): with every record, how often its item has come under its key.

    The table form is :func:`millrace.operators.rolling.rolling_count` over key
    and item.  ``ttl`` forgets an item, by itself, that has not come for so long.
    """
    keys = as_list(key)
    read = df.select(*keys, item, seq)
    schema = T.StructType([*_fields(read, [*keys, item, seq]), T.StructField("n", T.LongType())])
    processor = ItemCounts(schema, read.schema[item], seq, None if ttl is None else millis(ttl))
    return read.groupBy(*keys).transformWithState(processor, schema, "Append", "None" if ttl is None else "ProcessingTime")
