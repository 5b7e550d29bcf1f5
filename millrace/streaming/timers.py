"""Trend alerts and window evictors with timers."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.durations import millis, text
from millrace.operators.rolling import Keys, as_list
from millrace.operators.windows import window_of


class TrendAlert(StatefulProcessor):
    """State is (last value, its time, armed time), times in microseconds.

    A pending alert is settled by the first later record at or after its due
    time, or by the timer when no such record comes.
    """

    def __init__(self, schema: T.StructType, value: str, seq: str, hold: int, sign: int,
                 ttl: int | None, event_time: bool):
        self._row = Row(*schema.fieldNames())
        self._value, self._seq, self._hold, self._sign = value, seq, hold, sign
        self._ttl, self._event_time = ttl, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("trend", "value double, at long, armed long")

    def _alert(self, key, armed: int) -> Row:
        return self._row(*key, armed, armed + self._hold)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last, last_at, armed = self._state.get() if self._state.exists() else (None, None, None)
        if armed is not None:
            self._handle.deleteTimer(self._due_ms(armed))
        if self._ttl is not None and last_at is not None:
            self._handle.deleteTimer(self._gone_ms(last_at))
        now = None if self._event_time else timerValues.getCurrentProcessingTimeInMs() * 1000
        for row in sorted(rows, key=lambda r: r[self._seq]):
            at = row["_at"] if self._event_time else now
            if armed is not None and armed + self._hold <= at:
                yield self._alert(key, armed)
                armed = None
            value = row[self._value]
            if value is None:
                continue
            if self._ttl is not None and last_at is not None and at - last_at > self._ttl:
                last = None
            step = 0.0 if last is None else self._sign * (value - last)
            if step > 0 and armed is None:
                armed = at
            elif step < 0:
                armed = None
            last, last_at = value, at
        self._state.update((last, last_at, armed))
        if armed is not None:
            self._handle.registerTimer(self._due_ms(armed))
        if self._ttl is not None and last_at is not None:
            self._handle.registerTimer(self._gone_ms(last_at))

    def _gone_ms(self, last_at: int) -> int:
        """When a value is too old to be compared with; its state is cleared then."""
        return -(-(last_at + self._ttl) // 1000) + 1

    def _due_ms(self, armed: int) -> int:
        return -(-(armed + self._hold) // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self._state.exists():
            return
        last, last_at, armed = self._state.get()
        due = expiredTimerInfo.getExpiryTimeInMs()
        if armed is not None and self._due_ms(armed) <= due:
            yield self._alert(key, armed)
            armed = None
            self._state.update((last, last_at, None))
        if self._ttl is not None and armed is None and self._gone_ms(last_at) <= due:
            self._state.clear()

    def close(self) -> None:
        pass


def trend_alert_stream(
    df: DataFrame,
    key: Keys,
    ts: str,
    value: str,
    hold: int | str,
    seq: str,
    direction: str = "rising",
    *,
    bound: int | str | None,
    ttl: int | str | None = None,
    time_mode: str = "event",
) -> DataFrame:
    """Every alert of every trend, as (key, armed_at, alert_at).

    After an alert the next move in the same direction arms the timer again.
    Records that come ``bound`` later than newer ones are dropped by Spark;
    None goes with the processing time only.
    ``ttl`` forgets the last value when the next record comes later than that,
    and frees the state of a key that is silent for so long.
    ``time_mode="processing"`` counts from the clock instead of ``ts``.
    """
    keys = as_list(key)
    sign = {"rising": 1, "falling": -1}[direction]
    event_time = {"event": True, "processing": False}[time_mode]
    schema = T.StructType(
        [T.StructField(k, df.schema[k].dataType) for k in keys]
        + [T.StructField("armed_us", T.LongType()), T.StructField("alert_us", T.LongType())]
    )
    rows = df.select(*keys, ts, seq, value, F.unix_micros(ts).alias("_at"))
    if event_time:
        rows = rows.withWatermark(ts, text(bound))
    processor = TrendAlert(
        schema, value, seq, millis(hold) * 1000, sign,
        None if ttl is None else millis(ttl) * 1000, event_time,
    )
    out = rows.groupBy(*keys).transformWithState(
        processor, schema, "Append", "EventTime" if event_time else "ProcessingTime"
    )
    return out.select(
        *keys,
        F.timestamp_micros("armed_us").alias("armed_at"),
        F.timestamp_micros("alert_us").alias("alert_at"),
    )


class Evictor(StatefulProcessor):
    """The newest records of a window, and their aggregates once it closes.

    A record is an entry of a map; records that fall out are removed one by one,
    so a batch writes what comes and what goes and not the window.
    """

    def __init__(self, schema: T.StructType, seq: str, value: str, keep_n: int | None, keep_us: int | None):
        self._row, self._names = Row(*schema.fieldNames()), (seq, value)
        self._keep_n, self._keep_us = keep_n, keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._records = handle.getMapState("records", "at long, seq long", "value double")

    def _kept(self, places: list[tuple[int, int]]) -> set[tuple[int, int]]:
        if self._keep_n is not None:
            return set(sorted(places, key=lambda p: p[1])[-self._keep_n :])
        newest = max(at for at, _ in places)
        return {p for p in places if p[0] >= newest - self._keep_us}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seq, value = self._names
        new, end = {}, None
        for row in rows:
            end = row["_end_ms"]
            new[(row["_at"], row[seq])] = row[value]
        before = [tuple(p) for p in self._records.keys()]
        kept = self._kept([*before, *new])
        for place in before:
            if place not in kept:
                self._records.removeKey(place)
        for place, held in new.items():
            if place in kept:
                self._records.updateValue(place, (held,))
        if not before:
            self._handle.registerTimer(end)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        values = [v[0] for _, v in self._records.iterator()]
        known = [v for v in values if v is not None]
        self._records.clear()
        yield self._row(*key, len(values), sum(known) if known else None, min(known, default=None), max(known, default=None))

    def close(self) -> None:
        pass


def evict_stream(
    df: DataFrame, key: Keys, ts: str, size: int | str, seq: str, value: str,
    keep_n: int | None = None, keep_within: int | str | None = None, *, bound: int | str,
) -> DataFrame:
    """(key, window_start, window_end, n, total, low, high) over a window's last ``keep_n`` records by
    ``seq``, or over those at most ``keep_within`` older than its newest, when the window closes.

    State holds the records that may still count.  Records that come ``bound``
    later than newer ones are dropped by Spark.
    """
    if (keep_n is None) == (keep_within is None):
        raise ValueError("give either keep_n or keep_within")
    keys = as_list(key)
    w = window_of(ts, size)
    marked = df.withWatermark(ts, text(bound)).select(
        *keys, ts, F.col(seq).cast("long").alias(seq), F.col(value).cast("double").alias(value),
        F.unix_micros(ts).alias("_at"), w.start.alias("window_start"), w.end.alias("window_end"),
        F.unix_millis(w.end).alias("_end_ms"),
    )
    groups = [*keys, "window_start", "window_end"]
    schema = T.StructType(
        [T.StructField(g, marked.schema[g].dataType) for g in groups] + [T.StructField("n", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in ("total", "low", "high")]
    )
    processor = Evictor(schema, seq, value, keep_n, None if keep_within is None else millis(keep_within) * 1000)
    return marked.groupBy(*groups).transformWithState(processor, schema, "Append", "EventTime")


class WindowContent(StatefulProcessor):
    """All records of a window in a list that grows by what comes, given when the window closes."""

    def __init__(self, schema: T.StructType, fields: list[T.StructField]):
        self._row, self._fields = Row(*schema.fieldNames()), T.StructType(fields)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._records = handle.getListState("records", self._fields)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new, end = [], None
        for row in rows:
            end = row["_end_ms"]
            new.append(tuple(row[name] for name in self._fields.fieldNames()))
        if not self._records.exists():
            self._handle.registerTimer(end)
        self._records.appendList(new)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for place, record in enumerate(sorted(self._records.get(), key=lambda r: r[0]), 1):
            yield self._row(*key, place, record[1])
        self._records.clear()

    def close(self) -> None:
        pass


def window_content_stream(
    df: DataFrame, key: Keys, ts: str, size: int | str, seq: str, item: str, *, bound: int | str
) -> DataFrame:
    """(key, window_start, window_end, place, item): a window's records in the order of ``seq``, when it closes.

    One task gives a key's window; the table form, :func:`windows.window_list`,
    does not gather it.  Records that come ``bound`` later than newer ones are
    dropped by Spark.
    """
    keys = as_list(key)
    w = window_of(ts, size)
    marked = df.withWatermark(ts, text(bound)).select(
        *keys, ts, seq, item, w.start.alias("window_start"), w.end.alias("window_end"),
        F.unix_millis(w.end).alias("_end_ms"),
    )
    groups = [*keys, "window_start", "window_end"]
    schema = T.StructType(
        [T.StructField(g, marked.schema[g].dataType) for g in groups]
        + [T.StructField("place", T.LongType()), T.StructField("item", marked.schema[item].dataType)]
    )
    fields = [T.StructField("seq", marked.schema[seq].dataType), T.StructField("item", marked.schema[item].dataType)]
    rows = marked.withColumnsRenamed({seq: "seq", item: "item"}) if seq != item else marked.withColumns({"seq": F.col(seq), "item": F.col(item)})
    return rows.groupBy(*groups).transformWithState(WindowContent(schema, fields), schema, "Append", "EventTime")
