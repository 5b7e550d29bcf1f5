"""Add columns from a dimension table, a region table or an outside service."""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.rolling import Keys, as_list
from millrace.session import fresh_dir


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    key: Keys,
    cols: Sequence[str],
    dim_order: str | None = None,
) -> DataFrame:
    """One output row per input row; no match gives nulls, the last match wins.

    The join carries no broadcast hint: Spark broadcasts the dimension when its
    measured size is below the configured threshold and shuffles it otherwise.
    """
    keys = as_list(key)
    order = [F.col(dim_order)] if dim_order else [F.col(c) for c in cols]
    one = dim.groupBy(*keys).agg(
        F.max_by(F.struct(*cols), F.struct(*order)).alias("_dim")
    )
    return df.join(one, keys, "left").select(
        *df.columns, *[F.col(f"_dim.{c}").alias(c) for c in cols]
    )


class Refreshing:
    """A dimension that is read again once it is older than ``seconds``.

    Each reading is written to the shared folder, so that batches within the
    time meet the same rows and the source's files may be replaced meanwhile.
    """

    def __init__(self, load: Callable[[], DataFrame], seconds: float):
        self._load, self._seconds = load, seconds
        self._frame: DataFrame | None = None
        self._read_at = 0.0

    def get(self) -> DataFrame:
        if self._frame is None or time.monotonic() - self._read_at >= self._seconds:
            loaded = self._load()
            path = fresh_dir(loaded.sparkSession, "dimension")
            loaded.write.parquet(path)
            self._frame = loaded.sparkSession.read.schema(loaded.schema).parquet(path)
            self._read_at = time.monotonic()
        return self._frame


def config_join(df: DataFrame, dim: DataFrame, key: Keys, order: str | None = None) -> DataFrame:
    """Keep the rows whose key is in the newest dimension and append its columns.

    A key has one value: of several dimension rows the one with the largest
    ``order`` counts, or without it the largest row.
    """
    keys = as_list(key)
    rest = [c for c in dim.columns if c not in keys]
    if not rest:
        return df.join(dim.distinct(), keys, "inner")
    row = F.struct(*rest)
    one = dim.groupBy(*keys).agg(F.max_by(row, F.struct(F.col(order), row) if order else row).alias("_dim"))
    one = one.select(*keys, *[F.col(f"_dim.{c}").alias(c) for c in rest])
    return df.join(one, keys, "inner")


def broadcast_enrich(
    df: DataFrame,
    load_dim: Callable[[], DataFrame],
    key: Keys,
    refresh_seconds: float = 60.0,
    sink: Callable[[DataFrame, int], None] | None = None,
    order: str | None = None,
):
    """Join with the newest dimension, one row per key (see :func:`config_join`).

    A table is joined once.  A stream needs a ``sink(frame, batch_id)`` and
    gives back a stream writer: each micro-batch joins the dimension as read at
    most ``refresh_seconds`` ago.  The dimension is loaded before the first batch.
    """
    if not df.isStreaming:
        return config_join(df, load_dim(), key, order)
    if sink is None:
        raise ValueError("a stream needs a sink")
    dim = Refreshing(load_dim, refresh_seconds)
    dim.get()
    return df.writeStream.foreachBatch(
        lambda batch, batch_id: sink(config_join(batch, dim.get(), key, order), batch_id)
    )


def geo_region_join(
    df: DataFrame,
    regions: DataFrame,
    lon: str,
    lat: str,
    name: str = "province",
    cell: float = 5.0,
) -> DataFrame:
    """Name of the region whose box holds each point, null outside all boxes.

    ``regions`` has name, lon_lo, lon_hi, lat_lo, lat_hi; upper bounds are
    exclusive.  Boxes are cut into grid cells and points meet them by equal
    cell.  Where boxes overlap the alphabetically first name wins.  Every
    distinct coordinate is resolved once.
    """

    def cell_of(value):
        return F.floor(value / F.lit(cell)).cast("long")

    grid = regions.select(
        F.col(name).alias("_name"),
        "lon_lo",
        "lon_hi",
        "lat_lo",
        "lat_hi",
        F.explode(F.sequence(cell_of(F.col("lon_lo")), cell_of(F.col("lon_hi")))).alias("_cx"),
        F.col("lat_lo").alias("_a"),
        F.col("lat_hi").alias("_b"),
    )
    grid = grid.withColumn(
        "_cy", F.explode(F.sequence(cell_of(F.col("_a")), cell_of(F.col("_b"))))
    ).drop("_a", "_b")
    points = df.select(F.col(lon).alias("_lon"), F.col(lat).alias("_lat")).distinct()
    points = points.withColumns(
        {"_px": cell_of(F.col("_lon")), "_py": cell_of(F.col("_lat"))}
    )
    hit = (
        (F.col("_px") == F.col("_cx"))
        & (F.col("_py") == F.col("_cy"))
        & (F.col("_lon") >= F.col("lon_lo"))
        & (F.col("_lon") < F.col("lon_hi"))
        & (F.col("_lat") >= F.col("lat_lo"))
        & (F.col("_lat") < F.col("lat_hi"))
    )
    named = points.join(grid, hit).groupBy("_lon", "_lat").agg(F.min("_name").alias(name))
    cond = (F.col(lon) == F.col("_lon")) & (F.col(lat) == F.col("_lat"))
    return df.join(named, cond, "left").select(*df.columns, name)


def enrich_map(
    df: DataFrame,
    keys: Keys,
    fetch: Callable[..., dict | None],
    schema: str,
    capacity: int = 10,
    timeout: float = 3.0,
    tasks: int | None = None,
) -> DataFrame:
    """Call ``fetch(*key)`` once per distinct key and join the answers back.

    Per task at most ``capacity`` calls are in flight, over ``tasks`` tasks (by
    default one per core: waiting for answers, not data size, sets the pace);
    the next call starts as soon as one is done.  A call that fails or takes
    longer than ``timeout`` seconds from its start gives nulls, and its place is
    free for the next one; its rows are kept.
    """
    keys = as_list(keys)
    tasks = tasks or df.sparkSession.sparkContext.defaultParallelism
    key_ddl = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    answers = [c.strip().split()[0].strip("`") for c in schema.split(",")]

    def answered(rows: list[tuple]) -> list[dict]:
        found: list[dict] = [{}] * len(rows)
        done: queue.SimpleQueue = queue.SimpleQueue()

        def call(place: int, row: tuple) -> None:
            try:
                done.put((place, fetch(*row) or {}))
            except Exception:  # noqa: BLE001 - any failed call means "no answer"
                done.put((place, {}))

        waiting, due = iter(enumerate(rows)), {}
        while True:
            while len(due) < capacity and (following := next(waiting, None)) is not None:
                due[following[0]] = time.monotonic() + timeout
                # A thread of its own: one that hangs takes no other call's place.
                threading.Thread(target=call, args=following, daemon=True).start()
            if not due:
                return found
            try:
                place, answer = done.get(timeout=max(0.0, min(due.values()) - time.monotonic()))
                if due.pop(place, None) is not None:
                    found[place] = answer
            except queue.Empty:
                now = time.monotonic()
                due = {place: at for place, at in due.items() if at > now}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = answered(list(batch[keys].itertuples(index=False, name=None)))
            out = batch[keys].reset_index(drop=True)
            for name in answers:
                out[name] = pd.Series([f.get(name) for f in found], dtype="object")
            yield out

    distinct = df.select(*keys).distinct().repartition(tasks, *keys)
    resolved = distinct.mapInPandas(run, f"{key_ddl}, {schema}")
    renamed = resolved.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return df.join(renamed, same, "left").select(*df.columns, *answers)
