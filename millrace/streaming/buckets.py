"""State of many keys held together, for keyed state on streams without a ``ttl``.

A call to the state store, and a row handed to a stateful Python operator, cost
far more than what is done with them.  Keys are therefore dealt to a fixed
number of buckets by hash; a bucket's rows come to the operator packed, its
state is read and written in large entries, and its results leave packed.  A
batch then costs a few calls for each bucket instead of each key.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Fixed for the life of a job: a key's bucket must not change.
BUCKETS = 1 << 10
#: Rows that are dealt at once, and rows of a state entry.
GATHER, ENTRY = 1 << 16, 1000
#: Rows and bytes of a pack; Spark moves up to 10,000 packs at once.
PACK_ROWS, PACK_BYTES = 100, 1 << 13

_PLAIN = (T.IntegralType, T.StringType, T.BooleanType, T.DateType, T.DecimalType)
_PACKED = "_bucket int, data binary"
DATA = T.StructType([T.StructField("data", T.BinaryType())])


def fits(*kinds: T.DataType) -> bool:
    """Whether keys are equal in Python exactly if they are for Spark."""
    return all(isinstance(kind, _PLAIN) for kind in kinds)


def carries(*kinds: T.DataType) -> bool:
    """Whether values come back from Python as they went there, whatever the worker's time zone."""
    return all(isinstance(kind, (*_PLAIN, T.FloatType, T.DoubleType)) for kind in kinds)


def packed(value: object) -> tuple[bytes]:
    return (pickle.dumps(value, 4),)


def unpacked(entry: tuple) -> object:
    return pickle.loads(entry[0])


def _deal(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(held)
    order = np.argsort(table["_bucket"].to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    at = table["_bucket"].to_numpy()
    columns = [c.to_pylist() for c in table.columns[1:]]
    edges = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
    most = max(1, min(PACK_ROWS, PACK_BYTES * len(at) // max(1, table.nbytes)))
    bounds = [(i, min(i + most, high)) for low, high in zip(edges, edges[1:]) for i in range(low, high, most)]
    for n in range(0, len(bounds), 256):
        some = bounds[n : n + 256]
        data = [packed([c[i:j] for c in columns])[0] for i, j in some]
        numbers = pa.array([int(at[i]) for i, _ in some], pa.int32())
        yield pa.RecordBatch.from_arrays([numbers, pa.array(data, pa.binary())], names=["_bucket", "data"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held, n = [*held, batch], n + batch.num_rows
        if n >= GATHER:
            yield from _deal(held)
            held, n = [], 0
    if held:
        yield from _deal(held)


def dealt(df: DataFrame, *keys: str):
    """The rows of ``df``, packed and grouped by the bucket of their ``keys``."""
    number: Column = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("_bucket")
    return df.select(number, *df.columns).mapInArrow(_pack, _PACKED).groupBy("_bucket")


def rows_of(packs: Iterator[Row]) -> Iterator[tuple]:
    """The rows of a bucket as tuples of their columns."""
    for pack in packs:
        yield from zip(*pickle.loads(pack[1]))


def told(rows: Iterator[tuple]) -> Iterator[Row]:
    """Results of a bucket, packed."""
    make, rows, most = Row("data"), iter(rows), PACK_ROWS
    while some := list(itertools.islice(rows, most)):
        data = packed(list(zip(*some)))[0]
        most = max(1, min(PACK_ROWS, PACK_BYTES * len(some) // len(data)))
        yield make(data)


def spread(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows that were packed by ``told``."""
    kinds, names = [to_arrow_type(f.dataType) for f in schema.fields], schema.fieldNames()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                packs = [pickle.loads(data) for data in batch["data"].slice(low, 64).to_pylist()]
                columns = [list(itertools.chain(*c)) for c in zip(*packs)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return df.mapInArrow(work, schema)
