"""Tables as the input of streaming jobs, for the registered queries and the tests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import configure, fresh_dir
from millrace.streaming.batches import Sink, folder_sink
from millrace.streaming.run import drain


def feed(
    spark: SparkSession,
    inputs: dict[str, tuple[DataFrame, str]],
    transform: Callable[..., DataFrame],
    each: Callable[[str], Sink],
    mode: str = "append",
    rounds: int = 2,
    closing: dict[str, dict[str, object]] | None = None,
    partitions: int | None = None,
) -> tuple[str, DataFrame]:
    """Feed tables to a streaming job in ``rounds`` arrivals.

    Each input is (table, arrival column); the arrival columns share one scale.
    An arrival adds one slice of every table, in order, as new files; the job
    then starts from its checkpoint, takes exactly that slice and stops.
    ``closing`` gives, per input, the values of one row that arrives at the end,
    by itself, other columns being null: late enough in time, it moves the
    watermark past all data, so that nothing stays open.  ``each`` makes the
    batch function from the run's folder.  State has ``partitions`` partitions,
    by default one per core.  Returns that folder and the stream.
    """
    configure(spark)
    partitions = partitions or spark.sparkContext.defaultParallelism
    base = fresh_dir(spark, "replay")
    ends = []
    for table, order in inputs.values():
        ends += [end for end in table.agg(F.min(order), F.max(order)).first() if end is not None]
    low, high = min(ends, default=0), max(ends, default=0)
    width = (high - low) // rounds + 1
    sink = each(base)
    for number in range(rounds + bool(closing)):
        for name, (table, order) in inputs.items():
            if number == rounds:
                last = spark.range(1).select(
                    *[
                        F.lit(closing.get(name, {}).get(f.name)).cast(f.dataType).alias(f.name)
                        for f in table.schema.fields
                    ]
                )
                last.filter(F.lit(name in closing)).write.mode("append").parquet(f"{base}/in/{name}")
                continue
            # A plain range, so that the scan skips what other rounds hold.
            start = low + number * width
            here = (F.col(order) >= start) & (F.col(order) < start + width)
            if number == 0:
                here = here | F.col(order).isNull()
            table.filter(here).write.mode("append").parquet(f"{base}/in/{name}")
        out = transform(
            *[
                spark.readStream.schema(table.schema).parquet(f"{base}/in/{name}")
                for name, (table, _) in inputs.items()
            ]
        )
        drain(out, sink, f"{base}/checkpoint", mode, partitions)
    return base, out


def replay(
    spark: SparkSession,
    inputs: dict[str, tuple[DataFrame, str]],
    transform: Callable[..., DataFrame],
    mode: str = "append",
    **kw,
) -> DataFrame:
    """The whole output of a streaming job fed by :func:`feed`, with its ``batch``."""
    base, out = feed(
        spark, inputs, transform, lambda base: folder_sink(f"{base}/out"), mode, **kw
    )
    return spark.read.schema(out.schema.add("batch", "long")).parquet(f"{base}/out")


def newest(written: DataFrame, keys: list[str]) -> DataFrame:
    """The last version of each key written by an update-mode job."""
    rest = [c for c in written.columns if c not in {*keys, "batch"}]
    last = written.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch")).alias("_r"))
    return last.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
