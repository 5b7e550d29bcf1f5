"""Turn raw lines, sequences and records into typed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {"us": F.timestamp_micros, "ms": F.timestamp_millis, "s": F.timestamp_seconds}


def sequence(spark: SparkSession, low: int, high: int, partitions: int | None = None) -> DataFrame:
    """The integers low..high, both included, produced in parallel."""
    return spark.range(low, high + 1, numPartitions=partitions).withColumnRenamed("id", "value")


def lines(
    spark: SparkSession, path: str, streaming: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Text lines as ``value``; streaming reads files as they arrive in a folder."""
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def _route(df: DataFrame, bad: Column, on_error: str, message: str, raw: str):
    """Apply the bad-record policy to a frame holding a ``_bad`` flag."""
    flagged = df.withColumn("_bad", bad)
    if on_error == "fail":
        checked = flagged.withColumn(
            "_bad",
            F.when(
                F.col("_bad"),
                F.raise_error(F.concat(F.lit(message + ": "), F.coalesce(raw, F.lit("null")))),
            ).otherwise(False),
        )
        return checked.filter(~F.col("_bad")).drop("_bad"), None
    good = flagged.filter(~F.col("_bad")).drop("_bad")
    if on_error == "drop":
        return good, None
    if on_error == "side":
        return good, flagged.filter("_bad").select(raw)
    raise ValueError(f"on_error must be fail, drop or side, not {on_error!r}")


def parse_delimited(
    df: DataFrame,
    schema: T.StructType,
    sep: str = ",",
    on_error: str = "side",
    value: str = "value",
) -> tuple[DataFrame, DataFrame | None]:
    """Split each line, trim and cast the fields; returns (good, bad).

    A line is bad when it has too few fields or a field does not cast.
    Columns other than ``value`` are kept.
    """
    parts = F.split(F.col(value), f"\\Q{sep}\\E", -1)
    with_parts = df.withColumn("_parts", parts)
    fields = {
        f.name: F.trim(F.get(F.col("_parts"), F.lit(i))).try_cast(f.dataType)
        for i, f in enumerate(schema.fields)
    }
    typed = with_parts.withColumns(fields)
    bad = F.coalesce(F.size("_parts") < len(schema.fields), F.lit(True))
    for f in schema.fields:
        bad = bad | F.col(f.name).isNull()
    good, rejected = _route(typed, bad, on_error, "malformed line", value)
    return good.drop("_parts", value), rejected


def parse_json(
    df: DataFrame,
    schema: T.StructType,
    on_error: str = "drop",
    value: str = "value",
    observation: Observation | str | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Parse JSON objects against a schema; malformed text is dropped or split off.

    ``observation`` (on a stream: its name) receives the numbers of all records,
    ``records``, and of malformed ones, ``bad``, as the good rows flow.
    """
    corrupt = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = df.withColumn("_rec", F.from_json(F.col(value), corrupt, options))
    bad = F.col("_rec").isNull() | F.col("_rec._corrupt").isNotNull()
    if observation is not None:
        counts = F.count("*").alias("records"), F.count(F.when(bad, 1)).alias("bad")
        parsed = parsed.observe(observation, *counts)
    good, rejected = _route(parsed, bad, on_error, "malformed json", value)
    names = [c for c in good.columns if c not in ("_rec", value)]
    return good.select(*names, *[F.col("_rec")[f.name].alias(f.name) for f in schema.fields]), rejected


def csv_table(
    df: DataFrame,
    schema: T.StructType,
    rowtime: str,
    unit: str = "ms",
    bound: str = "1 second",
    view: str | None = None,
    value: str = "value",
) -> DataFrame:
    """A CSV text column as a table with event time ``rt``; unparsable lines are ignored."""
    corrupt = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in corrupt.fields)
    rec = df.select(F.from_csv(F.col(value), ddl, options).alias("_rec"))
    table = (
        rec.filter(F.col("_rec").isNotNull() & F.col("_rec._corrupt").isNull())
        .select("_rec.*")
        .drop("_corrupt")
        .withColumn("rt", event_time(F.col(rowtime), unit))
    )
    table = table.withWatermark("rt", bound)
    if view:
        table.createOrReplaceTempView(view)
    return table


def event_time(value: Column, unit: str) -> Column:
    """Epoch number to timestamp; the unit is always stated by the caller."""
    if unit not in _UNITS:
        raise ValueError(f"unit must be one of {sorted(_UNITS)}, not {unit!r}")
    return _UNITS[unit](value)


def stamp_arrival(df: DataFrame, name: str = "arrived") -> DataFrame:
    """Processing time as a column; on a stream, the start of the micro-batch."""
    return df.withColumn(name, F.current_timestamp())


def to_table(
    df: DataFrame,
    names: Sequence[str],
    rowtime: str | None = None,
    unit: str = "ms",
    append_as: str | None = None,
) -> DataFrame:
    """Rename columns by position; make one epoch column the event time.

    The epoch column is replaced, or kept beside a new column ``append_as``.
    """
    table = df.toDF(*names)
    if rowtime is None:
        return table
    return table.withColumn(append_as or rowtime, event_time(F.col(rowtime), unit))
