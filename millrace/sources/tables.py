"""The parquet tables, with time columns as zoned timestamps in UTC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import configure


def zoned(df: DataFrame) -> DataFrame:
    """Cast TIMESTAMP_NTZ columns to timestamp; watermarks reject NTZ."""
    ntz = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else df


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return zoned(configure(spark).read.parquet(f"{sf_dir}/{name}.parquet"))
