"""Row-by-row operators: tagging, routing, merging two streams, positional columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def flat_words(df: DataFrame, text: str, sep: str = r"\s+") -> DataFrame:
    """One row per non-empty word of a text column, as ``word``."""
    return df.select(F.explode(F.split(F.col(text), sep)).alias("word")).filter("word <> ''")


def project(df: DataFrame, *places: int) -> DataFrame:
    """Columns by position."""
    return df.select(*[df.columns[i] for i in places])


def tag(df: DataFrame, rules: dict[str, Column], name: str = "tags") -> DataFrame:
    """Add the labels whose condition holds; a row may carry none or several."""
    labels = F.array(*[F.when(cond, F.lit(label)) for label, cond in rules.items()])
    return df.withColumn(name, F.array_compact(labels))


def select_tags(df: DataFrame, *labels: str, name: str = "tags") -> DataFrame:
    """Rows carrying any of the labels, each row once."""
    return df.filter(F.arrays_overlap(F.col(name), F.array(*[F.lit(x) for x in labels])))


def side_output(
    df: DataFrame,
    predicate: Column,
    main: Sequence[Column] | None = None,
    side: Sequence[Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows where the predicate holds, and all others; each may be projected."""
    goes_main = F.coalesce(predicate, F.lit(False))
    first, second = df.filter(goes_main), df.filter(~goes_main)
    return (
        first.select(*main) if main else first,
        second.select(*side) if side else second,
    )


def comap(
    left: DataFrame, right: DataFrame, left_exprs: Sequence[Column], right_exprs: Sequence[Column]
) -> DataFrame:
    """Map two inputs, each with its own expressions, into one output."""
    return left.select(*left_exprs).unionByName(right.select(*right_exprs))


def row_map(df: DataFrame, record: Column, names: Sequence[str]) -> DataFrame:
    """Replace each row by the fields of one struct expression."""
    return df.select(record.alias("r")).select("r.*").toDF(*names)


def rich_map(
    df: DataFrame,
    open_: Callable[[], object],
    apply: Callable[[object, pd.DataFrame], pd.DataFrame],
    close: Callable[[object], None],
    schema: str,
) -> DataFrame:
    """Map whole batches with a resource opened once per partition and always closed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_()
        try:
            for batch in batches:
                yield apply(resource, batch)
        finally:
            close(resource)

    return df.mapInPandas(run, schema)


def observed(df: DataFrame, name: str, **exprs: Column) -> tuple[DataFrame, Observation | None]:
    """Count while the data flows; a batch frame returns an Observation to read.

    On a stream the numbers arrive with each progress report instead.
    """
    columns = [c.alias(n) for n, c in exprs.items()]
    if df.isStreaming:
        return df.observe(name, *columns), None
    watch = Observation(name)
    return df.observe(watch, *columns), watch
