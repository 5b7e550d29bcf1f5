"""The user-defined functions, as expressions first and registered for SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def upper_suffix(value: str | Column, suffix: str | None = None) -> Column:
    """Upper case, with an optional text appended; null stays null."""
    col = F.upper(value)
    return F.concat(col, F.lit(suffix)) if suffix is not None else col


def split_rows(df: DataFrame, column: str, sep: str = "_") -> DataFrame:
    """One row per part of a text: its (word, length) beside the input columns.

    ``sep`` is plain text, not a pattern.
    """
    parts = F.split(F.col(column), f"\\Q{sep}\\E", -1)
    return df.withColumn("word", F.explode(parts)).withColumn("length", F.length("word"))


def register(spark: SparkSession) -> None:
    """Register ``upper_suffix(text[, suffix])`` and ``split_words(text, sep)`` for SQL.

    Both are SQL functions, so calls become ordinary expressions of the plan.
    """
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION upper_suffix(value STRING, suffix STRING DEFAULT '')
           RETURNS STRING RETURN concat(upper(value), suffix)"""
    )
    spark.sql(
        r"""CREATE OR REPLACE TEMPORARY FUNCTION split_words(value STRING, sep STRING)
            RETURNS TABLE(word STRING, length INT)
            RETURN SELECT word, length(word)
                   FROM (SELECT explode(split(value, concat('\\Q', sep, '\\E'), -1)) AS word)"""
    )
