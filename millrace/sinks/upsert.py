"""Upsert into a database: UPDATE by key, INSERT when nothing was updated."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame

from millrace.operators.changelog import upsert_latest


def statements(table: str, columns: Sequence[str], keys: Sequence[str], mark: str = "?"):
    """(update, insert) text; update takes values then keys, insert all columns."""
    values = [c for c in columns if c not in keys]
    where = " AND ".join(f"{k} = {mark}" for k in keys)
    update = f"UPDATE {table} SET {', '.join(f'{c} = {mark}' for c in values)} WHERE {where}"
    marks = ", ".join([mark] * len(columns))
    return update, f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({marks})"


def upsert_rows(
    rows: Iterable,
    connect: Callable[[], object],
    table: str,
    columns: Sequence[str],
    keys: Sequence[str],
    mark: str = "?",
    commit_rows: int = 1000,
) -> None:
    """Write one partition over one connection, committing every ``commit_rows``."""
    values = [c for c in columns if c not in keys]
    update, insert = statements(table, columns, keys, mark)
    connection = None
    try:
        cursor = None
        for number, row in enumerate(rows, 1):
            if connection is None:
                connection = connect()
                cursor = connection.cursor()
            cursor.execute(update, [row[c] for c in [*values, *keys]])
            if cursor.rowcount == 0:
                cursor.execute(insert, [row[c] for c in columns])
            if number % commit_rows == 0:
                connection.commit()
        if connection is not None:
            connection.commit()
    finally:
        if connection is not None:
            connection.close()


def database_upsert(
    connect: Callable[[], object],
    table: str,
    keys: Sequence[str],
    seq: str,
    columns: Sequence[str] | None = None,
    mark: str = "?",
):
    """A ``foreachBatch`` function upserting the newest row per key of a batch.

    ``connect`` is a caller-supplied DB-API connection factory, called once per
    non-empty partition.  One row per key and batch makes a repeated batch
    harmless.
    """

    def write(batch: DataFrame, batch_id: int = 0) -> None:
        names = list(columns or [c for c in batch.columns if c != seq])
        latest = upsert_latest(batch, list(keys), seq).select(*names)
        latest.foreachPartition(
            lambda rows: upsert_rows(rows, connect, table, names, keys, mark)
        )

    return write
