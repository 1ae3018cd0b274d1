"""Joining small fitted tables back to rows, with their size checked first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 10_000


def local_table(table: DataFrame, rows: list) -> DataFrame:
    """Rows already on the driver as a table of the same schema."""
    return table.sparkSession.createDataFrame(rows, table.schema)


def match(df: DataFrame, table: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join where a missing key meets a missing key; the table's keys are dropped."""
    renamed = table.withColumnsRenamed({k: f"_key_{k}" for k in on})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in on])
    return df.join(renamed, same, how).drop(*[f"_key_{k}" for k in on])


def attach(df: DataFrame, table: DataFrame, on: list[str], how: str = "left",
           limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join a fitted table to the rows it was learnt from.

    At most ``limit + 1`` rows come to the driver to check the size. A table within the
    limit is broadcast from there and not computed again; a larger one takes an ordinary
    join, where adaptive execution splits skewed keys.
    """
    head = table.take(limit + 1)
    if len(head) <= limit:
        table = F.broadcast(local_table(table, head))
    return df.join(table, on, how)


def bounded_rows(table: DataFrame, limit: int, what: str) -> list:
    """Rows of a table that has to be small; an error, not a cut, where it is not."""
    head = table.take(limit + 1)
    if len(head) > limit:
        raise ValueError(f"more than {limit} {what}")
    return head
