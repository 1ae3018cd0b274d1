"""Cleaning and imputation. ``fit_*`` learns from one table, ``transform`` changes any other.

Learnt constants are plain numbers or labels, so a transform is one projection without a
shuffle. Learnt group tables are joined through :func:`attach`, which checks their size.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import outside
from .fitted import attach
from .quantiles import medians, quantiles


@dataclass(frozen=True)
class Replace:
    """Replace the cells that meet a condition by a learnt constant."""

    bad: dict[str, Column]
    value: dict[str, float | str | None]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: F.when(F.coalesce(bad, F.lit(False)), F.lit(self.value[c])).otherwise(F.col(c))
            for c, bad in self.bad.items() if self.value[c] is not None})


@dataclass(frozen=True)
class GroupFill:
    """Fill missing cells with a learnt value of the row's group.

    A row without a group gets no value, not even the one it had: a grouped transform has
    no result for it.
    """

    by: str
    columns: list[str]
    table: DataFrame = field(repr=False)

    def transform(self, df: DataFrame) -> DataFrame:
        named = self.table.select(self.by, *[F.col(c).alias(f"_fill_{c}") for c in self.columns])
        joined = attach(df, named, [self.by])
        grouped = F.col(self.by).isNotNull()
        filled = joined.withColumns({
            c: F.when(grouped, F.coalesce(c, f"_fill_{c}")) for c in self.columns})
        return filled.select(*df.columns)


def fit_outside_to_median(df: DataFrame, column: str, low: float, high: float,
                          accuracy: int | None = None) -> Replace:
    """Values beyond [low, high] -> median of the valid ones; missing stays missing."""
    bad = outside(F.col(column), low, high)
    return Replace({column: bad}, medians(df, {column: F.when(~bad, F.col(column))}, None, accuracy))


def fit_missing_to_median(df: DataFrame, columns: list[str],
                          accuracy: int | None = None) -> Replace:
    """Missing numbers -> global median; exact unless an ``accuracy`` is given."""
    return Replace({c: F.col(c).isNull() for c in columns},
                   medians(df, {c: F.col(c) for c in columns}, None, accuracy))


def fit_negative_to_median(df: DataFrame, columns: list[str],
                           rows: int | None = None) -> Replace:
    """Negative values -> median of the others."""
    return Replace({c: F.col(c) < 0 for c in columns},
                   medians(df, {c: F.when(F.col(c) >= 0, F.col(c)) for c in columns}, rows))


def _modes(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Most frequent present value per group and column, smallest value first on ties."""
    wide = df.select(*by, *[F.col(c).cast("string") for c in columns])
    counts = (wide.unpivot(by, columns, "column", "value").where("value IS NOT NULL")
              .groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n")))
    best = F.min_by("value", F.struct(-F.col("n"), F.col("value")))
    return counts.groupBy(*by, "column").agg(best.alias("value"))


def fit_missing_to_mode(df: DataFrame, columns: list[str]) -> Replace:
    """Missing labels -> most frequent label. One row per column reaches the driver."""
    found = {r["column"]: r["value"] for r in _modes(df, columns, []).collect()}
    return Replace({c: F.col(c).isNull() for c in columns}, {c: found.get(c) for c in columns})


def _widen(long: DataFrame, columns: list[str], by: str) -> DataFrame:
    return (long.where(F.col(by).isNotNull()).groupBy(by)
            .agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c)
                   for c in columns]))


def fit_group_mode(df: DataFrame, columns: list[str], by: str) -> GroupFill:
    """Missing labels -> most frequent label of the group; nothing for a missing key."""
    return GroupFill(by, columns, _widen(_modes(df, columns, [by]), columns, by))


def fit_group_median(df: DataFrame, columns: list[str], by: str,
                     accuracy: int | None = None) -> GroupFill:
    """Missing numbers -> median of the group; a missing key makes the result missing."""
    long = quantiles(df.where(F.col(by).isNotNull()), columns, [0.5], [by], accuracy=accuracy)
    return GroupFill(by, columns, _widen(long, columns, by))


def null_outside(df: DataFrame,
                 bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Values beyond their physical bounds become missing."""
    return df.withColumns({c: F.when(~outside(F.col(c), low, high), F.col(c))
                           for c, (low, high) in bounds.items()})


def dedupe(df: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """One row per group of equal rows, missing equal to missing.

    ``ignore`` names columns left out of the comparison (a row number); the row with the
    smallest values of them, compared in the order given, is kept.
    """
    ignore = ignore or []
    keys = [c for c in df.columns if c not in ignore]
    if not ignore:
        return df.dropDuplicates()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*ignore)).alias("_kept"))
    return kept.select(*[F.col(f"_kept.{c}") if c in ignore else F.col(c) for c in df.columns])
