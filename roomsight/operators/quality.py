"""Data-quality profile: missing cells, duplicates, value counts, bound violations, schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("rows"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot(["rows"], columns, "column", "missing")


def missing_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns that miss values: number missing and per cent of rows. One pass."""
    long = _missing_counts(df, columns or df.columns)
    share = F.col("missing") / F.col("rows") * 100.0
    return long.where("missing > 0").select("column", "missing", share.alias("missing_pct"))


def null_total(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing cells over all the columns together."""
    return _missing_counts(df, columns or df.columns).agg(F.sum("missing").alias("missing_cells"))


def duplicate_count(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each group of equal rows; missing equals missing.

    Copies collapse before the shuffle, so a group with a third of all rows sends one
    partial count per task.
    """
    groups = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each present value, most frequent first, ties by value."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column))


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """Value counts with the per cent of *all* rows, missing ones included."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return (counts.where(F.col(column).isNotNull())
            .select(column, "n", (F.col("n") / total * 100.0).alias("pct"))
            .orderBy(F.desc("n"), column))


def bound_violations(df: DataFrame,
                     bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Per column: rows below and above the physical bounds, minimum, maximum, mean.

    ``bounds`` maps a column to (low, high), None for an open side. One pass over the data.
    """
    never = F.lit(False)
    measures = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(F.col(c) < low if low is not None else never).alias("below"),
            F.count_if(F.col(c) > high if high is not None else never).alias("above"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
            F.avg(c).alias("mean"),
        )
        for c, (low, high) in bounds.items()
    ]
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))


def schema_profile(df: DataFrame) -> DataFrame:
    """Position, name and type of each column, and the number of rows."""
    fields = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                       F.lit(f.dataType.simpleString()).alias("type"))
              for i, f in enumerate(df.schema)]
    counted = df.agg(F.count(F.lit(1)).alias("rows"))
    return counted.select("rows", F.inline(F.array(*fields)))
