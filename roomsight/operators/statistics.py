"""Descriptive statistics, group tables, cross-tabulations and correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import KURTOSIS_LIMIT, SKEW_LIMIT
from ..functions.moments import pearson, sample_kurtosis, sample_skewness
from ..functions.scalar import lookup, share_of_group
from .quantiles import quartiles

MAX_PIVOT = 1_000


def _per_column(df: DataFrame, columns: list[str], measures: dict) -> DataFrame:
    """One row of measures per column.

    The columns are stacked and grouped by name: the few aggregates compile into one tight
    loop, which a set of aggregates per column does not, and a task shuffles one row per
    column.
    """
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot([], columns, "column", "value").groupBy("column").agg(
        *[make(F.col("value")).alias(name) for name, make in measures.items()])


def shape_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Sample skewness and excess kurtosis per column."""
    return _per_column(df, columns, {"skewness": sample_skewness, "kurtosis": sample_kurtosis})


def describe(df: DataFrame, columns: list[str], accuracy: int | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles, max, skewness and kurtosis; one row per column.

    Quartiles are exact unless an ``accuracy`` is given.
    """
    simple = _per_column(df, columns, {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp,
        "min": F.min, "max": F.max,
        "skewness": sample_skewness, "kurtosis": sample_kurtosis})
    # A row per column on both sides: the number of columns bounds the broadcast.
    joined = simple.join(F.broadcast(quartiles(df, columns, None, accuracy)), "column",
                         "left")
    return joined.select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max",
                         "skewness", "kurtosis")


def shape_flags(stats: DataFrame) -> DataFrame:
    """Advice from shape statistics: transform skewed columns, expect heavy tails."""
    return stats.select(
        "column", "skewness", "kurtosis",
        F.coalesce(F.abs("skewness") >= SKEW_LIMIT, F.lit(False)).alias("log1p_advised"),
        F.coalesce(F.col("kurtosis") > KURTOSIS_LIMIT, F.lit(False)).alias("heavy_tails"))


def group_means(df: DataFrame, by: str, columns: list[str],
                order: list[str] | None = None) -> DataFrame:
    """Mean of many columns per group; ``order`` keeps and sorts the known categories."""
    means = (df.where(F.col(by).isNotNull()).groupBy(by)
             .agg(*[F.avg(c).alias(c) for c in columns]))
    return means if order is None else in_order(means, by, order)


def in_order(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """Rows of the known categories in their canonical order."""
    place = lookup(F.col(column), {c: i for i, c in enumerate(order)})
    return df.where(F.col(column).isin(order)).orderBy(place)


def group_summary(df: DataFrame, by: str, aggregates: dict[str, Column]) -> DataFrame:
    """Named aggregates per present group key."""
    return (df.where(F.col(by).isNotNull()).groupBy(by)
            .agg(*[a.alias(name) for name, a in aggregates.items()]))


def session_stats(df: DataFrame, session: str, label: str, order: list[str],
                  means: dict[str, str]) -> DataFrame:
    """Labelled rows, per cent of each label and named means per session.

    ``order`` lists the labels of low_pct, mod_pct and high_pct. A missing label stays in
    the denominator of the shares but is not counted as a row.
    """
    low, mod, high = [share_of_group(F.col(label) == k) for k in order]
    return group_summary(df, session, {
        "rows": F.count(label), "low_pct": low, "mod_pct": mod, "high_pct": high,
        **{name: F.avg(c) for name, c in means.items()}})


def session_overview(stats: DataFrame) -> DataFrame:
    """Number of sessions and the spread of their sizes."""
    return stats.agg(F.count(F.lit(1)).alias("sessions"), F.min("rows").alias("min_rows"),
                     F.max("rows").alias("max_rows"), F.avg("rows").alias("mean_rows"))


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Distinct present values; the exact form spreads them over all tasks."""
    if approximate:
        return df.agg(F.approx_count_distinct(column).alias("n_distinct"))
    present = df.where(F.col(column).isNotNull()).select(column).distinct()
    return present.agg(F.count(F.lit(1)).alias("n_distinct"))


def group_size_wide(df: DataFrame, by: str, across: str, values: list[str]) -> DataFrame:
    """Rows per group and category, one column per category, empty cells 0."""
    if len(values) > MAX_PIVOT:
        raise ValueError(f"more than {MAX_PIVOT} categories across")
    present = df.where(F.col(by).isNotNull() & F.col(across).isNotNull())
    return present.groupBy(by).agg(*[F.count_if(F.col(across) == v).alias(v) for v in values])


def row_percent(wide: DataFrame, columns: list[str]) -> DataFrame:
    """Each cell as per cent of its row; NULL for a row of zeros."""
    total = sum((F.col(f"`{c}`") for c in columns[1:]), F.col(f"`{columns[0]}`"))
    share = {c: F.try_divide(F.col(f"`{c}`").cast("double"), total.cast("double")) * 100.0
             for c in columns}
    return wide.withColumns(share)


def crosstab_pct(df: DataFrame, by: str, across: str, values: list[str]) -> DataFrame:
    """Row-normalised cross-tabulation. Rows with either key missing do not count.

    Categories not listed in ``values`` still count in the row total.
    """
    present = df.where(F.col(by).isNotNull() & F.col(across).isNotNull())
    return present.groupBy(by).agg(
        *[(F.avg(F.when(F.col(across) == v, 1.0).otherwise(0.0)) * 100.0).alias(v)
          for v in values])


def _pair_corr(df: DataFrame, columns: list[str], pairs: list[tuple[int, int]]) -> DataFrame:
    """Pearson r per pair of column positions (i, j, r).

    Each row is turned into its pairs inside generated code and added to one running sum
    per pair, so a task shuffles one row per pair. One aggregate over many rows compiles
    far better than an aggregate expression per pair.
    """
    every = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in pairs])
    rows = (df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("v"))
            .select("v", F.explode(every).alias("p"))
            .select("p.i", "p.j", F.col("v")[F.col("p.i")].alias("x"),
                    F.col("v")[F.col("p.j")].alias("y")))
    return rows.groupBy("i", "j").agg(pearson(F.col("x"), F.col("y")).alias("r"))


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson r for every ordered pair (feature_a, feature_b, r), pairwise complete."""
    places = range(len(columns))
    half = _pair_corr(df, columns, [*combinations(places, 2), *[(i, i) for i in places]])
    names = F.array(*[F.lit(c) for c in columns])
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    mirrored = half.select(F.explode(both).alias("p"), "r")
    return mirrored.select(names[F.col("p.i")].alias("feature_a"),
                           names[F.col("p.j")].alias("feature_b"), "r")


def corr_lower(matrix: DataFrame, columns: list[str]) -> DataFrame:
    """The strict lower triangle in the given column order."""
    place = {c: i for i, c in enumerate(columns)}
    return matrix.where(lookup(F.col("feature_a"), place) > lookup(F.col("feature_b"), place))


def target_corr(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Absolute correlation of each column with the target, strongest first."""
    last = len(columns)
    found = _pair_corr(df, [*columns, target], [(i, last) for i in range(last)])
    names = F.array(*[F.lit(c) for c in columns])
    return (found.select(names[F.col("i")].alias("feature"), F.abs("r").alias("abs_r"))
            .orderBy(F.desc_nulls_last("abs_r"), "feature"))


def top_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent keys, ties by key."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), key).limit(k))


def top_key_mix(df: DataFrame, key: str, label: str, order: list[str], k: int) -> DataFrame:
    """Label shares in the k most frequent keys. ``k`` bounds the broadcast key set."""
    keys = F.broadcast(top_keys(df, key, k).select(key))
    mine = df.select(key, label).join(keys, key, "left_semi")
    return row_percent(group_size_wide(mine, key, label, order), order)
