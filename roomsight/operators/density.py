"""The numbers behind charts: histograms, kernel densities and box statistics."""

from __future__ import annotations

import math

from numpy.polynomial.hermite import herm2poly
from pyspark.sql import Column, DataFrame, functions as F

from ..constants import DENSITY_POINTS, VIOLIN_CUT, VIOLIN_POINTS, WHISKER
from .fitted import BROADCAST_ROWS, attach, local_table
from .quantiles import counts_and_quartiles, quartiles

#: Terms of the expansion of a kernel, and bandwidths beyond which it is nothing.
TERMS = 12
REACH = 9.0


def _long(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(by, columns, "column", "value").where("value IS NOT NULL")


def histogram(df: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """Equal-width bins 1..n per column, the last one closed, empty ones with 0.

    A constant column is spread over one unit around its value.
    """
    long = _long(df, columns, [])
    span = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.col("hi") == F.col("lo")
    # One row per column: the number of columns bounds both broadcasts.
    span = span.select("column", F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                       F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    # The edges decide, as rounding may put a value on an edge one bin off.
    guess = F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))
    below = F.col("value") < F.col("lo") + guess * width
    above = (guess < bins - 1) & (F.col("value") >= F.col("lo") + (guess + 1) * width)
    place = guess + F.when(below, 0).when(above, 2).otherwise(1)
    counts = (long.join(F.broadcast(span), "column").groupBy("column", place.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    every = span.select("column", "lo", "hi",
                        F.explode(F.sequence(F.lit(1).cast("bigint"),
                                             F.lit(bins).cast("bigint"))).alias("bin"))
    return (every.join(counts, ["column", "bin"], "left")
            .select("column", "bin", (F.col("lo") + (F.col("bin") - 1) * width).alias("left_edge"),
                    (F.col("lo") + F.col("bin") * width).alias("right_edge"),
                    F.coalesce("n", F.lit(0)).alias("n")))


def _hermite_rows() -> list[list[float]]:
    """Row n: coefficients of the Hermite polynomial n, lowest power first."""
    return [herm2poly([0] * n + [1]).tolist() for n in range(TERMS)]


def _density(long: DataFrame, keys: list[str], points: int, cut: float) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid per group, by a fast Gauss transform.

    Values are collected in boxes of half a bandwidth. A value at s from the middle of its box (in units
    of h * sqrt 2) adds to a point at t from it exp(-(t - s)**2), which is the sum over n of s**n / n! times the
    Hermite polynomial n at t times exp(-t**2). So a box needs no more than the sums of s**n / n!, which are
    combined before they are shuffled, and the boxes are what is moved to the grid: the cost is linear in
    rows. After ``TERMS`` terms a kernel (at most 1) is off by less than 1e-11; boxes further than
    ``REACH`` bandwidths from a point add less than 1e-17 a value and are left out there.
    """
    band = F.pow(F.col("n").cast("double"), F.lit(-0.2)) * F.col("sd")
    span = (long.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("value").alias("sd"),
                 F.min("value").alias("lo"), F.max("value").alias("hi"))
            .where("sd > 0").withColumn("h", band))
    span = span.select(*keys, "n", "h", (F.col("lo") - cut * F.col("h")).alias("lo"),
                       (F.col("hi") + cut * F.col("h")).alias("hi"))
    head = span.take(BROADCAST_ROWS + 1)
    span = F.broadcast(local_table(span, head)) if len(head) <= BROADCAST_ROWS else span
    box = F.floor((F.col("value") - F.col("lo")) / F.col("h") * 2)
    middle = F.col("lo") + (F.col("box") + 0.5) * F.col("h") / 2
    placed = long.join(span, keys).withColumn("box", box).withColumn(
        "s", (F.col("value") - middle) / (F.col("h") * math.sqrt(2)))
    powers, term = [], F.lit(1.0)
    for n in range(TERMS):
        powers.append(F.sum(term).alias(f"m{n}"))
        term = term * F.col("s") / (n + 1)
    boxes = placed.groupBy(*keys, "box", "n", "h", "lo", "hi").agg(*powers)
    rows = _hermite_rows()
    # The sum of all terms is one polynomial in t.
    made = [sum((F.col(f"m{n}") * rows[n][k] for n in range(k, TERMS) if rows[n][k]), F.lit(0.0)).alias(f"a{k}")
            for k in range(TERMS)]
    boxes = boxes.select(*keys, "n", "h", "lo", "hi", middle.alias("middle"), *made)
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    first = F.greatest(F.floor((F.col("middle") - REACH * F.col("h") - F.col("lo")) / step), F.lit(0)).cast("int")
    last = F.least(F.ceil((F.col("middle") + REACH * F.col("h") - F.col("lo")) / step),
                   F.lit(points - 1)).cast("int")
    spread = boxes.where(first <= last).withColumn("point", F.explode(F.sequence(first, last)))
    grid = F.col("lo") + F.col("point") * step
    spread = spread.withColumn("t", (grid - F.col("middle")) / (F.col("h") * math.sqrt(2)))
    total = F.col(f"a{TERMS - 1}")
    for k in range(TERMS - 2, -1, -1):
        total = total * F.col("t") + F.col(f"a{k}")
    sums = spread.groupBy(*keys, "point").agg(F.sum(total * F.exp(-F.col("t") * F.col("t"))).alias("s"))
    every = span.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    norm = F.col("n") * F.col("h") * math.sqrt(2 * math.pi)
    density = F.greatest(F.coalesce(F.col("s"), F.lit(0.0)), F.lit(0.0)) / norm
    return every.join(sums, [*keys, "point"], "left").select(
        *keys, "point", grid.alias("x"), density.alias("density"))


def kde_grid(df: DataFrame, columns: list[str], points: int = DENSITY_POINTS) -> DataFrame:
    """Density of whole columns between their minimum and maximum."""
    return _density(_long(df, columns, []), ["column"], points, 0.0)


def kde_by_class(df: DataFrame, columns: list[str], by: str, points: int = VIOLIN_POINTS,
                 cut: float = VIOLIN_CUT) -> DataFrame:
    """Density per class and column, with the class quartiles beside each grid point."""
    present = df.where(F.col(by).isNotNull())
    curve = _density(_long(present, columns, [by]), [by, "column"], points, cut)
    return attach(curve, quartiles(present, columns, [by]), [by, "column"])


def box_stats(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """Quartiles, whiskers inside 1.5 IQR and number of outliers per class and column.

    All of it follows from the distinct values and their counts, so the rows are read once.
    """
    counts, box = counts_and_quartiles(df.where(F.col(by).isNotNull()), columns, [by])
    reach = (F.col("q75") - F.col("q25")) * WHISKER
    fences = box.select("*", (F.col("q25") - reach).alias("low_fence"),
                        (F.col("q75") + reach).alias("high_fence"))
    joined = attach(counts, fences, [by, "column"], "inner")
    inside: Column = F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    return joined.groupBy(by, "column", "q25", "q50", "q75").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("rows")).otherwise(0)).alias("outliers"), F.sum("rows").alias("n"))


def outlier_rows(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """The rows behind the outlier counts: (class, column, value)."""
    present = df.where(F.col(by).isNotNull())
    reach = (F.col("q75") - F.col("q25")) * WHISKER
    joined = attach(_long(present, columns, [by]), quartiles(present, columns, [by]),
                    [by, "column"], "inner")
    inside = F.col("value").between(F.col("q25") - reach, F.col("q75") + reach)
    return joined.where(~inside).select(by, "column", "value")
