"""Exact quantiles without gathering a column, its values or its sketches in one task.

``percentile`` keeps every distinct value of a group in one task's memory. Here distinct values are
counted in one pass over the rows, combined before the shuffle, and the counts of a large table are written;
all else reads these alone. Few counts are ranked. Many are searched by radix, 16 bits a pass: a
value's image is a 64-bit integer of the same order (its sign, exponent and mantissa), and a cell
holds the values whose images share their leading bits. A pass sums the cells within those of the
last pass that hold a wanted rank; once these are small, or share 48 bits, their distinct values are
counted and ranked. So a task ranks at most 65,536 counts of a group and column (for each cell on from the
second pass), however the values are spread; two or three passes do unless values crowd very closely.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .fitted import BROADCAST_ROWS, local_table, match

SMALL_TABLE = 1_000_000
#: Rows of a cell whose values are ranked without another pass, and cells of a pass: 16 bits.
CELL_ROWS = 1 << 16
SHIFTS = (48, 32, 16)
LARGEST = 1.7976931348623157e308


def _long(df: DataFrame, columns: dict[str, Column], by: list[str]) -> DataFrame:
    wide = df.select(*by, *[c.cast("double").alias(n) for n, c in columns.items()])
    return wide.unpivot(by, list(columns), "column", "value").where("value IS NOT NULL")


def quantiles(df: DataFrame, columns: list[str] | dict[str, Column], probs: list[float],
              by: list[str] | None = None, rows: int | None = None,
              small_table: int = SMALL_TABLE, accuracy: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: (by..., column, n, q, value).

    ``columns`` may map names to expressions. Missing values do not count; a group whose
    key is missing is a group here. ``rows`` is the number of rows where the caller knows
    it. ``accuracy`` asks for one pass with a rank error of ``1 / accuracy`` instead.
    """
    by = by or []
    if not isinstance(columns, dict):
        columns = {c: F.col(c) for c in columns}
    probs = [float(p) for p in probs]
    long = _long(df, columns, by)
    keys = [*by, "column"]
    if accuracy:
        return _sketched(long, probs, keys, accuracy)
    counts = _counted(long, keys)
    if rows is not None and rows <= small_table:
        return _ranked(counts, probs, keys)
    return _of_counts(cut_lineage(counts), probs, keys, small_table)


def _counted(long: DataFrame, keys: list[str]) -> DataFrame:
    return long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("rows"))


def _of_counts(counts: DataFrame, probs: list[float], keys: list[str], small_table: int) -> DataFrame:
    if counts.count() <= small_table:
        return _ranked(counts, probs, keys)
    return _searched(counts, probs, keys)


def _image(value: Column) -> Column:
    """A bigint that grows with the double: sign, then exponent and mantissa as stored.

    Powers of two are exact, and so is dividing by them. The exponent of the logarithm can be one
    off next to a power of two. Infinities come behind the finite values, NaN behind them.
    """
    size = F.least(F.abs(value), F.lit(LARGEST))
    guess = F.least(F.greatest(F.coalesce(F.floor(F.log2(size)), F.lit(-1022)), F.lit(-1022)), F.lit(1023))
    part = size / F.pow(F.lit(2.0), guess)
    power = guess + F.when(part >= 2, 1).when((part < 1) & (guess > -1022), -1).otherwise(0)
    unit = 1 << 52
    bits = (power + 1022) * F.lit(unit) + (size / F.pow(F.lit(2.0), power) * unit).cast("bigint")
    bits = F.when(F.isnan(value), F.lit(2047 * unit + 1)).when(
        F.abs(value) > LARGEST, F.lit(2047 * unit)).otherwise(bits)
    return F.when(value < 0, -bits).otherwise(bits)


def _fixed(table: DataFrame) -> tuple[DataFrame, int]:
    """A table made once, for a broadcast where it is small, and the largest of its ``rows``."""
    head = table.take(BROADCAST_ROWS + 1)
    if len(head) <= BROADCAST_ROWS:
        return F.broadcast(local_table(table, head)), max((r["rows"] for r in head), default=0)
    table = cut_lineage(table)
    return table, table.agg(F.max("rows")).first()[0]


def _searched(counts: DataFrame, probs: list[float], keys: list[str]) -> DataFrame:
    """Quantiles by radix; only cells that hold a wanted rank go on to the next pass."""
    image, whole = _image(F.col("value")), Window.partitionBy(*keys)
    ranks = [f((F.col("n") - 1) * F.lit(p)) for p in probs for f in (F.floor, F.ceil)]
    holds = reduce(lambda a, b: a | b, [
        (r < F.col("upto")) & (r >= F.col("upto") - F.col("rows")) for r in ranks])
    hits, inside = counts, []
    for shift in SHIFTS:
        cells = hits.groupBy(*keys, *inside, F.shiftright(image, shift).alias("cell")).agg(
            F.sum("rows").alias("rows"))
        if inside:
            upto = F.col("start") + F.sum("rows").over(
                Window.partitionBy(*keys, "outer").orderBy("cell"))
            sums = cells.withColumn("upto", upto)
        else:
            sums = cells.withColumns({"upto": F.sum("rows").over(whole.orderBy("cell")),
                                      "n": F.sum("rows").over(whole)})
        # At most two cells per probability and group.
        wanted, most = _fixed(sums.where(holds).select(
            *keys, F.col("cell").alias("outer"), "n", "rows",
            (F.col("upto") - F.col("rows")).alias("start")))
        hits = match(counts.withColumn("outer", F.shiftright(image, shift)), wanted.drop("rows"),
                     [*keys, "outer"])
        inside = ["outer", "n", "start"]
        if most <= CELL_ROWS:
            break
    inner = Window.partitionBy(*keys, "outer").orderBy("value")
    return _at_ranks(hits.withColumn("upto", F.col("start") + F.sum("rows").over(inner)),
                     probs, keys)


def _ranked(counts: DataFrame, probs: list[float], keys: list[str]) -> DataFrame:
    """Quantiles from few counts of distinct values."""
    whole = Window.partitionBy(*keys)
    return _at_ranks(counts.withColumns({"upto": F.sum("rows").over(whole.orderBy("value")),
                                         "n": F.sum("rows").over(whole)}), probs, keys)


def _at_ranks(ranked: DataFrame, probs: list[float], keys: list[str]) -> DataFrame:
    """Interpolated values at the wanted ranks: the first value with more rows up to it."""
    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("upto") > rank, F.col("value")))

    ranks = [(F.col("n") - 1) * F.lit(p) for p in probs]
    ends = ranked.groupBy(*keys, "n").agg(
        *[at(F.floor(r)).alias(f"a{i}") for i, r in enumerate(ranks)],
        *[at(F.ceil(r)).alias(f"b{i}") for i, r in enumerate(ranks)])
    found = []
    for i, (p, r) in enumerate(zip(probs, ranks)):
        a, b = F.col(f"a{i}"), F.col(f"b{i}")
        found.append(F.struct(F.lit(p).alias("q"),
                              (a + (b - a) * (r - F.floor(r))).alias("value")))
    return ends.select(*keys, "n", F.inline(F.array(*found)))


def _sketched(long: DataFrame, probs: list[float], keys: list[str], accuracy: int) -> DataFrame:
    sketch = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("value", probs, accuracy).alias("v"))
    pairs = [F.struct(F.lit(p).alias("q"), F.col("v")[i].alias("value"))
             for i, p in enumerate(probs)]
    return sketch.select(*keys, "n", F.inline(F.array(*pairs)))


def medians(df: DataFrame, columns: dict[str, Column], rows: int | None = None,
            accuracy: int | None = None) -> dict[str, float | None]:
    """Global medians as numbers, one per named expression; None if nothing is present."""
    long = quantiles(df, columns, [0.5], rows=rows, accuracy=accuracy)
    found = {r["column"]: r["value"] for r in long.collect()}
    return {c: found.get(c) for c in columns}


QUARTERS = {0.25: "q25", 0.5: "q50", 0.75: "q75"}


def _in_one_row(long: DataFrame, keys: list[str]) -> DataFrame:
    return long.groupBy(*keys).agg(*[F.max(F.when(F.col("q") == p, F.col("value"))).alias(name)
                                     for p, name in QUARTERS.items()])


def quartiles(df: DataFrame, columns: list[str], by: list[str] | None = None,
              accuracy: int | None = None) -> DataFrame:
    """Quartiles in one row per group and column: (by..., column, q25, q50, q75)."""
    by = by or []
    return _in_one_row(quantiles(df, columns, list(QUARTERS), by, accuracy=accuracy), [*by, "column"])


def counts_and_quartiles(df: DataFrame, columns: list[str], by: list[str],
                         small_table: int = SMALL_TABLE) -> tuple[DataFrame, DataFrame]:
    """The distinct present values with their number of ``rows``, written once (by..., column, value,
    rows), and the quartiles. What depends on the values alone needs no other pass over the rows."""
    keys = [*by, "column"]
    counts = cut_lineage(_counted(_long(df, {c: F.col(c) for c in columns}, by), keys))
    return counts, _in_one_row(_of_counts(counts, list(QUARTERS), keys, small_table), keys)
