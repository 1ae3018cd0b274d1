"""Exact stratified and grouped splits by seeded hash order.

The k-th row of a class in hash order is found without ranking the class in one task: rows
are counted per class and hash bucket (4,096 equally likely buckets, few enough to collapse
within a task), the buckets are summed up, and only the one bucket that holds the wanted
rank is ordered. The split itself is then a comparison of each row's key with the cut point: no rows are shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import FOLDS, SEED, TEST_SHARE
from ..functions.hashing import hash_bucket, hash_key
from ..functions.scalar import lookup
from .fitted import attach, bounded_rows

MAX_CLASSES = 1_000


def class_counts(df: DataFrame, label: str, limit: int = MAX_CLASSES) -> dict:
    """Rows per present class on the driver; too many classes are an error."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return {r[label]: r["n"] for r in sorted(bounded_rows(counts, limit, "classes"),
                                             key=lambda r: r[label])}


@dataclass(frozen=True)
class CutPoints:
    """Per class, the hash keys after which the next part begins."""

    ident: str
    label: str | None
    seed: int
    cuts: dict

    def mark(self, df: DataFrame, name: str) -> DataFrame:
        """Add the part number of each row: how many cut points of its class lie before it.

        NULL for a row whose class has no cut points. A projection: no join, no exchange.
        """
        kind = df.schema[self.ident].dataType

        def points(found: list) -> Column:
            return F.array(*[F.struct(F.lit(h).alias("h"), F.lit(i).cast(kind).alias("i"))
                             for h, i in found])

        if self.label is None:
            mine = points(self.cuts[None])
        else:
            mine = lookup(F.col(self.label), {c: points(found) for c, found in self.cuts.items()})
        keyed = df.withColumn("_key", hash_key(F.col(self.ident), self.seed))
        passed = F.filter(mine, lambda p: (F.col("_key") > p["h"])
                          | ((F.col("_key") == p["h"]) & (F.col(self.ident) > p["i"])))
        return keyed.withColumn(name, F.when(mine.isNotNull(), F.size(passed))).drop("_key")


def fit_cut_points(df: DataFrame, ident: str, label: str | None, wanted: dict,
                   seed: int = SEED) -> CutPoints:
    """Find the row of each wanted rank (1-based, in hash order) per class.

    ``wanted`` maps a class to ascending ranks; rank 0 needs no search. Identifiers must be
    unique within a class. ``label`` None means one class, key None.
    """
    key = hash_key(F.col(ident), seed)
    owner = F.lit(0) if label is None else F.col(label)
    keyed = df.select(owner.alias("_class"), F.col(ident).alias("_id"), key.alias("_key"),
                      hash_bucket(key).alias("_bucket"))
    cuts = {c: [("", None)] * len(ranks) for c, ranks in wanted.items()}
    targets = [(0 if label is None else c, i, rank)
               for c, ranks in wanted.items() for i, rank in enumerate(ranks) if rank > 0]
    if not targets:
        return CutPoints(ident, label, seed, cuts)
    kind = keyed.schema["_class"].dataType.simpleString()
    want = df.sparkSession.createDataFrame(targets, f"_class {kind}, _cut int, _rank bigint")
    sizes = keyed.groupBy("_class", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    buckets = sizes.withColumn(
        "_upto", F.sum("_n").over(Window.partitionBy("_class").orderBy("_bucket")))
    # ``wanted`` bounds both broadcasts: one row per class and cut.
    holder = buckets.join(F.broadcast(want), "_class").where(
        F.col("_rank").between(F.col("_upto") - F.col("_n") + 1, F.col("_upto")))
    place = holder.select("_class", "_bucket", "_cut",
                          (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_need"))
    inside = keyed.join(F.broadcast(place), ["_class", "_bucket"])
    order = Window.partitionBy("_class", "_cut").orderBy("_key", "_id")
    found = (inside.withColumn("_row", F.row_number().over(order))
             .where(F.col("_row") == F.col("_need")).collect())
    for r in found:
        cuts[None if label is None else r["_class"]][r["_cut"]] = (r["_key"], r["_id"])
    return CutPoints(ident, label, seed, cuts)


def stratified_test_sizes(counts: dict, share: float = TEST_SHARE) -> dict:
    """Test rows per class: train sizes by largest remainder, the rest is test.

    Ties between remainders go to the class that sorts first.
    """
    total = sum(counts.values())
    n_train = total - math.ceil(share * total)
    exact = {c: n_train * n / total for c, n in counts.items()}
    train = {c: math.floor(x) for c, x in exact.items()}
    spare = n_train - sum(train.values())
    for c in sorted(counts, key=lambda c: (train[c] - exact[c], c))[:spare]:
        train[c] += 1
    return {c: counts[c] - train[c] for c in counts}


def stratified_split(df: DataFrame, ident: str, label: str, share: float = TEST_SHARE,
                     seed: int = SEED) -> DataFrame:
    """Add ``is_test``: the first rows of each class in hash order, exactly as many as due.

    A row without a label is in neither part (``is_test`` NULL).
    """
    sizes = stratified_test_sizes(class_counts(df, label), share)
    cut = fit_cut_points(df, ident, label, {c: [n] for c, n in sizes.items()}, seed)
    return cut.mark(df, "is_test").withColumn("is_test", F.col("is_test") == 0)


def _even_ranks(n: int, parts: int) -> list[int]:
    return [n * i // parts for i in range(1, parts)]


def stratified_folds(df: DataFrame, ident: str, label: str, folds: int = FOLDS,
                     seed: int = SEED) -> DataFrame:
    """Add ``fold``: consecutive stretches of each class in hash order, equal to within 1."""
    wanted = {c: _even_ranks(n, folds) for c, n in class_counts(df, label).items()}
    return fit_cut_points(df, ident, label, wanted, seed).mark(df, "fold")


def group_split(df: DataFrame, group: str, share: float = TEST_SHARE,
                seed: int = SEED) -> DataFrame:
    """Add ``is_test`` so that a group is wholly in one part; ``share`` of the groups test."""
    groups = df.where(F.col(group).isNotNull()).select(group).distinct()
    n = groups.count()
    cut = fit_cut_points(groups, group, None, {None: [math.ceil(share * n)]}, seed)
    return cut.mark(df, "is_test").withColumn(
        "is_test", F.when(F.col(group).isNotNull(), F.col("is_test") == 0))


def group_folds(df: DataFrame, group: str, label: str, order: list, folds: int = FOLDS,
                seed: int = SEED) -> DataFrame:
    """Fold of each group, similar class mix in each: (group, fold).

    Groups are sorted into cells by the magnitude of their class counts, rarest class first
    (``order`` lists the classes from common to rare), and dealt out in turn: the place of a
    group is the size of the cells before its own plus its place there. Cells are at most
    40 per class to the power of the classes; a cell is split further by hash bucket, so
    no task orders more than a bucket of one cell.
    """
    sizes = [F.floor(F.log2(F.count_if(F.col(label) == k) + 1)).cast("int").alias(f"_c{i}")
             for i, k in enumerate(order)]
    key = hash_key(F.col(group), seed)
    cells = [f"_c{i}" for i in reversed(range(len(order)))]
    groups = (df.where(F.col(group).isNotNull()).groupBy(group).agg(*sizes)
              .select(group, *cells, key.alias("_key"), hash_bucket(key).alias("_bucket")))
    # Bucket digits are shortened to keep the table of cells and buckets small.
    groups = groups.withColumn("_bucket", F.substring("_bucket", 1, 2))
    slots = groups.groupBy(*cells, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    walk = Window.orderBy(*[F.desc(c) for c in cells], "_bucket")
    starts = slots.select(*cells, "_bucket", (F.sum("_n").over(
        walk.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_start"))
    inner = Window.partitionBy(*cells, "_bucket").orderBy("_key", group)
    ranked = groups.withColumn("_row", F.row_number().over(inner)).join(
        starts, [*cells, "_bucket"])
    place = F.col("_start") + F.col("_row") - 1
    return ranked.select(group, F.pmod(place, F.lit(folds)).cast("int").alias("fold"))


def hash_rank(df: DataFrame, ident: str, label: str, seed: int = SEED) -> DataFrame:
    """Add ``rank`` from 0 within each class in hash order, in tasks of one bucket each.

    The table of bucket offsets has at most 4,096 rows per class.
    """
    key = hash_key(F.col(ident), seed)
    keyed = df.withColumns({"_key": key, "_bucket": hash_bucket(key)})
    sizes = keyed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(label).orderBy("_bucket"))
    offsets = sizes.select(label, "_bucket", (upto - F.col("_n")).alias("_start"))
    inner = Window.partitionBy(label, "_bucket").orderBy("_key", ident)
    ranked = keyed.withColumn("_row", F.row_number().over(inner)).join(
        offsets, [label, "_bucket"])
    return ranked.withColumn("rank", F.col("_start") + F.col("_row") - 1).select(
        *df.columns, "rank")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) per class: (label, n, weight)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    even = whole.select((F.col("n") / F.col("k"))).scalar()
    return counts.select(label, "n", (even / F.col("n")).alias("weight"))


def with_class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add the balanced weight of each row's class, for an estimator's ``weightCol``."""
    weights = class_weights(df, label).select(label, F.col("weight").alias(name))
    return attach(df, weights, [label])
