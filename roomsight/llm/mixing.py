"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a share of a budget of words by its weight, at most ``most`` times its own
size; what it cannot use is shared among the others by weight. A source is read in whole epochs
first; the rest of its target is filled in ascending order of exponential keys
``-ln(u) / quality``, up to the document that would overshoot by more than half of itself.

The place in that order where a source's rest is used up is found without sorting a source:
keys are counted in cells, only the cell that holds the place is counted again in finer cells
until it is small, and the selection is then a comparison of each row's key with that place.

Sizes, targets and places are tables of one row per source, never on the driver, so any number of
sources will do. Up to ``BROADCAST_ROWS`` of them are broadcast; of more only those that hold over
1/``BROADCAST_ROWS`` of the rows each, while the rows of the others are joined by a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window

from ..functions.hashing import hash_key
from ..operators.fitted import BROADCAST_ROWS, match
from ..session import cut_lineage
from .common import TOKEN

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 11
CELLS = 1024
CELL_ROWS = 20_000


def size_of(text: Column) -> Column:
    """Words of a text: runs of anything but ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("bigint")


def quality_of(text: Column, size: Column) -> Column:
    """Quality weight in [0.05, 1]: words against words plus four times the symbols."""
    symbols = F.coalesce(F.regexp_count(text, F.lit(r"[#$%&*|!<>{}=]")), F.lit(0))
    return F.greatest(F.lit(0.05), F.coalesce(
        F.try_divide(size.cast("double"), size + 4 * symbols), F.lit(1.0)))


def sampling_key(ident: Column, text: Column, quality: Column, seed: int = SEED) -> Column:
    """Exponential key of a row: small keys come first, the likelier the higher the quality.

    The uniform number is from MD5 of identifier and text, so equal rows share a key and are
    taken together.
    """
    mark = F.concat_ws("|", ident.cast("string"), F.md5(text.cast("binary")))
    number = F.conv(F.substring(hash_key(mark, seed), 1, 13), 16, 10).cast("bigint")
    return -F.ln((number + 0.5) / float(2 ** 52)) / quality


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``: 0 and on by code point, NULL last, in one range of names a task."""
    order = F.col("source").asc_nulls_last()
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(sources.repartitionByRange(n, order).sortWithinPartitions(order)
                         .withColumns({"_part": F.spark_partition_id(),
                                       "_at": F.monotonically_increasing_id()}))
    # One row per range, at most as many as shuffle partitions.
    ends = ranged.groupBy("_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    starts = ends.select(F.col("_part").alias("_p"), "_first", (F.sum("_n").over(
        Window.orderBy("_part")) - F.col("_n")).alias("_start"))
    return (ranged.join(F.broadcast(starts), F.col("_part") == F.col("_p"))
            .withColumn("place", F.col("_start") + F.col("_at") - F.col("_first"))
            .select(*sources.columns, "place"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE,
            most: int = MOST) -> DataFrame:
    """``sources`` (source, size and what else there is) with target, epochs and rest.

    Weights repeat in the order of the names, NULL last. A source gives its weight times a common
    level, or ``most`` times its size where that is less. The level rises from all sources' even
    share: each round holds the sources that reach their bound and shares the rest anew, until no
    further one is held; a round is one aggregate of the sources.
    """
    place = F.pmod(F.col("place"), F.lit(len(weights))).cast("int")
    weight = F.array(*map(F.lit, weights))[place]
    sources = cut_lineage(numbered(sources).withColumn("weight", weight).drop("place"))
    whole = sources.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    budget = share * (whole["size"] or 0)
    left, open_ = budget, whole["weight"] or 0
    bound, even = most * F.col("size"), F.lit(None).cast("double")
    while open_:
        even = F.col("weight") * F.lit(left) / F.lit(open_)
        held = F.when(bound <= even, F.col("size"))
        now = sources.agg(F.sum(held).alias("held"), F.sum(
            F.when(bound > even, F.col("weight"))).alias("open")).first()
        if (now["open"] or 0) == open_:
            break
        left, open_ = budget - most * (now["held"] or 0), now["open"] or 0
    bound = bound.cast("double")
    target = F.least(bound, even) if open_ else bound
    epochs = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("size"))), F.lit(0))
    return (sources.withColumn("target", target).withColumn("epochs", epochs)
            .withColumn("rest", F.col("target") - F.col("epochs") * F.col("size"))
            .drop("weight"))


def _rows(docs: DataFrame, seed: int) -> DataFrame:
    text = F.col("text").cast("string")
    sized = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"),
                        text.alias("text"), size_of(text).alias("size"))
    key = sampling_key(F.col("doc_id"), F.col("text"), quality_of(F.col("text"), F.col("size")), seed)
    return sized.select("doc_id", "source", "size", key.alias("key"))


def _per_source(rows: DataFrame, table: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Rows with what ``table`` (source, hot, ...) has for their source; none without.

    ``hot`` has the names of all hot sources; None where the table is small enough as it is.
    """
    if hot is None:
        return match(rows, F.broadcast(table), ["source"])
    # Bounded: each hot source has over 1/BROADCAST_ROWS of all rows.
    other = match(rows, F.broadcast(hot), ["source"], "left_anti")
    return match(rows, F.broadcast(table.where("hot")), ["source"]).unionByName(
        match(other, table.where("NOT hot"), ["source"]))


def _places(rows: DataFrame, plan: DataFrame, hot: DataFrame | None, cells: int,
            cell_rows: int) -> DataFrame:
    """For each source with a broken epoch the cell of keys that holds its end:
    (source, hot, rest, lo, hi, base).

    ``rows`` is (source, size, key). Cells are of the positions ``1 - exp(-key)``, in which keys
    spread evenly. Those below ``lo`` are taken, ``base`` words in all; ``lo`` is 2 where all are.
    """
    at = (1 - F.exp(-F.col("key")))
    open_ = plan.select("source", "hot", F.when(F.col("rest") > 0, F.col("rest")).alias("rest"),
                        F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"),
                        F.lit(0).cast("bigint").alias("base"))
    names, done = open_.columns, []
    while True:
        inside = _per_source(rows.withColumn("at", at), open_, hot).where(
            (F.col("at") >= F.col("lo")) & ((F.col("at") < F.col("hi")) | (F.col("hi") >= 1)))
        cell = F.least(F.floor((F.col("at") - F.col("lo")) / (F.col("hi") - F.col("lo")) * cells),
                       F.lit(cells - 1))
        sums = inside.where("rest IS NOT NULL").groupBy("source", "base", "rest", cell.alias("cell")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("cell"))
        sums = sums.withColumn("before", F.col("base") + upto - F.col("words"))
        holds = sums.where((F.col("before") < F.col("rest"))
                           & (F.col("before") + F.col("words") >= F.col("rest"))).select(
            "source", "cell", "before", "n")
        # A source without such a cell is taken whole, or not at all where it has no rest.
        found, step = F.col("cell").isNotNull(), (F.col("hi") - F.col("lo")) / cells
        low = F.col("lo") + F.col("cell") * step
        high = F.when(F.col("cell") < cells - 1, F.col("lo") + (F.col("cell") + 1) * step).otherwise(
            F.col("hi"))
        placed = cut_lineage(match(open_, holds, ["source"], "left").select(
            "source", "hot", "rest",
            F.when(found, low).otherwise(F.when(F.col("rest") > 0, 2.0).otherwise(-1.0)).alias("lo"),
            F.when(found, high).otherwise(F.when(F.col("rest") > 0, 2.0).otherwise(-1.0)).alias("hi"),
            F.when(found, F.col("before")).otherwise(F.col("base")).alias("base"),
            (found & (F.col("n") > cell_rows) & (step > 1e-13)).alias("again")))
        done.append(placed.where("NOT again").select(names))
        open_ = placed.where("again").select(names)
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, done)


def selection(rows: DataFrame, plan: DataFrame, hot: DataFrame | None = None, cells: int = CELLS,
              cell_rows: int = CELL_ROWS) -> DataFrame:
    """(source, low, last): a row is in the broken epoch if its position ``1 - exp(-key)`` is below
    ``low`` or its key is at most ``last``; both are -1 where no row is."""
    places = _places(rows, plan, hot, cells, cell_rows)
    inside = _per_source(rows.withColumn("at", 1 - F.exp(-F.col("key"))), places, hot).where(
        (F.col("rest") > 0) & (F.col("at") >= F.col("lo"))
        & ((F.col("at") < F.col("hi")) | (F.col("hi") >= 1)))
    groups = inside.groupBy("source", "base", "rest", "key").agg(F.sum("size").alias("words"))
    before = F.col("base") + F.sum("words").over(
        Window.partitionBy("source").orderBy("key")) - F.col("words")
    last = (groups.withColumn("before", before)
            .where(2 * F.col("before") + F.col("words") <= 2 * F.col("rest"))
            .groupBy("source").agg(F.max("key").alias("last")))
    return match(places, last, ["source"], "left").select(
        "source", F.col("lo").alias("low"), F.coalesce("last", F.lit(-1.0)).alias("last"))


def _marked(docs: DataFrame, weights, share: float, most: int, seed: int, cells: int,
            cell_rows: int, few_sources: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Slim rows (doc_id, source, size, key), the written plan, and the names of the hot sources,
    None where the plan is for a broadcast."""
    rows = cut_lineage(_rows(docs, seed))
    sums = cut_lineage(rows.groupBy("source").agg(F.sum("size").alias("size"),
                                                  F.count(F.lit(1)).alias("n")))
    whole = sums.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("sources")).first()
    big = F.col("n") > (whole["n"] or 0) / few_sources
    plan = cut_lineage(targets(sums.select("source", "size", big.alias("hot")), weights, share, most))
    hot = plan.where("hot").select("source") if whole["sources"] > few_sources else None
    ends = selection(rows.select("source", "size", "key"), plan, hot, cells, cell_rows)
    table = match(plan, ends, ["source"], "left").select(
        "source", "hot", F.col("size").alias("source_size"), "target", "epochs", "low", "last")
    return rows, cut_lineage(table), hot


def _copies() -> Column:
    once_more = (1 - F.exp(-F.col("key")) < F.col("low")) | (F.col("key") <= F.col("last"))
    return (F.col("epochs") + once_more.cast("int")).cast("int")


def report(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST,
           seed: int = SEED, cells: int = CELLS, cell_rows: int = CELL_ROWS,
           few_sources: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row.

    A NULL source is a source of its own, the last. Empty and NULL texts have size 0 and take
    nothing. Rows of equal id and text share a key and are taken or left together. Very long texts
    are sized whole. No rows: no result rows. Extra columns are not read.
    """
    rows, table, hot = _marked(docs, weights, share, most, seed, cells, cell_rows, few_sources)
    return _per_source(rows, table, hot).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _copies()).alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST,
        seed: int = SEED, cells: int = CELLS, cell_rows: int = CELL_ROWS,
        few_sources: int = BROADCAST_ROWS) -> DataFrame:
    """The mixture itself: each row, with all its columns, as often as it is taken.

    NULLs, empty and very long texts, ties and repeated rows count as in ``report``; an empty table
    gives an empty one. All columns come out as they are, whatever their names.
    """
    _, table, hot = _marked(docs, weights, share, most, seed, cells, cell_rows, few_sources)
    names = docs.columns
    plain = [f"_c{i}" for i in range(len(names))]
    ident, text, source = (F.col(plain[names.index(c)]) for c in ("doc_id", "text", "source"))
    text = text.cast("string")
    inner = docs.toDF(*plain).withColumns({"source": source.cast("string"), "key": sampling_key(
        ident, text, quality_of(text, size_of(text)), seed)})
    both = _per_source(inner, table, hot).withColumn("times", F.explode(
        F.sequence(F.lit(0), _copies())))
    return both.where("times > 0").select(*plain).toDF(*names)
