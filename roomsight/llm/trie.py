"""Prefix trie of conversations, its subtree totals found by parallel tree contraction.

A node is a sequence of turns that some conversation starts with. It is named by the exclusive or
of two 64-bit values of each of its turns, which hold the turn's place: the names of all prefixes are
running aggregates, computed in stretches of ``STRETCH`` turns, and no conversation is gathered.

The totals over subtrees come from tree contraction in join rounds. Each round *rakes* the leaves, which are
added to their parents by an aggregate, and *compresses* chains of nodes with one child: a node
of a chain whose bit-reversed depth is larger than that of the chain nodes beside it is spliced out, and its
child carries what the parent must get besides the child's total. Of nodes of consecutive depths that
is every other one, so the number of rounds grows with the logarithm of the longest chain.
When the root alone is left, the rounds are gone through backwards and every spliced node gets its
total from that of its child.

Every state is written to the shared folder. Aggregates by parent are combined before they are shuffled,
so a node with most of all children is no more work than others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .common import map_arrow

STRETCH = 4_096
#: More children than that are matched to their parent apart, by a list that is broadcast if it is
#: short enough.
MANY_CHILDREN = 10_000
SHORT_LIST = 100_000
ID = ["a", "b"]


def _stretch(place: Column) -> Column:
    return F.floor((place - 1) / F.lit(STRETCH)).cast("long")


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, place, x, y, bytes): turns of each conversation numbered from 1, written once.

    x and y name role and text, bytes is the UTF-8 length of the text. The order is by turn, NULL first, and
    of equal turns by the digest of role and text. Rows are sorted by ranges, so that a conversation may
    span many tasks; a place is that within the task plus the rows of the tasks before.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat_ws("|", F.octet_length(role).cast("string"), role, text))
    slim = cut_lineage(turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row")))
    order = ["conv_id", F.asc_nulls_first("turn"), "digest", "row"]
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = cut_lineage(slim.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()))
    sizes = parted.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("conv_id", "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    here = Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), "digest", "row")
    half = lambda at: F.conv(F.substring("digest", at, 16), 16, -10).cast("long")
    placed = parted.withColumn("at", F.row_number().over(here)).join(before, ["conv_id", "part"])
    return cut_lineage(placed.select("conv_id", (F.col("at") + F.col("before")).alias("place"),
                                     half(1).alias("x"), half(17).alias("y"), "bytes"))


def rebuilt(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, depth, x, y, bytes) of all turns of the rebuilt conversations, and (c, size) of these.

    Conversation c starts with the first h turns of conversation c - c % 5 and goes on with its own
    after its first h, where h is crc32 of its number in decimals, modulo 9.
    """
    h = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(9))
    own = cut_lineage(places.groupBy(F.col("conv_id").alias("c")).agg(F.max("place").alias("own")))
    from_ = own.select(F.col("c").alias("base"), F.col("own").alias("there"))
    plan = own.withColumn("h", h).withColumn("base", F.col("c") - F.col("c") % 5).join(from_, "base", "left")
    plan = plan.withColumn("lent", F.least("h", F.coalesce("there", F.lit(0))))
    plan = cut_lineage(plan.select("c", "base", "h", "lent", "own", (
        F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size")))
    # At most 8 turns of a base go to the few conversations of its block.
    lent = places.where("place <= 8").join(plan.select("c", "base", "lent"), F.col("conv_id") == F.col("base")).where(
        "place <= lent").select("c", F.col("place").alias("depth"), "x", "y", "bytes")
    # A long conversation meets its plan in stretches.
    spans = plan.where("own > h").select("c", "h", "lent", F.explode(
        F.sequence(F.lit(0).cast("long"), _stretch(F.col("own")))).alias("stretch"))
    stretched = places.withColumn("stretch", _stretch(F.col("place"))).withColumnRenamed("conv_id", "c")
    kept = stretched.join(spans, ["c", "stretch"]).where("place > h").select(
        "c", (F.col("place") - F.col("h") + F.col("lent")).alias("depth"), "x", "y", "bytes")
    return lent.union(kept), plan.select("c", "size")


def prefixes(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """(c, depth, a, b, pa, pb, bytes, last): every conversation at each of its nodes but the root."""
    value = lambda *more: F.xxhash64("depth", "x", "y", *more)
    rows = turns.select("c", "depth", "bytes", _stretch(F.col("depth")).alias("stretch"),
                        value().alias("u"), value(F.lit(1)).alias("v"))
    run = Window.partitionBy("c", "stretch").orderBy("depth")
    rows = rows.withColumn("a", F.bit_xor("u").over(run)).withColumn("b", F.bit_xor("v").over(run))
    whole = turns.where(F.col("depth") > 0).select("c", _stretch(F.col("depth")).alias("stretch"),
                                                   value().alias("u"), value(F.lit(1)).alias("v"))
    long_ = sizes.where(F.col("size") > STRETCH).select("c")
    whole = whole.join(long_, "c", "left_semi").groupBy("c", "stretch").agg(
        F.bit_xor("u").alias("u"), F.bit_xor("v").alias("v"))
    up = Window.partitionBy("c").orderBy("stretch")
    carried = whole.select("c", (F.col("stretch") + 1).alias("stretch"), F.bit_xor("u").over(up).alias("ca"),
                           F.bit_xor("v").over(up).alias("cb"))
    rows = rows.join(carried, ["c", "stretch"], "left")
    both = lambda one, other: F.col(one).bitwiseXOR(F.coalesce(other, F.lit(0).cast("long")))
    rows = rows.withColumn("a", both("a", "ca")).withColumn("b", both("b", "cb"))
    return rows.select("c", "depth", "a", "b", F.col("a").bitwiseXOR(F.col("u")).alias("pa"),
                       F.col("b").bitwiseXOR(F.col("v")).alias("pb"), "bytes")


def end_digests(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) from (a, b, c): SHA-256 of the numbers c of a node, ascending, joined by commas.

    Rows are sorted by ranges and joined to texts within a task's batch; the texts of a node are
    then hashed one after the other. No list of numbers is held.
    """
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = ends.select("a", "b", "c").repartitionByRange(n, "a", "b", "c").sortWithinPartitions("a", "b", "c")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            before = None
            for a, b, c in zip(*(x.to_pylist() for x in batch.columns)):
                if (a, b) == before:
                    out[3][-1].append(str(c))
                else:
                    for column, x in zip(out, (a, b, c, [str(c)])):
                        column.append(x)
                    before = (a, b)
            out[3] = [",".join(x) for x in out[3]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in out[:3]] + [pa.array(out[3], pa.string())],
                names=["a", "b", "c", "text"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for a, b, _, text in zip(*(x.to_pylist() for x in batch.columns)):
                if (a, b) == now:
                    state.update(b"," + text.encode())
                    continue
                if now:
                    out.append((*now, state.hexdigest()))
                now, state = (a, b), hashlib.sha256(text.encode())
            if out:
                yield _digests(out)
        if now:
            yield _digests([(*now, state.hexdigest())])

    def _digests(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(x), t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))],
            names=["a", "b", "ends_sha256"])

    texts = map_arrow(placed, join, "a long, b long, c long, text string")
    texts = texts.repartition(n, "a", "b").sortWithinPartitions("a", "b", "c")
    return map_arrow(texts, digest, "a long, b long, ends_sha256 string")


def nodes(conversations: DataFrame) -> DataFrame:
    """(a, b, pa, pb, depth, conv_id, n_convs, n_children, bytes, ends_sha256) of all nodes but for the root's
    parent, which is NULL; written once. conv_id is the smallest member."""
    turns, sizes = rebuilt(numbered(conversations))
    turns = cut_lineage(turns)
    members = cut_lineage(prefixes(turns, sizes))
    inner = members.groupBy(*ID).agg(
        F.first("pa").alias("pa"), F.first("pb").alias("pb"), F.first("depth").alias("depth"),
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("bytes").alias("bytes"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = sizes.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"), zero.alias("depth"), "conv_id",
        "n_convs", zero.alias("bytes"))
    every = inner.withColumn("depth", F.col("depth").cast("long")).unionByName(root)
    every = cut_lineage(every)
    children = every.where("pa IS NOT NULL").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count(F.lit(1)).alias("n_children"))
    last = members.join(sizes, "c").where("depth = size").select("a", "b", "c")
    last = last.union(sizes.where("size = 0").select(zero.alias("a"), zero.alias("b"), "c"))
    return cut_lineage(every.join(children, ID, "left").join(end_digests(last), ID, "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))).withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))))


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """(a, b, *values): sums over the subtrees, tops included, of (a, b, pa, pb, depth, *values).

    The parent of a root is NULL; there may be several trees.
    """
    extra = [f"{v}_x" for v in values]
    order = F.reverse(F.lpad(F.bin("depth"), 64, "0"))
    kids = tree.where("pa IS NOT NULL").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count(F.lit(1)).alias("kids"))
    state = tree.join(kids, ID, "left").select(
        *ID, "pa", "pb", order.alias("rank"), F.coalesce("kids", F.lit(0)).alias("kids"),
        *[F.col(v).cast("long").alias(v) for v in values], *[F.lit(0).cast("long").alias(x) for x in extra])
    state = cut_lineage(state)
    done, spliced = [], []
    while True:
        # Rake: a leaf's total is known and goes, with what it carries, to its parent.
        leaves = state.where("kids = 0")
        done.append(leaves.select(*ID, *values))
        gifts = leaves.where("pa IS NOT NULL").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
            F.count(F.lit(1)).alias("gone"), *[F.sum(F.col(v) + F.col(x)).alias(f"{v}_g")
                                               for v, x in zip(values, extra)])
        zero = F.lit(0).cast("long")
        rest = state.where("kids > 0").join(gifts, ID, "left").select(
            *ID, "pa", "pb", "rank", (F.col("kids") - F.coalesce("gone", zero)).alias("kids"),
            *[(F.col(v) + F.coalesce(f"{v}_g", zero)).alias(v) for v in values], *extra)
        rest = cut_lineage(rest)
        if rest.isEmpty():
            break
        # Compress: of each node with one child, the child; and whether it is a chain node too.
        chain = (F.col("kids") == 1) & F.col("pa").isNotNull()
        only = rest.where("pa IS NOT NULL").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
            F.min("a").alias("ka"), F.min("b").alias("kb"), F.min(F.when(chain, F.col("rank"))).alias("below"),
            *[F.min(x).alias(f"{x}_k") for x in extra])
        pairs = cut_lineage(rest.where(chain).join(only, ID))
        above = pairs.select(F.col("ka").alias("a"), F.col("kb").alias("b"), F.col("rank").alias("above"))
        out = pairs.join(above, ID, "left").where(
            "(below IS NULL OR rank > below) AND (above IS NULL OR rank > above)")
        # total(node) = its own sum + total(child) + what the child carries
        out = cut_lineage(out.select(*ID, "pa", "pb", "ka", "kb", *[
            (F.col(v) + F.col(f"{x}_k")).alias(v) for v, x in zip(values, extra)], *extra))
        spliced.append(out.select(*ID, "ka", "kb", *values))
        heirs = out.select(F.col("ka").alias("a"), F.col("kb").alias("b"), F.col("pa").alias("na"),
                           F.col("pb").alias("nb"), *[(F.col(v) + F.col(x)).alias(f"{x}_n")
                                                      for v, x in zip(values, extra)])
        state = cut_lineage(rest.join(out.select(*ID), ID, "left_anti").join(heirs, ID, "left").select(
            *ID, F.coalesce("na", "pa").alias("pa"), F.coalesce("nb", "pb").alias("pb"), "rank", "kids", *values,
            *[F.coalesce(f"{x}_n", x).alias(x) for x in extra]))
    # Expand: the child of a node spliced out was there after its round, so its total is known.
    known = done[0]
    for more in done[1:]:
        known = known.union(more)
    for out in reversed(spliced):
        child = known.select(F.col("a").alias("ka"), F.col("b").alias("kb"),
                             *[F.col(v).alias(f"{v}_k") for v in values])
        found = out.join(child, ["ka", "kb"]).select(
            *ID, *[(F.col(v) + F.col(f"{v}_k")).alias(v) for v in values])
        known = known.union(cut_lineage(found))
    return known


def _with_parents(every: DataFrame) -> DataFrame:
    """Column parent_conv_id. Parents of many children are a list of their own: one row per
    ``MANY_CHILDREN`` nodes at most, broadcast up to ``SHORT_LIST`` rows."""
    parents = every.select(F.col("a").alias("pa"), F.col("b").alias("pb"), "n_children",
                           F.col("conv_id").alias("parent_conv_id"))
    wide = cut_lineage(parents.where(F.col("n_children") > MANY_CHILDREN).drop("n_children"))
    usual = parents.where(F.col("n_children").between(1, MANY_CHILDREN)).drop("n_children")
    if wide.limit(SHORT_LIST + 1).count() > SHORT_LIST:
        return every.join(wide.union(usual), ["pa", "pb"], "left")
    marked = every.join(F.broadcast(wide.withColumnRenamed("parent_conv_id", "wide")), ["pa", "pb"], "left")
    rest = marked.where("wide IS NULL").drop("wide").join(usual, ["pa", "pb"], "left")
    return rest.unionByName(marked.where("wide IS NOT NULL").withColumnRenamed("wide", "parent_conv_id"))


def report(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of
    every node of the trie of the rebuilt conversations.

    NULL roles and texts are empty ones. Rows without a conv_id belong to no conversation. Turns of the same
    number, repeated rows included, all count, in the order of their digests. A table without any
    conversation gives no rows, not even a root. Very long texts count with all their bytes; columns
    other than the four are not read.
    """
    every = nodes(conversations)
    own = every.select(*ID, "pa", "pb", "depth", F.when(F.col("n_children") == 0, 1).otherwise(0).alias("n_leaves"),
                       ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    totals = subtree_totals(own, ["n_leaves", "saved_tokens"])
    return _with_parents(every).join(totals, ID).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
