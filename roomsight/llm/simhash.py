"""SimHash near-duplicates: fingerprints linked by a binary-trie self-join, then components.

Two fingerprints link when at most ``distance`` of 64 bits differ. Then at least one of
``distance + 1`` bit blocks is equal, so each distinct fingerprint goes to one group per block,
and within a group the self-join walks the binary trie of the fingerprints: pairs of nodes are
descended together, a pair adds one error where its nodes take different branches and is pruned
beyond ``distance`` errors. A task sends back no more than a spanning forest of each group, so a
group of near copies costs as many rows as it has members.

Equal fingerprints collapse to one before any join. A group above ``group_rows`` is cut into
chunks whose pairs are joined in different tasks: memory is bounded and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .common import fresh, map_arrow, per_row

SHINGLE = 4
DISTANCE = 4
GROUP_ROWS = 50_000
PAIRS_AT_ONCE = 200_000
SEED = 42


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64 majority bits of the XXH64 values of the word shingles, repeats included; 0 for none.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Fewer words than
    ``shingle`` make one shingle.
    """
    ws = text.lower().split() if text else []
    if not ws:
        return 0
    joined, n = b" ".join(ws), max(1, len(ws) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in ws]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    view = memoryview(joined)
    hash64 = xxhash.xxh64_intdigest
    tops = ends[shingle - 1:] if len(ws) >= shingle else ends[-1:]
    values = np.fromiter((hash64(view[a:b], SEED) for a, b in zip(starts[:n].tolist(), tops.tolist())),
                         np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        part = values[at:at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default doc_id) and ``fp``, the fingerprint as a signed long; one row per row."""
    def make():
        def work(columns):
            return [(v - (1 << 64) if v >> 63 else v,)
                    for v in (fingerprint(t, shingle) for t in columns[0])]
        return work

    return per_row(docs, "fp long", make, ["text"], ["doc_id"] if keep is None else keep)


class Forest:
    """Union of linked rows, vectorised."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        p = self.parent
        r = p[x]
        while True:
            up = p[r]
            if np.array_equal(up, r):
                return r
            r = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            open_ = a != b
            a, b = a[open_], b[open_]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def trie_links(group: np.ndarray, keys: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """For each row the smallest row it is linked to, directly or over others of its group.

    ``group`` and ``keys`` (unsigned) are sorted together. A node is a stretch of rows that share
    a prefix; its branches are found by counting ones. Node pairs are expanded a bounded number
    at a time, deepest first.
    """
    n = len(keys)
    forest = Forest(n)
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    last = np.concatenate([first[1:], [n]])
    many = last - first > 1
    lo, hi = first[many].astype(np.int32), last[many].astype(np.int32)
    ones: dict[int, np.ndarray] = {}

    def middle(lo, hi, bit):
        if bit not in ones:
            ones[bit] = np.concatenate(
                [[0], np.cumsum((keys >> np.uint64(63 - bit)) & np.uint64(1))]).astype(np.int32)
        return hi - (ones[bit][hi] - ones[bit][lo])

    stack = [(0, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        bit, a, b, c, d, err = stack.pop()
        if len(a) > PAIRS_AT_ONCE:
            half = len(a) // 2
            stack.append((bit, a[half:], b[half:], c[half:], d[half:], err[half:]))
            a, b, c, d, err = a[:half], b[:half], c[:half], d[:half], err[:half]
            stack.append((bit, a, b, c, d, err))
            continue
        # Two single rows: the rest of their paths at once.
        leaf = (b - a == 1) & (d - c == 1)
        if leaf.any():
            x, y = a[leaf], c[leaf]
            near = np.bitwise_count(keys[x] ^ keys[y]) <= distance
            forest.link(x[near], y[near])
            a, b, c, d, err = (v[~leaf] for v in (a, b, c, d, err))
        if bit == 64:
            # Equal keys: each stretch is one component.
            if len(a):
                wide = np.repeat(np.arange(len(a)), b - a)
                x = np.arange(len(wide)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[wide]
                forest.link(x, c[wide])
                wide = np.repeat(np.arange(len(c)), d - c)
                y = np.arange(len(wide)) - np.repeat(np.cumsum(d - c) - (d - c), d - c) + c[wide]
                forest.link(y, a[wide])
            continue
        if not len(a):
            continue
        same = a == c
        m, k = middle(a, b, bit), middle(c, d, bit)
        cross = ~same
        less = cross & (err < distance)
        grown = (err + 1).astype(np.int8)
        turn = same & (grown <= distance)
        new = [(a, m, c, k, err, same | cross), (m, b, k, d, err, same | cross),
               (a, m, k, d, grown, turn | less), (m, b, c, k, grown, less)]
        parts = []
        for p, q, r, s, e, take in new:
            take = take & (q > p) & (s > r) & ~((p == r) & (q - p == 1))
            parts.append((p[take], q[take], r[take], s[take], e[take]))
        joined = [np.concatenate(x) for x in zip(*parts)]
        if len(joined[0]):
            stack.append((bit + 1, *joined))
    return forest.roots(np.arange(n))


def _blocks(parts: int) -> list[tuple[int, int]]:
    """(shift, width) of the bit blocks, from the lowest bits on."""
    edges = [64 * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def links(fps: DataFrame, distance: int = DISTANCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pairs (fp, other) that span the components of each group of distinct fingerprints ``fp``."""
    blocks = _blocks(distance + 1)
    value = [F.struct(F.lit(i).alias("block"),
                      F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)).alias("value"))
             for i, (s, w) in enumerate(blocks)]
    rows = fps.select("fp", F.inline(F.array(*value)))
    sizes = rows.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(sizes, ["block", "value"])
    chunks = F.ceil(F.col("n") / F.lit(group_rows)).cast("int")
    rows = rows.withColumn("chunks", chunks).withColumn(
        "chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    pairs = rows.select("block", "value", "fp", "chunk",
                        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    pairs = pairs.select(
        "fp", F.xxhash64("block", "value", F.least("chunk", "other"),
                         F.greatest("chunk", "other")).alias("task"))
    # With several chunks a pair of a chunk with itself is contained in its pairs with others.
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = pairs.repartition(n, "task").sortWithinPartitions("task")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def solve(task, fp):
            order = np.lexsort((fp, task))
            task, fp = task[order], fp[order]
            root = trie_links(task, fp, distance)
            hit = root != np.arange(len(root))
            return pa.RecordBatch.from_arrays(
                [pa.array(fp[hit].view(np.int64)), pa.array(fp[root[hit]].view(np.int64))],
                names=["fp", "other"])

        for batch in batches:
            kept.append((batch.column(1).to_numpy(),
                         batch.column(0).to_numpy().view(np.uint64)))
            held += batch.num_rows
            if held < group_rows:
                continue
            task, fp = (np.concatenate(x) for x in zip(*kept))
            cut = int(np.searchsorted(task, task[-1]))  # the last group may go on
            if cut:
                yield solve(task[:cut], fp[:cut])
            kept, held = [(task[cut:], fp[cut:])], len(task) - cut
        if held:
            yield solve(*(np.concatenate(x) for x in zip(*kept)))

    return map_arrow(placed, run, "fp long, other long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable, for every node of (a, b).

    Large-star and small-star by turns: in each step a node's neighbours are linked to the
    smallest of them, found by an aggregate, so no neighbourhood is gathered. Each step is
    written to the shared folder. The sum of the roots falls until nothing changes.
    """
    pairs = cut_lineage(edges.select("a", "b").where("a <> b").distinct())
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        # Large star: neighbours above a node link to the smallest around it.
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: a node and its neighbours below link to the smallest of these.
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(below, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select(
            "e.a", "e.b").where("a <> b").distinct()
        pairs = cut_lineage(small)
        state = pairs.agg(F.count(F.lit(1)), F.count_distinct("a"),
                          F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == state[1] and state == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, fp, component_id and text_hash of every row.

    component_id is the smallest doc_id of all rows whose fingerprints are linked, directly or
    over others. NULL and empty texts have fingerprint 0 and link like any other. A NULL doc_id
    gets a component like others do, and is never its id unless the component has no other.
    Repeated rows stay repeated.
    """
    slim = cut_lineage(fingerprints(
        docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn(
            "text_hash", F.xxhash64("text")), shingle, ["doc_id", "text_hash"]))
    least = cut_lineage(slim.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = links(least.select("fp"), distance, group_rows)
    tree = components(found.select(F.col("fp").alias("a"), F.col("other").alias("b")))
    of = least.join(tree.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    ids = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of = of.join(ids, "root").select("fp", "component_id", "root")
    return slim.join(of, "fp")


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id of every row."""
    return near_duplicates(docs, **options).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One row of each component, with all its columns: the smallest doc_id.

    Among rows of that id the smallest text hash, and of wholly equal ones the one that comes
    first; rows without an id lose to others.
    """
    known = cut_lineage(near_duplicates(docs, **options))
    best = known.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("k"), F.lit(1).alias("x"))
    copies = known.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    kept = best.select("root", "k.doc_id", "k.text_hash").alias("k").join(
        copies.alias("c"), (F.col("k.root") == F.col("c.root"))
        & F.col("k.doc_id").eqNullSafe(F.col("c.doc_id"))
        & F.col("k.text_hash").eqNullSafe(F.col("c.text_hash"))).select(
        F.col("k.doc_id").alias("id"), F.col("k.text_hash").alias("th"), "c.n")
    id_, th, n = (fresh(docs, c) for c in ("_id", "_th", "_n"))
    kept = kept.toDF(id_, th, n)
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(kept[id_])
                     & F.xxhash64(docs["text"].cast("string")).eqNullSafe(kept[th]))
    single = rows.where(F.col(n) == 1).select(*docs.columns)
    return single.unionByName(rows.where(F.col(n) > 1).dropDuplicates([id_, th])
                              .select(*docs.columns))
