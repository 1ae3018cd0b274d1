"""MinHash near-duplicates: banded universal hash minima, verification, components.

The shingles of a text are its distinct runs of ``SHINGLE`` words, as 64-bit values. Every set gives
``BANDS * ROWS`` minima under multiply-shift hash functions; the ``ROWS`` minima of a band are one key,
and sets with a key in common are candidates. Candidates whose minima agree too rarely for the
similarity asked for are left (``least_agreement``: a pair at the similarity is lost with a chance
below ``MISS``), the others make classes, by large-star and small-star. The whole shingle sets of a
class then meet once, and only pairs that are similar enough as sets are links. The components of
the links are found in the same way.

Equal sets collapse to one before any join. No pair of a group is a row: a task returns a forest of
the links among its rows. A group too large for one task is cut by set size (sets whose sizes lie
apart cannot be similar) and then into chunks whose pairs meet in different tasks.

Two sets at the similarity itself share no band with a chance of ``(1 - 0.85 ** 5) ** 25`` or 4e-7
for the default parameters, more similar ones with less; that and ``MISS`` is all that can be lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage
from .common import fresh, map_arrow
from .simhash import Forest, components

SHINGLE = 5
PERCENT = 85
BANDS = 25
ROWS = 5
SEED = 42
MISS = 1e-9
GROUP_ROWS = 20_000
GROUP_SHINGLES = 1_000_000
AT_ONCE = 32_768
SMALL = 24
REMEMBERED = 300_000
FILTER_BITS = 1 << 26


class WordValues(dict):
    """XXH64 of words, found when first asked for; a bounded number is remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


class Functions:
    """The hash functions, drawn from a seed."""

    def __init__(self, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS):
        r = np.random.default_rng(SEED)
        odd = lambda n, bits, kind: r.integers(0, 1 << (bits - 1), n, kind) * kind(2) + kind(1)
        self.shingle, self.bands, self.rows = shingle, bands, rows
        self.by_place = odd(shingle + 1, 64, np.uint64)
        self.scale = odd(bands * rows, 32, np.uint32)
        self.shift = r.integers(0, 1 << 32, bands * rows, np.uint32, endpoint=False)
        self.by_row = odd(rows, 64, np.uint64)
        self.words = WordValues()

    def shingles(self, text: bytes | None) -> np.ndarray:
        """Distinct shingles of a text in ascending order, as unsigned 64-bit values."""
        ws = text.lower().split() if text else []
        if not ws:
            return np.zeros(0, np.uint64)
        w = np.fromiter(map(self.words.__getitem__, ws), np.uint64, len(ws))
        width = min(self.shingle, len(w))
        n = len(w) - width + 1
        out = np.repeat(self.by_place[-1:] * np.uint64(width), n)
        for j in range(width):
            out += w[j:j + n] * self.by_place[j]
        return np.unique(mixed(out))

    def minima(self, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(set, function) minima of the sets that begin at ``starts`` in ``values``."""
        x = (values >> np.uint64(32)).astype(np.uint32)
        held = np.empty_like(x)
        out = np.empty((len(starts), len(self.scale)), np.uint32)
        for i, (a, b) in enumerate(zip(self.scale, self.shift)):
            np.multiply(x, a, out=held)
            np.add(held, b, out=held)
            out[:, i] = np.minimum.reduceat(held, starts)
        return out

    def keys(self, minima: np.ndarray) -> np.ndarray:
        """(set, band) keys; different bands have different ones."""
        wide = minima.reshape(len(minima), self.bands, self.rows).astype(np.uint64)
        return mixed((wide * self.by_row).sum(2, dtype=np.uint64)
                     + np.arange(1, self.bands + 1, dtype=np.uint64) * self.by_place[0]).view(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64, fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def least_agreement(functions: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """Largest t such that a pair at the similarity agrees in fewer than t minima with a chance of
    at most ``miss``."""
    p, total = percent / 100, 0.0
    for t in range(functions + 1):
        total += math.comb(functions, t) * p ** t * (1 - p) ** (functions - t)
        if total > miss:
            return t
    return functions


def signatures(docs: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, th (hash of the text), n, sid, keys and sketch of every row.

    n counts the distinct shingles; ``sid`` (16 bytes) names the set; ``keys`` has the bands' keys and
    ``sketch`` a byte of each minimum. The last three are NULL for an empty set.
    """
    text = F.col("text").cast("string")
    given = docs.select("doc_id", F.xxhash64(text).alias("th"), text.cast("binary").alias("text"))
    names = ["n", "sid", "keys", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Functions(shingle, bands, rows)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            at = 0
            while at < len(texts):
                sets, held, first = [], 0, at
                while at < len(texts) and held < AT_ONCE:
                    sets.append(made.shingles(texts[at]))
                    held += len(sets[-1])
                    at += 1
                n = np.array([len(s) for s in sets])
                full = np.flatnonzero(n)
                sid, keys, sketch = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if len(full):
                    low = made.minima(np.concatenate(sets), (np.cumsum(n) - n)[full])
                    bytes_, found = low.astype(np.uint8), made.keys(low)
                    for j, i in enumerate(full):
                        sid[i] = xxhash.xxh3_128_digest(sets[i])
                        keys[i], sketch[i] = found[j], bytes_[j].tobytes()
                rows_ = [batch.column(i).slice(first, len(sets)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    rows_ + [pa.array(n, pa.int64()), pa.array(sid, pa.binary()),
                             pa.array(keys, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                    names=["doc_id", "th"] + names)

    made_type = StructType.fromDDL("n long, sid binary, keys array<long>, sketch binary")
    return map_arrow(given, run, StructType([given.schema[c] for c in ("doc_id", "th")] + made_type.fields))


def meet(rows: DataFrame, weight: str, most: int, percent: int = PERCENT) -> DataFrame:
    """Deal (group, node, n, ...) out to tasks: column ``task`` in place of ``group``.

    Groups of one row are left out. Any two rows of a group whose sizes n allow the similarity
    meet in at least one task, and a task has at most about twice ``most`` of the column ``weight``. A group
    within ``most`` is one task. A larger one is cut into stretches of sizes, each joined with the
    one below, and these into chunks by hash.
    """
    width = max(math.log(100 / percent) * (1 + 1e-9), 1e-4)
    totals = rows.groupBy("group").agg(F.sum(weight).alias("_total"), F.count(F.lit(1)).alias("_rows"))
    rows = rows.join(totals.where("_rows > 1").drop("_rows"), "group")
    level = F.floor(F.log("n") / F.lit(width)).cast("int")
    rows = rows.withColumn("_level", F.explode(
        F.when(F.col("_total") > most, F.array(level, level + 1)).otherwise(F.array(F.lit(-1)))))
    wide = rows.where("_level >= 0").groupBy("group", "_level").agg(
        F.ceil(F.sum(weight) / F.lit(most)).cast("int").alias("_chunks"))
    rows = rows.join(wide, ["group", "_level"], "left").withColumn("_chunks", F.coalesce("_chunks", F.lit(1)))
    rows = rows.withColumn("_chunk", F.pmod(F.xxhash64("node"), F.col("_chunks")).cast("int"))
    # With several chunks a pair of a chunk with itself is contained in its pairs with others.
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).where(
        "_chunks = 1 OR _chunk <> _other")
    task = F.xxhash64("group", "_level", F.least("_chunk", "_other"), F.greatest("_chunk", "_other"))
    return rows.withColumn("task", task).drop(
        "group", "_total", "_level", "_chunks", "_chunk", "_other")


def _whole_groups(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[pa.Table]:
    """Tables of whole runs of the first column, which is sorted."""
    kept, held = [], 0
    for batch in batches:
        kept.append(batch)
        held += batch.num_rows
        if held < at_once:
            continue
        table = pa.Table.from_batches(kept).combine_chunks()
        task = table.column(0).to_numpy()
        cut = int(np.searchsorted(task, task[-1]))  # the last group may go on
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
        kept, held = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(kept).combine_chunks()


def sketch_links(task: np.ndarray, n: np.ndarray, sketch: np.ndarray, least: int,
                 percent: int = PERCENT) -> np.ndarray:
    """For each row the smallest one it hangs together with by agreeing sketches, within its task.

    ``task`` and, within it, ``n`` ascend. Small groups are compared all at once; in larger ones
    each row reached is compared with the rows not yet reached of a possible size.
    """
    forest = Forest(len(task))
    first = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1]]))
    size = np.diff(np.append(first, len(task)))
    of = np.repeat(size, size)
    for d in range(1, min(SMALL, size.max(initial=1))):
        i = np.flatnonzero((task[:-d] == task[d:]) & (of[:-d] <= SMALL))
        i = i[100 * n[i] >= percent * n[i + d]]
        for part in np.array_split(i, len(i) // AT_ONCE + 1):
            part = part[forest.roots(part) != forest.roots(part + d)]
            near = (sketch[part] == sketch[part + d]).sum(1) >= least
            forest.link(part[near], part[near] + d)
    for a, s in zip(first[size > SMALL], size[size > SMALL]):
        left = np.arange(a, a + s)
        while len(left):
            reached, left = [left[0]], left[1:]
            while reached and len(left):
                x = reached.pop()
                fits = (100 * n[left] >= percent * n[x]) & (100 * n[x] >= percent * n[left])
                near = np.flatnonzero(fits)
                near = near[(sketch[left[near]] == sketch[x]).sum(1) >= least]
                hit = left[near]
                forest.link(np.full(len(hit), x), hit)
                reached.extend(hit.tolist())
                left = np.delete(left, near)
    return forest.roots(np.arange(len(task)))


def set_links(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """A forest of the pairs (i, j) of sets with ``100 * common >= percent * union``.

    From each set reached, the sets not yet reached are counted by an inverted index, which is
    made anew when half of them are reached.
    """
    m, n = len(sets), np.array([len(s) for s in sets])
    end = np.cumsum(n)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    new = np.concatenate([[True], values[order][1:] != values[order][:-1]])
    code = np.empty(len(values), np.int64)
    code[order] = np.cumsum(new) - 1
    holder, held = np.repeat(np.arange(m), n)[order], code[order]
    start = np.append(np.flatnonzero(new), len(values))
    left = np.ones(m, bool)
    count = indexed = m
    pairs: list[tuple[int, int]] = []
    for seed in range(m):
        if not left[seed]:
            continue
        left[seed], count, reached = False, count - 1, [seed]
        while reached and count:
            x = reached.pop()
            if 2 * count <= indexed:
                keep = left[holder]
                holder, held, indexed = holder[keep], held[keep], count
                start = np.concatenate([[0], np.cumsum(np.bincount(held, minlength=len(start) - 1))])
            c = code[end[x] - n[x]:end[x]]
            lengths = start[c + 1] - start[c]
            skip = np.repeat(start[c] - np.cumsum(lengths) + lengths, lengths)
            common = np.bincount(holder[skip + np.arange(len(skip))], minlength=m)
            hit = np.flatnonzero(left & (100 * common >= percent * (n + n[x] - common)))
            left[hit] = False
            count -= len(hit)
            reached.extend(hit.tolist())
            pairs += [(x, h) for h in hit.tolist()]
    return pairs


def _placed(rows: DataFrame, *columns: str) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select("task", *columns).repartition(n, "task").sortWithinPartitions("task")


def alike(sets: DataFrame, percent: int = PERCENT, group_rows: int = GROUP_ROWS,
          functions: int = BANDS * ROWS) -> DataFrame:
    """Pairs (a, b) of nodes that span the candidates whose sketches agree, from (node, n, keys,
    sketch) of different sets."""
    least = least_agreement(functions, percent)
    rows = sets.select("node", "n", F.explode("keys").alias("group"))
    dealt = meet(rows.withColumn("one", F.lit(1)), "one", group_rows, percent)
    dealt = dealt.join(sets.select("node", "sketch"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, group_rows):
            task, node, n = (table.column(i).to_numpy() for i in range(3))
            sketch = np.frombuffer(b"".join(table.column(3).to_pylist()), np.uint8).reshape(len(task), -1)
            order = np.lexsort((node, n, task))
            task, node, n, sketch = task[order], node[order], n[order], sketch[order]
            root = sketch_links(task, n, sketch, least, percent)
            hit = root != np.arange(len(root))
            yield pa.RecordBatch.from_arrays([pa.array(node[hit]), pa.array(node[root[hit]])], names=["a", "b"])

    return map_arrow(_placed(dealt, "node", "n", "sketch"), run, "a long, b long")


def similar(classes: DataFrame, texts: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
            group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """Pairs (a, b) of nodes that span the links within classes, judged on whole shingle sets.

    ``classes`` has (group, node, n), ``texts`` (node, text) of the same nodes.
    """
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Functions(shingle)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([made.shingles(t).tobytes() for t in batch.column(1).to_pylist()],
                                           pa.binary())], names=["node", "grams"])

    given = texts.select("node", F.col("text").cast("binary").alias("text"))
    grams = map_arrow(given, sets, "node long, grams binary")
    dealt = meet(classes, "n", group_shingles, percent).join(grams, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, 1):
            task, node = table.column(0).to_numpy(), table.column(1).to_numpy()
            found = [np.frombuffer(g, np.uint64) for g in table.column(2).to_pylist()]
            edge = np.append(np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1]])), len(task))
            pairs = [(int(node[a + i]), int(node[a + j])) for a, b in zip(edge, edge[1:])
                     for i, j in set_links(found[a:b], percent)]
            a, b = zip(*pairs) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return map_arrow(_placed(dealt, "node", "grams"), run, "a long, b long")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, th, text) of the rows whose (_id, _th) is wanted, and of few others.

    The wanted rows set bits of a table of ``FILTER_BITS`` bits, which every task gets; so most texts
    are left before the join shuffles them. With many millions of wanted rows it lets more pass.
    """
    bit = lambda *key: F.pmod(F.xxhash64(*key), F.lit(FILTER_BITS))
    marks = wanted.select(bit("_id", "_th").alias("bit")).groupBy(
        F.shiftright("bit", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toPandas()
    table = np.zeros(FILTER_BITS // 64, np.uint64)
    table[marks["word"].to_numpy(np.int64)] = marks["bits"].to_numpy(np.int64).view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(text).alias("th"), text.alias("text"))
    rows = rows.withColumn("bit", bit("doc_id", "th"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(3).to_numpy()
            hit = (shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            yield batch.filter(pa.array(hit.astype(bool))).select(["doc_id", "th", "text"])

    return map_arrow(rows, run, rows.drop("bit").schema)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS,
                    rows: int = ROWS, group_rows: int = GROUP_ROWS,
                    group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, root and component_id of every row.

    component_id is the smallest doc_id of all rows whose sets are linked, directly or over
    others; ``root`` names the component. A NULL, empty or wordless text has an empty set, is linked
    with nothing and has root NULL and its own id as component_id. A NULL doc_id is linked like
    any other and is a component's id only where it has no other. Repeated rows stay repeated. An
    empty table gives no rows. Very long texts are read whole; a task holds one batch of texts and
    their sets. Columns other than doc_id and text are not read.
    """
    slim = cut_lineage(signatures(docs, shingle, bands, rows))
    full = slim.where("n > 0")
    sets = cut_lineage(full.groupBy("sid").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "th")).alias("row"), F.first("n").alias("n"),
        F.first("keys").alias("keys"), F.first("sketch").alias("sketch")).withColumn(
        "node", F.monotonically_increasing_id()))
    classes = components(alike(sets, percent, group_rows, bands * rows))
    # The class itself is a member, which components() names as root only.
    member = classes.select(F.col("root").alias("group"), "node")
    member = member.union(member.select("group", F.col("group").alias("node")).distinct())
    member = cut_lineage(member.join(sets.select("node", "n", "row"), "node"))
    rows_of = member.select("node", F.col("row.doc_id").alias("_id"), F.col("row.th").alias("_th"))
    found = _texts(docs, rows_of).join(rows_of, (F.col("th") == F.col("_th"))
                                       & F.col("doc_id").eqNullSafe(F.col("_id")))
    found = found.select("node", "text").dropDuplicates(["node"])  # repeated rows
    links = similar(member.select("group", "node", "n"), found, shingle, percent, group_shingles)
    tree = components(links).withColumnRenamed("node", "_node")
    of = sets.select("sid", "least", "node").join(tree, F.col("node") == F.col("_node"), "left").select(
        "sid", "least", F.coalesce("root", "node").alias("root"))
    ids = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of = of.join(ids, "root").select("sid", "root", "component_id")
    known = full.select("doc_id", "n", "sid").join(of, "sid").select(
        "doc_id", F.col("n").alias("n_shingles"), "root", "component_id")
    lone = slim.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"),
                                      F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id"))
    return known.union(lone)


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the id is the component's) of every row.

    A NULL doc_id is kept where its component has no other id. NULLs, empty texts, repeated rows, an empty
    table and long texts: see ``near_duplicates``.
    """
    return near_duplicates(docs, **options).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose doc_id is that of their component, with all their columns.

    Rows that share the id of a kept one are told apart by nothing and stay with it; rows without an id
    stay where their component has no other. Empty texts stay. An empty table gives no rows, and columns
    of clashing names are returned as they are.
    """
    ids = report(docs, **options).where("kept").select("doc_id").distinct()
    name = fresh(docs, "_kept")
    ids = ids.toDF(name)
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids[name]), "left_semi")
