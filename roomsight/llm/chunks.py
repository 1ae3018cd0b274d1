"""Document fingerprints by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where its top bits are zero. Chunking is
normalised: up to the usual size more bits must be zero, beyond it fewer, so sizes stay close to
it. Boundaries depend on the last 32 bytes only, so an edit changes the chunks around it and no
others. A fingerprint is the set of (digest, length) of the chunks; the likeness of one to
another is the share of its length whose chunks the other has too.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import map_arrow, per_row, reach

LEAST, USUAL, MOST = 32, 64, 256
HARD_BITS, EASY_BITS = 8, 4
BYTES_AT_ONCE = 2_000_000
FAR = np.int64(1) << 40


def _gear() -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(bytes([b]), seed=1) for b in range(256)], np.uint32)


GEAR = _gear()


def boundaries(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """(text number, begin, end) of every chunk of all texts, and the texts as one."""
    data = b"".join(texts)
    size = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(size)
    begin = end - size
    h = GEAR[np.frombuffer(data, np.uint8)]
    for s in (1, 2, 4, 8, 16):  # the sum over 32 bytes by doubling
        older = h[:-s] << np.uint32(s)
        h = h.copy()
        h[s:] += older
    at = np.arange(1, len(h) + 1)  # a chunk ends after its last byte

    def following(bits):
        cuts = np.where(h >> np.uint32(32 - bits) == 0, at, FAR)
        return np.append(np.minimum.accumulate(cuts[::-1])[::-1], FAR)

    hard, easy = following(HARD_BITS), following(EASY_BITS)
    # All texts advance by one chunk at a time.
    alive = np.flatnonzero(size)
    pos = begin[alive]
    found = []
    while len(alive):
        stop = end[alive]
        first = hard[np.minimum(pos + LEAST - 1, len(h))]
        second = easy[np.minimum(pos + USUAL - 1, len(h))]
        cut = np.where(first < pos + USUAL, first, second)
        cut = np.minimum(np.minimum(cut, pos + MOST), stop)
        found.append((alive, pos, cut))
        more = cut < stop
        alive, pos = alive[more], cut[more]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, data
    owner, start, stop = (np.concatenate(x) for x in zip(*found))
    return owner, start, stop, data


def chunk_sets(texts: list[bytes]) -> list[np.ndarray]:
    """For each text its distinct chunks as ``digest * 256 + length - 1``, ascending."""
    owner, start, stop, data = boundaries(texts)
    view, digest = memoryview(data), xxhash.xxh32_intdigest
    keys = np.fromiter((digest(view[a:b]) for a, b in zip(start.tolist(), stop.tolist())),
                       np.uint64, len(start))
    keys = keys << np.uint64(8) | (stop - start - 1).astype(np.uint64)
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])])[:len(keys)]
    owner, keys = owner[new], keys[new]
    return np.split(keys, np.searchsorted(owner, np.arange(1, len(texts))))


def written(chunks: np.ndarray) -> str:
    """The set as text: base64 of five bytes a chunk."""
    return base64.b64encode(chunks.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the length of ``a`` in chunks that ``b`` has; two empty sets are alike."""
    if not len(a):
        return 0.0 if len(b) else 1.0
    sizes = (a & np.uint64(255)).astype(np.int64) + 1
    place = np.searchsorted(b, a)
    same = np.zeros(len(a), bool)
    ok = place < len(b)
    same[ok] = b[place[ok]] == a[ok]
    return float(sizes[same].sum() / sizes.sum())


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of another text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row, in one pass without an exchange."""
    def make():
        def work(columns):
            texts = [t or b"" for t in columns[0]]
            return [(written(c),) for part in _portions(texts) for c in chunk_sets(texts[part])]
        return work

    return per_row(docs.select("doc_id", F.col("text").cast("string").alias("text")),
                   "fingerprint string", make, ["text"], ["doc_id"])


def _portions(texts: list) -> Iterator[slice]:
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (held < BYTES_AT_ONCE or end == at):
            held += len(texts[end])
            end += 1
        yield slice(at, end)
        at = end


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows (part, flag, doc_id, text) sorted so that each is followed by its next document.

    The order is descending doc_id, NULL last, then the hash of the text; after the last comes
    the first. Stretches of that order are the parts; the first row of each comes once more, with
    ``flag`` 1, after the last row of the part before. Texts are shuffled once.
    """
    spark = docs.sparkSession
    reach(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parts or 4 * n
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    levels = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("doc_id", levels, 100 * parts)).first()[0] or []
    marks = np.unique(np.array(found, np.int64))

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        place = len(marks) - np.searchsorted(marks, ids[known].to_numpy(np.int64), side="right")
        return pd.Series(len(marks) + 1, index=ids.index).where(
            ~known, pd.Series(place, index=ids.index[known])).astype("int32")

    placed = rows.withColumn("part", part_of(F.col("doc_id")))
    order = [F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("down"),
             F.xxhash64("text").alias("th")]
    # One row per part.
    heads = sorted((r["part"], r["k"]) for r in placed.groupBy("part").agg(
        F.min(F.struct(*order)).alias("k")).collect())
    again = [(heads[i - 1][0], None if k["none"] else -k["down"], k["th"])
             for i, (_, k) in enumerate(heads)]
    first = F.broadcast(spark.createDataFrame(again, "part int, head long, th long"))
    ends = rows.join(first, rows["doc_id"].eqNullSafe(first["head"])
                     & (F.xxhash64("text") == first["th"])).select(
        "part", "doc_id", "text").dropDuplicates(["part"]).select(
        "part", F.lit(1).alias("flag"), "doc_id", "text")
    both = placed.select("part", F.lit(0).alias("flag"), "doc_id", "text").unionAll(ends)
    return both.repartition(n, "part").sortWithinPartitions(
        "part", "flag", F.desc_nulls_last("doc_id"), F.xxhash64("text"))


def report(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.

    The next document is the one of the next smaller doc_id (with repeated ids the next by hash
    of the text; equal rows follow each other), after the last the first; a single row is its
    own next. NULL texts count as empty: no chunk, fingerprint "", likeness 1 to another such
    and 0 to all others. Extra columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                 "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
                 pa.float64()]
        held = None
        for batch in batches:
            part, flag, ids, texts = (c.to_pylist() for c in batch.columns)
            for portion in _portions(texts):
                rows = list(zip(part[portion], flag[portion], ids[portion], texts[portion]))
                rows = [held, *rows] if held else rows
                plain = [r[3].encode() for r in rows]
                pairs = [i for i, (a, b) in enumerate(zip(rows, rows[1:])) if not a[1]]
                edited = [edit(rows[i][3], rows[i + 1][3]).encode() for i in pairs]
                sets = chunk_sets(plain + edited)
                made = []
                for at, i in enumerate(pairs):
                    own, changed = sets[i], sets[len(rows) + at]
                    made.append((rows[i][2], len(rows[i][3]),
                                 hashlib.sha256(edited[at]).hexdigest(), written(own),
                                 written(changed), likeness(own, changed),
                                 likeness(own, sets[i + 1])))
                held = rows[-1]
                if made:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=names)

    return map_arrow(
        with_next(docs, parts), run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")
