"""Benchmark decontamination: passages of test items found in training texts and removed.

Every run of ``WINDOW`` consecutive words of an item is one window (a shorter item is one window
of its own length). The set of normalised windows is broadcast; each text is scanned window by
window, and a hit is verified by the join itself, which compares the words and not their hash.
A set above ``BLOCK`` windows is broadcast in blocks, one scan each, so its size never matters
for memory. Everything is built-in expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .common import RAW_WORD, WORD, ascii_lower, fresh, words

WINDOW = 10
BLOCK = 400_000


def _windows(ws: Column, size: int | Column, n: Column) -> Column:
    """All runs of ``size`` words as texts; NULL where there are fewer words."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.when(n >= size, F.transform(
        F.sequence(F.lit(1), n - size + 1),
        lambda i: F.array_join(F.slice(ws, i, size), " ")))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of all items: (win, size, items); items without words have none."""
    ws = benchmark.select("item_id", words(F.col("text").cast("string")).alias("ws"))
    ws = ws.select("*", F.size("ws").alias("n")).where("n > 0")
    size = F.least(F.col("n"), F.lit(window))
    found = ws.select("item_id", size.alias("size"),
                      F.explode_outer(_windows(F.col("ws"), size, F.col("n"))).alias("win"))
    return found.groupBy("win", "size").agg(F.collect_set("item_id").alias("items"))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         block: int = BLOCK) -> DataFrame:
    """One row per contaminated text: (id, th, places, items).

    ``th`` is the hash of the text, so repeated ids with different texts stay apart; ``places``
    are the numbers (from 0) of the words inside a window, ascending; ``items`` the ids of items
    with a window in the text, NULL ids left out.
    """
    known = cut_lineage(benchmark_windows(benchmark, window))
    sizes = {r["size"]: r["n"] for r in known.groupBy("size").agg(
        F.sum(F.size("items") + 1).alias("n")).collect()}
    blocks = max(1, -(-sum(sizes.values()) // block))
    text = F.col("text").cast("string")
    scan = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text).alias("th"),
                       words(text).alias("ws")).select("*", F.size("ws").alias("n"))
    found = []
    for size in sorted(sizes):
        # An outer explode: an inner one would compute all windows a second time, as a filter.
        rows = scan.select("id", "th", F.posexplode_outer(
            _windows(F.col("ws"), size, F.col("n"))).alias("pos", "win"))
        for i in range(blocks):
            part = known.where((F.col("size") == size)
                               & (F.pmod(F.xxhash64("win"), F.lit(blocks)) == i))
            found.append(rows.join(F.broadcast(part.select("win", "size", "items")), "win"))
    if not found:
        found = [scan.where("false").select("id", "th", F.lit(0).alias("pos"), F.lit(1).alias("size"),
                                            F.array(F.lit(0).cast("bigint")).alias("items"))]
    found = [f.select("id", "th", "pos", "size", "items") for f in found]
    inside = F.flatten(F.transform(F.collect_set(F.struct("pos", "size")), lambda p: F.sequence(
        p["pos"], p["pos"] + p["size"] - 1)))
    return reduce(DataFrame.unionAll, found).groupBy("id", "th").agg(
        F.array_sort(F.array_distinct(inside)).alias("places"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: its words, the words hit, and the items found.

    A NULL or wordless text has no words and is never hit. ``items_sha256`` is over the ids as
    text, sorted and joined by commas (the empty text for none). Equal rows get equal results.
    Extra columns are not read.
    """
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(text).alias("_th"), F.coalesce(
        F.regexp_count(text, F.lit(RAW_WORD)), F.lit(0)).cast("bigint").alias("n_words"))
    found = hits(docs, benchmark, **options)
    both = rows.join(found, rows["doc_id"].eqNullSafe(found["id"]) & (rows["_th"] == found["th"]),
                     "left")
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    n_hit = F.coalesce(F.size("places"), F.lit(0)).cast("bigint")
    return both.select(
        "doc_id", "n_words", F.when(F.col("places").isNull(), 0).otherwise(n_hit).cast("bigint").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(names, F.lit("")).cast("binary"), 256).alias("items_sha256"),
        F.col("places").isNotNull().alias("contaminated"))


def without_words(text: Column, places: Column) -> Column:
    """The text less the given words (numbers from 0) and what follows each up to the next word."""
    low = ascii_lower(text)
    pieces = F.regexp_extract_all(text, F.lit(f"(?:{RAW_WORD})|(?:[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+)"), F.lit(0))
    shift = F.when(low.rlike("^" + WORD), 0).otherwise(1)
    return F.array_join(F.filter(pieces, lambda p, i: ~F.array_contains(
        places, F.floor((i - shift) / 2).cast("int")) | (i < shift)), "")


def clean(docs: DataFrame, benchmark: DataFrame, action: str = "documents", **options) -> DataFrame:
    """The rows with all their columns, less contaminated ones or less their spans.

    ``action`` is "documents" (a row with a hit goes) or "spans" (the hit words go, with what
    separates them from the next word).
    """
    found = hits(docs, benchmark, **options)
    id_, th, places = (fresh(docs, c) for c in ("_id", "_th", "_places"))
    found = found.select(F.col("id").alias(id_), F.col("th").alias(th), F.col("places").alias(places))
    same = (docs["doc_id"].eqNullSafe(found[id_])
            & (F.xxhash64(docs["text"].cast("string")) == found[th]))
    if action == "documents":
        return docs.join(found, same, "left_anti")
    if action != "spans":
        raise ValueError("action is 'documents' or 'spans'")
    both = docs.join(found, same, "left")
    rest = F.when(F.col(places).isNull(), F.col("text")).otherwise(
        without_words(F.col("text"), F.col(places)))
    return both.select(*[rest.alias(c) if c == "text" else docs[c] for c in docs.columns])
