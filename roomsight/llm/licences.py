"""Licence scan by diagonal voting.

All rolling word ``K``-grams of the texts are joined to the positions of the same grams in
licence templates. A match votes for the diagonal ``place in text - place in template``; a
passage copied as it is puts all votes of a template on one diagonal, words left out or put in
move the rest to a diagonal nearby. Diagonals up to ``NEAR`` apart are merged, and a merged span
is verified: enough different grams of the template, in a span about as long as the template.

A phrase of the base stands where all its grams vote for one diagonal, which is word-for-word
equality. The template table is fixed and small, so it is broadcast; all is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import RAW_WORD, words
from .decontaminate import _windows

K = 3
NEAR = 3
COVERAGE = 0.6
VOTES = 3
STRETCHED = 1.5

#: Phrases whose places are reported word for word, with their labels.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

#: The wording of common licence notices, for labels of approximate passages.
TEMPLATES = (
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain "
                 "a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-3", "you can redistribute it and or modify it under the terms of the gnu general public "
              "license as published by the free software foundation either version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or "
            "without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def template_grams(spark: SparkSession, base=BASE, templates=TEMPLATES, k: int = K) -> DataFrame:
    """One row per gram and place: (gram, tid, label, is_base, at, grams, length)."""
    rows = []
    for tid, (label, text, is_base) in enumerate(
            [(*b, True) for b in base] + [(*t, False) for t in templates]):
        ws = text.split()
        if len(ws) < k:
            raise ValueError(f"template of fewer than {k} words: {text}")
        rows += [(" ".join(ws[i:i + k]), tid, label, is_base, i, len(ws) - k + 1, len(ws))
                 for i in range(len(ws) - k + 1)]
    return spark.createDataFrame(rows, "gram string, tid int, label string, is_base boolean, "
                                       "at int, grams int, length int")


def votes(docs: DataFrame, base=BASE, templates=TEMPLATES, k: int = K) -> DataFrame:
    """Matches of grams: (id, th, tid, label, is_base, grams, length, at, pos, diagonal)."""
    text = F.col("text").cast("string")
    known = template_grams(docs.sparkSession, base, templates, k)
    scan = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text).alias("th"),
                       words(text).alias("ws")).select("*", F.size("ws").alias("n"))
    grams = scan.select("id", "th", F.posexplode_outer(
        _windows(F.col("ws"), k, F.col("n"))).alias("pos", "gram"))
    # The templates are fixed: some hundreds of rows.
    return grams.join(F.broadcast(known), "gram").withColumn("diagonal", F.col("pos") - F.col("at"))


def spans(found: DataFrame, k: int = K, near: int = NEAR) -> DataFrame:
    """Merged diagonals: (id, th, tid, label, is_base, first, last, coverage, places, accepted).

    ``coverage`` is the share of the template's grams found; ``places`` counts the diagonals
    with all of them; ``first`` and ``last`` are the smallest and largest of these.
    """
    key = ["id", "th", "tid", "label", "is_base", "grams", "length"]
    # Repeated rows vote once: a place of a text and a place of a template are one vote.
    lines = found.groupBy(*key, "diagonal").agg(
        F.collect_set("at").alias("ats"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    order = Window.partitionBy("id", "th", "tid").orderBy("diagonal")
    opens = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > near, F.lit(True))
    lines = lines.withColumn("opens", opens.cast("int"))
    lines = lines.withColumn("cluster", F.sum("opens").over(order))
    whole = F.size("ats") == F.col("grams")
    merged = lines.groupBy(*key, "cluster").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("ats")))).alias("n"),
        F.count_if(whole).alias("places"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last"),
        F.min("low").alias("low"), F.max("high").alias("high"))
    width = F.col("high") + k - F.col("low")
    accepted = F.when(F.col("is_base"), F.col("places") > 0).otherwise(
        (F.col("places") > 0) | ((F.col("n") >= COVERAGE * F.col("grams")) & (F.col("n") >= VOTES)
                                 & (width <= STRETCHED * F.col("length"))))
    return merged.select("id", "th", "tid", "label", "is_base", "first", "last",
                         (F.col("n") / F.col("grams")).alias("coverage"), "places",
                         accepted.alias("accepted"))


def report(docs: DataFrame, base=BASE, templates=TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: base places and labels, labels of all templates, the score.

    NULL and wordless texts have no place. Without one, first_word and last_word are NULL, the
    labels empty texts and the score the best coverage of any template (0 without a match).
    Equal rows get equal results. Extra columns are not read.
    """
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(text).alias("_th"), F.coalesce(
        F.regexp_count(text, F.lit(RAW_WORD)), F.lit(0)).cast("bigint").alias("n_words"))
    found = spans(votes(docs, base, templates))
    is_base = F.col("is_base") & F.col("accepted")

    def names(which):
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    by_text = found.groupBy("id", "th").agg(
        F.sum(F.when(is_base, F.col("places"))).alias("n"),
        F.min(F.when(is_base, F.col("first"))).cast("bigint").alias("first_word"),
        F.max(F.when(is_base, F.col("last"))).cast("bigint").alias("last_word"),
        names(is_base).alias("b"), names(F.col("accepted")).alias("l"),
        F.max("coverage").alias("c"))
    both = rows.join(by_text, rows["doc_id"].eqNullSafe(by_text["id"])
                     & (rows["_th"] == by_text["th"]), "left")
    return both.select("doc_id", "n_words", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_base"),
                       "first_word", "last_word", F.coalesce("b", F.lit("")).alias("base_labels"),
                       F.coalesce("l", F.lit("")).alias("labels"),
                       F.coalesce("c", F.lit(0.0)).alias("score"))
