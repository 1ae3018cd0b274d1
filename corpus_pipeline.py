"""From documents to token files: five stages, each written and read again before the next.

Each stage is a function of (spark, docs, sf_dir); all but the last return the columns of
``documents``. ``run`` applies them in order.

For every stage: NULL texts are empty ones; NULL ids, empty and very long texts, ties and repeated rows are kept or
left as the stage's operator says; an empty table gives an empty one; columns of clashing names come out as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roomsight.llm import decontaminate, mixing, simhash, tokens, toxicity
from roomsight.session import cut_lineage, scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic at all is below one half."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each component of near copies."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of the sources, documents as often as they are taken."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture, read back."""
    return tokens.report(docs, scratch_path(spark, "tokens"),
                         public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
    ("token output", write_tokens),
]

#: Components and learned models are not for SQL; the tests check against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
