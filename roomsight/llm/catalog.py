"""Queries of the operators over whole tables, and the same in SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from . import (chunks, decontaminate, language, licences, minhash, mixing, quality, scoring, simhash,
               tokens, toxicity, trie, whitening)
from .oracles import ORACLES

TOKENIZER = "word_bpe_49k.json"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark, sf_dir):
    return decontaminate.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_mixture(spark, sf_dir):
    return mixing.report(_read(spark, sf_dir, "documents"))


def op3_lm_scoring(spark, sf_dir):
    return scoring.report(_read(spark, sf_dir, "documents"))


def op4_quality(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    return quality.report(docs, quality.learn(docs, _read(spark, sf_dir, "labels")))


def op5_simhash(spark, sf_dir):
    return simhash.report(_read(spark, sf_dir, "documents"))


def op6_token_output(spark, sf_dir):
    return tokens.report(_read(spark, sf_dir, "documents"), scratch_path(spark, "tokens"),
                         public_tokenizers.path(TOKENIZER))


def op7_language(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    return language.report(docs, language.learn(docs))


def op8_toxicity(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    return toxicity.report(docs, toxicity.learn(docs, _read(spark, sf_dir, "labels")))


def op9_licence_scan(spark, sf_dir):
    return licences.report(_read(spark, sf_dir, "documents"))


def op10_chunk_fingerprints(spark, sf_dir):
    return chunks.report(_read(spark, sf_dir, "documents"))


def op11_conversation_trie(spark, sf_dir):
    return trie.report(_read(spark, sf_dir, "conversations"))


def op12_whitening(spark, sf_dir):
    return whitening.report(_read(spark, sf_dir, "embeddings"))


def op13_minhash(spark, sf_dir):
    return minhash.report(_read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_mixture, op3_lm_scoring, op4_quality, op5_simhash, op6_token_output,
    op7_language, op8_toxicity, op9_licence_scan, op10_chunk_fingerprints,
    op11_conversation_trie, op12_whitening, op13_minhash)}
