"""Rows for the tests of the operators."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

#: The columns of documents, and others whose names operators might use inside.
CLASHING = ["fp", "size", "key", "n", "part", "ws", "score", "label", "_id", "_c0", "_in0", "th"]

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                     StructField("lang", StringType()), StructField("source", StringType()),
                     StructField("n_chars", LongType())]
                    + [StructField(c, StringType()) for c in CLASHING])


def rows_of(texts, first=0):
    return [(first + i, t, "en", f"s{i % 3}", len(t or ""), *CLASHING) for i, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def invented(n, words, seed=1, vocabulary=300):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(vocabulary)]
    return [" ".join(r.choice(vocab) for _ in range(words)) for _ in range(n)]
