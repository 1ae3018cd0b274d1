"""Helpers the operators share: words, folds, free column names, Arrow batches."""

from __future__ import annotations

import os
import string
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructType

#: A word of a text whose A-Z are lower-cased: digits, a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words in a text as it is; enough where only their number counts.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A run of anything but ASCII white space.
TOKEN = r"[^\x20\x09-\x0D]+"

# Bytes of words lower-cased, all others made blanks; bytes from 128 on belong to words.
_word_bytes = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts of ASCII alone, known by their length, take the quick way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """Array of the words of a text; empty for NULL."""
    found = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def byte_blanks(text: bytes) -> bytes:
    """The text lower-cased, with a blank for each byte that belongs to no word."""
    return text.translate(_word_bytes)


def byte_words(text: bytes | None) -> list[bytes]:
    """The same words within a Python task, from and as UTF-8 bytes."""
    return byte_blanks(text).split() if text else []


def fold(ident: Column, parts: int) -> Column:
    """crc32 of the identifier as text, modulo ``parts``; a missing identifier is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(ident.cast("string").cast("binary")), F.lit(parts)),
                      F.lit(0)).cast("int")


def uniform(*parts: Column) -> Column:
    """Pseudo-random number in [0, 1) from the parts, the same on every run."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(2 ** 53))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def reach(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed for them.

    Tells workers started from now on the folder the package lies in; elsewhere (on a cluster
    that ships it) the folder is simply not there.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def map_arrow(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with functions of this package."""
    reach(df.sparkSession)
    return df.mapInArrow(run, schema)


def per_row(df: DataFrame, schema: str, make: Callable[[], Callable[[list], list[tuple]]],
            inputs: list[str], keep: list[str]) -> DataFrame:
    """Rows of ``keep`` plus what ``make()`` computes from ``inputs``, batch by batch.

    ``make`` runs once in a task and returns a function from a list of input columns (Python
    lists, texts as UTF-8 bytes) to one tuple per row. Spark bounds a batch by rows and by bytes, so a task holds one
    batch whatever the table. ``schema`` names the computed columns.
    """
    n_keep = len(keep)
    given = [F.col(c).cast("binary") if df.schema[c].dataType == StringType() else F.col(c)
             for c in inputs]
    given = [c.alias(f"_in{i}") for i, c in enumerate(given)]
    where = range(n_keep, n_keep + len(inputs))
    made_type = StructType.fromDDL(schema)
    whole_type = StructType([df.schema[c] for c in keep] + made_type.fields)
    out = to_arrow_schema(made_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = work([batch.column(i).to_pylist() for i in where])
            made = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), out)]
            fields = [batch.schema.field(i) for i in range(n_keep)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(n_keep)] + made,
                schema=pa.schema(fields + list(out)))

    return map_arrow(df.select(*keep, *given), run, whole_type)
