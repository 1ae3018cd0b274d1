"""Deterministic pseudo-random keys: the same rows on every run and in any SQL engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BUCKET_DIGITS = 3


def hash_key(ident: Column, seed: int) -> Column:
    """32 hex digits whose order is a seeded shuffle of the identifiers."""
    return F.md5(F.concat_ws("|", ident.cast("string"), F.lit(str(seed))))


def hash_bucket(key: Column) -> Column:
    """The leading digits of a hash key: 4,096 equally likely, ordered buckets."""
    return F.substring(key, 1, BUCKET_DIGITS)


def hash_int(*parts: Column | str | int) -> Column:
    """Uniform integer in [0, 2**32) from the parts."""
    text = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *text)), 1, 8), 16, 10).cast("bigint")
