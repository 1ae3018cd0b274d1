"""Column -> Column building blocks; all stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

BLANK_EDGES = r"^\s+|\s+$"
JOINERS = r"[\s\-]+"


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and NULL both mean missing; keep NULL only, so comparisons and aggregates agree."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating})


def trim_space(c: Column) -> Column:
    """Strip every kind of white space; ``trim`` would strip blanks only."""
    return F.regexp_replace(c, BLANK_EDGES, "")


def normalise_text(c: Column) -> Column:
    """Trim, lower-case, and join words with one underscore."""
    return F.regexp_replace(F.lower(trim_space(c)), JOINERS, "_")


def lookup(c: Column, mapping: dict) -> Column:
    """Value for a key of a constant mapping, NULL for an unknown or missing key.

    Values are constants or columns.
    """
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.when(c.isNotNull(), F.try_element_at(F.create_map(*pairs), c))


def canonical(c: Column, mapping: dict[str, str], on_unmapped: str = "null",
              case_insensitive: bool = False) -> Column:
    """Map spellings to canonical labels; ``on_unmapped`` is null, keep or error."""
    if case_insensitive:
        mapping = {k.lower(): v for k, v in mapping.items()}
    found = lookup(F.lower(c) if case_insensitive else c, mapping)
    if on_unmapped == "null":
        return found
    if on_unmapped == "keep":
        return F.coalesce(found, c)
    if on_unmapped == "error":
        fail = F.raise_error(F.concat(F.lit("unmapped label: "), c)).cast("string")
        return F.when(c.isNull() | found.isNotNull(), found).otherwise(fail)
    raise ValueError(f"on_unmapped={on_unmapped!r}")


def ordinal(c: Column, codes: dict[str, int], default: int | None = None) -> Column:
    """Ordered category -> integer code; unknown becomes ``default`` (NULL if not given)."""
    code = lookup(c, codes)
    return code if default is None else F.coalesce(code, F.lit(default))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def row_sum(columns: list[str]) -> Column:
    """Sum across columns, missing counted as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in columns])


def row_mean(columns: list[str]) -> Column:
    """Mean of the values present; NULL if there is none."""
    present = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns])
    return F.try_divide(row_sum(columns), present.cast("double"))


def row_max(columns: list[str]) -> Column:
    """Largest value present; NULL if there is none."""
    return F.greatest(*columns)


def discomfort_index(temperature: Column, humidity: Column) -> Column:
    """Thom's discomfort index from degrees Celsius and per cent humidity."""
    dryness = F.lit(1.0) - humidity / F.lit(100.0)
    return temperature - F.lit(0.55) * dryness * (temperature - F.lit(14.5))


def outside(c: Column, low: float | None, high: float | None) -> Column:
    """True where a value is present and beyond an (inclusive) bound."""
    tests = []
    if low is not None:
        tests.append(c < F.lit(low))
    if high is not None:
        tests.append(c > F.lit(high))
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def share_of_group(condition: Column) -> Column:
    """Per cent of all rows of a group that meet a condition; a missing value does not meet it."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0)) * 100.0
