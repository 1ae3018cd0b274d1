"""Aggregate expressions with sample corrections and without errors on degenerate input."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def sample_skewness(c: Column) -> Column:
    """Bias-corrected skewness G1: NULL below 3 values, 0 for a constant."""
    n = F.count(c).cast("double")
    corrected = F.skewness(c) * F.sqrt(n * (n - 1.0)) / F.when(n > 2, n - 2.0)
    return F.when(n >= 3, F.when(F.max(c) == F.min(c), 0.0).otherwise(corrected))


def sample_kurtosis(c: Column) -> Column:
    """Bias-corrected excess kurtosis G2: NULL below 4 values, 0 for a constant."""
    n = F.count(c).cast("double")
    scale = (n - 1.0) / F.when(n > 3, (n - 2.0) * (n - 3.0))
    corrected = scale * ((n + 1.0) * F.kurtosis(c) + 6.0)
    return F.when(n >= 4, F.when(F.max(c) == F.min(c), 0.0).otherwise(corrected))


def pearson(a: Column, b: Column) -> Column:
    """Pearson r over rows where both are present; NULL if either does not vary there."""
    return F.try_divide(F.regr_sxy(a, b), F.sqrt(F.regr_sxx(a, b) * F.regr_syy(a, b)))
