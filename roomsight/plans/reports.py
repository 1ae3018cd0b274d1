"""Reports: named tables, each lazy, over one table that the caller has at hand.

``df`` is usually the sanitised readings; where several reports follow each other, pass a
table that is written or persisted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions.scalar import ordinal
from ..operators import density, quality, statistics as T
from ..sources.files import write_csv

BOUNDS = {"temperature": K.TEMPERATURE_BOUNDS, "humidity": K.HUMIDITY_BOUNDS,
          "co2_infrared": K.CO2_BOUNDS, "co_gas": K.CO2_BOUNDS}
CO2 = ["co2_infrared", "co2_electrochem"]
MIXED = ["time_of_day", "hvac_mode", "ambient_light"]


def quality_report(df: DataFrame) -> dict[str, DataFrame]:
    """Missing cells, copies, label spellings, values beyond physical bounds."""
    return {"missing": quality.missing_profile(df),
            "duplicates": quality.duplicate_count(df),
            "activity": quality.value_counts(df, K.TARGET),
            "hvac": quality.value_counts(df, "hvac_mode"),
            "bounds": quality.bound_violations(df, BOUNDS)}


def univariate_report(df: DataFrame) -> dict[str, DataFrame]:
    """Summary with shape, advice, histograms, densities and category counts."""
    return {"summary": T.describe(df, K.NUMERIC),
            "advice": T.shape_flags(T.shape_stats(df, K.NUMERIC)),
            "histogram": density.histogram(df, K.NUMERIC, K.HISTOGRAM_BINS),
            "density": density.kde_grid(df, K.NUMERIC),
            **{f"counts_{c}": quality.value_counts(df, c) for c in K.CATEGORICAL}}


def bivariate_report(df: DataFrame) -> dict[str, DataFrame]:
    """Every feature against the activity level."""
    return {"boxes": density.box_stats(df, K.NUMERIC, K.TARGET),
            "violins": density.kde_by_class(df, CO2, K.TARGET),
            **{f"mix_{c}": T.crosstab_pct(df, c, K.TARGET, K.ACTIVITY_ORDER) for c in MIXED},
            "means": T.group_means(df, K.TARGET, K.NUMERIC, K.ACTIVITY_ORDER)}


def correlation_report(df: DataFrame) -> dict[str, DataFrame]:
    """Pearson matrix with the encoded target, its lower triangle, and the ranked features."""
    encoded = df.withColumn("target", ordinal(F.col(K.TARGET), K.ACTIVITY_CODES))
    names = [*K.NUMERIC, "target"]
    matrix = T.corr_matrix(encoded, names)
    return {"matrix": matrix, "lower": T.corr_lower(matrix, names),
            "ranked": T.target_corr(encoded, K.NUMERIC, "target")}


def session_report(df: DataFrame) -> dict[str, DataFrame]:
    """Statistics per session, their spread, and the mix in the largest sessions."""
    stats = T.session_stats(df, K.SESSION, K.TARGET, K.ACTIVITY_ORDER,
                            {"avg_co2": "co2_electrochem", "avg_temp": "temperature"})
    return {"sessions": stats, "overview": T.session_overview(stats),
            "sizes": density.histogram(stats, ["rows"], K.SESSION_HISTOGRAM_BINS),
            "top_mix": T.top_key_mix(df, K.SESSION, K.TARGET, K.ACTIVITY_ORDER, K.TOP_SESSIONS)}


def final_summary(df: DataFrame, csv_path: str | None = None) -> dict[str, DataFrame]:
    """Shape, missing cells, class shares; saves the table as CSV where a path is given."""
    if csv_path:
        write_csv(df, csv_path)
    return {"schema": quality.schema_profile(df), "missing": quality.null_total(df),
            "classes": quality.class_distribution(df, K.TARGET)}
