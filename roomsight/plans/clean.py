"""Cleaning chains: fit the constants on one table, then project."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions.scalar import canonical, nan_to_null, normalise_text, outside
from ..operators import repair
from ..operators.quantiles import medians
from ..session import cut_lineage, together


def standardise_labels(df: DataFrame) -> DataFrame:
    """Canonical activity labels and normalised air-conditioning modes."""
    return df.withColumns({
        "activity_level": canonical(F.col("activity_level"), K.ACTIVITY_LABELS),
        "hvac_mode": normalise_text(F.col("hvac_mode"))})


def clean_eager(df: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Each step sees the one before: outliers and missing numbers take the global median,
    then negatives the median of the rest, missing light the mode; then copies go, and light
    is filled by time of day. No light is missing by then, so all that last step does is to
    take the light from rows without a time of day, for which a grouped step has no result.

    Independent medians share one call, so the fits are narrow scans of a few columns.
    The only exchange of whole rows is the one that removes copies.
    """
    df = standardise_labels(nan_to_null(df))
    hot = outside(F.col("temperature"), *K.TEMPERATURE_BOUNDS)
    rows = df.count()

    def numbers() -> DataFrame:
        found = medians(df, {"temperature": F.when(~hot, F.col("temperature")),
                             **{c: F.col(c) for c in K.MEDIAN_FILLED}}, rows)
        bad = {"temperature": hot, **{c: F.col(c).isNull() for c in K.MEDIAN_FILLED}}
        filled = repair.Replace(bad, found).transform(df)
        return repair.fit_negative_to_median(filled, K.NEGATIVE_REPAIRED, rows).transform(filled)

    filled, light = together(df.sparkSession, numbers,
                             lambda: repair.fit_missing_to_mode(df, ["ambient_light"]))
    unique = repair.dedupe(light.transform(filled), ignore)
    return unique.withColumn("ambient_light", F.when(F.col("time_of_day").isNotNull(),
                                                     F.col("ambient_light")))


def clean_deferred(df: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """The first filling has no effect: outliers, negatives and copies go first, then missing
    numbers take the median of the repaired column and missing light the mode of its time
    of day. The rows without copies are written once, since two fits and the result read
    them.
    """
    df = standardise_labels(nan_to_null(df))
    hot = outside(F.col("temperature"), *K.TEMPERATURE_BOUNDS)
    found = medians(df, {"temperature": F.when(~hot, F.col("temperature")),
                         **{c: F.when(F.col(c) >= 0, F.col(c)) for c in K.NEGATIVE_REPAIRED}})
    df = repair.Replace({"temperature": hot, **{c: F.col(c) < 0 for c in K.NEGATIVE_REPAIRED}},
                        found).transform(df)
    df = cut_lineage(repair.dedupe(df, ignore))
    df = repair.fit_missing_to_median(df, K.MEDIAN_FILLED).transform(df)
    return repair.fit_group_mode(df, ["ambient_light"], "time_of_day").transform(df)


def clean(df: DataFrame, mode: str = "eager", ignore: list[str] | None = None) -> DataFrame:
    """Clean in ``eager`` or ``deferred`` mode."""
    return {"eager": clean_eager, "deferred": clean_deferred}[mode](df, ignore)


def sanitise(df: DataFrame) -> DataFrame:
    """Impossible humidity and CO2 values become missing, then take the median of their
    time of day, as do other missing cells of the repaired columns."""
    df = repair.null_outside(df, {"humidity": K.HUMIDITY_BOUNDS, "co2_infrared": K.CO2_BOUNDS})
    return repair.fit_group_median(df, K.SANITISED, "time_of_day").transform(df)
