"""Small hand-written inputs with known results."""

import math

import pytest
from pyspark.sql import functions as F

from roomsight import constants as K
from roomsight.functions import moments, scalar as S
from roomsight.operators import (density, encode, evaluate, quality, quantiles, repair, scale,
                                 split, statistics as T, windows as W)
from roomsight.plans import clean

KEYED = [(1, "a", 1.0), (2, "a", None), (3, None, 5.0), (4, "b", 2.0), (5, "b", None)]


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.createDataFrame(KEYED, "i int, k string, x double").persist()


def column(df, c, order="i"):
    return [r[c] for r in df.orderBy(order).collect()]


def numbers(spark, values):
    rows = [(i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i int, x double")


def test_group_median_and_missing_key(keyed):
    assert column(repair.fit_group_median(keyed, ["x"], "k").transform(keyed), "x") == [
        1, 1, None, 2, 2]


def test_step_difference_with_missing_neighbours(keyed):
    out = W.session_features(keyed, "k", ["i"], lambda w: {"d": W.step_diff("x", w)}, 1)
    assert column(out, "d") == [0, 0, 0, 0, 0]


def test_centred_has_no_value_without_a_key(keyed):
    out = W.session_features(keyed, "k", ["i"], lambda w: {}, 1, {"c": "x"})
    assert column(out, "c") == [0, None, None, 0, None]


def test_mode_takes_smallest_on_ties_and_skips_missing(spark):
    df = spark.createDataFrame([(c,) for c in ["b", "a", "b", "a", "c", None, None, None]],
                               "v string")
    assert repair.fit_missing_to_mode(df, ["v"]).value == {"v": "a"}


def test_group_mode_of_a_group_without_values(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "b", None)],
                               "i int, k string, v string")
    assert column(repair.fit_group_mode(df, ["v"], "k").transform(df), "v") == [None, "x", "x"]


def test_labels(spark):
    df = spark.createDataFrame([(1, "HighActivity"), (2, "LowActivity"), (3, None)],
                               "i int, v string")
    got = df.select("i", S.canonical(F.col("v"), K.ACTIVITY_LABELS).alias("n"),
                    S.canonical(F.col("v"), K.ACTIVITY_LABELS, "keep").alias("k"),
                    S.canonical(F.lower("v"), K.ACTIVITY_LABELS,
                                case_insensitive=True).alias("c"))
    assert column(got, "n") == [None, "Low Activity", None]
    assert column(got, "k") == ["HighActivity", "Low Activity", None]
    assert column(got, "c") == [None, "Low Activity", None]
    with pytest.raises(Exception, match="unmapped label"):
        df.select(S.canonical(F.col("v"), K.ACTIVITY_LABELS, "error")).collect()


def test_moments_and_quartiles(spark):
    row = T.describe(numbers(spark, [1, 2, 3, 10, 50, 3]), ["x"]).first()
    assert math.isclose(row["skewness"], 2.306860506215412)
    assert math.isclose(row["kurtosis"], 5.398002178173583)
    assert math.isclose(row["std"], 19.128512749296533)
    assert [row["q25"], row["q50"], row["q75"]] == [2.25, 3.0, 8.25]


@pytest.mark.parametrize("values,skew,kurt", [
    ([1.0] * 5, 0.0, 0.0), ([1.0, 2.0], None, None), ([1.0, 2.0, 4.0], "some", None)])
def test_moments_of_few_or_equal_values(spark, values, skew, kurt):
    row = numbers(spark, values).agg(moments.sample_skewness(F.col("x")).alias("s"),
                                     moments.sample_kurtosis(F.col("x")).alias("k")).first()
    assert (row["s"] is not None) if skew == "some" else row["s"] == skew
    assert row["k"] == kurt


def test_rolling_with_missing(spark):
    df = numbers(spark, [1.0, None, None, 4.0, 6.0]).withColumn("k", F.lit("s"))
    out = W.session_features(df, "k", ["i"], lambda w: {
        "sd": W.rolling_std("x", 3, w), "sum2": W.rolling_sum("x", 2, w)}, 3)
    assert column(out, "sd") == [0, 0, 0, 0, math.sqrt(2)]
    assert column(out, "sum2") == [1, 1, None, 4, 10]


def test_row_folds(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, None)], "i int, a double, b double")
    cols = ["a", "b"]
    got = df.select("i", S.row_sum(cols).alias("s"), S.row_mean(cols).alias("m"),
                    S.row_max(cols).alias("x"))
    assert [tuple(r)[1:] for r in got.orderBy("i").collect()] == [(1, 1, 1), (0, None, None)]


def test_flag_of_missing_is_zero(spark):
    df = numbers(spark, [None, 40.0]).select("i", S.flag(F.abs(F.col("x") - 1) > 30).alias("f"))
    assert column(df, "f") == [0, 1]


def test_one_hot_drops_first_and_keeps_missing_false(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "i int, h string")
    fitted = encode.fit_one_hot(df, ["h"])
    out = fitted.transform(df)
    assert out.columns == ["i", "h_b"] and fitted.columns() == ["h_b"]
    assert column(out, "h_b") == [True, False, False]
    with pytest.raises(ValueError):
        encode.fit_one_hot(df, ["h"], max_categories=1)


def test_crosstab_without_missing_keys(spark):
    df = spark.createDataFrame([("x", "p"), ("x", None), (None, "p"), ("y", "q")],
                               "r string, c string")
    got = {r["r"]: (r["p"], r["q"]) for r in T.crosstab_pct(df, "r", "c", ["p", "q"]).collect()}
    assert got == {"x": (100.0, 0.0), "y": (0.0, 100.0)}
    wide = T.row_percent(T.group_size_wide(df, "r", "c", ["p", "q"]), ["p", "q"])
    assert {r["r"]: (r["p"], r["q"]) for r in wide.collect()} == got


def test_share_keeps_missing_in_the_denominator(spark):
    df = numbers(spark, [0.0, None, 1.0])
    assert math.isclose(df.agg(S.share_of_group(F.col("x") == 0)).first()[0], 100 / 3)


def test_duplicates_match_on_missing(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "x int")
    assert quality.duplicate_count(df).first()[0] == 2
    assert repair.dedupe(df).count() == 2


def test_dedupe_keeps_first_of_an_ignored_column(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (5, None)], "seq int, v string")
    kept = repair.dedupe(df, ["seq"])
    assert sorted((r["seq"], r["v"]) for r in kept.collect()) == [(1, "a"), (2, None)]


def test_dedupe_keeps_a_row_that_was_there(spark):
    df = spark.createDataFrame([("k", 1, 9), ("k", 2, 3)], "v string, a int, b int")
    assert [tuple(r) for r in repair.dedupe(df, ["a", "b"]).collect()] == [("k", 1, 9)]
    assert [tuple(r) for r in repair.dedupe(df, ["b", "a"]).collect()] == [("k", 2, 3)]


def test_eager_cleaning_has_no_light_without_a_time_of_day(raw):
    bare = raw.withColumn("time_of_day", F.when(F.col("reading_id") % 7 > 0, F.col("time_of_day")))
    made = clean.clean_eager(bare)
    assert made.where("time_of_day IS NULL").count() > 0
    assert made.where("time_of_day IS NULL AND ambient_light IS NOT NULL").isEmpty()
    assert made.where("time_of_day IS NOT NULL AND ambient_light IS NULL").isEmpty()


def test_pairwise_pearson(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, None, 7.0), (None, 3.0, 7.0),
                                (4.0, 9.0, 7.0)], "a double, b double, c double")
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in
           T.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert math.isclose(got["a", "b"], 1.0) and math.isclose(got["b", "a"], 1.0)
    assert got["a", "c"] is None and got["c", "c"] is None and math.isclose(got["a", "a"], 1.0)


def test_histogram_closes_last_bin(spark):
    df = numbers(spark, [0.0, 1.0, 2.0, 3.0, 4.0, 5.0])
    assert column(density.histogram(df, ["x"], 5), "n", "bin") == [1, 1, 1, 1, 2]
    flat = density.histogram(numbers(spark, [3.0, 3.0]), ["x"], 2)
    assert column(flat, "n", "bin") == [0, 2]


def test_text_and_rounding(spark):
    df = spark.createDataFrame([("\t Heat - On \n",)], "t string")
    row = df.select(S.normalise_text(F.col("t")).alias("t"), F.bround(F.lit(0.125), 2).alias("r"),
                    ).first()
    assert row["t"] == "heat_on" and row["r"] == 0.12


def test_temperature_bounds_are_inclusive(spark):
    df = numbers(spark, [9.99, 10.0, 40.0, 40.01, None])
    got = repair.null_outside(df, {"x": K.TEMPERATURE_BOUNDS})
    assert column(got, "x") == [None, 10.0, 40.0, None, None]
    fixed = repair.fit_outside_to_median(df, "x", 10.0, 40.0).transform(df)
    assert column(fixed, "x") == [25.0, 10.0, 40.0, 25.0, None]


def test_nan_is_missing(spark):
    df = S.nan_to_null(numbers(spark, [float("nan"), 2.0]))
    assert column(df, "x") == [None, 2.0]
    assert repair.fit_missing_to_median(df, ["x"]).value == {"x": 2.0}


def test_column_without_values_stays_missing(spark):
    df = numbers(spark, [None, None])
    assert column(repair.fit_missing_to_median(df, ["x"]).transform(df), "x") == [None, None]


def test_single_row_session(spark):
    df = numbers(spark, [5.0]).withColumn("k", F.lit(1))
    row = W.session_features(df, "k", ["i"], lambda w: {
        "d": W.step_diff("x", w), "s": W.rolling_std("x", 5, w),
        "f": W.spike_flag("x", 10, 30.0, w)}, 10, {"c": "x"}).first()
    assert (row["d"], row["s"], row["f"], row["c"]) == (0, 0, 0, 0)


def test_report_counts_zero_over_zero_as_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 3)], "y int, p int")
    got = {r["entry"]: r for r in evaluate.classification_report(df, "y", "p").collect()}
    assert (got["1"]["precision"], got["1"]["f1"], got["1"]["support"]) == (0, 0, 1)
    assert (got["3"]["recall"], got["3"]["support"]) == (0, 0)
    assert got["accuracy"]["f1"] == 0.5
    assert math.isclose(evaluate.macro_f1(df, "y", "p").first()[0], 0.8 / 4)
    assert math.isclose(evaluate.MacroF1(labelCol="y", predictionCol="p").evaluate(df), 0.2)


def test_scaling_choice_and_constants(spark):
    df = spark.createDataFrame([(1.0, 0.0, 7.0, None), (2.0, 1.0, 7.0, None),
                                (3.0, 0.0, 7.0, None)], "a double, b double, c double, d double")
    assert scale.columns_to_scale(df, ["a", "b", "c", "d"]) == ["a"]
    assert scale.columns_to_scale(df, ["a", "b"], ("a",)) == []
    out = scale.fit_standardiser(df, ["a", "c"]).transform(df)
    assert [r["c"] for r in out.collect()] == [0, 0, 0]
    assert math.isclose(max(r["a"] for r in out.collect()), math.sqrt(1.5))


def test_sizes_of_a_stratified_split():
    assert split.stratified_test_sizes({"a": 5, "b": 5}, 0.2) == {"a": 1, "b": 1}
    got = split.stratified_test_sizes({"a": 57, "b": 31, "c": 12}, 0.2)
    assert sum(got.values()) == 20 and all(abs(got[c] - 0.2 * n) < 1 for c, n in
                                           {"a": 57, "b": 31, "c": 12}.items())


def test_value_counts_and_distribution(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "v string")
    assert [tuple(r) for r in quality.value_counts(df, "v").collect()] == [("b", 2), ("a", 1)]
    assert [tuple(r) for r in quality.class_distribution(df, "v").collect()] == [
        ("b", 2, 50.0), ("a", 1, 25.0)]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 9_999, 10_001, 30_011])
def test_quantiles_of_any_size_agree_with_sorting(spark, n):
    import numpy as np
    import pandas as pd

    values = np.round(np.random.default_rng(n).exponential(10, n), 3)
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    for small in (0, 1_000_000):
        for r in quantiles.quantiles(df, ["x"], probs, small_table=small).collect():
            assert math.isclose(r["value"], np.quantile(values, r["q"]), abs_tol=1e-9)


@pytest.mark.parametrize("small", [0, 1_000_000])
def test_quantiles_read_their_rows_once(spark, small):
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    df = spark.range(3_000).selectExpr("cast(id % 700 as double) x", "id % 2 g").mapInPandas(watch, "x double, g long")
    got = {r["g"]: r["value"] for r in quantiles.quantiles(df, ["x"], [0.5], ["g"], small_table=small).collect()}
    pdf = spark.range(3_000).toPandas()
    assert got == {g: (pdf[pdf.id % 2 == g].id % 700).median() for g in (0, 1)}
    assert seen.value == 3_000


def test_box_stats_read_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    values = [*[float(v) for v in range(10) for _ in range(3)], 100.0, 100.0, -50.0, None]
    rows = [("a", v) for v in values] + [("b", 1.0), ("b", 1.0), ("c", None), (None, 7.0)]
    df = spark.createDataFrame(rows, "g string, x double").mapInPandas(watch, "g string, x double")
    got = {r["g"]: r.asDict() for r in density.box_stats(df, ["x"], "g").collect()}
    assert set(got) == {"a", "b"}
    assert [got["a"][k] for k in ("whisker_low", "whisker_high", "outliers", "n")] == [0.0, 9.0, 3, 33]
    assert [got["b"][k] for k in ("q25", "whisker_low", "whisker_high", "outliers", "n")] == [1.0, 1.0, 1.0, 0, 2]
    assert seen.value == len(rows)


def test_approximate_medians(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"), F.lit("a").alias("g"))
    assert quantiles.medians(df, {"x": F.col("x")}, accuracy=1000) == {"x": 500.0}
    assert T.describe(df, ["x"], 1000).first()["q50"] == 500.0
    holes = df.withColumn("x", F.when(F.col("x") != 3, F.col("x")))
    for fitted in (repair.fit_missing_to_median(holes, ["x"], 1000),
                   repair.fit_group_median(holes, ["x"], "g", 1000)):
        assert fitted.transform(holes).where(F.col("x").isNull()).isEmpty()


def test_quantiles_where_one_value_is_most_rows(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, 5.0).otherwise(F.col("id").cast("double")).alias("x"),
        F.when(F.col("id") < 10, None).otherwise(F.col("id") % 2).alias("g"))
    pdf = df.toPandas()
    for by, got in ((None, quantiles.quantiles(df, ["x"], [0.1, 0.5, 0.9], small_table=0)),
                    ("g", quantiles.quantiles(df, ["x"], [0.1, 0.5, 0.9], ["g"], small_table=0))):
        for r in got.collect():
            part = pdf if by is None else pdf[pdf.g.isna() if r["g"] is None else pdf.g == r["g"]]
            assert math.isclose(r["value"], part.x.quantile(r["q"]), abs_tol=1e-9)


def test_quantiles_of_a_heavy_tail_over_many_tasks(spark):
    df = spark.range(300_000, numPartitions=24).select(
        F.when(F.col("id") % 5 == 0, -0.5).when(F.col("id") == 7, float("inf"))
        .otherwise(F.exp(F.randn(3) * 6)).alias("x"), (F.col("id") % 3).alias("g")).persist()
    pdf = df.toPandas()
    probs = [0.001, 0.2, 0.5, 0.5001, 0.999]
    for r in quantiles.quantiles(df, ["x"], probs, ["g"], small_table=0).collect():
        part = pdf[pdf.g == r["g"]].x
        assert r["n"] == len(part)
        assert math.isclose(r["value"], part.quantile(r["q"]), rel_tol=1e-9)


def test_quantiles_of_more_groups_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BROADCAST_ROWS", 3)
    df = spark.range(20_000).select((F.col("id") % 8).alias("g"), F.rand(1).alias("x")).persist()
    pdf = df.toPandas()
    for r in quantiles.quantiles(df, ["x"], [0.3, 0.5], ["g"], small_table=0).collect():
        assert math.isclose(r["value"], pdf[pdf.g == r["g"]].x.quantile(r["q"]), rel_tol=1e-9)


def test_quantiles_by_radix_however_values_spread(spark, monkeypatch):
    import random
    import struct

    import numpy as np

    r = random.Random(5)
    odd = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1e300, -1e300, 1.7976931348623157e308]
    powers = [x for e in range(-1074, 1024, 7) for x in (2.0 ** e, -(2.0 ** e), 2.0 ** e * (1 - 2 ** -53))]
    bits = [x for x in (struct.unpack("d", r.randbytes(8))[0] for _ in range(2000)) if abs(x) < 1e308]
    values = odd + powers + bits
    image = spark.createDataFrame([(x,) for x in values], "x double").select(
        "x", quantiles._image(F.col("x")).alias("i")).collect()
    for x, i in image:
        want = struct.unpack("q", struct.pack("d", abs(x)))[0]
        assert i == (-want if x < 0 else want)
    # Two clusters, one of them closer than 32 leading bits tell apart, and a far outlier.
    near = [1 + i * 2.0 ** -50 for i in range(3000)] + [1e-9 * i for i in range(1000)] + [1e300] * 2
    df = spark.createDataFrame([(x, g) for x in near for g in (1, None)], "x double, g int")
    monkeypatch.setattr(quantiles, "CELL_ROWS", 50)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.9999]
    for row in quantiles.quantiles(df, ["x"], probs, ["g"], small_table=0).collect():
        assert row["n"] == len(near)
        assert row["value"] == pytest.approx(float(np.quantile(near, row["q"])), rel=1e-15)
