"""Properties that hold for any input, and exactness of the ways taken for large groups."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roomsight import constants as K
from roomsight.functions.scalar import nan_to_null
from roomsight.operators import (balance, density, fitted, neighbours, repair, scale, split,
                                 statistics as T, windows as W)
from roomsight.plans import clean, features


@pytest.fixture(scope="module")
def rows(raw):
    return repair.dedupe(nan_to_null(raw)).persist()


@pytest.fixture(scope="module")
def skewed(spark, rows):
    """A third of the rows in one session, some rows without any."""
    key = (F.when(F.col("reading_id") % 3 == 0, 7).when(F.col("reading_id") % 50 == 1, None)
           .otherwise(F.col("session_id") + 100).cast("bigint"))
    return rows.withColumn("session_id", key).persist()


def features_of(df, long):
    def rolling(w):
        return {"diff": W.step_diff("co2_infrared", w), "sd": W.rolling_std("temperature", 5, w),
                "sum": W.rolling_sum("mox_1", 10, w),
                "spike": W.spike_flag("co2_infrared", 10, 30.0, w)}
    out = W.session_features(df, K.SESSION, K.ROW_ORDER, rolling, 10,
                             {"centred": "co2_infrared"}, long)
    return out.toPandas().sort_values("reading_id").reset_index(drop=True)


@pytest.mark.parametrize("min_rows", [2, 5, 40, 100])
def test_cutting_long_sessions_changes_nothing(skewed, min_rows):
    whole = features_of(skewed, None)
    long = W.find_long_sessions(skewed, K.SESSION, K.ROW_ORDER, min_rows)
    assert long is not None and long.keys.count() > 0 and long.parts > 1
    cut = features_of(skewed, long)
    pd.testing.assert_frame_equal(whole, cut, check_exact=False, rtol=1e-9, atol=1e-9)


def test_no_long_session_at_the_default_size(skewed):
    assert W.find_long_sessions(skewed, K.SESSION, K.ROW_ORDER) is None


def test_chunks_of_a_long_session_are_even(skewed):
    long = W.find_long_sessions(skewed, K.SESSION, K.ROW_ORDER, 40)
    sizes = (W._in_parts(skewed, K.ROW_ORDER, long)
             .where(F.col(K.SESSION) == 7).groupBy("_chunk").count().toPandas()["count"])
    assert len(sizes) > 3 and sizes.max() <= 2 * 40


def test_one_session_of_all_rows_and_one_time(skewed):
    """No ordering column but the last tells the rows apart; still cut in even parts, with equal results."""
    one = skewed.withColumn(K.SESSION, F.lit(1).cast(dict(skewed.dtypes)[K.SESSION])).withColumn(
        "ts", F.lit("2024-01-01").cast("timestamp"))
    n = one.count()
    long = W.find_long_sessions(one, K.SESSION, K.ROW_ORDER, n // 16)
    sizes = W._in_parts(one, K.ROW_ORDER, long).groupBy("_chunk").count().toPandas()["count"]
    assert len(sizes) >= 12 and sizes.max() <= 2 * (n // 16)
    pd.testing.assert_frame_equal(features_of(one, None), features_of(one, long), check_exact=False,
                                  rtol=1e-9, atol=1e-9)


def test_parts_shorter_than_the_lookback(skewed):
    """Parts of three rows: windows of ten reach over several of them."""
    small = skewed.where(F.col(K.SESSION) == 7).orderBy(*K.ROW_ORDER).limit(40)
    long = W.LongSessions(K.SESSION, 13, small.select(K.SESSION).distinct())
    pd.testing.assert_frame_equal(features_of(small, None), features_of(small, long), check_exact=False,
                                  rtol=1e-9, atol=1e-9)


def test_order_check(rows):
    assert W.order_violations(rows, K.SESSION, K.ROW_ORDER).isEmpty()
    twice = rows.unionAll(rows)
    assert not W.order_violations(twice, K.SESSION, K.ROW_ORDER).isEmpty()


def test_results_do_not_depend_on_partitions(raw):
    a = features.features_full(raw.repartition(1)).toPandas()
    b = features.features_full(raw.repartition(13, "ts").orderBy(F.desc("reading_id"))).toPandas()
    key = "reading_id"
    pd.testing.assert_frame_equal(a.sort_values(key).reset_index(drop=True),
                                  b.sort_values(key).reset_index(drop=True),
                                  check_exact=False, rtol=1e-9, atol=1e-9)


def test_imputers_fill_and_change_nothing_else(rows):
    filled = repair.fit_group_median(rows, K.SANITISED, "time_of_day").transform(rows)
    both = rows.select("reading_id", *[F.col(c).alias(f"old_{c}") for c in K.SANITISED]).join(
        filled.select("reading_id", *K.SANITISED), "reading_id")
    for c in K.SANITISED:
        assert both.where(F.col(c).isNull()).isEmpty()
        assert both.where(F.col(f"old_{c}").isNotNull()
                          & (F.col(f"old_{c}") != F.col(c))).isEmpty()


def test_sanitise_twice_is_once(raw):
    once = clean.sanitise(clean.clean(raw))
    assert once.exceptAll(clean.sanitise(once)).isEmpty()


def test_cleaned_table_keeps_its_promises(raw):
    for mode in ("eager", "deferred"):
        df = clean.sanitise(clean.clean(raw, mode))
        for c in [*K.NUMERIC, *K.CATEGORICAL]:
            assert df.where(F.col(c).isNull()).isEmpty(), (mode, c)
        assert df.where(~F.col("temperature").between(10, 40)
                        | ~F.col("humidity").between(0, 100) | (F.col("co_gas") < 0)
                        | (F.col("co2_infrared") < 0)).isEmpty()
        assert df.count() == df.dropDuplicates().count()


def test_crosstab_rows_sum_to_100(raw):
    df = clean.standardise_labels(raw)
    for r in T.crosstab_pct(df, "ambient_light", K.TARGET, K.ACTIVITY_ORDER).collect():
        assert math.isclose(sum(r[c] for c in K.ACTIVITY_ORDER), 100.0)


def test_densities_integrate_to_one(raw):
    curve = density.kde_by_class(clean.standardise_labels(raw), ["co2_electrochem"], K.TARGET)
    for _, part in curve.toPandas().groupby("activity_level"):
        part = part.sort_values("x")
        assert 0.9 < np.trapezoid(part["density"], part["x"]) < 1.05


def test_a_large_fitted_table_is_joined_not_broadcast(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("k"))
    table = df.groupBy("k").agg(F.count("*").alias("n"))
    small, large = (fitted.attach(df, table, ["k"], limit=n) for n in (50, 49))
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert small.exceptAll(large).isEmpty() and large.count() == 500
    with pytest.raises(ValueError):
        fitted.bounded_rows(table, 49, "groups")


# --- splits -------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def classed(rows):
    return rows.select("reading_id", "session_id", (F.col("reading_id") % 7 % 3).alias("y")
                       ).persist()


def test_stratified_split_is_exact(classed):
    counts = split.class_counts(classed, "y")
    due = split.stratified_test_sizes(counts)
    out = split.stratified_split(classed, "reading_id", "y")
    got = {r["y"]: r["n"] for r in out.where("is_test").groupBy("y").agg(
        F.count("*").alias("n")).collect()}
    assert got == due and out.where(F.col("is_test").isNull()).isEmpty()
    other = split.stratified_split(classed.repartition(5), "reading_id", "y")
    assert out.exceptAll(other).isEmpty()
    assert not out.exceptAll(split.stratified_split(classed, "reading_id", "y", seed=1)).isEmpty()


def test_folds_are_even(classed):
    out = split.stratified_folds(classed, "reading_id", "y")
    for _, part in out.groupBy("y", "fold").count().toPandas().groupby("y"):
        assert len(part) == 5 and part["count"].max() - part["count"].min() <= 1


def test_groups_stay_together(classed):
    out = split.group_split(classed, "session_id")
    sides = out.groupBy("session_id").agg(F.count_distinct("is_test").alias("n"),
                                          F.first("is_test").alias("t")).toPandas()
    assert (sides["n"] == 1).all() and sides["t"].sum() == math.ceil(0.2 * len(sides))
    folds = split.group_folds(classed, "session_id", "y", [0, 1, 2]).toPandas()
    assert folds["session_id"].is_unique and len(folds) == len(sides)
    sizes = folds["fold"].value_counts()
    assert sizes.max() - sizes.min() <= 1


def test_hash_rank_is_a_permutation(classed):
    got = split.hash_rank(classed, "reading_id", "y").toPandas()
    for _, part in got.groupby("y"):
        assert sorted(part["rank"]) == list(range(len(part)))


def test_split_without_test_rows(classed):
    out = split.stratified_split(classed, "reading_id", "y", share=0.0)
    assert out.where("is_test").isEmpty()


def test_scaler_sees_training_rows_only(rows):
    marked = rows.withColumn("is_test", F.col("reading_id") % 5 == 0)
    changed = marked.withColumn("temperature", F.when(F.col("is_test"), 1e6).otherwise(
        F.col("temperature")))
    a, b = (scale.fit_standardiser(d.where(~F.col("is_test")), ["temperature"])
            for d in (marked, changed))
    assert a == b


def test_class_weights_average_to_one(classed):
    got = split.class_weights(classed, "y").toPandas()
    assert math.isclose((got["n"] * got["weight"]).sum(), got["n"].sum())


# --- neighbours and balancing ----------------------------------------------------------------

def points(spark, n=900, d=6, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 10, (8, d))
    x = np.round(centres[rng.integers(0, 8, n)] + rng.normal(0, 1, (n, d)), 3)
    x[: n // 3] = x[0]  # a third of all rows is one and the same point
    y = np.where(np.arange(n) % 10 < 7, 0, np.where(np.arange(n) % 10 < 9, 1, 2))
    pdf = pd.DataFrame({"i": np.arange(n), "y": y, "v": list(x)})
    return pdf, spark.createDataFrame(pdf, "i bigint, y int, v array<double>")


@pytest.mark.parametrize("block", [10_000, 25])
def test_neighbours_equal_brute_force(spark, block):
    pdf, df = points(spark)
    asked = df.where("i % 4 = 1")
    got = neighbours.knn_within_class(df, asked, "i", "y", "v", 5, block_rows=block).toPandas()
    for y, part in pdf.groupby("y"):
        ids, x = part["i"].to_numpy(), np.stack(part["v"])
        for i in ids[ids % 4 == 1]:
            d2 = ((x - x[ids == i]) ** 2).sum(axis=1)
            d2[ids == i] = np.inf
            best = ids[np.lexsort((ids, d2))[:5]]
            mine = got[(got["i"] == i) & (got["y"] == y)].sort_values("rank")
            assert list(mine["neighbour"]) == list(best)


@pytest.mark.parametrize("block", [10_000, 40])
def test_neighbours_by_products_are_exact(spark, block):
    """Far clusters, in which the differences lie beyond the digits of a product, and equal distances."""
    r = np.random.default_rng(8)
    x = np.concatenate([r.integers(0, 4, (150, 3)), 1e7 + r.integers(0, 4, (150, 3)), r.normal(0, 1e-4, (100, 3))]).astype(float)
    df = spark.createDataFrame([(i, 0, v.tolist()) for i, v in enumerate(x)], "i long, y int, v array<double>")
    got = neighbours.knn_within_class(df, df, "i", "y", "v", 5, block_rows=block).toPandas().sort_values(["i", "rank"])
    for i, mine in got.groupby("i"):
        d2 = ((x - x[i]) ** 2).sum(axis=1)
        d2[i] = np.inf
        best = np.lexsort((np.arange(len(x)), d2))[:5]
        assert mine["neighbour"].tolist() == best.tolist() and mine["distance"].tolist() == np.sqrt(d2[best]).tolist()


def test_balancing_rows_that_come_twice(spark):
    """A copy leaves itself out with its twin, so its list is shorter; draws beyond it make no row."""
    x = np.random.default_rng(10).normal(0, 1, (20, 2))
    one = [(i, 1, v.tolist()) for i, v in enumerate(x[:8])]
    df = spark.createDataFrame([*one, *one, *[(i + 100, 0, x[i % 20].tolist()) for i in range(60)]],
                               "i long, y int, v array<double>")
    made = balance.synthetic_rows(df, "i", "y", "v").toPandas()
    assert 0 < len(made) and set(made["y"]) == {1} and (made["base"] != made["neighbour"]).all()


def test_a_distance_known_from_the_own_cell_saves_visits(spark):
    x = np.random.default_rng(9).normal(0, 1, (3000, 4))
    p = spark.createDataFrame([(i, 0, v.tolist()) for i, v in enumerate(x)], "id long, cls int, vec array<double>")
    pivots = neighbours._choose_pivots(p, K.SEED)
    cells = neighbours._assign(p, pivots)
    summary = neighbours._summarise(cells, 5)
    far = ((x[:, None] - x[None]) ** 2).sum(2)
    reach = np.sqrt(np.partition(far, 5, axis=1)[:, 5])  # as if the own cell held all that is near
    known = cells.join(spark.createDataFrame(list(enumerate(reach.tolist())), "id long, reach double"), "id")
    seen = [neighbours._visits(q, pivots, summary, 5).agg(F.sum(F.size("cells"))).first()[0] for q in (p, known)]
    assert seen[1] < seen[0] / 2


def test_neighbours_of_a_class_smaller_than_k(spark):
    _, df = points(spark, 30)
    got = neighbours.knn_within_class(df, df, "i", "y", "v", 5).toPandas()
    assert (got[got["y"] == 2].groupby("i").size() == 2).all()


def test_cells_are_skipped(spark):
    """Far cells are not visited, so the pairs looked at are far fewer than all."""
    _, df = points(spark, 900)
    p = df.select(F.col("y").alias("cls"), F.col("i").alias("id"), F.col("v").alias("vec"))
    pivots = neighbours._choose_pivots(p, K.SEED)
    summary = neighbours._summarise(neighbours._assign(p, pivots), 5)
    visits = neighbours._visits(p, pivots, summary, 5).agg(F.sum(F.size("cells"))).first()[0]
    everything = sum(len(summary[c]) * sum(x[1] for x in summary[c]) for c in summary)
    assert visits < everything / 3


def test_a_query_travels_once_to_neighbouring_cells(spark):
    """Where every cell must be visited, not a row per query and cell, and the result is exact."""
    r = np.random.default_rng(8)
    x = r.normal(0, 1, (900, 40))
    df = spark.createDataFrame([(i, "a", v.tolist()) for i, v in enumerate(x)], "i int, y string, v array<double>")
    p = df.selectExpr("y cls", "i id", "v vec")
    pivots = neighbours._choose_pivots(p, K.SEED)
    summary = neighbours._summarise(neighbours._assign(p, pivots), 5)
    packs = neighbours._pack(summary, pivots, 300)
    assert sorted(packs["a"]) == sorted(c[0] for c in summary["a"])
    rows = {}
    for c in summary["a"]:
        rows[packs["a"][c[0]]] = rows.get(packs["a"][c[0]], 0) + c[1]
    assert max(rows.values()) <= 300 or len(rows) == len(summary["a"])
    visits = neighbours._visits(p, pivots, summary, 5, packs)
    assert visits.agg(F.sum(F.size("cells"))).first()[0] > 900 * 20 and visits.count() <= 900 * len(rows)
    got = neighbours.knn_within_class(df, df, "i", "y", "v", 5, block_rows=300).collect()
    far = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(far, np.inf)
    assert len(got) == 900 * 5 and all(far[g["i"]].argsort()[g["rank"] - 1] == g["neighbour"] for g in got)
    assert all(np.allclose(g["neighbour_vector"], x[g["neighbour"]]) for g in got)



def test_balanced_classes_between_two_parents(spark):
    pdf, df = points(spark)
    wide = df.select("i", "y", *[F.col("v")[j].alias(f"c{j}") for j in range(6)],
                     (F.col("i") % 2).cast("double").alias("f"))
    names = [f"c{j}" for j in range(6)] + ["f"]
    out = balance.smote(wide, "i", "y", names, ["f"])
    sizes = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert len(set(sizes.values())) == 1 and sizes[0] == (pdf["y"] == 0).sum()
    assert out.where(F.col("f").isin(0.0, 1.0)).count() == out.count()
    made = balance.synthetic_rows(df, "i", "y", "v").toPandas()
    at = pdf.set_index("i")
    for r in made.itertuples():
        a, b = np.array(at.loc[r.base, "v"]), np.array(at.loc[r.neighbour, "v"])
        assert at.loc[r.base, "y"] == at.loc[r.neighbour, "y"] == r.y and 0 <= r.u < 1
        assert np.allclose(r.v, a + r.u * (b - a))


def test_too_few_rows_to_balance(spark):
    _, df = points(spark, 30)
    with pytest.raises(ValueError, match="cannot be balanced"):
        balance.synthetic_rows(df, "i", "y", "v")


def test_density_by_brute_force(spark):
    """The fast transform against every value at every point, with a far outlier and two clusters."""
    r = np.random.default_rng(5)
    columns = {"plain": r.normal(3, 2, 3000), "far": np.append(r.normal(0, 1, 2999), 1e4),
               "two": np.concatenate([r.normal(-50, 0.1, 1500), r.normal(70, 0.5, 1500)]),
               "repeated": r.integers(0, 4, 3000).astype(float)}
    df = spark.createDataFrame(list(zip(*(c.tolist() for c in columns.values()))), list(columns))
    got = density.kde_grid(df, list(columns), 64).toPandas()
    for name, values in columns.items():
        h = len(values) ** -0.2 * values.std(ddof=1)
        part = got[got["column"] == name].sort_values("point")
        x = np.linspace(values.min(), values.max(), 64)
        want = np.exp(-0.5 * ((x[:, None] - values) / h) ** 2).sum(1) / (len(values) * h * np.sqrt(2 * np.pi))
        assert len(part) == 64 and np.allclose(part["x"], x, atol=1e-9)
        assert np.abs(part["density"] - want).max() * h < 1e-9
