"""One query per operator, over the given tables or the readings derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from .. import constants as K
from ..functions import scalar as S
from ..operators import balance, density, encode, evaluate, models, neighbours, quality, repair
from ..operators import scale, split, statistics as T, windows as W
from ..operators.quantiles import quantiles
from ..plans import clean, features, training
from ..plans.readings import readings
from ..session import cut_lineage, scratch_path
from ..sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

TIE_SHIFT = 1.23456e-9
LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
BOUNDS = {"temperature": K.TEMPERATURE_BOUNDS, "humidity": K.HUMIDITY_BOUNDS,
          "co2_infrared": K.CO2_BOUNDS, "co_gas": K.CO2_BOUNDS}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, so that sums in another order compare equal.

    The tiny shift keeps exact halves from going either way.
    """
    return df.withColumns({f.name: F.round(F.col(f"`{f.name}`") + TIE_SHIFT, 6) + F.lit(0.0)
                           for f in df.schema if isinstance(f.dataType, DoubleType)})


def query(build: Callable[[SparkSession, str], DataFrame]):
    """Register a query under its function name."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(build(spark, folder))
    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return clean.standardise_labels(S.nan_to_null(readings(spark, folder)))


def _encoded(spark: SparkSession, folder: str) -> DataFrame:
    df = _labelled(spark, folder)
    return df.withColumn("target", S.ordinal(F.col(K.TARGET), K.ACTIVITY_CODES))


def _unique(spark: SparkSession, folder: str) -> DataFrame:
    return repair.dedupe(S.nan_to_null(readings(spark, folder)))


# --- profile -------------------------------------------------------------------------

@query
def missing_profile(spark, folder):
    return quality.missing_profile(readings(spark, folder))


@query
def null_total(spark, folder):
    return quality.null_total(readings(spark, folder))


@query
def null_total_subset(spark, folder):
    return quality.null_total(readings(spark, folder), K.SANITISED)


@query
def duplicate_count(spark, folder):
    return quality.duplicate_count(readings(spark, folder))


@query
def value_counts(spark, folder):
    return quality.value_counts(readings(spark, folder), "ambient_light")


@query
def value_counts_orders(spark, folder):
    return quality.value_counts(_table(spark, folder, "orders"), "o_orderpriority")


@query
def value_counts_documents(spark, folder):
    return quality.value_counts(_table(spark, folder, "documents"), "source")


@query
def class_distribution(spark, folder):
    return quality.class_distribution(_labelled(spark, folder), K.TARGET)


@query
def class_distribution_labels(spark, folder):
    return quality.class_distribution(_table(spark, folder, "labels"), "toxic")


@query
def bound_violations(spark, folder):
    return quality.bound_violations(readings(spark, folder), BOUNDS)


@query
def schema_profile(spark, folder):
    return quality.schema_profile(readings(spark, folder))


# --- projections and filters ----------------------------------------------------------

@query
def filter_project(spark, folder):
    impossible = (F.col("temperature") > 40) | (F.col("humidity") > 100)
    negative = F.coalesce(F.col("co_gas") < 0, F.lit(False))
    return (readings(spark, folder).where(impossible & ~negative)
            .select("reading_id", "temperature", "humidity", "co_gas"))


@query
def filter_project_lineitem(spark, folder):
    return (_table(spark, folder, "lineitem")
            .where((F.col("l_quantity") >= 45) & (F.col("l_discount") > 0.05))
            .select("l_orderkey", "l_partkey", "l_quantity", "l_discount"))


@query
def drop_columns(spark, folder):
    return readings(spark, folder).drop("ts", *K.METAL_OXIDE, *K.CATEGORICAL)


@query
def derive_columns(spark, folder):
    price = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    return _table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", price.alias("net"),
        (price * (F.lit(1.0) + F.col("l_tax"))).alias("gross"),
        S.flag(F.col("l_quantity") > 25).alias("is_large"))


@query
def clip_to_null(spark, folder):
    return repair.null_outside(readings(spark, folder), BOUNDS).select("reading_id", *BOUNDS)


@query
def scale_columns_chosen(spark, folder):
    df = readings(spark, folder).withColumns({
        "is_hot": S.flag(F.col("temperature") > 40), "one": F.lit(1.0),
        "time_code": S.ordinal(F.col("time_of_day"), TIME_CODES)})
    chosen = scale.columns_to_scale(df, [*K.NUMERIC, "is_hot", "one", "time_code"], ("time",))
    return spark.createDataFrame([(c,) for c in chosen], "column string")


@query
def sql_text(spark, folder):
    return spark.sql(
        "SELECT time_of_day, count(*) AS n, avg(temperature) AS mean_temperature FROM {r} "
        "GROUP BY time_of_day", r=readings(spark, folder))


@query
def first_rows(spark, folder):
    return (readings(spark, folder).orderBy(*K.ROW_ORDER).limit(10)
            .select("reading_id", "session_id", "temperature", "humidity", "hvac_mode"))


# --- cleaning ---------------------------------------------------------------------------

@query
def canonical_labels(spark, folder):
    df = readings(spark, folder)
    return df.select("reading_id", S.canonical(F.col(K.TARGET), K.ACTIVITY_LABELS).alias(K.TARGET))


@query
def canonical_priority(spark, folder):
    urgent = {"1-URGENT": "high", "2-HIGH": "high", "3-MEDIUM": "medium"}
    return _table(spark, folder, "orders").select(
        "o_orderkey", S.canonical(F.col("o_orderpriority"), urgent).alias("priority"),
        S.canonical(F.col("o_orderpriority"), urgent, "keep").alias("priority_kept"))


@query
def normalise_text(spark, folder):
    return readings(spark, folder).select(
        "reading_id", S.normalise_text(F.col("hvac_mode")).alias("hvac_mode"))


def _repaired(df: DataFrame, fitted, columns: list[str]) -> DataFrame:
    return fitted.transform(df).select("reading_id", *columns)


@query
def outlier_to_median(spark, folder):
    df = S.nan_to_null(readings(spark, folder))
    fitted = repair.fit_outside_to_median(df, "temperature", *K.TEMPERATURE_BOUNDS)
    return _repaired(df, fitted, ["temperature"])


@query
def impute_median(spark, folder):
    df = S.nan_to_null(readings(spark, folder))
    return _repaired(df, repair.fit_missing_to_median(df, K.MEDIAN_FILLED), K.MEDIAN_FILLED)


@query
def negative_to_median(spark, folder):
    df = S.nan_to_null(readings(spark, folder))
    return _repaired(df, repair.fit_negative_to_median(df, K.NEGATIVE_REPAIRED),
                     K.NEGATIVE_REPAIRED)


@query
def negative_to_median_customer(spark, folder):
    df = _table(spark, folder, "customer")
    return repair.fit_negative_to_median(df, ["c_acctbal"]).transform(df).select(
        "c_custkey", "c_acctbal")


@query
def impute_mode(spark, folder):
    df = readings(spark, folder)
    return _repaired(df, repair.fit_missing_to_mode(df, ["ambient_light"]), ["ambient_light"])


@query
def impute_group_mode(spark, folder):
    df = readings(spark, folder)
    return _repaired(df, repair.fit_group_mode(df, ["ambient_light"], "time_of_day"),
                     ["ambient_light"])


@query
def impute_group_median(spark, folder):
    df = S.nan_to_null(readings(spark, folder))
    return _repaired(df, repair.fit_group_median(df, K.SANITISED, "time_of_day"), K.SANITISED)


@query
def dedupe(spark, folder):
    return _unique(spark, folder).drop("ts")


@query
def clean_eager(spark, folder):
    return clean.clean(readings(spark, folder), "eager").drop("ts")


@query
def clean_deferred(spark, folder):
    return clean.clean(readings(spark, folder), "deferred").drop("ts")


@query
def sanitise(spark, folder):
    return clean.sanitise(S.nan_to_null(readings(spark, folder))).select(
        "reading_id", "time_of_day", *K.SANITISED)


# --- statistics ---------------------------------------------------------------------------

@query
def describe(spark, folder):
    return T.describe(readings(spark, folder), K.NUMERIC)


@query
def describe_lineitem(spark, folder):
    return T.describe(_table(spark, folder, "lineitem"), LINEITEM_NUMERIC)


@query
def shape_stats(spark, folder):
    return T.shape_stats(readings(spark, folder), K.NUMERIC)


@query
def shape_flags(spark, folder):
    return T.shape_flags(T.shape_stats(readings(spark, folder), K.NUMERIC))


@query
def group_means(spark, folder):
    return T.group_means(_labelled(spark, folder), K.TARGET, K.NUMERIC, K.ACTIVITY_ORDER)


@query
def group_means_customer(spark, folder):
    return T.group_means(_table(spark, folder, "customer"), "c_mktsegment", ["c_acctbal"])


def _session_stats(spark, folder):
    return T.session_stats(_labelled(spark, folder), K.SESSION, K.TARGET, K.ACTIVITY_ORDER,
                           {"avg_co2": "co2_electrochem", "avg_temp": "temperature"})


@query
def session_stats(spark, folder):
    return _session_stats(spark, folder)


@query
def session_overview(spark, folder):
    return T.session_overview(_session_stats(spark, folder))


@query
def distinct_sessions(spark, folder):
    return T.distinct_count(readings(spark, folder), K.SESSION)


@query
def crosstab_pct(spark, folder):
    return T.crosstab_pct(_labelled(spark, folder), "ambient_light", K.TARGET, K.ACTIVITY_ORDER)


@query
def crosstab_pct_lineitem(spark, folder):
    return T.crosstab_pct(_table(spark, folder, "lineitem"), "l_returnflag", "l_linestatus",
                          ["F", "O"])


@query
def group_size_wide(spark, folder):
    return T.group_size_wide(_labelled(spark, folder), K.SESSION, K.TARGET, K.ACTIVITY_ORDER)


@query
def top_sessions(spark, folder):
    return T.top_keys(readings(spark, folder), K.SESSION, K.TOP_SESSIONS)


@query
def top_sessions_mix(spark, folder):
    return T.top_key_mix(_labelled(spark, folder), K.SESSION, K.TARGET, K.ACTIVITY_ORDER,
                         K.TOP_SESSIONS)


CORR = [*K.NUMERIC, "target"]


@query
def corr_matrix(spark, folder):
    return T.corr_matrix(_encoded(spark, folder), CORR)


@query
def corr_lower(spark, folder):
    return T.corr_lower(T.corr_matrix(_encoded(spark, folder), CORR), CORR)


@query
def target_corr(spark, folder):
    return T.target_corr(_encoded(spark, folder), K.NUMERIC, "target")


@query
def corr_matrix_lineitem(spark, folder):
    return T.corr_matrix(_table(spark, folder, "lineitem"), LINEITEM_NUMERIC)


@query
def quantiles_lineitem(spark, folder):
    return quantiles(_table(spark, folder, "lineitem"), LINEITEM_NUMERIC,
                     [0.0, 0.1, 0.5, 0.9, 1.0], ["l_returnflag"])


# --- chart data -----------------------------------------------------------------------------

@query
def histogram(spark, folder):
    return density.histogram(readings(spark, folder), K.NUMERIC, K.HISTOGRAM_BINS)


@query
def histogram_sessions(spark, folder):
    return density.histogram(_session_stats(spark, folder), ["rows"], K.SESSION_HISTOGRAM_BINS)


@query
def histogram_lineitem(spark, folder):
    return density.histogram(_table(spark, folder, "lineitem"), LINEITEM_NUMERIC,
                             K.HISTOGRAM_BINS)


@query
def kde_grid(spark, folder):
    return density.kde_grid(readings(spark, folder), K.NUMERIC)


@query
def kde_by_class(spark, folder):
    return density.kde_by_class(_labelled(spark, folder), ["co2_infrared", "co2_electrochem"],
                                K.TARGET)


@query
def box_stats(spark, folder):
    return density.box_stats(_labelled(spark, folder), K.NUMERIC, K.TARGET)


@query
def box_stats_lineitem(spark, folder):
    return density.box_stats(_table(spark, folder, "lineitem"), LINEITEM_NUMERIC, "l_returnflag")


@query
def outlier_rows(spark, folder):
    return density.outlier_rows(_labelled(spark, folder), K.NUMERIC, K.TARGET)


# --- session windows --------------------------------------------------------------------------

def _windowed(spark, folder, columns=None, centred=None, lookback=K.BASELINE_ROWS):
    df = _unique(spark, folder).withColumn("burden", S.row_sum(K.METAL_OXIDE))
    long = W.find_long_sessions(readings(spark, folder), K.SESSION, K.ROW_ORDER)
    made = W.session_features(df, K.SESSION, K.ROW_ORDER, columns or (lambda w: {}), lookback,
                              centred, long)
    return made.select("reading_id", *[c for c in made.columns if c not in df.columns])


@query
def step_diff(spark, folder):
    return _windowed(spark, folder, lambda w: {
        f"{c}_diff": W.step_diff(c, w) for c in ("co2_infrared", "temperature", "humidity")})


@query
def rolling_std(spark, folder):
    return _windowed(spark, folder, lambda w: {
        f"{c}_std": W.rolling_std(c, K.VOLATILITY_ROWS, w)
        for c in ("temperature", "co2_infrared")})


@query
def rolling_mean(spark, folder):
    return _windowed(spark, folder, lambda w: {
        "co2_mean": W.rolling_mean("co2_infrared", K.BASELINE_ROWS, w)})


@query
def rolling_sum(spark, folder):
    return _windowed(spark, folder, lambda w: {
        "burden_sum": W.rolling_sum("burden", K.BASELINE_ROWS, w)})


@query
def session_centred(spark, folder):
    return _windowed(spark, folder, centred={
        "temperature_centred": "temperature", "co2_centred": "co2_infrared"})


@query
def spike_flag(spark, folder):
    return _windowed(spark, folder, lambda w: {
        "spike": W.spike_flag("co2_infrared", K.BASELINE_ROWS, K.SPIKE_LIMIT, w)})


# --- row functions and encodings ----------------------------------------------------------------

TIME_CODES = {"night": 0, "morning": 1, "afternoon": 2, "evening": 3}


@query
def row_fusion(spark, folder):
    return readings(spark, folder).select(
        "reading_id", S.row_mean(K.METAL_OXIDE).alias("mox_mean"),
        S.row_max(K.METAL_OXIDE).alias("mox_max"), S.row_sum(K.METAL_OXIDE).alias("mox_sum"))


@query
def discomfort_index(spark, folder):
    return readings(spark, folder).select(
        "reading_id",
        S.discomfort_index(F.col("temperature"), F.col("humidity")).alias("discomfort"))


@query
def ordinal_encode(spark, folder):
    return _labelled(spark, folder).select(
        "reading_id", S.ordinal(F.col(K.TARGET), K.ACTIVITY_CODES).alias("target"),
        S.ordinal(F.col("ambient_light"), K.LIGHT_CODES, K.LIGHT_DEFAULT).alias("light"))


@query
def ordinal_time(spark, folder):
    return readings(spark, folder).select(
        "reading_id", S.ordinal(F.col("time_of_day"), TIME_CODES).alias("time_code"))


@query
def one_hot(spark, folder):
    df = _labelled(spark, folder).select("reading_id", *features.ENCODED)
    return encode.fit_one_hot(df, features.ENCODED).transform(df)


@query
def fill_constant(spark, folder):
    return readings(spark, folder).select(
        "reading_id", F.coalesce("humidity", F.lit(0.0)).alias("humidity"),
        F.coalesce("ambient_light", F.lit("unknown")).alias("ambient_light"))


@query
def scalar_functions(spark, folder):
    c = F.col("co2_infrared")
    return readings(spark, folder).select(
        "reading_id", F.abs(c).alias("magnitude"), F.bround(c / 4, 1).alias("half_even"),
        S.flag(c < 0).alias("negative"),
        S.flag(F.col("hvac_mode").startswith("view")).alias("starts_view"))


@query
def log1p_columns(spark, folder):
    return scale.log1p_columns(readings(spark, folder), ["co_gas"]).select("reading_id", "co_gas")


@query
def log1p_documents(spark, folder):
    return scale.log1p_columns(_table(spark, folder, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars")), ["n_chars"])


@query
def features_full(spark, folder):
    return features.features_full(readings(spark, folder)).drop("ts")


# --- splits, scaling, balancing --------------------------------------------------------------------

def _classed(spark, folder, columns=()) -> DataFrame:
    """Rows without copies, written once, as the splits pass over them several times."""
    return cut_lineage(repair.dedupe(_encoded(spark, folder)).select(
        "reading_id", "target", *columns))


@query
def stratified_split(spark, folder):
    return split.stratified_split(_classed(spark, folder), "reading_id", "target")


@query
def stratified_split_labels(spark, folder):
    df = _table(spark, folder, "labels")
    return split.stratified_split(df, "doc_id", "toxic").select("doc_id", "toxic", "is_test")


@query
def stratified_folds(spark, folder):
    return split.stratified_folds(_classed(spark, folder), "reading_id", "target")


@query
def group_split(spark, folder):
    return split.group_split(_unique(spark, folder), K.SESSION).select("reading_id", "is_test")


@query
def group_folds(spark, folder):
    return split.group_folds(_encoded(spark, folder), K.SESSION, "target", [0, 1, 2])


@query
def class_weights(spark, folder):
    return split.class_weights(_encoded(spark, folder), "target")


@query
def class_weights_labels(spark, folder):
    return split.class_weights(_table(spark, folder, "labels"), "toxic")


@query
def standardise(spark, folder):
    df = split.stratified_split(_classed(spark, folder, K.NUMERIC), "reading_id", "target")
    fitted = scale.fit_chosen_standardiser(df.where(~F.col("is_test")), K.NUMERIC)
    return fitted.transform(df).select("reading_id", *K.NUMERIC)


@query
def knn_same_class(spark, folder):
    df = _table(spark, folder, "embeddings")
    return neighbours.knn_within_class(df, df, "vec_id", "label", "embedding",
                                       K.SMOTE_NEIGHBOURS).drop("neighbour_vector")


@query
def smote_class_counts(spark, folder):
    return balance.smote_class_counts(_encoded(spark, folder), "target")


@query
def smote_rows(spark, folder):
    df = _table(spark, folder, "embeddings")
    made = balance.synthetic_rows(df, "vec_id", "label", "embedding")
    return made.select("label", "draw", "base", "neighbour", "u",
                       F.posexplode("embedding").alias("position", "value"))


@query
def smote_readings(spark, folder):
    """Cleaned readings, all sensors scaled, with the synthetic rows that make the classes equal.

    Scaled values are rounded, so that distances of other engines compare equal.
    """
    code = S.ordinal(F.col(K.TARGET), K.ACTIVITY_CODES)
    df = clean.clean(readings(spark, folder)).select("reading_id", code.alias("target"), *K.NUMERIC)
    df = cut_lineage(df.where(F.col("target").isNotNull()))
    scaled = cut_lineage(rounded(scale.fit_chosen_standardiser(df, K.NUMERIC).transform(df)))
    return balance.smote(scaled, "reading_id", "target", K.NUMERIC)


# --- evaluation -----------------------------------------------------------------------------------------

def _ruled(spark, folder):
    """A fixed rule as a stand-in prediction."""
    rule = F.when(F.col("co2_infrared") > 140, 2).when(F.col("temperature") > 24, 1).otherwise(0)
    return _encoded(spark, folder).select("target", rule.alias("guess"))


@query
def classification_report(spark, folder):
    return evaluate.classification_report(_ruled(spark, folder), "target", "guess")


@query
def macro_f1(spark, folder):
    return evaluate.macro_f1(_ruled(spark, folder), "target", "guess")


@query
def confusion(spark, folder):
    return evaluate.confusion(_ruled(spark, folder), "target", "guess")


# --- sources and sinks ------------------------------------------------------------------------------------

@query
def csv_roundtrip(spark, folder):
    """Cleaned readings written as CSV and read back."""
    cleaned = clean.clean(readings(spark, folder)).drop("ts")
    path = scratch_path(spark, "cleaned-csv")
    files.write_csv(cleaned, path)
    return files.read_csv(spark, path, cleaned.schema)


@query
def csv_roundtrip_documents(spark, folder):
    """Texts with blanks, quotes and line breaks written as CSV and read back."""
    df = _table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    path = scratch_path(spark, "documents-csv")
    files.write_csv(df, path)
    return files.read_csv(spark, path, df.schema)


@query
def parquet_roundtrip(spark, folder):
    """Readings bound by their source names, written as Parquet, and read back."""
    original = {ours: theirs for theirs, ours in K.SOURCE_COLUMNS.items()}
    source = readings(spark, folder).drop("ts").withColumnsRenamed(original)
    path = scratch_path(spark, "readings")
    files.write_parquet(files.bind_columns(source), path)
    return files.read_parquet(spark, path)


# --- models ---------------------------------------------------------------------------------------------------

def _training(spark, folder) -> training.TrainingData:
    return training.training_data(features.features_full(readings(spark, folder)))


@query
def baseline_models(spark, folder):
    data = _training(spark, folder)
    return models.compare_models(data.train, data.test, models.CANDIDATES)


@query
def tuned_models(spark, folder):
    """Balanced search over all draws and folds per model, models and parameters saved."""
    return training.tuned_run(_training(spark, folder), "reading_id",
                              scratch_path(spark, "models"))


@query
def score_rows(spark, folder):
    """The test rows with the class that each model predicts."""
    data = _training(spark, folder)
    n, found = data.train.count(), None
    for c in models.CANDIDATES:
        rows = models.score_rows(c.build(n).fit(data.train), data.test).select(
            F.lit(c.name).alias("model"), "reading_id", "label", "prediction")
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def feature_importance(spark, folder):
    data = _training(spark, folder)
    forest = models.random_forest(0).fit(data.train)
    return models.feature_importance(forest, data.names)


@query
def model_roundtrip(spark, folder):
    """Every model saved, loaded and used: rows per label and prediction."""
    data = _training(spark, folder)
    where, n, found = scratch_path(spark, "models"), data.train.count(), None
    for c in models.CANDIDATES:
        path = files.save_model(c.build(n).fit(data.train), where, c.name)
        cells = evaluate.confusion(models.score_rows(c.load(spark, path), data.test), "label", "prediction")
        cells = cells.select(F.lit(c.name).alias("model"), "*")
        found = cells if found is None else found.unionByName(cells)
    return found


@query
def best_params(spark, folder):
    """Chosen parameters of every model, saved as JSON and read back."""
    where = scratch_path(spark, "params")
    training.tuned_run(_training(spark, folder), "reading_id", where)
    found = [(c.name, k, str(v)) for c in models.CANDIDATES
             for k, v in sorted(files.load_params(spark, where, c.name).items())]
    return spark.createDataFrame(found, "model string, parameter string, value string")


@query
def training_rows(spark, folder):
    """Rows per part and label after split and scaling."""
    data = _training(spark, folder)
    both = data.train.withColumn("is_test", F.lit(False)).unionByName(
        data.test.withColumn("is_test", F.lit(True)))
    return both.groupBy("is_test", "label").agg(F.count(F.lit(1)).alias("n"))
