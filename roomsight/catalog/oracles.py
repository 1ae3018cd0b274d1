"""The same results in plain SQL, written independently for another engine."""

from __future__ import annotations

from .. import constants as K
from ..plans.readings import READINGS_SQL
from .queries import TIE_SHIFT

ORACLES: dict[str, str] = {}

LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
RAW = f"r AS ({READINGS_SQL.format(events='events')})"


def r6(expr: str, name: str) -> str:
    """Six digits; the tiny shift keeps exact halves from going either way."""
    return f"round({expr} + {TIE_SHIFT}, 6) + 0.0 AS {name}"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def code(column: str, codes: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in codes.items()) + " END"


NORMAL_MODE = (r"regexp_replace(lower(regexp_replace(hvac_mode, '^\s+|\s+$', '', 'g')), "
               r"'[\s\-]+', '_', 'g')")
CANONICAL = "CASE activity_level " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in K.ACTIVITY_LABELS.items()) + " END"
TARGET = code("activity_level", K.ACTIVITY_CODES)

LABELLED = f"""{RAW},
lab AS (SELECT * REPLACE ({CANONICAL} AS activity_level, {NORMAL_MODE} AS hvac_mode) FROM r),
enc AS (SELECT *, {TARGET} AS target FROM lab)"""

MODE_LIGHT = ("(SELECT ambient_light FROM {src} WHERE ambient_light IS NOT NULL "
              "GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)")


def fill_median(columns, src: str) -> str:
    return ", ".join(f"coalesce({c}, (SELECT median({c}) FROM {src})) AS {c}" for c in columns)


def fix_negative(columns, src: str) -> str:
    return ", ".join(
        f"CASE WHEN {c} < 0 THEN (SELECT median({c}) FROM {src} WHERE {c} >= 0) ELSE {c} END AS {c}"
        for c in columns)


FIX_TEMPERATURE = ("CASE WHEN temperature < 10 OR temperature > 40 THEN (SELECT median(temperature)"
                   " FROM {src} WHERE temperature BETWEEN 10 AND 40) ELSE temperature END"
                   " AS temperature")

GROUP_MODE = """(SELECT time_of_day, ambient_light AS m FROM (
    SELECT time_of_day, ambient_light, row_number() OVER (PARTITION BY time_of_day
      ORDER BY count(*) DESC, ambient_light) AS rn
    FROM {src} WHERE ambient_light IS NOT NULL GROUP BY time_of_day, ambient_light) WHERE rn = 1)"""

EAGER = f"""{LABELLED},
c3 AS (SELECT * REPLACE ({FIX_TEMPERATURE.format(src='lab')}) FROM lab),
c4 AS (SELECT * REPLACE ({fill_median(K.MEDIAN_FILLED, 'c3')}) FROM c3),
c5 AS (SELECT * REPLACE ({fix_negative(K.NEGATIVE_REPAIRED, 'c4')}) FROM c4),
c6 AS (SELECT * REPLACE (coalesce(ambient_light, {MODE_LIGHT.format(src='c5')})
       AS ambient_light) FROM c5),
c7 AS (SELECT DISTINCT * FROM c6),
cleaned AS (SELECT c7.* REPLACE (CASE WHEN time_of_day IS NOT NULL
    THEN coalesce(ambient_light, g.m) END AS ambient_light)
  FROM c7 LEFT JOIN {GROUP_MODE.format(src='c7')} g USING (time_of_day))"""

DEFERRED = f"""{LABELLED},
d3 AS (SELECT * REPLACE ({FIX_TEMPERATURE.format(src='lab')}) FROM lab),
d5 AS (SELECT * REPLACE ({fix_negative(K.NEGATIVE_REPAIRED, 'd3')}) FROM d3),
d6 AS (SELECT DISTINCT * FROM d5),
d7 AS (SELECT * REPLACE ({fill_median(K.MEDIAN_FILLED, 'd6')}) FROM d6),
cleaned AS (SELECT d7.* REPLACE (CASE WHEN time_of_day IS NOT NULL
    THEN coalesce(ambient_light, g.m) END AS ambient_light)
  FROM d7 LEFT JOIN {GROUP_MODE.format(src='d7')} g USING (time_of_day))"""


def group_median(columns, src: str) -> str:
    meds = ", ".join(f"median({c}) AS m_{c}" for c in columns)
    fill = ", ".join(f"CASE WHEN time_of_day IS NOT NULL THEN coalesce({c}, m_{c}) END AS {c}"
                     for c in columns)
    drop = ", ".join(f"m_{c}" for c in columns)
    return (f"SELECT s.* EXCLUDE ({drop}) REPLACE ({fill}) FROM (SELECT * FROM {src} LEFT JOIN "
            f"(SELECT time_of_day, {meds} FROM {src} GROUP BY 1) USING (time_of_day)) s")


def sanitised(src: str) -> str:
    return f"""s1 AS (SELECT * REPLACE (
    CASE WHEN humidity < 0 OR humidity > 100 THEN NULL ELSE humidity END AS humidity,
    CASE WHEN co2_infrared < 0 THEN NULL ELSE co2_infrared END AS co2_infrared) FROM {src}),
san AS ({group_median(K.SANITISED, 's1')})"""


def columns(names, digits=K.NUMERIC) -> str:
    return ", ".join(r6(c, c) if c in digits else c for c in names)


ALL_BUT_TS = ["reading_id", "session_id", *K.NUMERIC, *K.CATEGORICAL]
UNIQUE = f"{RAW}, u AS (SELECT DISTINCT * FROM r)"
MOX_PRESENT = " + ".join(f"({c} IS NOT NULL)::INT" for c in K.METAL_OXIDE)
MOX_SUM = " + ".join(f"coalesce({c}, 0)" for c in K.METAL_OXIDE)
WINDOW = "WINDOW w AS (PARTITION BY session_id ORDER BY ts, reading_id)"


def roll(fn: str, c: str, rows: int) -> str:
    return (f"{fn}({c}) OVER (PARTITION BY session_id ORDER BY ts, reading_id "
            f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)")


def diff(c: str) -> str:
    return f"coalesce({c} - lag({c}) OVER (PARTITION BY session_id ORDER BY ts, reading_id), 0)"


def centred(c: str) -> str:
    return f"{c} - avg({c}) OVER (PARTITION BY session_id)"


SPIKE = f"coalesce(abs(co2_infrared - {roll('avg', 'co2_infrared', 10)}) > 30, false)::INT"

# --- profile -------------------------------------------------------------------------

NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, count(*) AS n FROM r"
    for c in ["reading_id", "ts", *ALL_BUT_TS[1:]])
ORACLES["missing_profile"] = f"""WITH {RAW} SELECT "column", missing,
  {r6('missing / n * 100.0', 'missing_pct')} FROM ({NULLS}) WHERE missing > 0"""
ORACLES["null_total"] = f"WITH {RAW} SELECT sum(missing)::BIGINT AS missing_cells FROM ({NULLS})"
ORACLES["null_total_subset"] = f"""WITH {RAW} SELECT sum(missing)::BIGINT AS missing_cells
  FROM ({NULLS}) WHERE "column" IN ({quoted(K.SANITISED)})"""
ORACLES["duplicate_count"] = f"""WITH {RAW} SELECT
  (SELECT count(*) FROM r) - (SELECT count(*) FROM (SELECT DISTINCT * FROM r)) AS duplicates"""


def counts(table: str, c: str) -> str:
    return f"SELECT {c}, count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY 1"


ORACLES["value_counts"] = f"WITH {RAW} {counts('r', 'ambient_light')}"
ORACLES["value_counts_orders"] = counts("orders", "o_orderpriority")
ORACLES["value_counts_documents"] = counts("documents", "source")
SHARE = "SELECT {c}, count(*) AS n, " + r6("count(*) / (SELECT count(*) FROM {t}) * 100.0", "pct") \
    + " FROM {t} WHERE {c} IS NOT NULL GROUP BY 1"
ORACLES["class_distribution"] = f"WITH {LABELLED} {SHARE.format(c='activity_level', t='lab')}"
ORACLES["class_distribution_labels"] = SHARE.format(c="toxic", t="labels")
BOUNDS = {"temperature": (10, 40), "humidity": (0, 100), "co2_infrared": (0, None),
          "co_gas": (0, None)}
ORACLES["bound_violations"] = f"WITH {RAW} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({c} < {lo}) AS below,
    {f'count(*) FILTER ({c} > {hi})' if hi is not None else '0::BIGINT'} AS above,
    {r6(f'min({c})', 'min')}, {r6(f'max({c})', 'max')}, {r6(f'avg({c})', 'mean')} FROM r"""
    for c, (lo, hi) in BOUNDS.items())
SCHEMA = [("reading_id", "bigint"), ("session_id", "bigint"), ("ts", "timestamp_ntz"),
          ("time_of_day", "string"), *[(c, "double") for c in K.NUMERIC],
          ("ambient_light", "string"), ("hvac_mode", "string"), ("activity_level", "string")]
ORACLES["schema_profile"] = f"WITH {RAW} SELECT (SELECT count(*) FROM r) AS rows, * FROM (VALUES " \
    + ", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(SCHEMA)) \
    + ') v(position, "column", "type")'

# --- projections and filters ----------------------------------------------------------

ORACLES["filter_project"] = f"""WITH {RAW} SELECT reading_id,
  {columns(['temperature', 'humidity', 'co_gas'])} FROM r
  WHERE (temperature > 40 OR humidity > 100) AND NOT coalesce(co_gas < 0, false)"""
ORACLES["filter_project_lineitem"] = f"""SELECT l_orderkey, l_partkey,
  {columns(['l_quantity', 'l_discount'], LINEITEM_NUMERIC)} FROM lineitem
  WHERE l_quantity >= 45 AND l_discount > 0.05::DOUBLE"""
KEPT = [c for c in ["reading_id", "session_id", *K.NUMERIC] if c not in K.METAL_OXIDE]
ORACLES["drop_columns"] = f"WITH {RAW} SELECT {columns(KEPT)} FROM r"
NET = "l_extendedprice * (1.0::DOUBLE - l_discount)"
ORACLES["derive_columns"] = f"""SELECT l_orderkey, l_linenumber, {r6('l_quantity', 'l_quantity')},
  {r6(NET, 'net')}, {r6(f'{NET} * (1.0::DOUBLE + l_tax)', 'gross')},
  (l_quantity > 25)::INT AS is_large FROM lineitem"""


def clipped(c: str) -> str:
    lo, hi = BOUNDS[c]
    test = f"{c} < {lo}" + (f" OR {c} > {hi}" if hi is not None else "")
    return r6(f"CASE WHEN {test} THEN NULL ELSE {c} END", c)


ORACLES["clip_to_null"] = f"WITH {RAW} SELECT reading_id, {', '.join(clipped(c) for c in BOUNDS)}" \
                          " FROM r"
ORACLES["scale_columns_chosen"] = f"""WITH {RAW},
  x AS (SELECT *, (temperature > 40)::INT AS is_hot, 1.0 AS one FROM r)
  SELECT "column" FROM (""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n FROM x"""
    for c in [*K.NUMERIC, "is_hot", "one"]) + ") WHERE n > 2"
ORACLES["sql_text"] = f"""WITH {RAW} SELECT time_of_day, count(*) AS n,
  {r6('avg(temperature)', 'mean_temperature')} FROM r GROUP BY time_of_day"""
ORACLES["first_rows"] = f"""WITH {RAW} SELECT reading_id, session_id,
  {columns(['temperature', 'humidity'])}, hvac_mode FROM r ORDER BY ts, reading_id LIMIT 10"""

# --- cleaning ---------------------------------------------------------------------------

ORACLES["canonical_labels"] = f"WITH {LABELLED} SELECT reading_id, activity_level FROM lab"
URGENT = "CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' " \
         "WHEN '3-MEDIUM' THEN 'medium' {rest} END"
ORACLES["canonical_priority"] = f"""SELECT o_orderkey, {URGENT.format(rest='')} AS priority,
  {URGENT.format(rest='ELSE o_orderpriority')} AS priority_kept FROM orders"""
ORACLES["normalise_text"] = f"WITH {LABELLED} SELECT reading_id, hvac_mode FROM lab"
ORACLES["outlier_to_median"] = f"""WITH {RAW}, x AS (SELECT * REPLACE (
  {FIX_TEMPERATURE.format(src='r')}) FROM r) SELECT reading_id, {columns(['temperature'])} FROM x"""
ORACLES["impute_median"] = f"""WITH {RAW}, x AS (SELECT * REPLACE (
  {fill_median(K.MEDIAN_FILLED, 'r')}) FROM r)
  SELECT reading_id, {columns(K.MEDIAN_FILLED)} FROM x"""
ORACLES["negative_to_median"] = f"""WITH {RAW}, x AS (SELECT * REPLACE (
  {fix_negative(K.NEGATIVE_REPAIRED, 'r')}) FROM r)
  SELECT reading_id, {columns(K.NEGATIVE_REPAIRED)} FROM x"""
ORACLES["negative_to_median_customer"] = f"""WITH x AS (SELECT * REPLACE (
  {fix_negative(['c_acctbal'], 'customer')}) FROM customer)
  SELECT c_custkey, {r6('c_acctbal', 'c_acctbal')} FROM x"""
ORACLES["impute_mode"] = f"""WITH {RAW} SELECT reading_id,
  coalesce(ambient_light, {MODE_LIGHT.format(src='r')}) AS ambient_light FROM r"""
ORACLES["impute_group_mode"] = f"""WITH {RAW} SELECT reading_id,
  CASE WHEN time_of_day IS NOT NULL THEN coalesce(ambient_light, g.m) END AS ambient_light
  FROM r LEFT JOIN {GROUP_MODE.format(src='r')} g USING (time_of_day)"""
ORACLES["impute_group_median"] = f"""WITH {RAW}, x AS ({group_median(K.SANITISED, 'r')})
  SELECT reading_id, {columns(K.SANITISED)} FROM x"""
ORACLES["dedupe"] = f"WITH {UNIQUE} SELECT {columns(ALL_BUT_TS)} FROM u"
ORACLES["clean_eager"] = f"WITH {EAGER} SELECT {columns(ALL_BUT_TS)} FROM cleaned"
ORACLES["clean_deferred"] = f"WITH {DEFERRED} SELECT {columns(ALL_BUT_TS)} FROM cleaned"
ORACLES["sanitise"] = f"""WITH {RAW}, {sanitised('r')}
  SELECT reading_id, time_of_day, {columns(K.SANITISED)} FROM san"""

# --- statistics ---------------------------------------------------------------------------


def described(table: str, names) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, {r6(f'avg({c})', 'mean')},
        {r6(f'stddev_samp({c})', 'std')}, {r6(f'min({c})', 'min')},
        {r6(f'quantile_cont({c}, 0.25)', 'q25')}, {r6(f'quantile_cont({c}, 0.5)', 'q50')},
        {r6(f'quantile_cont({c}, 0.75)', 'q75')}, {r6(f'max({c})', 'max')},
        {r6(f'skewness({c})', 'skewness')}, {r6(f'kurtosis({c})', 'kurtosis')} FROM {table}"""
        for c in names)


ORACLES["describe"] = f"WITH {RAW} {described('r', K.NUMERIC)}"
ORACLES["describe_lineitem"] = described("lineitem", LINEITEM_NUMERIC)
ORACLES["shape_stats"] = f"""WITH {RAW} SELECT "column", skewness, kurtosis
  FROM ({described('r', K.NUMERIC)})"""
ORACLES["shape_flags"] = f"""WITH {RAW} SELECT "column", skewness, kurtosis,
  abs(skewness) >= 0.5 AS log1p_advised, kurtosis > 1 AS heavy_tails
  FROM ({described('r', K.NUMERIC)})"""
ORACLES["group_means"] = f"""WITH {LABELLED} SELECT activity_level,
  {', '.join(r6(f'avg({c})', c) for c in K.NUMERIC)} FROM lab
  WHERE activity_level IS NOT NULL GROUP BY 1"""
ORACLES["group_means_customer"] = f"""SELECT c_mktsegment, {r6('avg(c_acctbal)', 'c_acctbal')}
  FROM customer GROUP BY 1"""


def pct(test: str, name: str) -> str:
    return r6(f"avg(CASE WHEN {test} THEN 1.0::DOUBLE ELSE 0.0 END) * 100.0", name)


SESSIONS = f"""SELECT session_id, count(activity_level) AS rows, {pct('target = 0', 'low_pct')},
  {pct('target = 1', 'mod_pct')}, {pct('target = 2', 'high_pct')},
  {r6('avg(co2_electrochem)', 'avg_co2')}, {r6('avg(temperature)', 'avg_temp')}
  FROM enc GROUP BY 1"""
ORACLES["session_stats"] = f"WITH {LABELLED} {SESSIONS}"
ORACLES["session_overview"] = f"""WITH {LABELLED}, s AS ({SESSIONS})
  SELECT count(*) AS sessions, min(rows) AS min_rows, max(rows) AS max_rows,
  {r6('avg(rows)', 'mean_rows')} FROM s"""
ORACLES["distinct_sessions"] = f"WITH {RAW} SELECT count(DISTINCT session_id) AS n_distinct FROM r"
ORACLES["crosstab_pct"] = f"WITH {LABELLED} SELECT ambient_light, " + ", ".join(
    pct(f"activity_level = '{a}'", f'"{a}"') for a in K.ACTIVITY_ORDER) + """ FROM lab
  WHERE ambient_light IS NOT NULL AND activity_level IS NOT NULL GROUP BY 1"""
ORACLES["crosstab_pct_lineitem"] = f"""SELECT l_returnflag, {pct("l_linestatus = 'F'", '"F"')},
  {pct("l_linestatus = 'O'", '"O"')} FROM lineitem GROUP BY 1"""
WIDE = ", ".join(f"count(*) FILTER (activity_level = '{a}') AS \"{a}\"" for a in K.ACTIVITY_ORDER)
ORACLES["group_size_wide"] = f"""WITH {LABELLED} SELECT session_id, {WIDE} FROM lab
  WHERE activity_level IS NOT NULL GROUP BY 1"""
TOP = "SELECT session_id, count(*) AS n FROM r GROUP BY 1 ORDER BY n DESC, session_id LIMIT 20"
ORACLES["top_sessions"] = f"WITH {RAW} {TOP}"
TOTAL = " + ".join(f'"{a}"' for a in K.ACTIVITY_ORDER)
ORACLES["top_sessions_mix"] = f"""WITH {LABELLED}, wide AS (SELECT session_id, {WIDE} FROM lab
  WHERE activity_level IS NOT NULL AND session_id IN (SELECT session_id FROM ({TOP})) GROUP BY 1)
  SELECT session_id, """ + ", ".join(
    r6(f'"{a}" / ({TOTAL}) * 100.0', f'"{a}"') for a in K.ACTIVITY_ORDER) + " FROM wide"


def corr_rows(table: str, names, keep) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r6(f'corr({a}, {b})', 'r')}
        FROM {table}""" for a in names for b in names if keep(names.index(a), names.index(b)))


CORR = [*K.NUMERIC, "target"]
ORACLES["corr_matrix"] = f"WITH {LABELLED} {corr_rows('enc', CORR, lambda i, j: True)}"
ORACLES["corr_lower"] = f"WITH {LABELLED} {corr_rows('enc', CORR, lambda i, j: i > j)}"
ORACLES["corr_matrix_lineitem"] = corr_rows("lineitem", LINEITEM_NUMERIC, lambda i, j: True)
ORACLES["target_corr"] = f"WITH {LABELLED} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r6(f'abs(corr({c}, target))', 'abs_r')} FROM enc"
    for c in K.NUMERIC)
ORACLES["quantiles_lineitem"] = " UNION ALL ".join(
    f"""SELECT l_returnflag, '{c}' AS "column", count({c}) AS n, {q}::DOUBLE AS q,
    {r6(f'quantile_cont({c}, {q})', 'value')} FROM lineitem GROUP BY 1"""
    for c in LINEITEM_NUMERIC for q in (0.0, 0.1, 0.5, 0.9, 1.0))

# --- chart data -----------------------------------------------------------------------------


def long_form(table: str, names, by: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {by} '{c}' AS \"column\", {c}::DOUBLE AS v FROM {table} WHERE {c} IS NOT NULL"
        for c in names)


def histogram(table: str, names, bins: int) -> str:
    return f"""l AS ({long_form(table, names)}),
  span AS (SELECT "column", min(v) AS lo, max(v) AS hi FROM l GROUP BY 1),
  every AS (SELECT "column", b AS bin, hi, lo + (b - 1) * ((hi - lo) / {bins}) AS left_edge,
    lo + b * ((hi - lo) / {bins}) AS right_edge FROM span, range(1, {bins + 1}) t(b)),
  hit AS (SELECT e."column", bin, count(*) AS n FROM every e JOIN l ON e."column" = l."column"
    AND v >= left_edge AND (v < right_edge OR bin = {bins}) GROUP BY ALL)
  SELECT "column", bin, {r6('left_edge', 'left_edge')}, {r6('right_edge', 'right_edge')},
    coalesce(n, 0) AS n FROM every LEFT JOIN hit USING ("column", bin)"""


ORACLES["histogram"] = f"WITH {RAW}, {histogram('r', K.NUMERIC, 50)}"
ORACLES["histogram_sessions"] = f"""WITH {LABELLED}, s AS ({SESSIONS}),
  {histogram('s', ['rows'], 30)}"""
ORACLES["histogram_lineitem"] = f"WITH {histogram('lineitem', LINEITEM_NUMERIC, 50)}"


def density(table: str, names, points: int, cut: float, by: str = "") -> str:
    key = f'{by}"column"'
    return f"""l AS ({long_form(table, names, by)}),
  span0 AS (SELECT {key}, count(*) AS n, min(v) AS lo0, max(v) AS hi0,
    count(*) ** -0.2::DOUBLE * stddev_samp(v) AS h FROM l GROUP BY ALL),
  span AS (SELECT *, lo0 - {cut} * h AS lo, hi0 + {cut} * h AS hi FROM span0),
  val AS (SELECT {key}, v, count(*) AS w FROM l GROUP BY ALL),
  grid AS (SELECT {key}, n, h, p::INT AS point, lo + p * ((hi - lo) / {points - 1}) AS x
    FROM span, range(0, {points}) t(p)),
  kde AS (SELECT {key}, point, x, sum(w * exp(-0.5::DOUBLE * ((x - v) / h) ** 2))
      / (any_value(n) * any_value(h) * sqrt(2 * pi())) AS density
    FROM grid JOIN val USING ({key}) GROUP BY ALL)"""


ORACLES["kde_grid"] = f"""WITH {RAW}, {density('r', K.NUMERIC, 200, 0.0)} SELECT "column", point, {r6('x', 'x')}, {r6('density', 'density')} FROM kde"""


def quartile_rows(by: str) -> str:
    return (f'SELECT {by}, "column", quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, '
            f"quantile_cont(v, 0.75) AS q75 FROM l GROUP BY ALL")


ORACLES["kde_by_class"] = f"""WITH {LABELLED},
  {density('lab', ['co2_infrared', 'co2_electrochem'], 100, 2.0, 'activity_level, ')},
  q AS ({quartile_rows('activity_level')})
  SELECT activity_level, "column", point, {r6('x', 'x')}, {r6('density', 'density')},
  {', '.join(r6(c, c) for c in ('q25', 'q50', 'q75'))}
  FROM kde JOIN q USING (activity_level, "column")"""


def box(table: str, names, by: str) -> str:
    return f"""l AS ({long_form(table, names, by + ',')}), q AS ({quartile_rows(by)}),
  j AS (SELECT *, v BETWEEN q25 - (q75 - q25) * 1.5::DOUBLE AND q75 + (q75 - q25) * 1.5::DOUBLE
    AS inside FROM l JOIN q USING ({by}, "column"))"""


def box_report(by: str) -> str:
    return f"""SELECT {by}, "column", {', '.join(r6(c, c) for c in ('q25', 'q50', 'q75'))},
  {r6('min(v) FILTER (inside)', 'whisker_low')}, {r6('max(v) FILTER (inside)', 'whisker_high')},
  count(*) FILTER (NOT inside) AS outliers, count(*) AS n FROM j
  GROUP BY {by}, "column", q25, q50, q75"""


ORACLES["box_stats"] = f"""WITH {LABELLED}, {box('lab', K.NUMERIC, 'activity_level')}
  {box_report('activity_level')}"""
ORACLES["box_stats_lineitem"] = f"""WITH {box('lineitem', LINEITEM_NUMERIC, 'l_returnflag')}
  {box_report('l_returnflag')}"""
ORACLES["outlier_rows"] = f"""WITH {LABELLED}, {box('lab', K.NUMERIC, 'activity_level')}
  SELECT activity_level, "column", {r6('v', 'value')} FROM j WHERE NOT inside"""

# --- session windows --------------------------------------------------------------------------

BURDEN = f"{RAW}, u AS (SELECT DISTINCT *, {MOX_SUM} AS burden FROM r)"
ORACLES["step_diff"] = f"WITH {UNIQUE} SELECT reading_id, " + ", ".join(
    r6(diff(c), f"{c}_diff") for c in ("co2_infrared", "temperature", "humidity")) + " FROM u"
ORACLES["rolling_std"] = f"WITH {UNIQUE} SELECT reading_id, " + ", ".join(
    r6(f"coalesce({roll('stddev_samp', c, 5)}, 0)", f"{c}_std")
    for c in ("temperature", "co2_infrared")) + " FROM u"
ORACLES["rolling_mean"] = f"""WITH {UNIQUE} SELECT reading_id,
  {r6(roll('avg', 'co2_infrared', 10), 'co2_mean')} FROM u"""
ORACLES["rolling_sum"] = f"""WITH {BURDEN} SELECT reading_id,
  {r6(roll('sum', 'burden', 10), 'burden_sum')} FROM u"""
ORACLES["session_centred"] = f"""WITH {UNIQUE} SELECT reading_id,
  {r6(centred('temperature'), 'temperature_centred')},
  {r6(centred('co2_infrared'), 'co2_centred')} FROM u"""
ORACLES["spike_flag"] = f"WITH {UNIQUE} SELECT reading_id, {SPIKE} AS spike FROM u"

# --- row functions and encodings ----------------------------------------------------------------

ORACLES["row_fusion"] = f"""WITH {RAW} SELECT reading_id,
  {r6(f'({MOX_SUM}) / nullif({MOX_PRESENT}, 0)', 'mox_mean')},
  {r6(f"greatest({', '.join(K.METAL_OXIDE)})", 'mox_max')}, {r6(MOX_SUM, 'mox_sum')} FROM r"""
THOM = "temperature - 0.55::DOUBLE * (1.0::DOUBLE - humidity / 100) * (temperature - 14.5::DOUBLE)"
ORACLES["discomfort_index"] = f"WITH {RAW} SELECT reading_id, {r6(THOM, 'discomfort')} FROM r"
LIGHT = f"coalesce({code('ambient_light', K.LIGHT_CODES)}, 2)"
ORACLES["ordinal_encode"] = f"WITH {LABELLED} SELECT reading_id, target, {LIGHT} AS light FROM enc"
TIME_CODES = {"night": 0, "morning": 1, "afternoon": 2, "evening": 3}
ORACLES["ordinal_time"] = f"""WITH {RAW} SELECT reading_id,
  {code('time_of_day', TIME_CODES)} AS time_code FROM r"""
MODES = ["error_mode", "purchase_mode", "signup_mode", "view_mode"]
TIMES = ["evening", "morning", "night"]
DUMMIES = ", ".join(
    [f"coalesce(hvac_mode = '{m}', false) AS hvac_mode_{m}" for m in MODES]
    + [f"coalesce(time_of_day = '{t}', false) AS time_of_day_{t}" for t in TIMES])
ORACLES["one_hot"] = f"WITH {LABELLED} SELECT reading_id, {DUMMIES} FROM lab"
ORACLES["fill_constant"] = f"""WITH {RAW} SELECT reading_id,
  {r6('coalesce(humidity, 0)', 'humidity')},
  coalesce(ambient_light, 'unknown') AS ambient_light FROM r"""
ORACLES["scalar_functions"] = f"""WITH {RAW} SELECT reading_id,
  {r6('abs(co2_infrared)', 'magnitude')}, {r6('round_even(co2_infrared / 4, 1)', 'half_even')},
  (co2_infrared < 0)::INT AS negative, starts_with(hvac_mode, 'view')::INT AS starts_view FROM r"""
ORACLES["log1p_columns"] = f"""WITH {RAW} SELECT reading_id,
  {r6('CASE WHEN co_gas > -1 THEN ln(1 + co_gas) END', 'co_gas')} FROM r"""
ORACLES["log1p_documents"] = f"""SELECT doc_id,
  {r6('ln(1 + n_chars::DOUBLE)', 'n_chars')} FROM documents"""
ORACLES["features_full"] = f"""WITH {EAGER}, {sanitised('cleaned')}
  SELECT reading_id, session_id, {columns(K.NUMERIC)},
  {r6(f'({MOX_SUM}) / nullif({MOX_PRESENT}, 0)', '"MetalOxide_Mean"')},
  {r6(f"greatest({', '.join(K.METAL_OXIDE)})", '"MetalOxide_Max"')},
  {r6(THOM, '"Env_Comfort_Index"')}, {r6(MOX_SUM, '"Total_VOC_Burden"')},
  {TARGET} AS "Target_Activity", {LIGHT} AS "Ambient_Light_Encoded",
  {r6(diff('co2_infrared'), '"CO2_Infrared_Diff"')}, {r6(diff('temperature'), '"Temp_Diff"')},
  {r6(diff('humidity'), '"Humidity_Diff"')},
  {r6(f"coalesce({roll('stddev_samp', 'temperature', 5)}, 0)", '"Temp_Volatility"')},
  {r6(f"coalesce({roll('stddev_samp', 'co2_infrared', 5)}, 0)", '"CO2_Volatility"')},
  {r6(roll('sum', f'({MOX_SUM})', 10), '"VOC_Accumulation_10"')},
  {SPIKE} AS "CO2_Discrepancy_Flag",
  {r6(centred('temperature'), '"Temp_Centered"')}, {r6(centred('co2_infrared'), '"CO2_Centered"')},
  {DUMMIES} FROM san"""

# --- splits, scaling, balancing --------------------------------------------------------------------


def hashed(ident: str) -> str:
    return f"md5(concat_ws('|', {ident}, '42'))"


def ranked(table: str, ident: str, label: str) -> str:
    return f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY {label}
    ORDER BY {hashed(ident)}, {ident}) AS rk, count(*) OVER (PARTITION BY {label}) AS nc,
    count(*) OVER () AS n FROM {table})"""


def test_sizes(label: str) -> str:
    return f"""sz AS (SELECT DISTINCT {label}, nc, n,
    (n - ceil(0.2::DOUBLE * n)) * nc / n AS share FROM ranked),
  sizes AS (SELECT {label}, nc - floor(share) - (row_number() OVER (
      ORDER BY share - floor(share) DESC, {label})
    <= n - ceil(0.2::DOUBLE * n) - sum(floor(share)) OVER ())::INT AS n_test FROM sz)"""


UNIQUE_ENC = f"{LABELLED}, ue AS (SELECT DISTINCT * FROM enc)"
ORACLES["stratified_split"] = f"""WITH {UNIQUE_ENC}, {ranked('ue', 'reading_id', 'target')},
  {test_sizes('target')} SELECT reading_id, target, rk <= n_test AS is_test
  FROM ranked JOIN sizes USING (target)"""
ORACLES["stratified_split_labels"] = f"""WITH {ranked('labels', 'doc_id', 'toxic')},
  {test_sizes('toxic')} SELECT doc_id, toxic, rk <= n_test AS is_test
  FROM ranked JOIN sizes USING (toxic)"""
ORACLES["stratified_folds"] = f"""WITH {UNIQUE_ENC}, {ranked('ue', 'reading_id', 'target')}
  SELECT reading_id, target, ((rk > nc * 1 // 5)::INT + (rk > nc * 2 // 5)::INT
    + (rk > nc * 3 // 5)::INT + (rk > nc * 4 // 5)::INT) AS fold FROM ranked"""
ORACLES["group_split"] = f"""WITH {UNIQUE}, g AS (SELECT session_id,
    row_number() OVER (ORDER BY {hashed('session_id')}, session_id)
      <= ceil(0.2::DOUBLE * count(*) OVER ()) AS is_test
    FROM (SELECT DISTINCT session_id FROM u))
  SELECT reading_id, is_test FROM u JOIN g USING (session_id)"""
CELLS = ", ".join(f"floor(log2(count(*) FILTER (target = {k}) + 1))::INT AS c{k}" for k in range(3))
ORACLES["group_folds"] = f"""WITH {LABELLED}, g AS (SELECT session_id, {CELLS} FROM enc GROUP BY 1)
  SELECT session_id, ((row_number() OVER (ORDER BY c2 DESC, c1 DESC, c0 DESC,
    {hashed('session_id')}, session_id) - 1) % 5)::INT AS fold FROM g"""
WEIGHTS = "SELECT {c}, count(*) AS n, " + r6(
    "(SELECT count(*) FROM {t}) / ((SELECT count(DISTINCT {c}) FROM {t}) * count(*))", "weight") \
    + " FROM {t} GROUP BY 1"
ORACLES["class_weights"] = f"WITH {LABELLED} {WEIGHTS.format(c='target', t='enc')}"
ORACLES["class_weights_labels"] = WEIGHTS.format(c="toxic", t="labels")
ORACLES["standardise"] = f"""WITH {UNIQUE_ENC}, {ranked('ue', 'reading_id', 'target')},
  {test_sizes('target')},
  s AS (SELECT *, rk <= n_test AS is_test FROM ranked JOIN sizes USING (target)),
  m AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}"
                               for c in K.NUMERIC) + """
    FROM s WHERE NOT is_test) SELECT reading_id, """ + ", ".join(
    r6(f"({c} - m_{c}) / s_{c}", c) for c in K.NUMERIC) + " FROM s, m"
KNN = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
  pairs AS (SELECT a.label, a.vec_id, b.vec_id AS neighbour,
    list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d2,
    b.v AS nv FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
  knn AS (SELECT *, row_number() OVER (PARTITION BY label, vec_id ORDER BY d2, neighbour)::INT
    AS rank FROM pairs QUALIFY rank <= 5)"""
ORACLES["knn_same_class"] = f"""WITH {KNN} SELECT label, vec_id, rank, neighbour,
  {r6('sqrt(d2)', 'distance')} FROM knn"""
ORACLES["smote_class_counts"] = f"""WITH {LABELLED} SELECT target, count(*) AS n,
  (max(count(*)) OVER () - count(*)) AS needed FROM enc WHERE target IS NOT NULL GROUP BY 1"""


def drawn(tag: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', '42', '{tag}', label, draw)), 1, 8))::BIGINT"


ORACLES["smote_rows"] = f"""WITH {KNN}, {ranked('e', 'vec_id', 'label')},
  need AS (SELECT label, count(*) AS nc, max(count(*)) OVER () - count(*) AS needed
    FROM e GROUP BY 1),
  draws0 AS (SELECT label, nc, unnest(range(0, needed)) AS draw FROM need),
  draws AS (SELECT label, draw, {drawn('b')} % nc AS base_rank, ({drawn('k')} % 5 + 1)::INT AS rank,
    {drawn('u')} / 4294967296.0::DOUBLE AS u FROM draws0),
  made AS (SELECT d.label, d.draw, b.vec_id AS base, k.neighbour, d.u,
    list_transform(list_zip(b.v, k.nv), lambda p: p[1] + d.u * (p[2] - p[1])) AS v
    FROM draws d JOIN ranked b ON b.label = d.label AND b.rk - 1 = d.base_rank
    JOIN knn k ON k.label = d.label AND k.vec_id = b.vec_id AND k.rank = d.rank)
  SELECT label, draw, base, neighbour, {r6('u', 'u')}, (p - 1)::INT AS position,
    {r6('v[p]', 'value')} FROM made, range(1, 65) t(p)"""
_all = ", ".join(K.NUMERIC)
ORACLES["smote_readings"] = f"""WITH {EAGER},
  t AS (SELECT reading_id, {code('activity_level', K.ACTIVITY_CODES)} AS label, {_all} FROM cleaned),
  known AS (SELECT * FROM t WHERE label IS NOT NULL),
  m AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in K.NUMERIC)} FROM known),
  e AS (SELECT reading_id, label, [{", ".join(r6(f"({c} - m_{c}) / s_{c}", "x").removesuffix(" AS x")
                                              for c in K.NUMERIC)}] AS v FROM known, m),
  {ranked('e', 'reading_id', 'label')},
  need AS (SELECT label, count(*) AS nc, max(count(*)) OVER () - count(*) AS needed FROM e GROUP BY 1),
  draws0 AS (SELECT label, nc, unnest(range(0, needed)) AS draw FROM need),
  draws AS (SELECT label, draw, {drawn('b')} % nc AS base_rank, ({drawn('k')} % 5 + 1)::INT AS rank,
    {drawn('u')} / 4294967296.0::DOUBLE AS u FROM draws0),
  base AS (SELECT DISTINCT b.label, b.reading_id, b.v FROM draws d
    JOIN ranked b ON b.label = d.label AND b.rk - 1 = d.base_rank),
  pairs AS (SELECT a.label, a.reading_id, b.reading_id AS neighbour, b.v AS nv,
    list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d2
    FROM base a JOIN e b ON a.label = b.label AND a.reading_id <> b.reading_id),
  knn AS (SELECT *, row_number() OVER (PARTITION BY label, reading_id ORDER BY d2, neighbour)::INT AS rank
    FROM pairs QUALIFY rank <= 5),
  made AS (SELECT d.label, list_transform(list_zip(b.v, k.nv), lambda p: p[1] + d.u * (p[2] - p[1])) AS v
    FROM draws d JOIN ranked b ON b.label = d.label AND b.rk - 1 = d.base_rank
    JOIN knn k ON k.label = d.label AND k.reading_id = b.reading_id AND k.rank = d.rank),
  every AS (SELECT reading_id, label, v, false AS is_synthetic FROM e
    UNION ALL SELECT NULL, label, v, true FROM made)
  SELECT reading_id, label AS target, {", ".join(r6(f"v[{i + 1}]", c) for i, c in enumerate(K.NUMERIC))},
    is_synthetic FROM every"""

# --- evaluation -----------------------------------------------------------------------------------------

RULED = f"""{LABELLED}, g AS (SELECT target, CASE WHEN co2_infrared > 140 THEN 2
    WHEN temperature > 24 THEN 1 ELSE 0 END AS guess FROM enc)"""
SCORED = f"""{RULED},
  k AS (SELECT target AS c FROM g UNION SELECT guess FROM g),
  t AS (SELECT c, (SELECT count(*) FROM g WHERE target = c AND guess = c) AS tp,
    (SELECT count(*) FROM g WHERE target = c) AS support,
    (SELECT count(*) FROM g WHERE guess = c) AS predicted FROM k),
  sc AS (SELECT c, coalesce(tp / nullif(predicted, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0)
    AS r, coalesce(2 * tp / nullif(support + predicted, 0), 0) AS f, support, tp FROM t)"""
ORACLES["classification_report"] = f"""WITH {SCORED}
  SELECT c::VARCHAR AS entry, {r6('p', 'precision')}, {r6('r', 'recall')}, {r6('f', 'f1')},
    support FROM sc
  UNION ALL SELECT 'accuracy', {r6('sum(tp) / sum(support)', 'x')},
    {r6('sum(tp) / sum(support)', 'x')}, {r6('sum(tp) / sum(support)', 'x')},
    sum(support)::BIGINT FROM sc
  UNION ALL SELECT 'macro avg', {r6('avg(p)', 'x')}, {r6('avg(r)', 'x')},
    {r6('avg(f)', 'x')}, sum(support)::BIGINT FROM sc
  UNION ALL SELECT 'weighted avg', {r6('sum(p * support) / sum(support)', 'x')},
    {r6('sum(r * support) / sum(support)', 'x')},
    {r6('sum(f * support) / sum(support)', 'x')}, sum(support)::BIGINT FROM sc"""
ORACLES["macro_f1"] = f"WITH {SCORED} SELECT {r6('avg(f)', 'macro_f1')} FROM sc"
ORACLES["confusion"] = f"""WITH {RULED} SELECT target::DOUBLE AS label, guess::DOUBLE AS prediction,
  count(*) AS n FROM g GROUP BY ALL"""

# --- sources and sinks, training rows ------------------------------------------------------------------------

ORACLES["csv_roundtrip"] = ORACLES["clean_eager"]
ORACLES["csv_roundtrip_documents"] = ("SELECT doc_id, nullif(text, '') AS text, "
                                      "nullif(lang, '') AS lang, nullif(source, '') AS source FROM documents")
ORACLES["parquet_roundtrip"] = f"WITH {RAW} SELECT {columns(ALL_BUT_TS)} FROM r"
ORACLES["training_rows"] = f"""WITH {UNIQUE_ENC}, {ranked('ue', 'reading_id', 'target')},
  {test_sizes('target')} SELECT rk <= n_test AS is_test, target::DOUBLE AS label, count(*) AS n
  FROM ranked JOIN sizes USING (target) GROUP BY ALL"""
