"""Exploratory statistics statements."""

from oracles.base import features, fleet, pct

SENSORS = ["air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm", "tool_wear_min"]
ENGINEERED = ["temp_diff_K", "power_W", "torque_x_toolwear", "speed_torque_ratio"]
Z = "air_temp_z_within_type"
CANDIDATES = [*SENSORS, *ENGINEERED, Z]
MODES = ["TWF", "HDF", "PWF", "OSF", "RNF"]
INZ = """, inz AS (SELECT eng.*, (air_temperature_k - AVG(air_temperature_k) OVER w) / STDDEV_SAMP(air_temperature_k) OVER w
  AS air_temp_z_within_type FROM eng WINDOW w AS (PARTITION BY type_code))"""


def _union(parts):
    return " UNION ALL ".join(parts)


def _long(columns, table, keep="machine_failure"):
    return ", lng AS (" + _union(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, {keep} FROM {table} WHERE {c} IS NOT NULL" for c in columns) + ")"


def _describe(columns, table):
    return _union(
        f"""SELECT '{c}' AS feature, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std,
        ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS min, ROUND(QUANTILE_CONT(CAST({c} AS DOUBLE), 0.25), 6) AS q25, ROUND(QUANTILE_CONT(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
        ROUND(QUANTILE_CONT(CAST({c} AS DOUBLE), 0.75), 6) AS q75, ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS max FROM {table}""" for c in columns)


def _erfc(x):
    """Trapezoid sums of step 1/2 over exp(-t * t) / (t * t + x * x), less the residue at x; exact to double precision."""
    sums = " + ".join(f"EXP(-{n * n / 4}E0) / ({n * n / 4}E0 + ({x}) * ({x}))" for n in range(1, 14))
    residue = f"CASE WHEN ({x}) < 6.283E0 THEN 2.0E0 / (1.0E0 - EXP(4.0E0 * PI() * ({x}))) ELSE 0.0E0 END"
    return (f"(CASE WHEN ({x}) < 1.0E-8 THEN 1.0E0 - 2.0E0 * ({x}) / SQRT(PI()) ELSE "
            f"({x}) / 2.0E0 / PI() * EXP(-({x}) * ({x})) * (1.0E0 / (({x}) * ({x})) + 2.0E0 * ({sums})) + {residue} END)")


RANKS = """
, c AS (SELECT feature, value, COUNT(*) FILTER (machine_failure = 0) AS n0, COUNT(*) FILTER (machine_failure = 1) AS n1 FROM lng GROUP BY 1, 2)
, r AS (SELECT *, n0 + n1 AS t, SUM(n0 + n1) OVER (PARTITION BY feature ORDER BY value) - (n0 + n1) AS before FROM c)
, u AS (SELECT feature, CAST(SUM(n0) AS DOUBLE) AS n0, CAST(SUM(n1) AS DOUBLE) AS n1,
    CAST(SUM(CAST(n0 AS HUGEINT) * (2 * before + t + 1)) - SUM(n0) * (SUM(n0) + 1) AS DOUBLE) / 2 AS u,
    CAST(SUM(CAST(t AS HUGEINT) * t * t - t) AS DOUBLE) AS ties FROM r GROUP BY feature)
, z AS (SELECT feature, u, (GREATEST(u, n0 * n1 - u) - n0 * n1 / 2 - 0.5E0) /
    SQRT(n0 * n1 / 12 * ((n0 + n1 + 1) - ties / ((n0 + n1) * (n0 + n1 - 1)))) AS z FROM u)
, med AS (SELECT feature, QUANTILE_CONT(value, 0.5) FILTER (machine_failure = 0) AS m0,
    QUANTILE_CONT(value, 0.5) FILTER (machine_failure = 1) AS m1 FROM lng GROUP BY 1)"""
P = f"CASE WHEN z <= 0 THEN 1.0E0 ELSE {_erfc('(z / SQRT(2.0E0))')} END"
MWU = RANKS + f"""
SELECT feature, ROUND(m0, 6) AS median_normal, ROUND(m1, 6) AS median_failure, u AS "mannwhitney_U", ROUND(z, 6) AS z, ROUND({P}, 9) AS p_value,
       CASE WHEN {P} < 0.05 THEN 1 ELSE 0 END AS significant_at_005 FROM z JOIN med USING (feature)"""
D = """(AVG(value) FILTER (machine_failure = 0) - AVG(value) FILTER (machine_failure = 1)) /
  SQRT(((COUNT(*) FILTER (machine_failure = 0) - 1) * VAR_SAMP(value) FILTER (machine_failure = 0)
      + (COUNT(*) FILTER (machine_failure = 1) - 1) * VAR_SAMP(value) FILTER (machine_failure = 1)) / (COUNT(*) - 2))"""


def _corr_cells(columns):
    return _union((f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, " +
                   ("1.0E0 AS r" if a == b else f"(SELECT ROUND(CORR({a}, {b}), 6) FROM inz) AS r")) for a in columns for b in columns)


def _scatter(x, y):
    def cell(c):
        return (f"CAST(LEAST(FLOOR((CAST({c} AS DOUBLE) - (SELECT MIN({c}) FROM obs)) * 40 / "
                f"((SELECT CAST(MAX({c}) AS DOUBLE) FROM obs) - (SELECT MIN({c}) FROM obs))), 39) AS INT)")
    return fleet(f"SELECT '{x}' AS x_column, '{y}' AS y_column, {cell(x)} AS x_bin, {cell(y)} AS y_bin, machine_failure, COUNT(*) AS n "
                 "FROM obs GROUP BY ALL")


HIST = """
, rng AS (SELECT {by}, CASE WHEN MIN(value) = MAX(value) THEN MIN(value) - 0.5 ELSE MIN(value) END AS lo,
    CASE WHEN MIN(value) = MAX(value) THEN MAX(value) + 0.5 ELSE MAX(value) END AS hi, COUNT(*) AS total FROM lng GROUP BY {by})
, hit AS (SELECT {by}, CAST(LEAST(FLOOR((value - lo) * 40 / (hi - lo)), 39) AS INT) AS bin, COUNT(*) AS n FROM lng JOIN rng USING ({by}) GROUP BY ALL)
SELECT {by}, CAST(b.i AS INT) AS bin, FLOOR((lo + (hi - lo) * b.i / 40) * 1000000 + 0.5E0) / 1000000 AS bin_low, FLOOR((lo + (hi - lo) * (b.i + 1) / 40) * 1000000 + 0.5E0) / 1000000 AS bin_high,
  COALESCE(hit.n, 0) AS n, ROUND(COALESCE(hit.n, 0) * 40 / (total * (hi - lo)), 9) AS density
FROM rng CROSS JOIN (SELECT UNNEST(RANGE(40)) AS i) b LEFT JOIN (SELECT {by}, bin AS i, n FROM hit) hit USING ({by}, i)"""


def histogram(long, by):
    return long + HIST.format(by=by)


SUMMARY = """, u AS ({rows}) SELECT feature, flag_name, flag, COUNT(*) AS count, ROUND(MIN(value), 6) AS min,
  ROUND(QUANTILE_CONT(value, 0.25), 6) AS q25, ROUND(QUANTILE_CONT(value, 0.5), 6) AS q50, ROUND(QUANTILE_CONT(value, 0.75), 6) AS q75,
  ROUND(MAX(value), 6) AS max FROM u GROUP BY 1, 2, 3"""


def _five(columns, flags, table):
    return SUMMARY.format(rows=_union(
        f"SELECT '{c}' AS feature, '{f}' AS flag_name, {f} AS flag, CAST({c} AS DOUBLE) AS value FROM {table}" for c in columns for f in flags))


def _iqr(columns):
    return ", q AS (" + _union(
        f"SELECT '{c}' AS feature, QUANTILE_CONT(CAST({c} AS DOUBLE), 0.25) AS a, QUANTILE_CONT(CAST({c} AS DOUBLE), 0.75) AS b FROM obs" for c in columns
    ) + "), bd AS (SELECT feature, a - 1.5E0 * (b - a) AS lo, b + 1.5E0 * (b - a) AS hi FROM q)" + _long(columns, "obs") + f"""
    , o AS (SELECT feature, FLOOR(lo * 100 + 0.5E0) / 100 AS lower_bound, FLOOR(hi * 100 + 0.5E0) / 100 AS upper_bound,
      COUNT(*) FILTER (value < lo OR value > hi) AS n_outliers_iqr, COUNT(*) AS tot FROM lng JOIN bd USING (feature) GROUP BY ALL)
    SELECT feature, lower_bound, upper_bound, n_outliers_iqr, {pct('n_outliers_iqr', 'tot')} AS pct_outliers FROM o"""


SQL = {
    "e01_describe": fleet(_describe(SENSORS, "obs")),
    "e01_describe_features": features(INZ + _describe(CANDIDATES, "inz")),
    "e02_univariate": fleet(_union(
        f"""SELECT '{c}' AS feature, ROUND(ROUND(AVG({c}), 6), 3) AS mean, ROUND(ROUND(QUANTILE_CONT(CAST({c} AS DOUBLE), 0.5), 6), 3) AS median,
        ROUND(ROUND(STDDEV_SAMP({c}), 6), 3) AS std, ROUND(CAST(MIN({c}) AS DOUBLE), 3) AS min, ROUND(CAST(MAX({c}) AS DOUBLE), 3) AS max,
        FLOOR((ROUND(QUANTILE_CONT(CAST({c} AS DOUBLE), 0.75), 6) - ROUND(QUANTILE_CONT(CAST({c} AS DOUBLE), 0.25), 6)) * 1000 + 0.5E0) / 1000 AS "IQR" FROM obs"""
        for c in SENSORS)),
    "e03_iqr_outliers": fleet(_iqr(SENSORS)),
    "e04_histogram": fleet(histogram(_long(SENSORS, "obs"), "feature")),
    "e05_frequencies": fleet(", c AS (" + _union(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS count FROM obs GROUP BY {c}"
        for c in ["type_code", "machine_failure", *MODES]) + f") SELECT *, {pct('count', 'SUM(count) OVER (PARTITION BY column_name)')} AS pct FROM c"),
    "e06_class_balance": fleet(f""", c AS (SELECT COUNT(*) AS t, COUNT(*) FILTER (machine_failure = 1) AS f FROM obs)
        SELECT t AS n_total, t - f AS n_normal, f AS n_failure, {pct('(t - f)', 't')} AS normal_pct, {pct('f', 't')} AS failure_pct,
        CAST(((t - f) * 20 + f) // (f * 2) AS DOUBLE) / 10 AS imbalance_ratio FROM c"""),
    "e07_mode_summary": fleet(_union(
        f"SELECT '{m}' AS failure_mode_code, SUM({m})::BIGINT AS count, {pct(f'SUM({m})', 'COUNT(*)', 3)} AS pct_of_all_rows, "
        f"{pct(f'SUM({m})', 'SUM(machine_failure)')} AS pct_of_failure_rows FROM obs" for m in MODES)),
    "e08_five_numbers": fleet(_five(SENSORS, [*MODES, "machine_failure"], "obs")),
    "e08_five_numbers_features": features(INZ + _five([*ENGINEERED, Z], ["machine_failure"], "inz")),
    "e08_bucket_by_class": features("SELECT tool_wear_bucket, machine_failure, COUNT(*) AS n FROM eng GROUP BY 1, 2"),
    "e09_mann_whitney": fleet(_long(SENSORS, "obs") + MWU),
    "e09_mann_whitney_features": features(INZ + _long(CANDIDATES, "inz") + MWU),
    "e10_crosstab": fleet(f""", c AS (SELECT type_code, COUNT(*) FILTER (machine_failure = 0) AS normal, COUNT(*) FILTER (machine_failure = 1) AS failure FROM obs GROUP BY 1)
        SELECT *, {pct('normal', '(normal + failure)', 4)} AS normal_pct, {pct('failure', '(normal + failure)', 4)} AS failure_pct,
        {pct('failure', '(normal + failure)')} AS failure_rate_pct FROM c"""),
    "e11_chi_square": fleet(""", c AS (SELECT type_code, machine_failure, COUNT(*) AS o FROM obs GROUP BY 1, 2)
        , e AS (SELECT o, SUM(o) OVER (PARTITION BY type_code) * SUM(o) OVER (PARTITION BY machine_failure) / SUM(o) OVER () AS e FROM c)
        , x AS (SELECT SUM((o - e) * (o - e) / e) AS chi2 FROM e)
        SELECT ROUND(chi2, 6) AS chi2, 2 AS dof, ROUND(EXP(-chi2 / 2), 9) AS p_value, CASE WHEN EXP(-chi2 / 2) < 0.05 THEN 1 ELSE 0 END AS significant_at_005 FROM x"""),
    "e12_correlations": features(INZ + _corr_cells(SENSORS)),
    "e12_correlations_features": features(INZ + _corr_cells(CANDIDATES)),
    "e13_redundant_pairs": features(INZ + ", c AS (" + _union(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, (SELECT ROUND(CORR({a}, {b}), 6) FROM inz) AS r"
        for i, a in enumerate(CANDIDATES) for b in CANDIDATES[i + 1:]) + ") SELECT feature_1, feature_2, ROUND(r, 3) AS correlation FROM c WHERE ABS(r) > 0.85"),
    "e14_cohens_d": features(INZ + _long(CANDIDATES, "inz") + f" SELECT feature, ROUND({D}, 3) AS cohens_d, ROUND(ABS({D}), 3) AS abs_effect_size FROM lng GROUP BY 1"),
    "e15_rank_features": features(INZ + _long(CANDIDATES, "inz") + RANKS + f""", d AS (SELECT feature, ROUND({D}, 3) AS cohens_d, ROUND(ABS({D}), 3) AS abs_effect_size FROM lng GROUP BY 1)
        SELECT feature, ROUND({P}, 9) AS p_value, CASE WHEN {P} < 0.05 THEN 1 ELSE 0 END AS significant_at_005, cohens_d, abs_effect_size FROM z JOIN d USING (feature)"""),
    "e16_scatter_speed_torque": _scatter("rotational_speed_rpm", "torque_nm"),
    "e16_scatter_air_process": _scatter("air_temperature_k", "process_temperature_k"),
}
