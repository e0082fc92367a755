"""Exploratory statistics. Most start from value counts, which are combined before any shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright import constants as K
from millwright.functions.columns import int_div, percent
from millwright.functions.significance import chi_square_tail, two_sided_normal
from millwright.operators.features import grouped_z
from millwright.plans.ordering import cumulate
from millwright.plans.quantiles import long_values, quantiles, value_counts

TARGET = "machine_failure"
CANDIDATES = [*K.SENSORS, *K.ENGINEERED, K.GROUPED_Z]
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _all_sensors(features: Sequence[str]) -> bool:
    """Sensors are two-decimal or integer readings: their distinct values are few."""
    return set(features) <= set(K.SENSORS)


def _r(column: Column | str, digits: int = 6) -> Column:
    return F.round(column, digits)


def _half_up(column: Column, digits: int = 2) -> Column:
    return F.floor(column * 10**digits + 0.5) / 10**digits


def _stack(df: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """One pass of aggregates, one output row per struct."""
    one = df.agg(*[s.alias(f"_{i}") for i, s in enumerate(structs)])
    return one.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(structs))])))


def with_grouped_z(engineered: DataFrame) -> DataFrame:
    """The in-sample grouped z: fitted on all rows, for description only."""
    return grouped_z(engineered, engineered)


def describe(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles, maximum per feature."""
    moments = _stack(df, [F.struct(
        F.lit(f).alias("feature"), F.avg(f).alias("mean"), F.stddev_samp(f).alias("std"),
        F.min(F.col(f).cast("double")).alias("min"), F.max(F.col(f).cast("double")).alias("max"),
    ) for f in features])
    middle = quantiles(value_counts(df, features), ["feature"], QUARTILES, _all_sensors(features))
    return moments.join(middle, "feature").select(
        "feature", "count", _r("mean").alias("mean"), _r("std").alias("std"), _r("min").alias("min"),
        *[_r(q).alias(q) for q in QUARTILES], _r("max").alias("max"))


def univariate(df: DataFrame, features: Sequence[str] = K.SENSORS) -> DataFrame:
    """Mean, median, deviation, range and interquartile range, three decimals."""
    described = describe(df, features)
    return described.select(
        "feature", _r("mean", 3).alias("mean"), _r("q50", 3).alias("median"), _r("std", 3).alias("std"),
        _r("min", 3).alias("min"), _r("max", 3).alias("max"), _half_up(F.col("q75") - F.col("q25"), 3).alias("IQR"))


def iqr_outliers(df: DataFrame, features: Sequence[str] = K.SENSORS) -> DataFrame:
    """Values outside quartiles -/+ 1.5 IQR: bounds, count, share. Counted on the value counts."""
    counts = value_counts(df, features)
    bounds = quantiles(counts, ["feature"], QUARTILES, _all_sensors(features)).select(
        "feature", F.col("count").alias("_total"),
        (F.col("q25") - 1.5 * (F.col("q75") - F.col("q25"))).alias("_lo"),
        (F.col("q75") + 1.5 * (F.col("q75") - F.col("q25"))).alias("_hi"))
    outside = (F.col("value") < F.col("_lo")) | (F.col("value") > F.col("_hi"))
    return counts.join(bounds, "feature").groupBy("feature").agg(
        _half_up(F.first("_lo")).alias("lower_bound"), _half_up(F.first("_hi")).alias("upper_bound"),
        F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("n_outliers_iqr"), F.first("_total").alias("_total"),
    ).withColumn("pct_outliers", percent("n_outliers_iqr", "_total")).drop("_total")


def histogram(counts: DataFrame, by: Sequence[str], bins: int = 40) -> DataFrame:
    """Equal-width bins between each group's minimum and maximum, last bin closed, empty bins kept."""
    by = list(by)
    ranges = counts.groupBy(*by).agg(
        F.min("value").alias("_min"), F.max("value").alias("_max"), F.sum("n").alias("_total"))
    flat = F.col("_min") == F.col("_max")
    ranges = ranges.select(
        *by, "_total",
        F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_lo"),
        F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("_hi"))
    width = F.col("_hi") - F.col("_lo")
    index = F.least(F.floor((F.col("value") - F.col("_lo")) * bins / width), F.lit(bins - 1)).cast("int")
    filled = counts.join(ranges, by).groupBy(*by, index.alias("bin")).agg(F.sum("n").alias("_n"))
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    rows = grid.join(filled, [*by, "bin"], "left").withColumn("n", F.coalesce("_n", F.lit(0)))
    return rows.select(
        *by, "bin",
        _half_up(F.col("_lo") + width * F.col("bin") / bins, 6).alias("bin_low"),
        _half_up(F.col("_lo") + width * (F.col("bin") + 1) / bins, 6).alias("bin_high"),
        "n",
        _r(F.col("n") * bins / (F.col("_total") * width), 9).alias("density"))


def sensor_histogram(df: DataFrame, features: Sequence[str] = K.SENSORS, bins: int = 40) -> DataFrame:
    return histogram(value_counts(df, features), ["feature"], bins)


def frequencies(clean: DataFrame, columns: Sequence[str] = ("type_code", TARGET, *K.MODES)) -> DataFrame:
    """Count and share of every value of the categorical columns.

    Rows are counted per combination of all the columns first; a combination is then unfolded.
    """
    combos = clean.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    counted = combos.select("_n", F.inline(pairs)).groupBy("column_name", "value").agg(F.sum("_n").alias("count"))
    total = F.sum("count").over(Window.partitionBy("column_name"))  # the few values of one column
    return counted.withColumn("pct", percent(F.col("count"), total))


def class_balance(clean: DataFrame) -> DataFrame:
    failures = F.count(F.when(F.col(TARGET) == 1, 1))
    one = clean.agg(F.count(F.lit(1)).alias("n_total"), failures.alias("n_failure"))
    one = one.withColumn("n_normal", F.col("n_total") - F.col("n_failure"))
    ratio = int_div(F.col("n_normal") * 20 + F.col("n_failure"), F.col("n_failure") * 2) / 10
    return one.select(
        "n_total", "n_normal", "n_failure",
        percent("n_normal", "n_total").alias("normal_pct"), percent("n_failure", "n_total").alias("failure_pct"),
        F.when(F.col("n_failure") != 0, ratio).alias("imbalance_ratio"))


def mode_summary(clean: DataFrame) -> DataFrame:
    """Flags per mode as a share of all rows and of failure rows."""
    return _stack(clean, [F.struct(
        F.lit(mode).alias("failure_mode_code"), F.sum(F.col(mode).cast("long")).alias("count"),
        percent(F.sum(mode), F.count(F.lit(1)), 3).alias("pct_of_all_rows"),
        percent(F.sum(mode), F.sum(TARGET)).alias("pct_of_failure_rows"),
    ) for mode in K.MODES]).orderBy(F.col("count").desc(), "failure_mode_code")


def five_numbers(df: DataFrame, features: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Minimum, quartiles and maximum of each feature for each value of each binary flag.

    Values are counted per combination of flags and only the counts are unfolded per flag.
    """
    counts = value_counts(df, features, keep=list(flags))
    pairs = F.array(*[F.struct(F.lit(f).alias("flag_name"), F.col(f).alias("flag")) for f in flags])
    unfolded = counts.select("feature", "value", "n", F.inline(pairs)).groupBy(
        "feature", "flag_name", "flag", "value").agg(F.sum("n").alias("n"))
    summary = quantiles(unfolded, ["feature", "flag_name", "flag"], QUARTILES, _all_sensors(features),
                        extra=[F.min("value").alias("min"), F.max("value").alias("max")])
    return summary.select("feature", "flag_name", "flag", "count",
                          *[_r(c).alias(c) for c in ("min", *QUARTILES, "max")])


def bucket_by_class(engineered: DataFrame) -> DataFrame:
    return engineered.groupBy("tool_wear_bucket", TARGET).agg(F.count(F.lit(1)).alias("n"))


def _exact(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def mann_whitney(df: DataFrame, features: Sequence[str], label: str = TARGET) -> DataFrame:
    """Two-sided Mann-Whitney U of normal against failed rows per feature, with medians.

    Rank sums come from running value counts as exact integers; the p-value uses the tie-corrected
    normal approximation with continuity correction.
    """
    normal, failed = F.col(label) == 0, F.col(label) == 1
    counts = long_values(df, features, keep=[label]).groupBy("feature", "value").agg(
        F.count(F.when(normal, 1)).alias("n0"), F.count(F.when(failed, 1)).alias("n1"))
    totals = counts.groupBy("feature").agg(F.sum("n0").alias("all0"), F.sum("n1").alias("all1"))
    running = cumulate(counts, ["feature"], "value", ["n0", "n1"], _all_sensors(features))
    running = running.join(totals, "feature")
    tied = _exact(F.col("n0") + F.col("n1"))
    before = _exact(F.col("cum_n0") + F.col("cum_n1")) - tied

    def median(cum: str, total: str) -> Column:
        low, high = F.floor((F.col(total) - 1) / 2), F.ceil((F.col(total) - 1) / 2)
        return (F.min(F.when(F.col(cum) > low, F.col("value"))) + F.min(F.when(F.col(cum) > high, F.col("value")))) / 2

    sums = running.groupBy("feature").agg(
        median("cum_n0", "all0").alias("median_normal"), median("cum_n1", "all1").alias("median_failure"),
        F.sum(_exact(F.col("n0")) * (before * 2 + tied + 1)).alias("_twice_ranks"),
        F.sum(tied * tied * tied - tied).cast("double").alias("_ties"),
        F.first("all0").alias("_n0"), F.first("all1").alias("_n1"))
    n0, n1 = F.col("_n0").cast("double"), F.col("_n1").cast("double")
    n = n0 + n1
    u = (F.col("_twice_ranks") - _exact(F.col("_n0")) * (_exact(F.col("_n0")) + 1)).cast("double") / 2
    tested = sums.withColumn("mannwhitney_U", u).withColumn(
        "_sd", F.sqrt(n0 * n1 / 12 * ((n + 1) - F.col("_ties") / (n * (n - 1)))))
    larger = F.greatest(F.col("mannwhitney_U"), n0 * n1 - F.col("mannwhitney_U"))
    z = F.try_divide(larger - n0 * n1 / 2 - 0.5, F.col("_sd"))
    tested = tested.withColumn("z", z).withColumn("p_value", F.when(z <= 0, 1.0).otherwise(two_sided_normal(z)))
    return tested.select(
        "feature", "median_normal", "median_failure", "mannwhitney_U", _r("z").alias("z"), "p_value",
        (F.col("p_value") < 0.05).cast("int").alias("significant_at_005"))


def crosstab(clean: DataFrame) -> DataFrame:
    """Normal and failed rows per type, row shares, failure rate."""
    counts = clean.groupBy("type_code").agg(
        F.count(F.when(F.col(TARGET) == 0, 1)).alias("normal"), F.count(F.when(F.col(TARGET) == 1, 1)).alias("failure"))
    total = F.col("normal") + F.col("failure")
    return counts.select(
        "type_code", "normal", "failure",
        percent(F.col("normal"), total, 4).alias("normal_pct"), percent(F.col("failure"), total, 4).alias("failure_pct"),
        percent(F.col("failure"), total).alias("failure_rate_pct"))


def chi_square(clean: DataFrame, row: str = "type_code") -> DataFrame:
    """Chi-square test of independence of ``row`` and the target; corrected for continuity at one dof."""
    counts = clean.groupBy(row).agg(
        F.count(F.when(F.col(TARGET) == 0, 1)).alias("_0"), F.count(F.when(F.col(TARGET) == 1, 1)).alias("_1"))
    table = counts.select(row, F.posexplode(F.array("_0", "_1")).alias("_class", "_o"))
    everything = Window.partitionBy()  # a contingency table
    table = table.withColumns({
        "_row": F.sum("_o").over(Window.partitionBy(row)),
        "_col": F.sum("_o").over(Window.partitionBy("_class")),
        "_all": F.sum("_o").over(everything),
        "_dof": F.size(F.collect_set(row).over(everything)) - 1,
    })
    expected = F.col("_row") * F.col("_col") / F.col("_all")
    gap = F.abs(F.col("_o") - expected)
    gap = F.when(F.col("_dof") == 1, gap - F.least(gap, F.lit(0.5))).otherwise(gap)
    result = table.agg(F.sum(gap * gap / expected).alias("chi2"), F.max("_dof").alias("dof"))
    result = result.withColumn("p_value", chi_square_tail(F.col("chi2"), F.col("dof")))
    return result.select(
        _r("chi2").alias("chi2"), "dof", _r("p_value", 9).alias("p_value"),
        (F.col("p_value") < 0.05).cast("int").alias("significant_at_005"))


def correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The Pearson matrix, every pair in one pass."""
    order = {f: i for i, f in enumerate(features)}
    pairs = [(a, b) for a in features for b in features if order[a] < order[b]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    cells = [F.struct(F.lit(a).alias("feature_1"), F.lit(b).alias("feature_2"),
                      (F.lit(1.0) if a == b else F.col("|".join(sorted((a, b), key=order.get)))).alias("r"))
             for a, b in product(features, features)]
    return one.select(F.inline(F.array(*cells))).withColumn("r", _r("r"))


def redundant_pairs(df: DataFrame, features: Sequence[str], limit: float = 0.85) -> DataFrame:
    order = F.create_map(*[x for i, f in enumerate(features) for x in (F.lit(f), F.lit(i))])
    upper = order[F.col("feature_1")] < order[F.col("feature_2")]
    return correlations(df, features).where(upper & (F.abs("r") > limit)).select(
        "feature_1", "feature_2", _r("r", 3).alias("correlation"))


def cohens_d(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Standardised mean difference of normal and failed rows, pooled sample deviation."""
    def one(feature):
        a = F.when(F.col(TARGET) == 0, F.col(feature).cast("double"))
        b = F.when(F.col(TARGET) == 1, F.col(feature).cast("double"))
        pooled = F.sqrt(((F.count(a) - 1) * F.var_samp(a) + (F.count(b) - 1) * F.var_samp(b))
                        / (F.count(a) + F.count(b) - 2))
        return F.struct(F.lit(feature).alias("feature"), F.try_divide(F.avg(a) - F.avg(b), pooled).alias("d"))
    return _stack(df, [one(f) for f in features]).select(
        "feature", _r("d", 3).alias("cohens_d"), _r(F.abs("d"), 3).alias("abs_effect_size"))


def rank_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features by absolute effect size, with their test result."""
    tests = mann_whitney(df, features).select("feature", "p_value", "significant_at_005")
    return cohens_d(df, features).join(tests, "feature").select(
        "feature", "p_value", "significant_at_005", "cohens_d", "abs_effect_size"
    ).orderBy(F.col("abs_effect_size").desc(), "feature")


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 40) -> DataFrame:
    """Row counts on a grid over two sensors, per class: what a scatter plot shows, at any size."""
    ranges = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).agg(
        F.struct(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")))
    held = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), TARGET).withColumn(
        "_r", ranges.scalar())
    def cell(value, low, high):
        return F.least(F.floor((F.col(value) - F.col(low)) * bins / (F.col(high) - F.col(low))),
                       F.lit(bins - 1)).cast("int")
    return held.groupBy(
        cell("_x", "_r.x0", "_r.x1").alias("x_bin"), cell("_y", "_r.y0", "_r.y1").alias("y_bin"), TARGET
    ).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(x).alias("x_column"), F.lit(y).alias("y_column"), "x_bin", "y_bin", TARGET, "n")
