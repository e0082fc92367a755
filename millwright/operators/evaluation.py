"""Evaluation of (score, label) rows: curves, areas, thresholds, sweeps, costs, reports.

Everything ordered by score starts from counts per distinct score, cut into blocks of scores, so
no task sorts the whole fleet. Grid sweeps count each row once in the grid cell of its score.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright import constants as K
from millwright.operators.exploration import histogram
from millwright.plans.ordering import cumulate

EPSILON = 1e-10


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def _confusion(score: str, label: str, threshold) -> list[Column]:
    flagged, positive = F.col(score) >= threshold, F.col(label) == 1
    def n(condition):
        return F.count(F.when(condition, 1))
    return [n(~flagged & ~positive).alias("tn"), n(flagged & ~positive).alias("fp"),
            n(~flagged & positive).alias("fn"), n(flagged & positive).alias("tp")]


def confusion_matrix(df: DataFrame, threshold: float = K.DECISION_THRESHOLD, score: str = "score",
                     label: str = "label") -> DataFrame:
    return df.agg(*_confusion(score, label, threshold))


def point_metrics(matrix: DataFrame, missing_fnr_is_zero: bool = False) -> DataFrame:
    """Precision, recall, F1 (0 when undefined) and the false-negative rate (NULL without positives)."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rate = F.when(fn + tp > 0, fn / (fn + tp))
    return matrix.withColumns({
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "false_negative_rate": F.coalesce(rate, F.lit(0.0)) if missing_fnr_is_zero else rate,
    })


def threshold_points(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row per distinct score taken as threshold: counts at it, tp and fp at or above it, totals."""
    per_score = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) != 1, 1)).alias("neg"))
    totals = per_score.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    running = cumulate(per_score, [], "threshold", ["pos", "neg"]).withColumn("_all", totals)
    return running.select(
        "threshold", "pos", "neg",
        (F.col("_all.p") - F.col("cum_pos") + F.col("pos")).alias("tp"),
        (F.col("_all.n") - F.col("cum_neg") + F.col("neg")).alias("fp"),
        F.col("_all.p").alias("positives"), F.col("_all.n").alias("negatives"))


def precision_recall(points: DataFrame) -> DataFrame:
    """Precision and recall per threshold, and the closing point (1, 0) without a threshold."""
    recall = F.when(F.col("positives") > 0, F.col("tp") / F.col("positives")).otherwise(F.lit(1.0))
    curve = points.select("threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                          recall.alias("recall"))
    # The closing point rides on a one-row aggregate of the same counts.
    closing = points.agg(F.count(F.lit(1)).alias("_n")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return curve.unionByName(closing)


def average_precision(points: DataFrame) -> DataFrame:
    """Sum of recall steps times precision."""
    step = _ratio(F.col("pos"), F.col("positives")) * F.col("tp") / (F.col("tp") + F.col("fp"))
    return points.agg(F.sum(step).alias("average_precision"))


def pr_auc_trapezoid(points: DataFrame) -> DataFrame:
    """Area under the linearly joined precision-recall points; the previous point is this one less its own counts."""
    tp_before, n_before = F.col("tp") - F.col("pos"), F.col("tp") + F.col("fp") - F.col("pos") - F.col("neg")
    before = F.when(n_before > 0, tp_before / n_before).otherwise(F.lit(1.0))
    height = (F.col("tp") / (F.col("tp") + F.col("fp")) + before) / 2
    return points.agg(F.sum(_ratio(F.col("pos"), F.col("positives")) * height).alias("pr_auc_trapezoid"))


def roc_auc(points: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, ties counting half; exact integers until the end."""
    def wide(column):
        return column.cast("decimal(20,0)")
    twice = wide(F.col("neg")) * (wide(F.col("tp") - F.col("pos")) * 2 + wide(F.col("pos")))
    pairs = F.first("positives").cast("double") * F.first("negatives").cast("double")
    return points.agg(F.try_divide(F.sum(twice).cast("double") / 2, pairs).alias("roc_auc"))


def threshold_for_precision(points: DataFrame, min_precision: float = 0.30) -> DataFrame:
    """The threshold of greatest recall with enough precision; recall falls with the threshold, so the lowest."""
    enough = F.col("tp") / (F.col("tp") + F.col("fp")) >= min_precision
    best = points.where(enough).agg(F.min_by(F.struct("threshold", "tp", "fp", "positives"), "threshold").alias("_b"))
    return best.select(
        F.col("_b.threshold").alias("threshold"),
        (F.col("_b.tp") / (F.col("_b.tp") + F.col("_b.fp"))).alias("precision"),
        _ratio(F.col("_b.tp"), F.col("_b.positives")).alias("recall"))


def f1_threshold(points: DataFrame) -> DataFrame:
    """The threshold of greatest F1, lowest on ties."""
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    recall = _ratio(F.col("tp"), F.col("positives"))
    scored = points.select("threshold", precision.alias("precision"), recall.alias("recall")).withColumn(
        "f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + EPSILON))
    best = scored.agg(F.max_by(F.struct("threshold", "precision", "recall", "f1"),
                               F.struct("f1", -F.col("threshold"))).alias("_b"))
    return best.select("_b.*")


def grid(n: int, low: float = 0.01, high: float = 0.99) -> list[float]:
    """``n`` evenly spaced thresholds, ends included."""
    step = (high - low) / (n - 1)
    return [low + i * step for i in range(n - 1)] + [high]


def grid_counts(df: DataFrame, thresholds: Sequence[float], score: str = "score", label: str = "label") -> DataFrame:
    """tp, fp, fn, tn at each threshold of an even ascending grid.

    A row is counted in one cell, found by arithmetic and corrected by a comparison with the
    neighbouring grid values; cells are then summed from above.
    """
    n, low = len(thresholds), thresholds[0]
    step = (thresholds[-1] - low) / (n - 1)
    values = F.array(*[F.lit(t) for t in thresholds])
    guess = F.least(F.greatest(F.floor((F.col(score) - low) / step).cast("int"), F.lit(0)), F.lit(n - 1))
    located = df.select(F.col(score), F.col(label), guess.alias("_g"), values.alias("_t"))
    here = F.get("_t", F.col("_g"))
    above = F.get("_t", F.col("_g") + 1)
    passed = F.when(F.col(score) < here, F.col("_g")).when(
        above.isNotNull() & (F.col(score) >= above), F.col("_g") + 2).otherwise(F.col("_g") + 1)
    cells = located.groupBy(passed.alias("_passed")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) != 1, 1)).alias("neg"))
    # At most n + 1 cells: for each threshold i (0-based) the flagged rows are those that passed more than i.
    spread = cells.select("pos", "neg", "_passed", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    flagged = F.col("_passed") > F.col("i")
    def total(condition, name):
        return F.coalesce(F.sum(F.when(condition, F.col(name))), F.lit(0))
    summed = spread.groupBy("i").agg(total(flagged, "pos").alias("tp"), total(flagged, "neg").alias("fp"),
                                     total(~flagged, "pos").alias("fn"), total(~flagged, "neg").alias("tn"))
    return summed.withColumn("threshold", F.get(values, F.col("i"))).drop("i")


def threshold_sweep(df: DataFrame, n: int = 100) -> DataFrame:
    """Precision, recall and F1 at ``n`` thresholds from 0.01 to 0.99."""
    counts = grid_counts(df, grid(n))
    rated = counts.withColumns({
        "precision": F.col("tp") / (F.col("tp") + F.col("fp") + EPSILON),
        "recall": F.col("tp") / (F.col("tp") + F.col("fn") + EPSILON),
    })
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + EPSILON)
    return rated.withColumn("f1", f1).select("threshold", "precision", "recall", "f1")


def cost_sweep(df: DataFrame, n: int = 99, false_alarm: int = K.FALSE_ALARM_COST,
               missed: int = K.MISSED_FAILURE_COST) -> DataFrame:
    counts = grid_counts(df, grid(n))
    return counts.select("threshold", "fp", "fn", (F.col("fp") * false_alarm + F.col("fn") * missed).alias("cost"))


def cheapest_threshold(sweep: DataFrame) -> DataFrame:
    """The threshold of least cost, lowest on ties."""
    return sweep.agg(F.min_by(F.struct("threshold", "cost"), F.struct("cost", "threshold")).alias("_b")).select("_b.*")


def policy_costs(df: DataFrame, threshold: float = K.DECISION_THRESHOLD, inspection: int = K.INSPECTION_COST,
                 failure: int = K.FAILURE_COST) -> DataFrame:
    """Cost of repairing after failures against inspecting flagged machines."""
    counts = confusion_matrix(df, threshold)
    reactive = (F.col("tp") + F.col("fn")) * failure
    predictive = (F.col("tp") + F.col("fp")) * inspection + F.col("fn") * failure
    return counts.select(reactive.alias("reactive_cost"), predictive.alias("predictive_cost"),
                         (reactive - predictive).alias("savings"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages."""
    pairs = df.groupBy(F.col(label).cast("string").alias("_l"), F.col(prediction).cast("string").alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"))
    hit = F.when(F.col("_l") == F.col("_p"), F.col("_n")).otherwise(0)
    sides = pairs.select(F.inline(F.array(
        F.struct(F.col("_l").alias("class"), F.col("_n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 hit.cast("long").alias("hits")),
        F.struct(F.col("_p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("_n").alias("predicted"),
                 F.lit(0).cast("long").alias("hits")))))
    classes = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    classes = classes.select(
        "class", _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"), "support", "hits")
    def average(name, weight):
        return F.sum(F.col(name) * weight) / F.sum(weight)
    kinds = []
    for kind, weight in (("macro avg", F.lit(1)), ("weighted avg", F.col("support"))):
        kinds.append(F.struct(F.lit(kind).alias("class"), average("precision", weight).alias("precision"),
                              average("recall", weight).alias("recall"), average("f1", weight).alias("f1"),
                              F.sum("support").alias("support")))
    accuracy = F.sum("hits") / F.sum("support")
    kinds.append(F.struct(F.lit("accuracy").alias("class"), accuracy.alias("precision"), accuracy.alias("recall"),
                          accuracy.alias("f1"), F.sum("support").alias("support")))
    overall = classes.agg(*[k.alias(f"_{i}") for i, k in enumerate(kinds)]).select(
        F.inline(F.array(*[F.col(f"_{i}") for i in range(len(kinds))])))
    return classes.drop("hits").unionByName(overall)


def class_separation(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Mean score of each class and their ratio."""
    means = df.agg(F.avg(F.when(F.col(label) == 0, F.col(score))).alias("mean_normal"),
                   F.avg(F.when(F.col(label) == 1, F.col(score))).alias("mean_failure"))
    return means.withColumn("separation", F.try_divide("mean_failure", "mean_normal"))


def score_histogram(df: DataFrame, bins: int = 40, score: str = "score", label: str = "label") -> DataFrame:
    """Density of scores per class, bins over each class's own range."""
    counts = df.groupBy(F.col(label).alias("label"), F.col(score).cast("double").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    return histogram(counts, ["label"], bins)


def metrics_row(df: DataFrame, model: str, split: str, threshold: float = K.DECISION_THRESHOLD) -> DataFrame:
    """One comparison row; always says which split it was measured on."""
    points = threshold_points(df)
    matrix = point_metrics(confusion_matrix(df, threshold))
    return matrix.select(
        F.lit(model).alias("model"), F.lit(split).alias("split"), F.lit(float(threshold)).alias("threshold"),
        "precision", "recall", "f1",
        average_precision(points).scalar().alias("pr_auc"),
        pr_auc_trapezoid(points).scalar().alias("pr_auc_trapezoid"),
        roc_auc(points).scalar().alias("roc_auc"),
        "false_negative_rate", "tn", "fp", "fn", "tp")


def compare_models(rows: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows).orderBy(F.col("pr_auc").desc_nulls_last(), "model")


def ranked_within(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows per group with their rank; each task drops all but its own ``k`` before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
