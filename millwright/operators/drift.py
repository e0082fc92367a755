"""Distribution drift, simulated sensor degradation, occlusion attribution."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright import constants as K
from millwright.functions import columns as C
from millwright.functions.columns import rule_score
from millwright.functions.significance import kolmogorov_tail
from millwright.operators.scoring import Scorer as ModelScorer
from millwright.operators.scoring import scored_beside
from millwright.plans.ordering import cumulate
from millwright.session import stage
from millwright.plans.quantiles import long_values

Scorer = Callable[[Mapping[str, Column]], Column]


def rule_scorer(inputs: Mapping[str, Column]) -> Column:
    return rule_score(inputs["tool_wear_min"], inputs["torque_nm"])


def ks_drift(df: DataFrame, features: Sequence[str], period: str, old: str, new: str, alpha: float = 0.05) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per feature between two periods, exact, with limiting p-value."""
    rows = long_values(df.where(F.col(period).isin(old, new)), features, keep=[period])
    counts = stage(rows.groupBy("feature", "value").agg(
        F.count(F.when(F.col(period) == old, 1)).alias("old"), F.count(F.when(F.col(period) == new, 1)).alias("new")), "drift-counts")
    totals = counts.groupBy("feature").agg(F.sum("old").alias("n_old"), F.sum("new").alias("n_new"))
    running = cumulate(counts, ["feature"], "value", ["old", "new"]).join(totals, "feature")
    def wide(name):
        return F.col(name).cast("decimal(19,0)")
    gap = F.abs(wide("cum_old") * wide("n_new") - wide("cum_new") * wide("n_old"))
    widest = running.groupBy("feature").agg(
        F.max(gap).cast("double").alias("_gap"), F.first("n_old").alias("n_old"), F.first("n_new").alias("n_new"))
    distance = F.try_divide("_gap", F.col("n_old").cast("double") * F.col("n_new").cast("double"))
    tested = widest.withColumn("statistic", distance).withColumn(
        "p_value", kolmogorov_tail(F.col("statistic"), F.col("n_old"), F.col("n_new")))
    return tested.select("feature", "n_old", "n_new", "statistic", "p_value",
                         F.when(F.col("p_value") < alpha, "DRIFT").otherwise("ok").alias("flag"))


def _uniform(digest: Column, start: int) -> Column:
    """A number in [0, 1) from twelve hex digits."""
    return F.conv(F.substring(digest, start, 12), 16, 10).cast("long") / float(1 << 48)


def hashed_normal(uid: str, step: int, seed: int) -> Column:
    """A standard normal draw that depends on the row id, the step and the seed only."""
    digest = F.md5(F.concat(F.col(uid).cast("string"), F.lit(f"|{step}|{seed}")))
    radius = F.sqrt(-2.0 * F.ln(1.0 - _uniform(digest, 1)))
    return radius * F.cos(2.0 * pi * _uniform(digest, 13))


def drifted_sensors(step: int, seed: int = K.SEED, heat_per_step: float = 3.5, noise_per_step: float = 2.0) -> dict[str, Column]:
    """Raw sensors as they read after drifting for ``step`` steps."""
    if step == 0:
        return {}
    return {
        "air_temperature_k": F.col("air_temperature_k") + heat_per_step * step,
        "torque_nm": F.col("torque_nm") + hashed_normal("machine_id", step, seed) * (noise_per_step * step),
    }


def degradation_risk(clean: DataFrame, steps: Sequence[int] = (0, 1, 2, 3, 4), seed: int = K.SEED,
                     scorer: Scorer = rule_scorer, heat_per_step: float = 3.5, noise_per_step: float = 2.0) -> DataFrame:
    """Mean risk per degradation step, all steps in one pass over the fleet."""
    averages = []
    for step in steps:
        inputs = {**{name: F.col(name) for name in K.SENSORS}, **drifted_sensors(step, seed, heat_per_step, noise_per_step)}
        averages.append(F.struct(F.lit(step).alias("step"), C.exact_mean(scorer(inputs), 9).alias("mean_risk")).alias(f"_{step}"))
    return clean.agg(*averages).select(F.inline(F.array(*[F.col(f"_{s}") for s in steps])))


def model_degradation_risk(clean: DataFrame, model, steps: Sequence[int] = (0, 1, 2, 3, 4), seed: int = K.SEED) -> DataFrame:
    """The same with a fitted pipeline as scorer; features are derived from the drifted raw sensors, all steps in one pass.

    A row is repeated inside its task, once per step, so that its score is compiled once and not once per step.
    """
    drifted = [drifted_sensors(step, seed) for step in steps]
    moved = sorted({name for sensors in drifted for name in sensors})
    readings = [F.struct(F.lit(i).alias("_step"), *[sensors.get(n, F.col(n)).cast("double").alias(n) for n in moved]) for i, sensors in enumerate(drifted)]
    repeated = clean.withColumn("_at", F.explode(F.array(*readings))).withColumns({n: F.col(f"_at.{n}") for n in [*moved, "_step"]}).drop("_at")
    scored = scored_beside(repeated, model, {}, "_risk")
    averages = [F.struct(F.lit(s).alias("step"), C.exact_mean(F.when(F.col("_step") == i, F.col("_risk")), 9).alias("mean_risk")).alias(f"_{i}")
                for i, s in enumerate(steps)]
    return scored.agg(*averages).select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(steps))])))


def reference_means(train: DataFrame, features: Sequence[str] = K.SENSORS) -> DataFrame:
    return train.agg(*[F.avg(f).alias(f) for f in features])


def attributions(df: DataFrame, means: DataFrame, features: Sequence[str] = K.SENSORS, top: int = 5,
                 scorer: Scorer = rule_scorer, uid: str = "machine_id") -> DataFrame:
    """Signed contribution of each feature: the score less the score with that feature at its mean.

    Features are ranked inside the row, so no shuffle is needed at any fleet size.
    """
    held = df.withColumn("_m", means.select(F.struct(*features)).scalar())
    inputs = {f: F.col(f) for f in features}
    base = scorer(inputs)
    parts = [
        F.struct(
            F.round(base - scorer({**inputs, f: F.col(f"_m.{f}")}), 9).alias("contribution"),
            F.lit(i).alias("place"), F.lit(f).alias("feature"))
        for i, f in enumerate(features)
    ]
    weight = F.struct  # order: larger effect first, then the fixed feature order
    ordered = F.array_sort(F.transform(F.array(*parts), lambda p: weight(
        (-F.abs(p["contribution"])).alias("key"), p["place"].alias("place"), p["feature"].alias("feature"),
        p["contribution"].alias("contribution"))))
    spread = held.select(uid, F.posexplode(F.slice(ordered, 1, top)).alias("_rank", "_p"))
    return spread.select(uid, (F.col("_rank") + 1).alias("rank"), "_p.feature", "_p.contribution")


def model_attributions(df: DataFrame, model, means: Mapping[str, float], top: int = 5, uid: str = "machine_id") -> DataFrame:
    """Occlusion attribution through a fitted pipeline: beside its own score a row gets one per sensor held at its mean.

    All scores of a row are made in the row, so nothing is shuffled.
    """
    names = list(means)
    scorer = ModelScorer(model)
    scored = scored_beside(df, scorer, {}, "_base")
    for name in names:
        scored = scored_beside(scored, scorer, {name: F.lit(float(means[name]))}, f"_without_{name}")
    gap = {n: F.round(F.col("_base") - F.col(f"_without_{n}"), 9) for n in names}
    parts = F.array_sort(F.array(*[
        F.struct((-F.abs(gap[n])).alias("key"), F.lit(i).alias("place"), F.lit(n).alias("feature"), gap[n].alias("contribution")) for i, n in enumerate(names)]))
    spread = scored.select(uid, F.posexplode(F.slice(parts, 1, top)).alias("_rank", "_p"))
    return spread.select(uid, (F.col("_rank") + 1).alias("rank"), "_p.feature", "_p.contribution")


def global_attribution(local: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature."""
    return local.groupBy("feature").agg(C.exact_mean(F.abs("contribution"), 9).alias("mean_abs_contribution")).orderBy(
        F.col("mean_abs_contribution").desc(), "feature")
