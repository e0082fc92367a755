"""Scoring, status bands, dashboard tables, lookups and rule diagnosis."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright import constants as K
from millwright.functions import columns as C
from millwright.operators.quality import require_columns, split_rejects
from millwright.sources.schemas import DOMAIN_RULES, RANGE_RULES, Rule

#: Nodes of a tree that is scored as an expression.
TREE_NODES = 127
# Physical limits a sensor cannot leave; scoring sends such rows to the reject output.
PLAUSIBLE_RULES = [
    Rule("air temperature plausible", "air_temperature_k BETWEEN 200 AND 500"),
    Rule("process temperature plausible", "process_temperature_k BETWEEN 200 AND 500"),
]


def _present(df: DataFrame, *names: str) -> Column | None:
    for name in names:
        if name in df.columns:
            return F.col(f"`{name}`")
    return None


def rule_probability(df: DataFrame) -> Column:
    """The rule score under either header; absent sensors count with their defaults."""
    return C.rule_score(_present(df, "Tool wear [min]", "tool_wear_min"), _present(df, "Torque [Nm]", "torque_nm"))


def with_rule_score(df: DataFrame, threshold: float = K.DECISION_THRESHOLD) -> DataFrame:
    scored = df.withColumn("failure_probability", rule_probability(df))
    return scored.withColumn("predicted_failure", C.at_least("failure_probability", threshold))


def tree_probability(tree: DecisionTreeClassificationModel, columns: Sequence[str]) -> Column | None:
    """The tree's probability of the positive class from its feature columns, as a case expression.

    A missing value goes right, as what is no number does in the model. None for a tree that splits categories.
    """
    def below(node) -> Column | None:
        if node.getClass().getSimpleName() == "LeafNode":
            counts = list(node.impurityStats().stats())
            return F.lit(counts[1] / sum(counts) if sum(counts) else counts[1])
        split = node.split()
        left, right = below(node.leftChild()), below(node.rightChild())
        if split.getClass().getSimpleName() != "ContinuousSplit" or left is None or right is None:
            return None
        return F.when(F.col(columns[split.featureIndex()]).cast("double") <= F.lit(split.threshold()), left).otherwise(right)

    return below(tree._java_obj.rootNode())


def flat_stages(model) -> list:
    """The stages of a fitted pipeline, those of pipelines inside it too."""
    return [inner for stage in model.stages for inner in flat_stages(stage)] if isinstance(model, PipelineModel) else [model]


class Scorer:
    """A fitted pipeline's probability of the positive class, for many scores of each row.

    A small decision tree over assembled columns is scored by an expression; no vector is made.
    """

    def __init__(self, model: PipelineModel):
        self.model, self.tree = model, None
        *self.before, assembler, tree = [None, *flat_stages(model)]
        if (isinstance(tree, DecisionTreeClassificationModel) and tree.numClasses == 2 and tree.numNodes <= TREE_NODES
                and isinstance(assembler, VectorAssembler) and assembler.getHandleInvalid() == "keep"
                and assembler.getOutputCol() == tree.getFeaturesCol() and len(assembler.getInputCols()) == tree.numFeatures):
            self.tree = tree_probability(tree, assembler.getInputCols())

    def with_score(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with ``name``; other columns may be changed or added."""
        if self.tree is None:
            return self.model.transform(df).withColumn(name, vector_to_array("probability")[1])
        for stage in self.before[1:]:
            df = stage.transform(df)
        return df.withColumn(name, self.tree)


def scored_beside(df: DataFrame, model, replaced: Mapping[str, Column], name: str) -> DataFrame:
    """``df`` with the model's probability as ``name``, were its columns ``replaced``; a projection, rows stay where they are.

    ``model`` is a fitted pipeline, or its ``Scorer`` where it scores several times.
    """
    scorer = model if isinstance(model, Scorer) else Scorer(model)
    # the model scales sensors in place, so every column is kept beside it
    held = df.withColumns({f"_own_{c}": F.col(c) for c in df.columns})
    held = held.withColumns(dict(replaced)) if replaced else held
    scored = scorer.with_score(held, name)
    return scored.select(*[F.col(f"_own_{c}").alias(c) for c in df.columns], name)


def score_raw(raw: DataFrame, model=None, threshold: float = K.DECISION_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Score rows under the raw header: (scored rows, rejected rows with their reasons).

    ``model`` is a fitted pipeline that takes table column names and adds ``probability``; without
    one the rule score is used. Rows keep all their input columns.
    """
    require_columns(raw, K.SCORING_COLUMNS)
    clean = raw.withColumnsRenamed(K.RAW_TO_CLEAN)
    good, rejected = split_rejects(clean, [DOMAIN_RULES[0], *RANGE_RULES, *PLAUSIBLE_RULES])
    if model is None:
        scored = with_rule_score(good, threshold)
    else:
        scored = scored_beside(good, model, {}, "failure_probability").withColumn(
            "predicted_failure", C.at_least("failure_probability", threshold))
    return scored.withColumnsRenamed(K.CLEAN_TO_RAW), rejected.withColumnsRenamed(K.CLEAN_TO_RAW)


def all_scored(raw: DataFrame, model=None, threshold: float = K.DECISION_THRESHOLD) -> DataFrame:
    """Every input row: scored, or without a score and with the rules it breaks in ``rejected_for``."""
    scored, rejected = score_raw(raw, model, threshold)
    told = rejected.withColumn("rejected_for", F.array_join("broken_rules", "; ")).drop("broken_rules")
    return scored.unionByName(told, allowMissingColumns=True)


def fleet_status(clean: DataFrame) -> DataFrame:
    """Every machine with its risk and status band."""
    risk = clean.withColumn("failure_risk", rule_probability(clean))
    return risk.withColumn("status", C.status_band("failure_risk")).select(
        "machine_id", "failure_risk", "status", *K.SENSORS)


def fleet_kpis(status: DataFrame) -> DataFrame:
    """Machines, machines at high risk, mean risk in percent."""
    return status.agg(
        F.count(F.lit(1)).alias("total_machines"),
        F.count(F.when(F.col("status") == K.HIGH_RISK, 1)).alias("machines_at_risk"),
        C.exact_mean("failure_risk", 6, 100).alias("average_risk_pct"))


def anomaly_kpis(scored: DataFrame) -> DataFrame:
    """Flagged machines and the mean probability in percent."""
    return scored.agg(
        F.count(F.when(F.col("is_anomaly"), 1)).alias("flagged_as_anomaly"),
        C.exact_mean("mlp_probability", 6, 100).alias("average_probability_pct"))


def worklist(df: DataFrame, by: str, limit: int | None = None, uid: str = "machine_id") -> DataFrame:
    """Rows by descending risk; with ``limit`` only the head, which needs no global sort."""
    ordered = df.orderBy(F.col(by).desc(), uid)
    return ordered if limit is None else ordered.limit(limit)


def squared_errors(columns: Sequence[str], rebuilt: Sequence[str], weights: Sequence[float] | None = None) -> Column:
    """Mean (weighted) squared difference of two column lists."""
    weights = weights or [1.0] * len(columns)
    total = F.lit(0.0)
    for column, other, weight in zip(columns, rebuilt, weights):
        gap = F.col(column) - F.col(other)
        total = total + gap * gap * float(weight)
    return total / len(columns)


def tail_weights(n: int, boosted: int = 3, weight: float = 4.0) -> list[float]:
    """Weights 1 with the last ``boosted`` columns raised."""
    return [1.0] * (n - boosted) + [weight] * boosted


def flag_anomalies(df: DataFrame, threshold: float = K.ANOMALY_THRESHOLD) -> DataFrame:
    return df.withColumn("is_anomaly", F.col("anomaly_score") >= threshold)


def telemetry(status: DataFrame) -> DataFrame:
    """Machine rows as JSON text with the risk as a percentage."""
    body = F.struct("machine_id", *K.SENSORS, C.percent_text(F.col("failure_risk")).alias("Predicted_Failure_Risk"))
    return status.select("machine_id", F.to_json(body).alias("telemetry"))


def lookup_telemetry(status: DataFrame, wanted: DataFrame) -> DataFrame:
    """JSON per wanted machine id, with a message for unknown ids."""
    found = wanted.select("machine_id").join(telemetry(status), "machine_id", "left")
    missing = F.concat(F.lit(K.TELEMETRY_MISSING), F.col("machine_id").cast("string"), F.lit("."))
    return found.withColumn("telemetry", F.coalesce("telemetry", missing))


@dataclass(frozen=True)
class DiagnosisRule:
    """A condition on the feature columns, and the question that finds its protocol."""

    code: str
    condition: str
    question: str = ""


@dataclass(frozen=True)
class DiagnosisLimits:
    heat_gap_k: float = 8.6
    heat_speed_rpm: int = 1380
    power_low_w: float = 3500.0
    power_high_w: float = 9000.0
    strain_low: float = 11000.0
    strain_medium: float = 12000.0
    strain_high: float = 13000.0
    wear_window_min: int = 200
    wear_window_max: int = 240
    wear_warning: int = 200


def diagnosis_rules(limits: DiagnosisLimits = DiagnosisLimits()) -> list[DiagnosisRule]:
    strain = (f"CASE type_code WHEN 'L' THEN {limits.strain_low}D WHEN 'M' THEN {limits.strain_medium}D "
              f"ELSE {limits.strain_high}D END")
    return [
        DiagnosisRule("HDF", f"temp_diff_K < {limits.heat_gap_k}D AND rotational_speed_rpm < {limits.heat_speed_rpm}",
                      "heat does not leave the process: the air is as hot as the process and the speed is low"),
        DiagnosisRule("PWF", f"power_W < {limits.power_low_w}D OR power_W > {limits.power_high_w}D",
                      "the power of the tool is too low or too high for the work"),
        DiagnosisRule("OSF", f"torque_x_toolwear > {strain}", "strain: a worn tool at too high a torque for this type of machine"),
        DiagnosisRule("TWF", f"tool_wear_min BETWEEN {limits.wear_window_min} AND {limits.wear_window_max}",
                      "the tool is in the window of wear in which it fails and is to be replaced"),
        DiagnosisRule("WEAR", f"tool_wear_min > {limits.wear_warning}", "wear of the tool is over the limit, plan to change it soon"),
    ]


def diagnose(engineered: DataFrame, rules: Sequence[DiagnosisRule] | None = None) -> DataFrame:
    """One row per machine and rule it meets, found in one pass over the machines."""
    rules = diagnosis_rules() if rules is None else rules
    hits = F.array_compact(F.array(*[
        F.when(F.expr(rule.condition), F.struct(F.lit(i).alias("rule_order"), F.lit(rule.code).alias("diagnosis")))
        for i, rule in enumerate(rules)
    ]))
    return engineered.select("machine_id", F.inline(hits))


def rules_met(rules: Sequence[DiagnosisRule] | None = None) -> Column:
    """The numbers of the rules a row of features meets, in their order."""
    rules = diagnosis_rules() if rules is None else rules
    return F.array_compact(F.array(*[F.when(F.expr(rule.condition), F.lit(i)) for i, rule in enumerate(rules)]))


def with_protocols(diagnoses: DataFrame, protocols: DataFrame) -> DataFrame:
    """Diagnoses with the text of their rule from the rows (rule_order, protocol) of a table; null where it has none."""
    return diagnoses.join(protocols.select("rule_order", "protocol"), "rule_order", "left").select(
        "machine_id", "rule_order", "diagnosis", "protocol")
