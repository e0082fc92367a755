"""Training, tuning and anomaly models as Spark ML jobs over the feature table.

Anything that several fits read is staged once under the shared folder, so a lost executor costs a
re-read and not a recomputation. Forests keep each row's place in each tree between levels instead of walking all
trees from their roots at every level; the trees are the same.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.feature import PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright import constants as K
from millwright.functions import columns as C
from millwright.operators import evaluation as I
from millwright.operators.features import FEATURE_COLUMNS, split_fleet
from millwright.operators.forest_search import SearchResult, search
from millwright.operators.forests import BoundedForest
from millwright.operators.transformers import GroupedZScorer, PopulationScaler, SensorFeatures
from millwright.plans.split import folds
from millwright.session import stage

LABEL = "machine_failure"


def preparation() -> list:
    """Stages from table columns to the ordered 14-feature vector."""
    return [
        SensorFeatures(),
        GroupedZScorer(),
        PopulationScaler(),
        VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features", handleInvalid="keep"),
    ]


def feature_pipeline(train: DataFrame) -> PipelineModel:
    """Fitted on the training rows only."""
    return Pipeline(stages=preparation()).fit(train)


def training_set(clean: DataFrame, seed: int = K.SEED) -> tuple[PipelineModel, dict[str, DataFrame]]:
    """Split, fit the preparation on the training part, and stage each part's vectors.

    Iterative learners read the staged files once per pass; parts of few files are spread over the
    session's tasks.
    """
    parts = stage(split_fleet(clean, seed), "split")
    fitted = feature_pipeline(parts.where("split = 'train'"))
    keep = ["machine_id", "split", "features", LABEL, *FEATURE_COLUMNS]
    ready = stage(fitted.transform(parts).select(*keep), "vectors")
    return fitted, {name: spread(ready.where(F.col("split") == name)) for name in ("train", "val", "test")}


def spread(df: DataFrame) -> DataFrame:
    """Enough partitions to use every core; large inputs already have them and are left alone."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def logistic_baseline(max_iter: int = 1000) -> LogisticRegression:
    return LogisticRegression(labelCol=LABEL, maxIter=max_iter)


def decision_tree(depth: int = 5) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=LABEL, maxDepth=depth, seed=K.SEED)


def random_forest(trees: int = 300, depth: int = 8, weight: str | None = None) -> BoundedForest:
    forest = BoundedForest(labelCol=LABEL, numTrees=trees, maxDepth=depth, seed=K.SEED, cacheNodeIds=True)
    return forest.setWeightCol(weight) if weight else forest


def boosted_trees(rounds: int = 300, depth: int = 5, rate: float = 0.1, weight: str | None = None) -> GBTClassifier:
    boosted = GBTClassifier(labelCol=LABEL, maxIter=rounds, maxDepth=depth, stepSize=rate, seed=K.SEED)
    return boosted.setWeightCol(weight) if weight else boosted


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Per class: rows, balanced weight n / (k * n_c), and the negative-to-positive ratio."""
    name = F.col(label).cast("string")
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.struct(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
        F.sum(F.when(name == "0", F.col("n"))).alias("neg"), F.sum(F.when(name == "1", F.col("n"))).alias("pos"),
    )).scalar()
    held = counts.withColumn("_w", whole)
    positive = F.when(name == "1", F.try_divide(F.col("_w.neg"), F.col("_w.pos"))).otherwise(F.lit(1.0))
    return held.select(label, "n", (F.col("_w.n") / (F.col("_w.k") * F.col("n"))).alias("balanced_weight"),
                       positive.alias("positive_weight"))


def with_weights(df: DataFrame, label: str = LABEL, column: str = "weight") -> DataFrame:
    """Balanced weights on every row that has a label. Rows stay in their tasks: dealt by label they would fill as many as there are classes."""
    weights = class_weights(df, label).select(label, F.col("balanced_weight").alias(column))
    return df.join(F.broadcast(weights), label)  # one row per class


def oversample(df: DataFrame, uid: str = "machine_id", label: str = LABEL) -> DataFrame:
    """Positives repeated so that both classes weigh the same, for learners without row weights."""
    ratio = class_weights(df, label).where(F.col(label) == 1).select(F.round("positive_weight").cast("int")).scalar()
    copies = F.when(F.col(label) == 1, F.greatest(ratio, F.lit(1))).otherwise(F.lit(1))
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def perceptron(layers: Sequence[int] = (64, 32), max_iter: int = 120) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(labelCol=LABEL, layers=[len(FEATURE_COLUMNS), *layers, 2], maxIter=max_iter,
                                          seed=K.SEED)


def probability(scored: DataFrame) -> DataFrame:
    """(score, label) rows of a scored frame."""
    return scored.select(vector_to_array("probability")[1].alias("score"), F.col(LABEL).alias("label"))


def train_and_evaluate(model: Estimator | Model, train: DataFrame, held_out: DataFrame, name: str, split: str = "val",
                       threshold: float = K.DECISION_THRESHOLD, already_fitted: bool = False) -> tuple[Model, DataFrame]:
    """Fit unless already fitted, score the held-out rows, return the model and its metrics row."""
    fitted = model if already_fitted else model.fit(train)
    return fitted, I.metrics_row(probability(fitted.transform(held_out)), name, split, threshold)


# The search space of the forest, in the published order.
SEARCH_SPACE = {
    "numTrees": [200, 300, 400, 500, 700],
    "maxDepth": [4, 6, 8, 10, 12, 30],
    "minInstancesPerNode": [1, 2, 4],
    "featureSubsetStrategy": ["sqrt", "log2", "all"],
}


def draw_parameters(space: Mapping[str, Sequence], draws: int = 40, seed: int = K.SEED) -> list[dict]:
    """Distinct random combinations; the same for the same seed."""
    total = 1
    for values in space.values():
        total *= len(values)
    chosen = random.Random(seed).sample(range(total), min(draws, total))
    out = []
    for number in chosen:
        combination = {}
        for name, values in space.items():
            number, place = divmod(number, len(values))
            combination[name] = values[place]
        out.append(combination)
    return out


def random_search(train: DataFrame, space: Mapping[str, Sequence] = SEARCH_SPACE, draws: int = 40, k: int = 5,
                  parallelism: int = 4, seed: int = K.SEED) -> SearchResult:
    """Random search of the forest by cross-validated average precision on the training rows."""
    def forest(**params) -> BoundedForest:
        return BoundedForest(labelCol=LABEL, seed=seed, cacheNodeIds=True, **params)

    return search(folds(train, "machine_id", LABEL, seed, k), forest, draw_parameters(space, draws, seed), k, LABEL, parallelism)


def tuned_forest(searched: SearchResult) -> BoundedForest:
    """A forest with the parameters that scored best."""
    return BoundedForest(labelCol=LABEL, seed=K.SEED, cacheNodeIds=True, **searched.best)


def side_by_side(models: Sequence[Model], df: DataFrame) -> DataFrame:
    """The label and one score column per model, from one pass over the rows."""
    out = df.select("features", LABEL)
    for place, model in enumerate(models):
        scored = model.transform(out).withColumn(f"score_{place}", vector_to_array("probability")[1])
        out = scored.select("features", LABEL, *[f"score_{i}" for i in range(place + 1)])
    return stage(out.drop("features").withColumnRenamed(LABEL, "label"), "scores")


def mode_classifier(trees: int = 200, depth: int = 12) -> Pipeline:
    """Failure-mode forest on the raw sensors, classes balanced by weight."""
    return Pipeline(stages=[
        StringIndexer(inputCol="failure_mode", outputCol="mode_index", stringOrderType="alphabetAsc", handleInvalid="keep"),
        VectorAssembler(inputCols=K.SENSORS, outputCol="sensor_vector"),
        BoundedForest(labelCol="mode_index", featuresCol="sensor_vector", numTrees=trees, maxDepth=depth,
                               weightCol="weight", seed=K.SEED, cacheNodeIds=True),
    ])


def predicted_modes(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(label, prediction) with mode names."""
    names = F.array(*[F.lit(n) for n in model.stages[0].labels])
    return model.transform(df).select(
        F.col("failure_mode").alias("label"), F.get(names, F.col("prediction").cast("int")).alias("prediction"))


def feature_importance(spark: SparkSession, model: Model, names: Sequence[str] = K.FEATURE_NAMES) -> DataFrame:
    """Importances by name, largest first; as many rows as features."""
    rows = [(name, float(value)) for name, value in zip(names, model.featureImportances.toArray())]
    frame = spark.createDataFrame(rows, "feature string, importance double")
    return frame.withColumn("display_name", C.display_name("feature")).orderBy(F.col("importance").desc(), "feature")


class SubspaceModel:
    """Normal behaviour as a linear subspace fitted on normal rows; the distance to it is the anomaly score.

    Scores are arithmetic on the feature columns. The feature weights travel with the model, so the
    threshold and the score it was tuned on agree.
    """

    def __init__(self, components: np.ndarray, weights: Sequence[float], columns: Sequence[str] = FEATURE_COLUMNS):
        self.components = components  # features x k, orthonormal columns
        self.weights = list(weights)
        self.columns = list(columns)

    @classmethod
    def fit(cls, normal: DataFrame, k: int = 2, weights: Sequence[float] | None = None,
            columns: Sequence[str] = FEATURE_COLUMNS) -> SubspaceModel:
        """``normal`` has standardised feature columns and the vector of them."""
        fitted = PCA(k=k, inputCol="features", outputCol="latent").fit(normal.select("features"))
        return cls(fitted.pc.toArray(), weights or [1.0] * len(columns), columns)

    def _latent(self, j: int) -> Column:
        total = F.lit(0.0)
        for column, loading in zip(self.columns, self.components[:, j]):
            total = total + F.col(column) * float(loading)
        return total

    def _with_latents(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"_z{j}": self._latent(j) for j in range(self.components.shape[1])})

    def score(self, df: DataFrame, name: str = "anomaly_score") -> DataFrame:
        """Mean weighted squared reconstruction error."""
        k = self.components.shape[1]
        total = F.lit(0.0)
        for column, row, weight in zip(self.columns, self.components, self.weights):
            gap = F.col(column)
            for j in range(k):
                gap = gap - F.col(f"_z{j}") * float(row[j])
            total = total + F.pow(gap, F.lit(2)) * float(weight)
        return self._with_latents(df).withColumn(name, total / len(self.columns)).drop(*[f"_z{j}" for j in range(k)])

    def centre(self, normal: DataFrame, floor: float = 0.1) -> list[float]:
        """Mean latent of the normal rows, coordinates nearer to zero than ``floor`` set to it."""
        row = normal.agg(*[F.avg(self._latent(j)).alias(f"z{j}") for j in range(self.components.shape[1])]).first()
        return [floor if abs(v) < floor else v for v in row]  # k numbers

    def centre_distance(self, df: DataFrame, centre: Sequence[float], name: str = "anomaly_score") -> DataFrame:
        """Squared distance of the latent to the centre."""
        total = F.lit(0.0)
        for j, c in enumerate(centre):
            total = total + F.pow(F.col(f"_z{j}") - float(c), F.lit(2))
        return self._with_latents(df).withColumn(name, total).drop(*[f"_z{j}" for j in range(len(centre))])

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, column, [float(w) for w in row], float(weight))
                for i, (column, row, weight) in enumerate(zip(self.columns, self.components, self.weights))]
        frame = spark.createDataFrame(rows, "place int, column_name string, loadings array<double>, weight double")
        frame.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SubspaceModel:
        rows = spark.read.parquet(path).orderBy("place").collect()  # one row per feature
        return cls(np.array([r["loadings"] for r in rows]), [r["weight"] for r in rows], [r["column_name"] for r in rows])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
