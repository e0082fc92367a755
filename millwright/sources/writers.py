"""Sinks: tables, feature sets, scores, metadata, run log, comparison tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.sources.readers import METADATA
from millwright.sources.schemas import TABLES

FILE_SORT = {"machines": "machine_id", "sensor_readings": "machine_id", "failure_events": "machine_id",
             "maintenance_events": "machine_id"}
SMALL = ("machine_type", "failure_mode")


def write_flat(clean: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The cleaned wide rows; a rerun replaces them."""
    writer = clean.write.mode("overwrite")
    (writer.option("header", True).csv if fmt == "csv" else writer.format(fmt).save)(path)


def write_table(name: str, df: DataFrame, folder: str) -> None:
    """One table in its declared types.

    Rows are sorted by machine inside each file, so a lookup by machine skips row groups. No
    repartitioning: the tables arrive partitioned by their key.
    """
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].fields])
    if name in SMALL:
        typed = typed.coalesce(1)
    elif name in FILE_SORT:
        typed = typed.sortWithinPartitions(FILE_SORT[name])
    typed.write.mode("overwrite").parquet(f"{folder}/{name}")


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Full refresh, dimensions before facts."""
    for name in TABLES:
        write_table(name, tables[name], folder)


def write_features(matrix: DataFrame, path: str, features: list[str]) -> None:
    """Named feature columns and the same values as one dense array in the given order."""
    dense = F.array(*[F.col(f).cast("double") for f in features])
    matrix.withColumn("features", dense).write.mode("overwrite").parquet(path)


def write_scores(scored: DataFrame, rejected: DataFrame, path: str) -> None:
    """Scored rows by descending risk as CSV, rejected rows with their reasons beside them.

    Rows of equal risk are ordered by a hash, so that however many there are, several tasks share them.
    """
    ordered = scored.orderBy(F.col("failure_probability").desc(), F.xxhash64(*[f"`{c}`" for c in scored.columns]))
    ordered.write.mode("overwrite").option("header", True).csv(f"{path}/scored")
    told = rejected.withColumn("broken_rules", F.array_join("broken_rules", "; "))
    told.write.mode("overwrite").option("header", True).csv(f"{path}/rejected")


def write_metadata(spark: SparkSession, path: str, model_name: str, best_params: Mapping, threshold: float,
                   feature_names: list[str], val_metrics: Mapping) -> None:
    """One JSON document; numbers in the open maps are kept as text."""
    def texts(values):
        return {str(k): None if v is None else str(v) for k, v in values.items()}
    row = (model_name, texts(best_params), float(threshold), list(feature_names), texts(val_metrics))
    spark.createDataFrame([row], METADATA).coalesce(1).write.mode("overwrite").json(path)


def log_run(spark: SparkSession, path: str, run_id: str, params: Mapping, metrics: list[tuple[str, int, float]]) -> None:
    """Append the parameters and per-step metrics of one run."""
    rows = [(run_id, "param", k, None, None, str(v)) for k, v in params.items()]
    rows += [(run_id, "metric", k, int(step), float(value), None) for k, step, value in metrics]
    schema = "run_id string, kind string, key string, step int, value double, text string"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def write_comparison(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
