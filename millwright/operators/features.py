"""Feature engineering: stateless columns, train-fitted statistics, encoding, alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright import constants as K
from millwright.functions import columns as C
from millwright.plans.quantiles import quantiles, value_counts
from millwright.plans.split import sample_rows, stratified_split

FEATURE_COLUMNS = [*K.NUMERIC_FEATURES, "type_H", "type_L", "type_M", "tool_wear_ordinal"]
TO_FEATURE_NAME = dict(zip(FEATURE_COLUMNS, K.FEATURE_NAMES))


class MissingFeatures(ValueError):
    """Expected features cannot be derived from the input."""


def select_inputs(clean: DataFrame) -> DataFrame:
    """Drop identifiers and leakage flags, whichever are present."""
    return clean.drop(*K.LEAKAGE_COLUMNS, "reading_id")


def engineer(clean: DataFrame) -> DataFrame:
    """The stateless features; safe on any split."""
    return clean.withColumns({
        "temp_diff_K": C.temp_diff(),
        "power_W": C.power_w(),
        "torque_x_toolwear": C.torque_x_toolwear(),
        "speed_torque_ratio": C.speed_torque_ratio(),
        "tool_wear_bucket": C.wear_bucket(),
    })


def split_fleet(clean: DataFrame, seed: int = K.SEED) -> DataFrame:
    """70/15/15 by target, before anything is fitted."""
    return stratified_split(clean, "machine_id", "machine_failure", seed)


def split_by_mode(clean: DataFrame, seed: int = K.SEED) -> DataFrame:
    """70/30 by first failure mode."""
    labelled = clean.withColumn("failure_mode", C.first_mode())
    return stratified_split(labelled, "machine_id", "failure_mode", seed, second_pct=100)


def group_statistics(train: DataFrame, value: str, group: str) -> DataFrame:
    """Mean and sample deviation per group and overall (``is_total`` = 1), in one aggregation."""
    return train.rollup(group).agg(
        F.grouping(group).alias("is_total"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
    )


def z_from(value: Column, mean: Column, std: Column, all_mean: Column, all_std: Column) -> Column:
    """Group z-score; overall statistics where the group is unknown or has no spread."""
    usable = std.isNotNull() & (std != 0)
    return F.when(usable, (value - mean) / std).otherwise((value - all_mean) / F.nullif(all_std, F.lit(0.0)))


def grouped_z(df: DataFrame, train: DataFrame, value: str = "air_temperature_k", group: str = "type_code",
              domain: Sequence[str] | None = K.TYPES, name: str = K.GROUPED_Z) -> DataFrame:
    """Add the z-score of ``value`` within ``group``, fitted on ``train`` only.

    With a ``domain`` the group statistics, as many rows as it has entries, come to the driver and
    enter the plan as literals; groups outside it count as unknown. Without one the join is left to
    adaptive execution.
    """
    stats = group_statistics(train, value, group)
    if domain is not None:
        few = stats.where((F.col("is_total") == 1) | F.col(group).isin(list(domain))).collect()
        mean = std = F.lit(None).cast("double")
        all_mean = all_std = mean
        for row in few:
            own_mean, own_std = (F.lit(row[c]).cast("double") for c in ("mean", "std"))
            if row["is_total"] == 1:
                all_mean, all_std = own_mean, own_std
            else:
                here = F.col(group) == F.lit(row[group])
                mean, std = F.when(here, own_mean).otherwise(mean), F.when(here, own_std).otherwise(std)
        return df.withColumn(name, z_from(F.col(value), mean, std, all_mean, all_std))
    per_group = stats.where("is_total = 0").select(group, F.col("mean").alias("_m"), F.col("std").alias("_s"))
    overall = stats.where("is_total = 1").select(F.struct("mean", "std")).scalar()
    joined = df.join(per_group, group, "left").withColumn("_all", overall)
    z = z_from(F.col(value), F.col("_m"), F.col("_s"), F.col("_all.mean"), F.col("_all.std"))
    return joined.withColumn(name, z).drop("_m", "_s", "_all")


def column_statistics(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: a struct (mean, population deviation) per column; a constant column divides by 1."""
    spread = {c: F.stddev_pop(c) for c in columns}
    return train.agg(*[
        F.struct(
            F.avg(c).alias("mean"),
            F.when(spread[c] == 0, 1.0).otherwise(spread[c]).alias("std"),
        ).alias(c) for c in columns
    ])


def standardise(df: DataFrame, train: DataFrame, columns: Sequence[str] = K.NUMERIC_FEATURES) -> DataFrame:
    """Scale columns by statistics of ``train``: one row, which enters the plan as literals."""
    stats = column_statistics(train, columns).first()
    return df.withColumns({
        c: (F.col(c) - F.lit(stats[c]["mean"]).cast("double")) / F.lit(stats[c]["std"]).cast("double") for c in columns
    })


def encode(df: DataFrame) -> DataFrame:
    """Type dummies (unknown: all zero) and the wear ordinal (unknown: -1)."""
    return df.withColumns({
        **{f"type_{level}": C.one_hot(level) for level in K.TYPES},
        "tool_wear_ordinal": C.wear_ordinal(),
    })


def prepared(clean: DataFrame, seed: int = K.SEED) -> DataFrame:
    """Split, engineered, grouped z and encoded: the features before scaling, for every row.

    Nothing is written: a fitted statistic is one aggregate over the few columns it needs.
    """
    parts = engineer(split_fleet(clean, seed))
    return encode(grouped_z(parts, parts.where("split = 'train'")))


def feature_matrix(clean: DataFrame, seed: int = K.SEED) -> DataFrame:
    """The 14 model features per machine in their fixed order, with target and split."""
    ready = prepared(clean, seed)
    scaled = standardise(ready, ready.where("split = 'train'"))
    return scaled.select("machine_id", "split", "machine_failure", *FEATURE_COLUMNS)


def align(df: DataFrame, expected: Sequence[str] = K.FEATURE_NAMES, fill: float | None = None,
          keep: Sequence[str] = ("machine_id",)) -> DataFrame:
    """Columns renamed to the expected feature names, in their order.

    Dummies and the wear ordinal are derived where their source is there. A feature that cannot be
    derived is an error unless ``fill`` gives its value.
    """
    ready = encode(df) if {"type_code", "tool_wear_bucket"} <= set(df.columns) else df
    if "type_code" in ready.columns and "type_H" not in ready.columns:
        ready = ready.withColumns({f"type_{level}": C.one_hot(level) for level in K.TYPES})
    ours = {name: column for column, name in TO_FEATURE_NAME.items()}
    missing = [name for name in expected if ours.get(name, name) not in ready.columns]
    if missing and fill is None:
        raise MissingFeatures(f"cannot derive {missing}")
    chosen = [F.lit(float(fill)).alias(name) if name in missing else F.col(f"`{ours.get(name, name)}`").alias(name)
              for name in expected]
    return ready.select(*keep, *chosen)


def wear_quartile_label(clean: DataFrame) -> DataFrame:
    """Q1..Q4 by interpolated quartiles, right-closed, lowest included; equal edges fall together."""
    counts = value_counts(clean, ["tool_wear_min"])
    edges = quantiles(counts, ["feature"], {"q1": 0.25, "q2": 0.5, "q3": 0.75}, bounded=True)
    edge = edges.select(F.array_distinct(F.array("q1", "q2", "q3"))).scalar()
    passed = F.size(F.filter(F.col("_edges"), lambda e: e < F.col("tool_wear_min")))
    return clean.withColumn("_edges", edge).withColumn(
        "tool_wear_bucket", F.concat(F.lit("Q"), (passed + 1).cast("string"))
    ).drop("_edges")


def normal_training_rows(matrix: DataFrame) -> DataFrame:
    return matrix.where("split = 'train' AND machine_failure = 0")


def seeded_sample(df: DataFrame, n: int = 100, seed: int = K.SEED) -> DataFrame:
    return sample_rows(df, "machine_id", n, seed)


def feature_means(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean per feature, with the name a report shows."""
    means = [F.struct(F.lit(name).alias("feature"), F.avg(f"`{name}`").alias("mean_value")).alias(f"_{i}")
             for i, name in enumerate(features)]
    rows = df.agg(*means).select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(means))])))
    return rows.withColumn("display_name", C.display_name("feature"))
