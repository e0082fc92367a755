"""Normalisation: wide observations to keyed tables, events, the maintenance log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright import constants as K
from millwright.functions.columns import one_hot, type_from_dummies, wear_bucket
from millwright.plans.ordering import dense_index
from millwright.session import stage
from millwright.sources import schemas as S


def rename_raw(raw: DataFrame) -> DataFrame:
    """Raw header to table column names."""
    return raw.withColumnsRenamed(K.RAW_TO_CLEAN)


def machine_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(K.TYPE_ROWS, S.MACHINE_TYPE)


def failure_mode(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(K.MODE_ROWS, S.FAILURE_MODE)


def machines(clean: DataFrame) -> DataFrame:
    return clean.select("machine_id", "product_id", "type_code").dropDuplicates()


def sensor_readings(clean: DataFrame) -> DataFrame:
    """The fact table; a source without its own reading id has one reading per machine."""
    reading = "reading_id" if "reading_id" in clean.columns else "machine_id"
    return clean.select(F.col(reading).alias("reading_id"), "machine_id", *K.SENSORS)


def melt_failures(clean: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per set flag, plus UNSPECIFIED for a failure without any; ``mode_order`` keeps melt order."""
    reading = "reading_id" if "reading_id" in clean.columns else "machine_id"
    no_flag = F.lit(True)
    for mode in K.MODES:
        no_flag = no_flag & (F.col(mode) != 1)
    entries = [
        F.when(F.col(mode) == 1, F.struct(F.lit(i).alias("mode_order"), F.lit(mode).alias("failure_mode_code")))
        for i, mode in enumerate(K.MODES)
    ]
    entries.append(F.when(no_flag & (F.col("machine_failure") == 1), F.struct(
        F.lit(len(K.MODES)).alias("mode_order"), F.lit(K.UNSPECIFIED).alias("failure_mode_code"))))
    relevant = clean.where(~no_flag | (F.col("machine_failure") == 1))
    spread = relevant.select(
        F.col(reading).alias("reading_id"), "machine_id",
        F.explode(F.array_compact(F.array(*entries))).alias("_event"),
        F.col("machine_failure").alias("is_overall_failure"), *keep,
    )
    return spread.select("reading_id", "machine_id", "_event.failure_mode_code", "is_overall_failure",
                         "_event.mode_order", *keep)


def failure_events(clean: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Melted events numbered 1..n in reading order, then mode order, with the ``keep`` columns of their reading.

    The melted rows are written once, as three jobs read them to number them.
    """
    numbered = dense_index(stage(melt_failures(clean, keep), "melted"), "reading_id", ["mode_order"], "event_id")
    return numbered.select("event_id", "reading_id", "machine_id", "failure_mode_code", "is_overall_failure", *keep)


def maintenance_events(events: DataFrame, readings: DataFrame) -> DataFrame:
    """One corrective record per failure event, with the reading's wear (0 when the reading is unknown)."""
    return maintenance_records(events.join(readings.select("reading_id", "tool_wear_min"), "reading_id", "left"))


def maintenance_records(events: DataFrame) -> DataFrame:
    """The records of events that carry their reading's ``tool_wear_min``."""
    return events.select(
        F.col("event_id").alias("maintenance_id"),
        "machine_id",
        "event_id",
        F.lit(K.MAINTENANCE_TYPES[0]).alias("maintenance_type"),
        F.coalesce("tool_wear_min", F.lit(0)).alias("tool_wear_at_event"),
        F.lit(1).alias("is_synthetic"),
        F.concat(F.lit(K.MAINTENANCE_NOTE), "failure_mode_code").alias("notes"),
    )


def feature_table_to_raw(features: DataFrame) -> DataFrame:
    """Feature-table columns back to the scoring input: dummies to a type letter, raw header."""
    sensors = [F.col(name).alias(K.CLEAN_TO_RAW[name]) for name in K.SENSORS]
    return features.select("machine_id", type_from_dummies().alias("Type"), *sensors)


def feature_table(clean: DataFrame) -> DataFrame:
    """One row per machine: sensors, two engineered columns, type dummies, target."""
    from millwright.functions.columns import power_w, temp_diff

    return clean.select(
        "machine_id", *K.SENSORS,
        temp_diff().alias("temp_diff_k"),
        power_w().alias("mechanical_power_w"),
        *[one_hot(level).alias(f"type_{level}") for level in K.TYPES],
        "machine_failure",
    )


@dataclass
class FleetTables:
    """The six tables. ``source`` is the wide frame they were cut from, when there is one."""

    machine_type: DataFrame
    machines: DataFrame
    sensor_readings: DataFrame
    failure_mode: DataFrame
    failure_events: DataFrame
    maintenance_events: DataFrame
    source: DataFrame | None = None

    @classmethod
    def from_observations(cls, clean: DataFrame) -> FleetTables:
        return ObservedTables(clean)

    @classmethod
    def load(cls, spark: SparkSession, folder: str, but: Sequence[str] = ()) -> FleetTables:
        return cls(**{name: None if name in but else spark.read.schema(schema).parquet(f"{folder}/{name}")
                      for name, schema in S.TABLES.items()})

    def named(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name != "source"}

    @cached_property
    def reading_facts(self) -> DataFrame:
        """Readings with their machine's product and type.

        Straight from the wide source when that is at hand, since it carries both; otherwise the
        join of the two stored tables. Two-decimal sensors are doubles here.
        """
        sensors = [F.col(name).cast("double").alias(name) if name not in ("rotational_speed_rpm", "tool_wear_min")
                   else F.col(name) for name in K.SENSORS]
        if self.source is not None:
            return self.source.select("reading_id", "machine_id", "product_id", "type_code", *sensors)
        return self.sensor_readings.join(self.machines, "machine_id").select(
            "reading_id", "machine_id", "product_id", "type_code", *sensors
        )

    @cached_property
    def melted(self) -> DataFrame:
        """Events without their surrogate key, for queries that only count them."""
        if self.source is not None:
            return melt_failures(self.source).drop("mode_order")
        return self.failure_events.drop("event_id")

    @cached_property
    def event_facts(self) -> DataFrame:
        """Events with their machine's product and type: kept while melting, or joined from the stored tables."""
        if self.source is not None:
            return melt_failures(self.source, ["product_id", "type_code"]).drop("mode_order")
        return self.failure_events.drop("event_id").join(self.machines, "machine_id")

    def typed(self, df: DataFrame, *names: str) -> DataFrame:
        """Attach type columns. The dimension is three literal rows (three stored rows when loaded)."""
        return df.join(F.broadcast(self.machine_type.select("type_code", *names)), "type_code")


class ObservedTables(FleetTables):
    """The six tables cut from wide rows. Events are numbered when they are first asked for, as that runs jobs."""

    def __init__(self, clean: DataFrame):
        spark = clean.sparkSession
        self.machine_type, self.failure_mode = machine_type(spark), failure_mode(spark)
        self.machines, self.sensor_readings = machines(clean), sensor_readings(clean)
        self.source = clean

    @cached_property
    def failure_events(self) -> DataFrame:
        return failure_events(self.source)

    @cached_property
    def maintenance_events(self) -> DataFrame:
        return maintenance_events(self.failure_events, self.sensor_readings)


def is_overall(column: str = "is_overall_failure") -> Column:
    return F.col(column) == 1
