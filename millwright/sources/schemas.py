"""Declared schemas and the constraints that come with them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from millwright.constants import MODES

TEMPERATURE = T.DecimalType(6, 2)

RAW = T.StructType(
    [
        T.StructField("UDI", T.LongType(), False),
        T.StructField("Product ID", T.StringType(), False),
        T.StructField("Type", T.StringType(), False),
        T.StructField("Air temperature [K]", T.DoubleType(), False),
        T.StructField("Process temperature [K]", T.DoubleType(), False),
        T.StructField("Rotational speed [rpm]", T.IntegerType(), False),
        T.StructField("Torque [Nm]", T.DoubleType(), False),
        T.StructField("Tool wear [min]", T.IntegerType(), False),
        T.StructField("Machine failure", T.IntegerType(), False),
    ]
    + [T.StructField(mode, T.IntegerType(), False) for mode in MODES]
)

MACHINE_TYPE = T.StructType([
    T.StructField("type_code", T.StringType(), False),
    T.StructField("type_name", T.StringType(), False),
    T.StructField("description", T.StringType(), True),
])
MACHINES = T.StructType([
    T.StructField("machine_id", T.LongType(), False),
    T.StructField("product_id", T.StringType(), False),
    T.StructField("type_code", T.StringType(), False),
])
SENSOR_READINGS = T.StructType([
    T.StructField("reading_id", T.LongType(), False),
    T.StructField("machine_id", T.LongType(), False),
    T.StructField("air_temperature_k", TEMPERATURE, False),
    T.StructField("process_temperature_k", TEMPERATURE, False),
    T.StructField("rotational_speed_rpm", T.IntegerType(), False),
    T.StructField("torque_nm", T.DecimalType(6, 2), False),
    T.StructField("tool_wear_min", T.IntegerType(), False),
])
FAILURE_MODE = T.StructType([
    T.StructField("failure_mode_code", T.StringType(), False),
    T.StructField("description", T.StringType(), False),
])
FAILURE_EVENTS = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("reading_id", T.LongType(), False),
    T.StructField("machine_id", T.LongType(), False),
    T.StructField("failure_mode_code", T.StringType(), False),
    T.StructField("is_overall_failure", T.IntegerType(), False),
])
MAINTENANCE_EVENTS = T.StructType([
    T.StructField("maintenance_id", T.LongType(), False),
    T.StructField("machine_id", T.LongType(), False),
    T.StructField("event_id", T.LongType(), True),
    T.StructField("maintenance_type", T.StringType(), False),
    T.StructField("tool_wear_at_event", T.IntegerType(), False),
    T.StructField("is_synthetic", T.IntegerType(), False),
    T.StructField("notes", T.StringType(), True),
])

# Load order: dimensions before the facts that point at them.
TABLES = {
    "machine_type": MACHINE_TYPE,
    "machines": MACHINES,
    "sensor_readings": SENSOR_READINGS,
    "failure_mode": FAILURE_MODE,
    "failure_events": FAILURE_EVENTS,
    "maintenance_events": MAINTENANCE_EVENTS,
}

UNIQUE_KEYS = [
    ("machine_type", "type_code"),
    ("machines", "machine_id"),
    ("machines", "product_id"),
    ("sensor_readings", "reading_id"),
    ("failure_mode", "failure_mode_code"),
    ("failure_events", "event_id"),
    ("maintenance_events", "maintenance_id"),
]


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_column: str

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column}"


FOREIGN_KEYS = [
    ForeignKey("machines", "type_code", "machine_type", "type_code"),
    ForeignKey("sensor_readings", "machine_id", "machines", "machine_id"),
    ForeignKey("failure_events", "reading_id", "sensor_readings", "reading_id"),
    ForeignKey("failure_events", "machine_id", "machines", "machine_id"),
    ForeignKey("failure_events", "failure_mode_code", "failure_mode", "failure_mode_code"),
    ForeignKey("maintenance_events", "machine_id", "machines", "machine_id"),
    ForeignKey("maintenance_events", "event_id", "failure_events", "event_id"),
]


@dataclass(frozen=True)
class Rule:
    """A row predicate in SQL text; a row that does not satisfy it is a violation."""

    name: str
    predicate: str


DOMAIN_RULES = [Rule("type_code in domain", "type_code IN ('L', 'M', 'H')")] + [
    Rule(f"{flag} is binary", f"{flag} IN (0, 1)") for flag in [*MODES, "machine_failure"]
]
RANGE_RULES = [
    Rule("air_temperature_k > 0", "air_temperature_k > 0"),
    Rule("process_temperature_k > 0", "process_temperature_k > 0"),
    Rule("rotational_speed_rpm >= 0", "rotational_speed_rpm >= 0"),
    Rule("torque_nm >= 0", "torque_nm >= 0"),
    Rule("tool_wear_min >= 0", "tool_wear_min >= 0"),
]
