"""The twelve analytical questions over the fleet tables, and their unlimited forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright import constants as K
from millwright.functions.columns import centi, greatest_or_null, half_up_mean, percent
from millwright.operators.modelling import FleetTables, is_overall
from millwright.session import stage
from millwright.plans.ordering import (
    ntile,
    percent_rank,
    positions,
    sequence_by_key,
    trailing_frames,
    value_ranks,
)


def _rounded(column: Column) -> Column:
    return F.round(column, 2)


def failure_rate_by_type(t: FleetTables) -> DataFrame:
    """Readings and failures per type, failure rate, share of all failures.

    Stored readings are counted per machine before they meet its type, so that they are shuffled once.
    """
    failed = t.melted.where(is_overall()).select("reading_id").distinct().withColumn("failed", F.lit(1))
    wide = t.source is not None
    readings = (t.source if wide else t.sensor_readings).select("reading_id", "type_code" if wide else "machine_id")
    counts = readings.join(failed, "reading_id", "left").groupBy(readings.columns[1]).agg(
        F.count(F.lit(1)).alias("machine_count"), F.count("failed").alias("failures")
    )
    per_type = counts if wide else counts.join(t.machines.select("machine_id", "type_code"), "machine_id").groupBy("type_code").agg(
        F.sum("machine_count").alias("machine_count"), F.sum("failures").alias("failures")
    )
    everything = Window.partitionBy()  # three rows
    return t.typed(per_type, "type_name").select(
        "type_name", "machine_count", "failures",
        percent("failures", "machine_count").alias("failure_rate_pct"),
        percent(F.col("failures"), F.sum("failures").over(everything)).alias("pct_of_all_failures"),
    ).orderBy("type_name")


def torque_rank(t: FleetTables, limit: int | None = 30) -> DataFrame:
    """Torque rank within type, in (type, rank) order.

    A rank depends on the rows before it only, so the report's first rows are cut before ranking.
    """
    facts = t.reading_facts.select("machine_id", "product_id", "type_code", "torque_nm", "reading_id")
    if limit is not None:
        top = facts.orderBy("type_code", F.col("torque_nm").desc(), "reading_id").limit(limit)
        ranked = top.withColumn("torque_rank_in_type", F.rank().over(
            Window.partitionBy("type_code").orderBy(F.col("torque_nm").desc())).cast("long"))
    else:
        ranks = value_ranks(facts, ["type_code"], "torque_nm", descending=True).select(
            "type_code", "torque_nm", (F.col("rows_before") + 1).alias("torque_rank_in_type"))
        ranked = facts.join(ranks, ["type_code", "torque_nm"])
    return t.typed(ranked, "type_name").orderBy("type_code", "torque_rank_in_type", "reading_id").select(
        "machine_id", "product_id", "type_name", "torque_nm", "torque_rank_in_type"
    )


def _type_moments(t: FleetTables, sensors: list[str]) -> DataFrame:
    """Mean and population deviation of sensors per type: at most the dimension's three rows."""
    stats = t.reading_facts.groupBy("type_code").agg(
        *[F.avg(s).alias(f"avg_{s}") for s in sensors], *[F.stddev_pop(s).alias(f"std_{s}") for s in sensors]
    )
    return F.broadcast(t.typed(stats, "type_name"))


def _z(sensor: str) -> Column:
    return (F.col(sensor) - F.col(f"avg_{sensor}")) / F.nullif(F.col(f"std_{sensor}"), F.lit(0.0))


def torque_outliers(t: FleetTables, z_limit: float = 2.0, limit: int | None = 25) -> DataFrame:
    """Readings whose torque is more than ``z_limit`` deviations from their type's mean."""
    facts = t.reading_facts.select("reading_id", "machine_id", "type_code", "torque_nm")
    scored = facts.join(_type_moments(t, ["torque_nm"]), "type_code").withColumn("_z", _z("torque_nm"))
    found = scored.where(F.abs("_z") > z_limit).orderBy(F.abs("_z").desc(), "reading_id")
    found = found.limit(limit) if limit is not None else found
    return found.select(
        "machine_id", "type_name", "torque_nm",
        _rounded(F.col("avg_torque_nm")).alias("type_avg_torque"), _rounded(F.col("_z")).alias("torque_zscore"),
    )


def highest_stress(t: FleetTables, limit: int = 15) -> DataFrame:
    """The machines with the largest torque x wear and their fleet-wide percent rank.

    Every row ranked above a listed one is listed too, so ranks inside the list are fleet ranks;
    only the row count is needed from the rest.
    """
    facts = t.typed(t.reading_facts, "type_name").withColumn("_stress", centi("torque_nm") * F.col("tool_wear_min"))
    top = facts.orderBy(F.col("_stress").desc(), "reading_id").limit(limit)
    total = t.reading_facts.agg(F.count(F.lit(1)).alias("n"))
    rank = F.rank().over(Window.orderBy(F.col("_stress").desc()))  # over the listed rows
    scored = top.withColumn("_before", rank - 1).withColumn("_total", total.scalar())
    return scored.orderBy("_before", "reading_id").select(
        "machine_id", "product_id", "type_name", "torque_nm", "rotational_speed_rpm", "tool_wear_min",
        percent_rank(F.col("_before"), F.col("_total")).alias("risk_percentile"),
    )


def failure_mode_pareto(t: FleetTables) -> DataFrame:
    """Events per mode with share and running share; modes with equal counts share the running total."""
    counts = t.melted.where(F.col("failure_mode_code") != K.UNSPECIFIED).groupBy("failure_mode_code").agg(
        F.count(F.lit(1)).alias("n"))
    described = counts.join(F.broadcast(t.failure_mode), "failure_mode_code")
    whole = F.sum("n").over(Window.partitionBy())  # one row per mode
    running = F.sum("n").over(Window.orderBy(F.col("n").desc()))
    return described.select(
        "failure_mode_code", "description", "n",
        percent(F.col("n"), whole).alias("pct_of_mode_failures"),
        percent(running, whole).alias("running_cumulative_pct"),
    ).orderBy(F.col("n").desc(), "failure_mode_code")


def wear_quartiles(t: FleetTables) -> DataFrame:
    """Every reading with its wear quartile (NTILE) within type.

    Stored tables are joined once and the rows written, as three steps read them.
    """
    facts = t.reading_facts.select("reading_id", "machine_id", "type_code", "tool_wear_min")
    facts = stage(facts, "facts") if t.source is None else facts
    placed = positions(facts, ["type_code"], "tool_wear_min", "reading_id")
    return placed.withColumn("wear_quartile", ntile(F.col("_pos"), F.col("_total"), 4)).drop("_pos", "_total")


def wear_quartile_failures(t: FleetTables) -> DataFrame:
    """Failure rate per type and wear quartile."""
    failed = t.melted.where(is_overall()).select("machine_id").distinct().withColumn("failed", F.lit(1))
    grouped = wear_quartiles(t).join(failed, "machine_id", "left").groupBy("type_code", "wear_quartile").agg(
        F.count(F.lit(1)).alias("machine_count"), F.count("failed").alias("failures")
    )
    return grouped.withColumn("failure_rate_pct", percent("failures", "machine_count")).orderBy(
        "type_code", "wear_quartile")


def multi_mode_machines(t: FleetTables) -> DataFrame:
    """Machines with more than one flagged mode: how many events, how many distinct modes, the list.

    Events are counted per (machine, mode) first, so a machine with any number of events lists at
    most five entries; the list repeats a mode as often as it occurred.
    """
    events = t.event_facts.where(F.col("failure_mode_code") != K.UNSPECIFIED)
    machine = ["machine_id", "product_id", "type_code"]
    per_mode = events.groupBy(*machine, "failure_mode_code").agg(F.count(F.lit(1)).alias("_n"))
    per_machine = per_mode.groupBy(*machine).agg(
        F.sum("_n").alias("distinct_modes_triggered"),
        F.count(F.lit(1)).alias("distinct_modes"),
        F.array_sort(F.collect_list(F.struct("failure_mode_code", "_n"))).alias("_modes"),
    ).where(F.col("distinct_modes_triggered") > 1)
    listed = F.array_join(F.flatten(F.transform(
        "_modes", lambda m: F.array_repeat(m["failure_mode_code"], m["_n"].cast("int")))), ",")
    return t.typed(per_machine, "type_name").select(
        "machine_id", "product_id", "type_name", "distinct_modes_triggered", "distinct_modes", listed.alias("modes")
    ).orderBy(F.col("distinct_modes_triggered").desc(), "machine_id")


def maintenance_sequence(t: FleetTables) -> DataFrame:
    """Maintenance events numbered per machine, with the wear since the event before.

    The events are written once where they are made from wide rows, as three steps read them.
    """
    events = t.maintenance_events.select("machine_id", "maintenance_id", "maintenance_type", "tool_wear_at_event")
    numbered = sequence_by_key(
        events if t.source is None else stage(events, "maintenance"),
        "machine_id", "maintenance_id", "tool_wear_at_event", "maint_sequence", "prev_tool_wear",
    )
    return numbered.select(
        "machine_id", "maintenance_id", "maintenance_type", "tool_wear_at_event", "maint_sequence", "prev_tool_wear",
        (F.col("tool_wear_at_event") - F.col("prev_tool_wear")).alias("wear_minutes_since_last_maint"),
    ).orderBy("machine_id", "maint_sequence")


def torque_moving_average(t: FleetTables, limit: int | None = 50, preceding: int = 20) -> DataFrame:
    """Mean torque over the current and the ``preceding`` readings in wear order, per type.

    A frame reaches back only, so the report's first rows hold all their frames.
    """
    facts = t.reading_facts.select("machine_id", "type_code", "tool_wear_min", "torque_nm", "reading_id").withColumn(
        "_centi", centi("torque_nm"))
    def averages(frame):
        return half_up_mean(F.sum("_centi").over(frame), F.count(F.lit(1)).over(frame))
    if limit is not None:
        top = facts.orderBy("type_code", "tool_wear_min", "reading_id").limit(limit)
        frame = Window.partitionBy("type_code").orderBy("tool_wear_min", "reading_id").rowsBetween(-preceding, 0)
        smoothed = top.withColumn("torque_moving_avg_20", averages(frame))
    else:
        placed = positions(facts, ["type_code"], "tool_wear_min", "reading_id")
        smoothed = trailing_frames(placed, ["type_code"], "_pos", preceding, {"torque_moving_avg_20": averages})
    return smoothed.orderBy("type_code", "tool_wear_min", "reading_id").select(
        "machine_id", "type_code", "tool_wear_min", "torque_nm", "torque_moving_avg_20"
    )


def compound_anomalies(t: FleetTables, z_limit: float = 2.5) -> DataFrame:
    """Readings with air, process or speed beyond ``z_limit`` deviations of their type."""
    sensors = ["air_temperature_k", "process_temperature_k", "rotational_speed_rpm"]
    facts = t.reading_facts.select("reading_id", "machine_id", "type_code", *sensors)
    scored = facts.join(_type_moments(t, sensors), "type_code").select(
        "reading_id", "machine_id", "type_code",
        *[_z(s).alias(z) for s, z in zip(sensors, ["z_air", "z_proc", "z_rpm"])],
    )
    a, p, r = F.abs("z_air"), F.abs("z_proc"), F.abs("z_rpm")
    found = scored.where((a > z_limit) | (p > z_limit) | (r > z_limit))
    return found.orderBy(greatest_or_null(a, p, r).desc_nulls_last(), "reading_id").select(
        "machine_id", "type_code", *[_rounded(F.col(z)).alias(z) for z in ("z_air", "z_proc", "z_rpm")]
    )


def high_torque(t: FleetTables, floor: float = 0.90) -> DataFrame:
    """Readings at or above a percent rank of torque within their type."""
    facts = t.reading_facts.select("machine_id", "type_code", "torque_nm", "reading_id")
    ranks = value_ranks(facts, ["type_code"], "torque_nm")
    high = ranks.select(
        "type_code", "torque_nm", percent_rank(F.col("rows_before"), F.col("rows_total")).alias("pct_rank")
    ).where(F.col("pct_rank") >= floor)
    return facts.join(high, ["type_code", "torque_nm"]).orderBy(
        "type_code", F.col("torque_nm").desc(), "reading_id"
    ).select("machine_id", "type_code", "torque_nm", "pct_rank")


def failure_cost(t: FleetTables, cost_per_failure: int = K.DOWNTIME_COST) -> DataFrame:
    """Events and placeholder cost per type and mode, with the mode's share of its type."""
    events = t.event_facts.where(F.col("failure_mode_code") != K.UNSPECIFIED)
    counts = events.groupBy("type_code", "failure_mode_code").agg(F.count(F.lit(1)).alias("failure_count"))
    in_type = F.sum("failure_count").over(Window.partitionBy("type_name"))  # five rows per type
    return t.typed(counts, "type_name").select(
        "type_name", "failure_mode_code", "failure_count",
        (F.col("failure_count") * cost_per_failure).alias("estimated_downtime_cost_usd_placeholder"),
        percent(F.col("failure_count"), in_type).alias("pct_of_type_failures"),
    ).orderBy("type_name", F.col("failure_count").desc(), "failure_mode_code")
