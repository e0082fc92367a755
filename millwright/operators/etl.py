"""The load job: wide rows in, flat file and six tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.operators.modelling import FleetTables, failure_events, maintenance_records
from millwright.operators.quality import clean_observations, foreign_key_report, unique_key_report
from millwright.sources.readers import good_lines, read_raw
from millwright.session import remove, stage
from millwright.sources.schemas import FOREIGN_KEYS, UNIQUE_KEYS
from millwright.sources.versions import current, new_version, publish
from millwright.sources.writers import write_flat, write_table

FLAT = "clean"


class RefreshRejected(ValueError):
    """The tables of a refresh break a key or a reference; the version before stays current."""


def check_tables(tables: FleetTables) -> None:
    """Stops where a key repeats or a reference points nowhere."""
    named = tables.named()
    keys = unique_key_report(named, UNIQUE_KEYS).where("n_repeated > 0").collect()  # a row per key
    references = foreign_key_report(named, FOREIGN_KEYS).where("n_orphans > 0").collect()
    if keys or references:
        raise RefreshRejected("; ".join(str(r.asDict()) for r in keys + references))


def refresh_fleet(clean: DataFrame, folder: str) -> FleetTables:
    """Write the flat file and all six tables as a new version, check keys and references there, and publish it.

    The expensive steps run once: the tables read the flat file, and the numbered events carry their reading's wear
    to the maintenance log, as reading ids are checked to be unique. Readers see all tables of the version before or all of this one.
    """
    spark = clean.sparkSession
    version = new_version(folder)
    try:
        write_flat(clean, f"{version}/{FLAT}")
        stored = spark.read.schema(clean.schema).parquet(f"{version}/{FLAT}")
        tables = FleetTables.from_observations(stored)
        for name in ("machine_type", "machines", "sensor_readings", "failure_mode"):
            write_table(name, getattr(tables, name), version)
        events = stage(failure_events(stored, ["tool_wear_min"]), "events")
        write_table("failure_events", events, version)
        known = F.when(F.col("reading_id").isNotNull(), F.col("tool_wear_min"))  # no reading is found without an id
        write_table("maintenance_events", maintenance_records(events.withColumn("tool_wear_min", known)), version)
        written = FleetTables.load(spark, version)
        check_tables(written)
    except Exception:
        remove(spark, version)
        raise
    publish(spark, folder, version)
    return written


def load_fleet(spark: SparkSession, folder: str) -> FleetTables:
    """The six tables of the version published last."""
    version = current(spark, folder)
    if version is None:
        raise FileNotFoundError(f"nothing was published under {folder}")
    return FleetTables.load(spark, version)


def run_etl(spark: SparkSession, raw_path: str, folder: str, fmt: str = "csv") -> FleetTables:
    """Read, validate (stops on a violation), write."""
    return refresh_fleet(clean_observations(good_lines(read_raw(spark, raw_path, fmt))), folder)
