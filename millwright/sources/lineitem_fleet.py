"""Machine observations derived from the delivered ``lineitem`` table.

One observation per delivered line, and no other. The rule constants below define the derived data
set; integers until the last step keep every engine's result bit-equal.

All values of an observation come from its own line, so that a query which needs no id needs no order
of lines either. An observation's id is its order's key and its place among the order's lines, in the order of the
values it is made of; ``(l_orderkey, l_linenumber)`` is not unique in the delivered tables. Only lines equal in
all these could swap places, which changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millwright.constants import CLEAN_TO_RAW, MODES
from millwright.plans.ordering import in_bounded_tasks
from millwright.session import stage

#: Ids leave room for this many lines in an order.
LINES_PER_ORDER = 1_000_000
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_VALUES = {
    "p": "l_partkey",
    "s": "l_suppkey",
    "disc": "l_discount",
    "tax": "l_tax",
    "qty": "l_quantity",
    "cents": "l_extendedprice",
}

# SQL text keeps the derivation a few plan nodes, whoever builds on it. floor(x + 0.5) is the plain
# rounding of a non-negative number and stays inside generated code.
DRAW = "p * 8191 + s * 131 + CAST(floor(cents * 100 + 0.5) AS BIGINT) AS u"
SETTINGS = [
    "u",
    "CASE WHEN p % 10 < 6 THEN 'L' WHEN p % 10 < 9 THEN 'M' ELSE 'H' END AS type_code",
    "29500 + floor(disc * 100 + 0.5) * 90 + IF(u % 211 = 0, 900, 0) AS air_c",
    "845 + floor(tax * 100 + 0.5) * 40 + floor(cents * 100 + 0.5) % 40 AS gap_c",
    "1160 + (floor(cents * 100 + 0.5) % 42) * (p % 42) AS rpm",
    "3450 + 115 * (CAST(qty AS BIGINT) - 1) AS watts",
    "(u * 7 + p * 31) % 254 AS wear",
]
TORQUE = "floor(watts * 9.549296585513721D * 100 / rpm + 0.5) AS torque_c"
FLAGS = [
    "IF(wear >= 240 AND u % 5 = 0, 1, 0) AS TWF",
    "IF(gap_c < 860 AND rpm < 1380, 1, 0) AS HDF",
    "IF(torque_c * rpm < 3342254 OR torque_c * rpm > 8594367, 1, 0) AS PWF",
    "IF(torque_c * wear > CASE type_code WHEN 'L' THEN 1100000 WHEN 'M' THEN 1200000 ELSE 1300000 END, 1, 0) AS OSF",
    "IF(u % 521 = 0, 1, 0) AS RNF",
]
COLUMNS = [
    "udi AS machine_id",
    "concat(type_code, CAST(10000 + udi AS STRING)) AS product_id",
    "type_code",
    "air_c / 100 AS air_temperature_k",
    "(air_c + gap_c) / 100 AS process_temperature_k",
    "CAST(rpm AS INT) AS rotational_speed_rpm",
    "torque_c / 100 AS torque_nm",
    "CAST(wear AS INT) AS tool_wear_min",
    "IF(TWF + HDF + PWF + OSF > 0 OR u % 1009 = 0, 1, 0) AS machine_failure",
    *MODES,
    "p",
]


def number_lines(lines: DataFrame) -> DataFrame:
    """(udi, p, s, disc, tax, qty, cents) of every line, numbered inside its order.

    The lines are counted first, as tasks of too many rows would spill their sort.
    """
    lines = in_bounded_tasks(lines.select("l_orderkey", *LINE_ORDER), lines.count(), "l_orderkey")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)) - 1
    udi = F.col("l_orderkey") * LINES_PER_ORDER + place
    return lines.select(udi.alias("udi"), *[F.col(column).alias(name) for name, column in LINE_VALUES.items()])


def observe(numbered: DataFrame) -> DataFrame:
    """Map numbered lines to observations with table column names and the part ``p``; stateless."""
    settings = numbered.selectExpr("*", DRAW).selectExpr("udi", "p", *SETTINGS)
    return settings.selectExpr("*", TORQUE).selectExpr("*", *FLAGS).selectExpr(*COLUMNS)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def _numbered(spark: SparkSession, sf_dir: str, stored: bool) -> DataFrame:
    """The numbered lines, written once with ``stored``: for callers of which several jobs read ids."""
    numbered = number_lines(_lines(spark, sf_dir))
    return stage(numbered, "lines") if stored else numbered


def observations(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """One row per machine under table column names, with ``reading_id`` = ``machine_id``."""
    return observe(_numbered(spark, sf_dir, stored)).drop("p").withColumn("reading_id", F.col("machine_id"))


def repeated_observations(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """Several readings per machine: the part is the machine, the observation is the reading."""
    return observe(_numbered(spark, sf_dir, stored)).withColumns({
        "reading_id": F.col("machine_id"),
        "machine_id": F.col("p"),
        "product_id": F.concat("type_code", (10000 + F.col("p")).cast("string")),
    }).drop("p")


def to_raw(df: DataFrame) -> DataFrame:
    """The same rows under the raw file's header."""
    return df.select(*[F.col(clean).alias(raw) for clean, raw in CLEAN_TO_RAW.items()], *MODES)
