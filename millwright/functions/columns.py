"""Scalar expressions: exact ratios, engineered features, bins, bands, the rule score."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

from millwright import constants as K


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def int_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a.cast("long"), b.cast("long"))


def percent(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """100 * part / whole of two counts, rounded half up exactly; NULL when whole is 0."""
    a, b, scale = _col(part).cast("long"), _col(whole).cast("long"), 10**digits
    exact = int_div(a * (200 * scale) + b, b * 2) / scale
    return F.when(b != 0, exact)


def centi(column: Column | str) -> Column:
    """A two-decimal measurement as an exact integer number of hundredths."""
    return F.floor(_col(column).cast("double") * 100 + 0.5)


def half_up_mean(total_centi: Column, n: Column) -> Column:
    """Mean of hundredths rounded half up to hundredths, as a number; exact for non-negative totals."""
    return int_div(total_centi * 2 + n, n * 2) / 100


def temp_diff() -> Column:
    return F.col("process_temperature_k").cast("double") - F.col("air_temperature_k").cast("double")


def power_w() -> Column:
    """Mechanical power: torque times angular speed."""
    return F.col("torque_nm").cast("double") * (F.col("rotational_speed_rpm") * 2 * pi / 60)


def torque_x_toolwear() -> Column:
    return F.col("torque_nm").cast("double") * F.col("tool_wear_min")


def speed_torque_ratio() -> Column:
    """Speed per torque; NULL for an idle spindle."""
    return F.try_divide(F.col("rotational_speed_rpm").cast("double"), F.col("torque_nm").cast("double"))


def right_closed(value: Column, edges: list[float], labels: list) -> Column:
    """Label of the bin (edge, next edge] that holds ``value``; NULL outside all bins."""
    chain = F.when(value <= edges[0], None)
    for upper, label in zip(edges[1:], labels):
        chain = chain.when(value <= upper, label)
    return chain


def wear_bucket(value: Column | str = "tool_wear_min") -> Column:
    return right_closed(_col(value), K.WEAR_EDGES, K.WEAR_LABELS)


def wear_ordinal(label: Column | str = "tool_wear_bucket") -> Column:
    """Position of the wear label; -1 when missing or unknown."""
    chain = F.when(_col(label) == K.WEAR_LABELS[0], 0)
    for i, name in enumerate(K.WEAR_LABELS[1:], start=1):
        chain = chain.when(_col(label) == name, i)
    return chain.otherwise(-1)


def one_hot(level: str, column: Column | str = "type_code") -> Column:
    return F.when(_col(column) == level, 1).otherwise(0)


def type_from_dummies() -> Column:
    """Type letter from 0/1 or boolean dummies, H when neither M nor L is set."""
    return F.when(F.col("type_M").cast("int") == 1, "M").when(F.col("type_L").cast("int") == 1, "L").otherwise("H")


def rule_score(wear: Column | None, torque: Column | None) -> Column:
    """The built-in risk score in [0, 1]; a sensor the input lacks counts with its default."""
    wear = F.lit(K.RULE_WEAR_DEFAULT) if wear is None else wear
    torque = F.lit(K.RULE_TORQUE_DEFAULT) if torque is None else torque
    raw = (wear.cast("double") / K.RULE_WEAR_FULL) * K.RULE_WEAR_WEIGHT + (
        torque.cast("double") / K.RULE_TORQUE_FULL
    ) * K.RULE_TORQUE_WEIGHT
    return F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0))


def status_band(risk: Column | str) -> Column:
    return right_closed(_col(risk), K.BAND_EDGES, K.BAND_LABELS)


def at_least(score: Column | str, threshold: float) -> Column:
    return F.when(_col(score) >= threshold, 1).otherwise(0)


def first_mode(default: str = "None") -> Column:
    """The first set failure flag in melt order."""
    return F.coalesce(*[F.when(F.col(mode) == 1, mode) for mode in K.MODES], F.lit(default))


def any_mode() -> Column:
    return F.greatest(*[F.col(mode) for mode in K.MODES])


def mode_count() -> Column:
    total = F.col(K.MODES[0])
    for mode in K.MODES[1:]:
        total = total + F.col(mode)
    return total


NANO = 10**9


def exact_mean(value: Column | str, digits: int, factor: int = 1) -> Column:
    """``factor`` times the mean of non-negative numbers, each taken to nine decimals, rounded half up.

    An aggregate of integers, so neither the order of rows nor their partitioning can move a tie.
    """
    units = F.floor(_col(value) * NANO + 0.5).cast("decimal(20,0)")
    total, n = F.sum(units).cast("decimal(38,0)"), F.count(units).cast("decimal(38,0)")
    doubled = F.lit(2 * factor * 10**digits).cast("decimal(38,0)")
    rounded = F.call_function("div", total * doubled + n * F.lit(NANO).cast("decimal(38,0)"), n * F.lit(2 * NANO).cast("decimal(38,0)"))
    return F.when(F.count(units) > 0, rounded / 10**digits)


def percent_text(risk: Column) -> Column:
    """A probability as text with two decimals and a percent sign."""
    points = F.floor(risk * 10000 + 0.5)
    return F.concat(int_div(points, F.lit(100)).cast("string"), F.lit("."),
                    F.lpad((points % 100).cast("string"), 2, "0"), F.lit("%"))


def display_name(name: Column | str) -> Column:
    """Feature name without its encoder prefix."""
    return F.regexp_replace(_col(name), "num__|cat_onehot__|cat_ordinal__", "")


def greatest_or_null(*columns: Column) -> Column:
    """Largest value, NULL as soon as one argument is NULL."""
    missing = columns[0].isNull()
    for column in columns[1:]:
        missing = missing | column.isNull()
    return F.when(~missing, F.greatest(*columns))
