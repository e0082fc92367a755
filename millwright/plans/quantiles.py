"""Exact quantiles of many columns from value counts.

The value counts are combined before the shuffle and are all the later steps read, so no task ever
holds a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.plans.ordering import cumulate


def long_values(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, feature) with its value as a double; missing values are left out."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("feature"), F.col(name).cast("double").alias("value")) for name in features
    ])
    return df.select(*keep, F.explode(pairs).alias("_pair")).select(
        *keep, "_pair.feature", "_pair.value"
    ).where(F.col("value").isNotNull())


def value_counts(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return long_values(df, features, keep).groupBy("feature", *keep, "value").agg(F.count(F.lit(1)).alias("n"))


def _at(rank: Column) -> Column:
    """The value at a 0-based rank, given running counts."""
    return F.min(F.when(F.col("cum_n") > rank, F.col("value")))


def quantiles(counts: DataFrame, by: Sequence[str], fractions: dict[str, float], bounded: bool,
              extra: Sequence[Column] = ()) -> DataFrame:
    """Linearly interpolated quantiles per ``by`` from (by, value, n) rows."""
    by = list(by)
    totals = counts.groupBy(*by).agg(F.sum("n").alias("_total"))
    running = cumulate(counts, by, "value", ["n"], bounded).join(totals, by)
    picks, finish = [], {}
    for name, fraction in fractions.items():
        at = (F.col("_total") - 1) * F.lit(float(fraction))
        low = F.floor(at)
        picks += [_at(low).alias(f"_{name}_lo"), _at(F.ceil(at)).alias(f"_{name}_hi"),
                  F.first(at - low).alias(f"_{name}_w")]
        finish[name] = F.col(f"_{name}_lo") + (F.col(f"_{name}_hi") - F.col(f"_{name}_lo")) * F.col(f"_{name}_w")
    picked = running.groupBy(*by).agg(*picks, F.first("_total").alias("count"), *extra)
    hidden = [f"_{name}_{part}" for name in fractions for part in ("lo", "hi", "w")]
    return picked.withColumns(finish).drop(*hidden)
