"""Cleaning, validation and profiling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright import constants as K
from millwright.functions.columns import any_mode, mode_count, percent
from millwright.operators.modelling import rename_raw
from millwright.sources.schemas import DOMAIN_RULES, RANGE_RULES, ForeignKey, Rule

ID_COLUMNS = ["machine_id", "product_id"]


class SchemaMismatch(ValueError):
    """Required columns are absent."""


class ValidationFailed(ValueError):
    """Rows violate the declared rules."""


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Check the header before any job runs."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise SchemaMismatch(f"missing required columns: {missing}")
    return df


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def drop_copies(df: DataFrame) -> DataFrame:
    """Exact duplicate rows removed; copies meet before the shuffle, so a much-copied row stays cheap."""
    return df.dropDuplicates()


def copy_report(df: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct rows and surplus copies, over all columns or without some."""
    columns = [name for name in df.columns if name not in without]
    groups = df.groupBy(*[_q(name) for name in columns]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"),
    )


def duplicate_profile(clean: DataFrame, ids: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """Surplus copies of whole rows and of rows without their ids, from one grouping of the rows."""
    profile = [name for name in clean.columns if name not in [*ids, "reading_id"]]
    whole = [name for name in clean.columns if name != "reading_id"]
    rows = clean.groupBy(*whole).agg(F.count(F.lit(1)).alias("_n"))
    outcomes = rows.groupBy(*profile).agg(
        F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_full")
    )
    return outcomes.agg(
        F.sum("_n").alias("n_rows"), F.sum("_full").alias("duplicated_rows"),
        F.sum(F.col("_n") - 1).alias("duplicated_without_ids"),
    )


def coerce_numeric(df: DataFrame, columns: Mapping[str, str], strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Cast text columns to numbers.

    Strict: a bad value raises when the rows are read. Otherwise returns the good rows and, beside
    them, the rejected rows with the names of the columns that failed.
    """
    if strict:
        return df.withColumns({name: F.col(name).cast(to) for name, to in columns.items()}), df.limit(0)
    failed = F.array_compact(F.array(*[
        F.when(F.col(name).isNotNull() & F.col(name).try_cast(to).isNull(), name) for name, to in columns.items()
    ]))
    marked = df.withColumn("failed_columns", failed)
    good = marked.where(F.size("failed_columns") == 0).drop("failed_columns")
    good = good.withColumns({name: F.col(name).cast(to) for name, to in columns.items()})
    return good, marked.where(F.size("failed_columns") > 0)


def coercion_report(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Per column: values present and values that are not numbers, in one pass."""
    counts = [F.struct(
        F.lit(name).alias("column_name"),
        F.count(F.col(name)).alias("n_values"),
        F.count(F.when(F.col(name).isNotNull() & F.col(name).try_cast(to).isNull(), 1)).alias("n_rejected"),
    ) for name, to in columns.items()]
    return _as_rows(df, counts)


def _as_rows(df: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """One pass of aggregates, one output row per struct."""
    named = [s.alias(f"_s{i}") for i, s in enumerate(structs)]
    return df.agg(*named).select(F.inline(F.array(*[F.col(f"_s{i}") for i in range(len(named))])))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    found = [
        df.groupBy(_q(key)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(
            F.lit(key).alias("key_column"), _q(key).cast("string").alias("key_value"), "n")
        for key in keys
    ]
    return reduce(DataFrame.unionByName, found)


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations per rule, all rules in one pass; a NULL counts as a violation."""
    broken = [F.struct(
        F.lit(rule.name).alias("rule"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(~F.coalesce(F.expr(rule.predicate), F.lit(False)), 1)).alias("n_violations"),
    ) for rule in rules]
    return _as_rows(df, broken)


def split_rejects(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy all rules, and the others with the names of the rules they break."""
    broken = F.array_compact(F.array(*[
        F.when(~F.coalesce(F.expr(rule.predicate), F.lit(False)), rule.name) for rule in rules
    ]))
    marked = df.withColumn("broken_rules", broken)
    return (marked.where(F.size("broken_rules") == 0).drop("broken_rules"),
            marked.where(F.size("broken_rules") > 0))


def foreign_key_report(tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey]) -> DataFrame:
    """Rows and orphans per foreign key; NULL references are allowed.

    References are counted per value before they meet the parent, so a parent most rows point at is
    one row on its way to the join.
    """
    reports = []
    for key in keys:
        references = tables[key.child].where(_q(key.column).isNotNull()).groupBy(
            _q(key.column).alias("_ref")).agg(F.count(F.lit(1)).alias("_n"))
        parents = tables[key.parent].select(_q(key.parent_column).alias("_ref")).distinct().withColumn(
            "_known", F.lit(1))
        reports.append(references.join(parents, "_ref", "left").agg(
            F.lit(key.name).alias("foreign_key"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0)).alias("n_orphans"),
        ))
    return reduce(DataFrame.unionByName, reports)


def orphans(tables: Mapping[str, DataFrame], key: ForeignKey) -> DataFrame:
    """The child rows that break a foreign key."""
    parent = tables[key.parent].select(_q(key.parent_column).alias(key.column))
    return tables[key.child].where(_q(key.column).isNotNull()).join(parent, key.column, "left_anti")


def label_consistency(clean: DataFrame) -> DataFrame:
    """Counts of rows whose target and flags disagree, and of rows with several flags."""
    failed, flags = F.col("machine_failure") == 1, mode_count()
    return clean.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(any_mode() != F.col("machine_failure"), 1)).alias("inconsistent"),
        F.count(F.when(failed & (flags == 0), 1)).alias("failure_without_mode"),
        F.count(F.when(~failed & (flags > 0), 1)).alias("mode_without_failure"),
        F.count(F.when(flags > 1, 1)).alias("multi_mode"),
    )


def inconsistent_rows(clean: DataFrame) -> DataFrame:
    return clean.where(any_mode() != F.col("machine_failure")).select(
        "machine_id", "type_code", "machine_failure", *K.MODES)


def unique_key_report(tables: Mapping[str, DataFrame], keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Per declared unique key: rows, and rows beyond the first of their value."""
    reports = []
    for table, column in keys:
        per_value = tables[table].groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        reports.append(per_value.agg(
            F.lit(f"{table}.{column}").alias("unique_key"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_repeated")))
    return reduce(DataFrame.unionByName, reports)


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing values per column with their share in percent, three decimals."""
    counts = [F.struct(
        F.lit(name).alias("column_name"),
        F.count(F.when(_q(name).isNull(), 1)).alias("missing_count"),
        F.count(F.lit(1)).alias("_n"),
    ) for name in df.columns]
    return _as_rows(df, counts).select(
        "column_name", "missing_count", percent("missing_count", "_n", 3).alias("missing_pct"))


def id_profile(clean: DataFrame, ids: Sequence[str] = ("machine_id",)) -> DataFrame:
    """Range, distinct count, largest repeat count and contiguity of integer ids, without sorting them."""
    reports = []
    for name in ids:
        per_id = clean.groupBy(_q(name).alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
        reports.append(per_id.agg(
            F.lit(name).alias("id_column"),
            F.min("_id").alias("min_id"), F.max("_id").alias("max_id"),
            F.count(F.lit(1)).alias("n_unique"), F.sum("_n").alias("n_rows"),
            F.max("_n").alias("max_repeats"),
            (F.max("_id") - F.min("_id") + 1 == F.count(F.lit(1))).cast("int").alias("contiguous"),
        ))
    return reduce(DataFrame.unionByName, reports)


def prefix_agreement(clean: DataFrame) -> DataFrame:
    """Share of rows whose product id starts with their type letter."""
    same = F.count(F.when(F.substring("product_id", 1, 1) == F.col("type_code"), 1))
    return clean.agg(same.alias("n_match"), F.count(F.lit(1)).alias("n_rows")).withColumn(
        "match_pct", percent("n_match", "n_rows", 1))


def binary_values(clean: DataFrame) -> DataFrame:
    """The distinct values of the target and the flags."""
    names = ["machine_failure", *K.MODES]
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("value")) for n in names])
    return clean.select(F.inline(pairs)).distinct()


def leakage_agreement(clean: DataFrame) -> DataFrame:
    """Share of rows in which "any flag set" already equals the target."""
    same = F.count(F.when(any_mode() == F.col("machine_failure"), 1))
    return clean.agg(same.alias("n_agree"), F.count(F.lit(1)).alias("n_rows")).withColumn(
        "agreement_pct", percent("n_agree", "n_rows"))


def clean_observations(raw: DataFrame, dedupe: bool = True) -> DataFrame:
    """Rename, remove exact copies, and stop on any broken rule or repeated key.

    The rule check is one pass and the key checks one grouping each; they run here, as the stop must
    come before anything is written.
    """
    require_columns(raw, [*K.RAW_TO_CLEAN, *K.MODES])
    clean = rename_raw(raw)
    clean = drop_copies(clean) if dedupe else clean
    broken = rule_report(clean, [*DOMAIN_RULES, *RANGE_RULES]).where("n_violations > 0").collect()
    repeated = key_violations(clean, ID_COLUMNS).groupBy("key_column").count().collect()
    if broken or repeated:
        raise ValidationFailed(str([r.asDict() for r in [*broken, *repeated]]))
    return clean
