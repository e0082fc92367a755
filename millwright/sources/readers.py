"""Readers: raw files, text folders, tables, model metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.sources.schemas import RAW

CORRUPT = "_corrupt_record"


def read_raw(spark: SparkSession, path: str, fmt: str = "csv", mode: str = "PERMISSIVE") -> DataFrame:
    """Raw observations under the declared schema; never inferred.

    Unreadable CSV lines are kept in ``_corrupt_record`` unless ``mode`` is FAILFAST.
    """
    if fmt == "csv":
        # The reader fills unreadable fields with NULL, so nullability is left to the rules.
        fields = [T.StructField(f.name, f.dataType, True) for f in RAW.fields]
        schema = T.StructType(fields + ([T.StructField(CORRUPT, T.StringType(), True)] if mode == "PERMISSIVE" else []))
        reader = spark.read.schema(schema).option("header", True).option("mode", mode)
        return reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    if fmt in ("parquet", "orc", "json"):
        return spark.read.schema(RAW).format(fmt).load(path)
    raise ValueError(f"unknown format {fmt!r}")


def good_lines(raw: DataFrame) -> DataFrame:
    return raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in raw.columns else raw


def bad_lines(raw: DataFrame) -> DataFrame:
    return raw.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_text_folder(spark: SparkSession, folder: str, glob: str = "*.txt") -> DataFrame:
    """Every matching file below ``folder`` as one row: its path and whole text."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    return files.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents delivered as a table."""
    return spark.read.parquet(path)


METADATA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("best_params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("feature_names", T.ArrayType(T.StringType())),
    T.StructField("val_metrics", T.MapType(T.StringType(), T.StringType())),
])


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Model metadata: one row with the ordered feature names."""
    return spark.read.schema(METADATA).option("multiLine", True).json(path)


def read_feature_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
