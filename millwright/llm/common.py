"""Small helpers the operators share.

Every operator reads the columns it names and carries the rest of a row as one struct, so extra
columns may have any names. Column names that start with ``_`` plus a name below are made inside
such packed frames only, where nothing of the caller's stands beside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.session import scratch_path

#: White space of the texts: x20 and x09 to x0D.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """A text column, null read as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def packed(frame: DataFrame, **columns: Column) -> DataFrame:
    """``columns`` of ``frame`` and the whole row as the struct ``row``."""
    return frame.select(*[c.alias(name) for name, c in columns.items()], F.struct(*[f"`{c}`" for c in frame.columns]).alias("row"))


def unpacked(frame: DataFrame, names: list[str], replaced: dict[str, Column] | None = None) -> DataFrame:
    """The columns ``names`` of the struct ``row``, some with new values, in the old order."""
    new = replaced or {}
    return frame.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in names])


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def two_hashes(text: Column, mark: str) -> list[Column]:
    """Two 64-bit hashes of a string that fail together about once in 2**128 pairs."""
    return [F.xxhash64(text), F.xxhash64(F.concat(F.lit(mark), text))]


#: Rows of a few numbers that may go to every task.
FEW_ROWS = 100_000


def held(keys: DataFrame) -> DataFrame:
    """``keys``, a written table of a few numbers a row, as the right side of a semi or anti join whose
    left side carries texts: broadcast while it has at most ``FEW_ROWS`` rows, else hashed in each
    partition, so that texts are never sorted."""
    return F.broadcast(keys) if keys.limit(FEW_ROWS + 1).count() <= FEW_ROWS else keys.hint("shuffle_hash")


def stored(frame: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``frame`` written to a new folder under the shared one and read back, and the folder."""
    spark = frame.sparkSession
    path = scratch_path(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``stored`` made, once nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
