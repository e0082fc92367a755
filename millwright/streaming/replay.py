"""Row replay: delivered rows scored as a stream, labelled as a replay.

No statistic is rolled over a machine's replayed rows; a replay has no real time order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright import constants as K
from millwright.functions.columns import at_least, status_band
from millwright.operators.scoring import rule_probability
from millwright.session import scratch_path
from millwright.sources.lineitem_fleet import number_lines, observe

LABEL = "replayed rows"


def replay_source(spark: SparkSession, folder: str, files: str, files_per_trigger: int = 1) -> DataFrame:
    """The matching Parquet files of a folder as a stream, in a fixed schema."""
    schema = spark.read.option("pathGlobFilter", files).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    return reader.option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def score_rows(observations: DataFrame, threshold: float = K.DECISION_THRESHOLD) -> DataFrame:
    """Stateless scoring, the same for a batch and a stream."""
    scored = observations.withColumn("failure_probability", rule_probability(observations))
    return scored.select(
        "machine_id", "type_code", "torque_nm", "tool_wear_min", "failure_probability",
        at_least("failure_probability", threshold).alias("predicted_failure"),
        status_band("failure_probability").alias("status"))


def run_replay(stream: DataFrame, output: str, checkpoint: str) -> None:
    """Score everything available once into Parquet; a restart goes on from the checkpoint."""
    query = (score_rows(stream).writeStream.format("parquet").outputMode("append")
             .option("path", output).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def run_status_counts(stream: DataFrame, output: str, checkpoint: str) -> None:
    """Running rows per status band; each trigger replaces the table, so a retried batch changes nothing."""
    counts = score_rows(stream).groupBy("status").agg(F.count(F.lit(1)).alias("n"))

    def publish(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(output)  # one row per band

    query = (counts.writeStream.outputMode("complete").foreachBatch(publish)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def _replayed(spark: SparkSession, folder: str, run: Callable[[DataFrame, str, str], None]) -> DataFrame:
    # the feed numbers its rows once, so a replayed row has the id of the batch
    place = scratch_path(spark, "replay")
    number_lines(spark.read.parquet(f"{folder}/lineitem.parquet")).write.parquet(f"{place}/in")
    stream = observe(replay_source(spark, f"{place}/in", "*.parquet", files_per_trigger=32)).drop("p")
    run(stream, f"{place}/out", f"{place}/checkpoint")
    return spark.read.parquet(f"{place}/out")


def replay_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(spark, folder, run_replay)


def replay_status(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(spark, folder, run_status_counts)
