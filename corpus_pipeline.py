"""The corpus pipeline: documents pass through five operators, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from millwright.llm import decontamination, line_crf, line_dedup, simhash
from millwright.llm.common import stored, table, unpacked
from millwright.llm.queries import packed_digest


def low_quality_goes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of documents given here."""
    model = line_crf.fit(docs, table(spark, sf_dir, "labels"))
    good = line_crf.scored(docs, model).where(F.col("score") >= line_crf.THRESHOLD)
    return unpacked(good, docs.columns)


def shared_lines_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents share stay in one of them; every document stays."""
    return line_dedup.with_clean_text(docs)


def near_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies one document stays."""
    return simhash.one_of_each(docs)


def benchmark_passages_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontamination.without_matches(docs, table(spark, sf_dir, "benchmark"))


def sequences_filled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in packed sequences."""
    return packed_digest(docs)


STAGES = [
    ("quality_classifier", low_quality_goes),
    ("line_dedup", shared_lines_go),
    ("simhash_near_dedup", near_copies_go),
    ("benchmark_decontamination", benchmark_passages_go),
    ("best_fit_packing", sequences_filled),
]

#: Fingerprints, the classifier and the tokenizer have no SQL form; tests/llm holds the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
