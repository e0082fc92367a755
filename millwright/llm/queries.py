"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import decontamination, html_text, langid, lexical, line_crf, line_dedup, line_rules, packing, rans, secrets, sharding, simhash, whitening
from millwright.llm.common import table
from millwright.session import scratch_path


def vocabulary() -> str:
    return tokenizer_path("word_bpe_49k.json")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = rans.encode_corpus(table(spark, sf_dir, "documents"), vocabulary(), scratch_path(spark, "token-files"))
    pieces = rans.decode_corpus(spark, folder).select("part", "ordinal", "piece", "doc_id", "start", F.length("ids").cast("long").alias("bytes"), F.crc32("ids").alias("crc"))
    join_crc = F.udf(lambda rows: rows and rans.joined_crc32([(r["crc"], r["bytes"]) for r in rows]), "long")
    whole = pieces.groupBy("part", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("bytes").alias("bytes"), F.min("crc").alias("crc"),
        F.sort_array(F.collect_list(F.struct("piece", "crc", "bytes"))).alias("pieces"),
    )
    several = F.size("pieces") > 1  # of one piece nothing travels to Python
    crc = F.when(several, join_crc(F.when(several, F.col("pieces")))).otherwise(F.col("crc"))
    return whole.select("doc_id", "start", (F.col("bytes") / 4).cast("long").alias("n_tokens"), crc.alias("ids_crc32"))


def op2_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    live = F.transform("live", lambda s: F.struct(F.lit(secrets.KINDS.index("live")).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    counts = [secrets.n_of_kind(F.col("spans"), kind).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS[:3]]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.span_list(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
        secrets.span_list(F.concat("spans", live)).alias("spans"), F.size("live").cast("long").alias("n_live"), "n_copied",
    )


def op4_line_first_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.judge_documents(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_failed_lines", "lost_chars")


def op5_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = line_crf.scored(docs, line_crf.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", line_crf.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= line_crf.THRESHOLD).cast("int").alias("predicted"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "first_token")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def packed_digest(docs: DataFrame) -> DataFrame:
    pieces = packing.cut_documents(docs, vocabulary()).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    placed = packing.pack(pieces)
    return placed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(table(spark, sf_dir, "documents"))


def op10_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_word_first_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predicted(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op12_block_matrix_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_hybrid_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_files, op2_label_propagation_shards, op3_secret_ownership, op4_line_first_rules, op5_quality_crf, op6_simhash_near_dedup,
        op7_benchmark_decontamination, op8_line_dedup, op9_best_fit_packing, op10_html_blocks, op11_word_first_backoff, op12_block_matrix_whitening, op13_hybrid_lexical_search,
    )
}
