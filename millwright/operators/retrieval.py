"""Text retrieval: chunking, embedding, similarity search, context for high-risk machines."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright import constants as K
from millwright.operators.evaluation import ranked_within
from millwright.operators.vector_index import QUERY_BLOCK, SCORE_DIGITS, best_rows, candidates, matrix, unit

CHUNK_SIZE, CHUNK_OVERLAP = 500, 50
CONTEXT_SEPARATOR = "\n\n"


def chunk_fixed(documents: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, uid: str = "doc_id",
                text: str = "text") -> DataFrame:
    """Windows of ``size`` characters, each starting ``size - overlap`` after the last; whole texts.

    One regular-expression pass finds all windows of a text, so the work is linear in its length. A
    last window that would lie inside the overlap is left out.
    """
    step = size - overlap
    pattern = f"(?s)(?=(.{{1,{size}}})).{{1,{step}}}"
    windows = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
    spread = documents.select(uid, F.length(text).alias("_chars"), F.posexplode(windows).alias("chunk_id", "chunk"))
    keep = F.col("chunk_id") * step < F.greatest(F.col("_chars") - overlap, F.lit(1))
    return spread.where(keep).drop("_chars")


def chunk_lines(documents: DataFrame, size: int = CHUNK_SIZE, uid: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks of whole lines: the lines that start within the same ``size`` characters of a text.

    No line is cut, so a chunk is as long as its lines; ``chunk_id`` numbers the stretches of a text.
    Lines keep their order; lines without characters belong to their stretch like any other.
    """
    lines = documents.where(F.length(text) > 0).select(uid, F.posexplode(F.split(text, "\n", -1)).alias("_place", "_line"))
    before = Window.partitionBy(uid).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("_line") + 1).over(before), F.lit(0))
    placed = lines.withColumn("chunk_id", F.floor(start / size).cast("int"))
    gathered = placed.groupBy(uid, "chunk_id").agg(F.array_sort(F.collect_list(F.struct("_place", "_line"))).alias("_lines"))
    return gathered.select(uid, "chunk_id", F.array_join(F.col("_lines")["_line"], "\n").alias("chunk"))


def chunk_separators(documents: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, uid: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """Chunks of at most ``size`` characters that end at separators, each led by the end of the piece before it.

    A text is cut into pieces of at most ``size - overlap`` characters: what is left if it fits, else up to
    the last empty line in the second half of that width, else the last line end there, else the last
    blank there, else the whole width. One pass of one expression; every character is in exactly one piece.
    """
    width = size - overlap
    half = width // 2
    pattern = f"(?s).{{1,{width}}}\\z|.{{{half - 2},{width - 2}}}\n\n|.{{{half - 1},{width - 1}}}\n|.{{{half - 1},{width - 1}}} |.{{{width}}}"
    pieces = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    held = documents.where(F.length(text) > 0).select(uid, pieces.alias("_pieces"))
    led = F.transform("_pieces", lambda piece, i: F.concat(F.when(i > 0, F.right(F.get("_pieces", i - 1), F.lit(overlap))).otherwise(""), piece))
    return held.select(uid, F.posexplode(led).alias("chunk_id", "chunk"))


def embedder(dimensions: int = 384, text: str = "chunk") -> Pipeline:
    """Hashed term weights scaled by inverse document frequency, at unit length."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_terms", pattern="[^\\p{L}\\p{N}]+"),
        HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=dimensions),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="_unit", p=2.0),
    ])


def embed(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("embedding", vector_to_array("_unit", "float32")).drop(
        "_terms", "_tf", "_tfidf", "_unit")


def prototypes(vectors: DataFrame, group: str = "label", vector: str = "embedding") -> DataFrame:
    """The mean vector of each group."""
    held = vectors.select(group, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    return held.groupBy(group).agg(vector_to_array(Summarizer.mean(F.col("_v"))).alias(vector))


def top_k(queries: DataFrame, corpus: DataFrame, k: int = 3, query_id: str = "query_id", uid: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """The ``k`` most cosine-similar corpus rows per query, exactly; ties by id.

    Queries are sent to the tasks in blocks of about ``QUERY_BLOCK``, one search per block. A task
    keeps its ``k`` best per query over its Arrow batches and returns those alone, so what is
    shuffled grows with the number of tasks and not of corpus rows.
    """
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    found = []
    for block in range(blocks):
        part = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64(query_id), F.lit(blocks)) == block)
        found.append(_best(part, corpus, k, query_id, uid, vector))
    return ranked_within(reduce(DataFrame.union, found), [query_id], [F.col("score").desc(), F.col(uid)], k)


def _best(queries: DataFrame, corpus: DataFrame, k: int, query_id: str, uid: str, vector: str) -> DataFrame:
    """Each task's ``k`` best rows of the corpus for each query of one block."""
    held = queries.select(query_id, F.col(vector).cast("array<double>").alias("_v")).collect()  # one block
    id_type = queries.schema[query_id].dataType.simpleString()
    schema = f"{query_id} {id_type}, {uid} long, score double"
    if not held:
        return corpus.sparkSession.createDataFrame([], schema)
    ids = np.array([row[0] for row in held], dtype=object)
    everywhere = corpus.sparkSession.sparkContext.broadcast((ids, unit(np.array([row[1] for row in held], dtype="float64"))))

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, q = everywhere.value
        kept = (np.zeros(0, "int64"), np.zeros(0), np.zeros(0, "int64"))
        for batch in batches:
            if len(batch):
                scores = np.round(unit(matrix(batch[vector])) @ q.T, SCORE_DIGITS)
                row, query = candidates(scores, k)
                whole = [np.concatenate(c) for c in zip(kept, (query, scores[row, query], batch[uid].to_numpy()[row]))]
                kept = tuple(c[best_rows(*whole, k)] for c in whole)
        yield pd.DataFrame({query_id: names[kept[0]], uid: kept[2], "score": kept[1]})

    return corpus.select(uid, vector).mapInPandas(best, schema)


def context(hits: DataFrame, texts: DataFrame, queries: DataFrame, query_id: str = "query_id", uid: str = "vec_id",
            text: str = "text") -> DataFrame:
    """Retrieved texts joined in rank order per query; a fixed message when nothing was found.

    ``hits`` holds at most ``k`` rows per query.
    """
    named = texts.join(hits, uid)
    joined = named.groupBy(query_id).agg(F.array_sort(F.collect_list(F.struct("rank", text))).alias("_found"))
    told = joined.select(query_id, F.array_join(F.transform("_found", lambda f: f[text]), CONTEXT_SEPARATOR).alias("context"))
    return queries.select(query_id).join(told, query_id, "left").withColumn(
        "context", F.coalesce("context", F.lit(K.NOT_FOUND)))


def risk_protocols(machines: DataFrame, protocols: DataFrame, n_rules: int) -> DataFrame:
    """For every high-risk machine the protocols of its diagnoses, in rule order, as one text.

    ``machines`` carry their risk, their status and the array ``rules`` of the rules they meet;
    ``protocols`` (rule_order, protocol) have at most one row per rule. The text of each set of rules
    is built once, so texts never travel with machines.
    """
    sets = [[r for r in range(n_rules) if chosen >> r & 1] for chosen in range(1, 2**n_rules)]
    spark = machines.sparkSession
    members = spark.createDataFrame([(rules, r) for rules in sets for r in rules], "rules array<int>, rule_order int")
    told = members.join(protocols.where(F.col("protocol").isNotNull()), "rule_order").groupBy("rules").agg(
        F.array_sort(F.collect_list(F.struct("rule_order", "protocol"))).alias("_p"))
    texts = told.select("rules", F.array_join(F.array_distinct(F.transform("_p", lambda p: p["protocol"])), CONTEXT_SEPARATOR).alias("context"))
    wanted = machines.where(F.col("status") == K.HIGH_RISK).select("machine_id", "failure_risk", "rules")
    # one row per set of rules
    return wanted.join(F.broadcast(texts), "rules", "left").select(
        "machine_id", "failure_risk", F.coalesce("context", F.lit(K.NOT_FOUND)).alias("context"))
