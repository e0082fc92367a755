"""Exact nearest vectors through a pivot index.

Rows are grouped by their nearest pivot and written in the order of the groups. A group's angles
to its pivot lie between two known ones, so by the triangle inequality of angles no row of it can be closer to
a query than the query's own angle to the pivot allows. A search reads each query's nearest groups
first; of the others it reads those alone whose bound reaches the query's k-th best score.

Pivots are at most ``MAX_PIVOTS`` rows of the corpus (those whose ids hash least); every row is indexed
and every result exact. Queries are taken in blocks. A zero vector scores 0 with everything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.operators.evaluation import ranked_within
from millwright.session import scratch_path

MAX_PIVOTS = 1024
QUERY_BLOCK = 4096  # search vectors held by every task at once: at 384 numbers each, 12 MB
SCORE_DIGITS = 9
#: Beyond the error of angles and of rounded scores.
SLACK = 1e-7


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length one; zeros stay."""
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(lengths == 0, 1.0, lengths)


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("float64")


def best_rows(query: np.ndarray, score: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores of each query, ties by key."""
    order = np.lexsort((key, -score, query))
    named = query[order]
    starts = np.flatnonzero(np.r_[True, named[1:] != named[:-1]]) if len(named) else np.zeros(0, int)
    place = np.arange(len(named)) - np.repeat(starts, np.diff(np.r_[starts, len(named)]))
    return order[place < k]


def candidates(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, query) places of all scores at or above each query's k-th best; ``scores`` is rows by queries."""
    if len(scores) <= k:
        return tuple(a.ravel() for a in np.indices(scores.shape))
    return np.nonzero(scores >= np.partition(scores, len(scores) - k, axis=0)[len(scores) - k])


@dataclass
class PivotIndex:
    """The grouped rows (uid, embedding, group) and, per group, its pivot, angles and size."""

    rows: DataFrame
    uid: str
    pivots: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sizes: np.ndarray

    @classmethod
    def build(cls, corpus: DataFrame, uid: str = "vec_id", vector: str = "embedding", pivots: int | None = None) -> PivotIndex:
        spark = corpus.sparkSession
        wanted = pivots or min(MAX_PIVOTS, max(1, ceil(sqrt(corpus.count()))))
        held = corpus.select(F.col(uid).alias("uid"), F.col(vector).cast("array<double>").alias("embedding"))
        chosen = held.orderBy(F.xxhash64("uid"), "uid").limit(wanted).collect()  # at most MAX_PIVOTS rows
        if not chosen:
            return cls(held.withColumn("group", F.lit(0)), uid, np.zeros((0, 0)), np.zeros(0), np.zeros(0), np.zeros(0, int))
        points = unit(np.array([r["embedding"] for r in chosen], float))
        shared = spark.sparkContext.broadcast(points)

        def grouped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    near = unit(matrix(batch["embedding"])) @ shared.value.T
                    group = near.argmax(axis=1)
                    angle = np.arccos(np.clip(near[np.arange(len(group)), group], -1, 1))
                    yield batch.assign(group=group.astype("int32"), angle=angle)

        path = scratch_path(spark, "pivot-index")
        # a group of most rows is split by id; files and row groups hold few groups, so a filter on them skips the rest
        found = held.mapInPandas(grouped, f"uid {held.schema['uid'].dataType.simpleString()}, embedding array<double>, group int, angle double")
        found.repartitionByRange("group", "uid").sortWithinPartitions("group").write.parquet(path)
        rows = spark.read.parquet(path)
        low, high, sizes = np.zeros(len(points)), np.zeros(len(points)), np.zeros(len(points), int)
        for r in rows.groupBy("group").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count(F.lit(1)).alias("n")).collect():
            low[r["group"]], high[r["group"]], sizes[r["group"]] = r["low"], r["high"], r["n"]  # one row per pivot
        return cls(rows.select("uid", "embedding", "group"), uid, points, low, high, sizes)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The best score each query (at length one) can have in each group."""
        angle = np.arccos(np.clip(queries @ self.pivots.T, -1, 1))
        gap = np.maximum(0, np.maximum(angle - self.high, self.low - angle))
        best = np.cos(gap) + SLACK
        best[~queries.any(axis=1)] = SLACK  # a zero vector scores 0
        zero = ~self.pivots.any(axis=1)
        best[:, zero] = 1 + SLACK  # rows no pivot points to may point anywhere
        return np.where(self.sizes > 0, best, -2.0)

    def _probe(self, queries: np.ndarray, pairs: np.ndarray, k: int) -> DataFrame:
        """(query, uid, score): each task's k best per query among the groups that ``pairs`` (queries by groups) marks."""
        groups = np.flatnonzero(pairs.any(axis=0)).tolist()
        shared = self.rows.sparkSession.sparkContext.broadcast((queries, {g: np.flatnonzero(pairs[:, g]) for g in groups}))
        kind = self.rows.schema["uid"].dataType.simpleString()

        def probed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            q, asked = shared.value
            kept = (np.zeros(0, "int64"), np.zeros(0), np.zeros(0, "int64"))
            for batch in batches:
                if not len(batch):
                    continue
                rows, keys, group = unit(matrix(batch["embedding"])), batch["uid"].to_numpy(), batch["group"].to_numpy()
                order = np.argsort(group, kind="stable")
                parts = [kept]
                for own in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
                    which = asked[group[own[0]]]
                    scores = np.round(rows[own] @ q[which].T, SCORE_DIGITS)
                    row, query = candidates(scores, k)
                    parts.append((which[query], scores[row, query], keys[own][row]))
                whole = [np.concatenate(c) for c in zip(*parts)]
                best = best_rows(whole[0], whole[1], whole[2], k)
                kept = tuple(c[best] for c in whole)
            yield pd.DataFrame({"query": kept[0], "uid": kept[2], "score": kept[1]})

        return self.rows.where(F.col("group").isin(groups)).mapInPandas(probed, f"query long, uid {kind}, score double")

    def _block(self, queries: np.ndarray, k: int) -> tuple[DataFrame, int]:
        """The results of one block of queries, and how many (query, row) pairs were scored."""
        points = unit(queries)
        bounds = self.bounds(points)
        order = np.argsort(-bounds, axis=1, kind="stable")
        # the first groups that hold k rows together
        before = np.cumsum(self.sizes[order], axis=1) - self.sizes[order]
        first = np.zeros(bounds.shape, bool)
        np.put_along_axis(first, order, (before < k) & (self.sizes[order] > 0), axis=1)
        path = scratch_path(self.rows.sparkSession, "nearest-groups")
        self._probe(points, first, k).write.parquet(path)
        near = self.rows.sparkSession.read.parquet(path)
        bar = np.full(len(points), -2.0)
        ranked = ranked_within(near, ["query"], [F.col("score").desc(), F.col("uid")], k)
        for r in ranked.where(F.col("rank") == k).select("query", "score").collect():  # one row per query of the block
            bar[r["query"]] = r["score"]
        second = (bounds >= bar[:, None]) & ~first & (self.sizes > 0)
        scored = int(((first | second) * self.sizes).sum())
        return (near.union(self._probe(points, second, k)) if second.any() else near), scored

    def search(self, queries: DataFrame, k: int = 3, query_id: str = "query_id", vector: str = "embedding") -> DataFrame:
        """(query_id, uid, score, rank): the ``k`` most cosine-similar rows of each query; ties by id."""
        return self.search_counted(queries, k, query_id, vector)[0]

    def search_counted(self, queries: DataFrame, k: int = 3, query_id: str = "query_id", vector: str = "embedding") -> tuple[DataFrame, float]:
        """The search, and the share of (query, row) pairs that no task had to score."""
        spark = queries.sparkSession
        kind, uid_kind = queries.schema[query_id].dataType.simpleString(), self.rows.schema["uid"].dataType.simpleString()
        n = queries.count()
        blocks = max(1, -(-n // QUERY_BLOCK))
        found, scored = [], 0
        for block in range(blocks):
            part = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64(query_id), F.lit(blocks)) == block)
            held = part.select(query_id, F.col(vector).cast("array<double>").alias("embedding")).collect()  # one block
            if held and len(self.pivots):
                hits, pairs = self._block(np.array([r["embedding"] for r in held], float), k)
                names = spark.createDataFrame([(i, r[query_id]) for i, r in enumerate(held)], f"query long, {query_id} {kind}")
                found.append(hits.join(names, "query").select(query_id, F.col("uid").alias(self.uid), "score"))
                scored += pairs
        if not found:
            return spark.createDataFrame([], f"{query_id} {kind}, {self.uid} {uid_kind}, score double, rank int"), 0.0
        ranked = ranked_within(reduce(DataFrame.union, found), [query_id], [F.col("score").desc(), F.col(self.uid)], k)
        return ranked, 1 - scored / (n * int(self.sizes.sum()))
