"""Ranked lexical search: a hybrid of term-at-a-time and document-at-a-time evaluation.

Documents stay where they are. Each task cuts its documents into shards of at most ``SHARD``
documents, and writes per shard the posting lists of the terms that the queries hold: documents in
order and how often each holds the term. Counts over all shards give the weights.

A query meets a shard in two steps. Its short lists are summed term at a time into accumulators. The
accumulators then stand as one more list beside the long ones, with a bound like theirs, and
documents are read in order: a range of documents whose bounds together stay below the score of the
k-th best is skipped. In a range that is read, lists with the highest bounds are read whole; the
others are only looked up for documents that can still reach that score. The best of a task's
shards raise the bar for its later shards; only the best of each task are merged.

A term's weight is floor(1000 * ln((2 * N + 2) / (2 * df + 1))), and a document's score the sum of
weight * ((1000000000 * tf) div (1000 * tf + 8 * m)) with m = 25 + (75 * n * N) div L, over the terms
of the query with repeats; all in 64-bit integers, as stated for ``op13``.

Queries are taken in blocks of at most ``BLOCK_BYTES`` of text (and at least one query), against all
documents each: the vocabulary and the queries of one block are what a task is sent.

Defined cases: a null or empty text has no term and is no document of N; rows that repeat a doc_id
are documents of their own; equal scores go by ascending doc_id, null ids last; rows that repeat a
query's id and text count once, other texts under the same id are queries of their own; a query
without a term, or whose terms no document holds, or whose terms all weigh nothing gives no row.
Empty tables give none. Extra columns are not read. A long text is read in pieces cut between terms.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.common import stored, whole_text

TOP = 10
SHARD = 8192
#: Found terms after which a shard ends.
SHARD_TERMS = 4_000_000
#: Documents of a range, for which each list has a bound.
RANGE = 512
#: A list of at most this share of a shard's documents is short.
SHORT_SHARE = 16
BLOCK_BYTES = 32_000_000
PIECE_BYTES = 4_000_000

#: Every byte of a term as it counts, every other one a blank: A-Z are lowered, bytes from x80 belong to letters beyond ASCII.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

INDEX = "doc_ids array<long>, lengths array<long>, n_docs long, n_terms long, terms array<int>, counts array<int>, docs array<int>, tfs array<int>"


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, in pieces of bounded size."""
    data = text.encode().translate(TERM_BYTES)
    start = 0
    while start < len(data):
        end = start + PIECE_BYTES
        end = len(data) if end >= len(data) else data.find(b" ", end)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def _shard(doc_ids: list, lengths: list[int], numbers: list[np.ndarray]) -> dict:
    """One row of the index: the posting lists of one shard."""
    owner = np.repeat(np.arange(len(numbers), dtype=np.int64), [len(n) for n in numbers])
    found = np.concatenate(numbers).astype(np.int64)
    pairs, tfs = np.unique(found * SHARD + owner, return_counts=True)
    terms, counts = np.unique(pairs // SHARD, return_counts=True)
    return {
        "doc_ids": doc_ids, "lengths": lengths, "n_docs": sum(n > 0 for n in lengths), "n_terms": sum(lengths),
        "terms": terms.astype(np.int32), "counts": counts.astype(np.int32), "docs": (pairs % SHARD).astype(np.int32), "tfs": tfs.astype(np.int32),
    }


def build_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """The posting lists of the terms in ``vocabulary``, one row per shard of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = [("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("n_docs", pa.int64()), ("n_terms", pa.int64()),
             *[(name, pa.list_(pa.int32())) for name in ("terms", "counts", "docs", "tfs")]]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        ids: list = []
        lengths: list[int] = []
        numbers: list[np.ndarray] = []
        held = 0

        def ended() -> pa.RecordBatch:
            row = _shard(ids, lengths, numbers)
            return pa.RecordBatch.from_arrays([pa.array([row[name]], kind) for name, kind in names], schema=pa.schema(names))

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, own = 0, []
                for piece in terms_of(text.as_py()):
                    n += len(piece)
                    own += [x for x in map(number, piece) if x is not None]
                ids.append(doc_id)
                lengths.append(n)
                numbers.append(np.array(own, np.int32))
                held += len(own)
                if len(ids) == SHARD or held >= SHARD_TERMS:
                    yield ended()
                    ids, lengths, numbers, held = [], [], [], 0
        if ids:
            yield ended()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(shards, INDEX)


def weight(documents: int, df: int) -> int:
    """The weight of a term that ``df`` of ``documents`` hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def normaliser(lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """m of documents with ``lengths`` terms; exact beyond 64 bits too."""
    if len(lengths) and 75 * int(lengths.max()) * documents >= 2**63:
        return np.array([25 + 75 * int(n) * documents // terms for n in lengths], np.int64)
    return 25 + 75 * lengths * documents // max(terms, 1)


@dataclass
class PostingList:
    """One term's documents in a shard, and what each adds per unit of weight."""

    docs: np.ndarray
    parts: np.ndarray
    edges: np.ndarray  # where each range begins
    bounds: np.ndarray  # the largest part in each range

    @classmethod
    def of(cls, docs: np.ndarray, parts: np.ndarray, n_ranges: int) -> PostingList:
        edges = np.searchsorted(docs, np.arange(n_ranges + 1) * RANGE)
        bounds = np.zeros(n_ranges, np.int64)
        full = edges[:-1] < edges[1:]
        if full.any():
            bounds[full] = np.maximum.reduceat(parts, edges[:-1][full])
        return cls(docs, parts, edges, bounds)


class Shard:
    """The posting lists of a shard, by term."""

    def __init__(self, row: dict, documents: int, terms: int):
        self.doc_ids = row["doc_ids"]
        self.size = len(self.doc_ids)
        self.n_ranges = -(-self.size // RANGE)
        tfs, docs = row["tfs"].astype(np.int64), row["docs"]
        m = normaliser(row["lengths"], documents, terms)
        self.parts = 1_000_000_000 * tfs // (1000 * tfs + 8 * m[docs])
        self.docs = docs
        ends = np.cumsum(row["counts"])
        self.places = {int(t): (int(e - c), int(e)) for t, c, e in zip(row["terms"], row["counts"], ends)}
        self.lists: dict[int, PostingList] = {}

    def postings(self, term: int) -> PostingList:
        if term not in self.lists:
            start, end = self.places[term]
            self.lists[term] = PostingList.of(self.docs[start:end], self.parts[start:end], self.n_ranges)
        return self.lists[term]


class Best:
    """The k best of one query so far, over the shards of a task."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def bar(self) -> int:
        """The least score that can still be listed."""
        return max(1, -self.rows[-1][0]) if len(self.rows) == self.k else 1

    def offer(self, doc_ids: list, scores: np.ndarray) -> None:
        new = [(-int(s), d is None, d if d is not None else 0) for d, s in zip(doc_ids, scores)]
        self.rows = sorted(self.rows + new)[: self.k]


def search_shard(shard: Shard, query: list[tuple[int, int]], best: Best) -> int:
    """Offer to ``best`` the documents of the shard that score high for (term, weight) pairs; the number of ranges read."""
    held = [(w, shard.places[t], t) for t, w in query if t in shard.places]
    if not held:
        return 0
    short = shard.size // SHORT_SHARE
    sums = np.zeros(shard.size, np.int64)  # the accumulators
    long: list[tuple[int, PostingList]] = []
    for w, (start, end), term in held:
        if end - start <= short:
            sums[shard.docs[start:end]] += w * shard.parts[start:end]
        else:
            long.append((w, shard.postings(term)))
    starts = np.arange(shard.n_ranges) * RANGE
    summed = np.maximum.reduceat(sums, starts)  # the accumulators' bound in each range
    bounds = np.array([w * p.bounds for w, p in long], np.int64).reshape(len(long), shard.n_ranges)
    reach = summed + bounds.sum(axis=0)
    read = 0
    for r in np.flatnonzero(reach >= best.bar):
        bar = best.bar
        if reach[r] < bar:
            continue
        read += 1
        low, high = int(starts[r]), min(int(starts[r]) + RANGE, shard.size)
        scores = sums[low:high].copy()
        order = np.argsort(bounds[:, r], kind="stable") if long else []
        below = np.cumsum(bounds[order, r]) if long else np.zeros(0, np.int64)
        # lists that together stay below the bar name no document by themselves
        looked_up = int(np.searchsorted(below, bar, "left"))
        for i in order[looked_up:]:
            w, p = long[i]
            a, b = p.edges[r], p.edges[r + 1]
            scores[p.docs[a:b] - low] += w * p.parts[a:b]
        rest = int(below[looked_up - 1]) if looked_up else 0
        alive = np.flatnonzero(scores + rest >= bar)
        for place in range(looked_up - 1, -1, -1):
            if not len(alive):
                break
            w, p = long[order[place]]
            a, b = int(p.edges[r]), int(p.edges[r + 1])
            if a < b:
                at = a + np.searchsorted(p.docs[a:b], alive + low)
                hit = (at < b) & (p.docs[np.minimum(at, b - 1)] == alive + low)
                scores[alive[hit]] += w * p.parts[at[hit]]
            rest = int(below[place - 1]) if place else 0
            alive = alive[scores[alive] + rest >= bar]
        if len(alive):
            best.offer([shard.doc_ids[low + int(d)] for d in alive], scores[alive])
    return read


def _search(index: DataFrame, queries: list[list[tuple[int, int]]], documents: int, terms: int, k: int) -> DataFrame:
    """(number, doc_id, score): the k best of each task for each query."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        best = [Best(k) for _ in asked]
        for batch in batches:
            names = batch.schema.names
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].values.to_numpy(zero_copy_only=False) for name in names if name not in ("doc_ids",)}
                shard = Shard({**row, "doc_ids": batch.column("doc_ids")[i].as_py()}, documents, terms)
                for query, top in zip(asked, best):
                    search_shard(shard, query, top)
        out = [(number, None if null else d, -s) for number, top in enumerate(best) for s, null, d in top.rows]
        columns = [[row[j] for row in out] for j in range(3)]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["number", "doc_id", "score"])

    lists = index.select("doc_ids", "lengths", "terms", "counts", "docs", "tfs")
    return lists.mapInArrow(found, "number int, doc_id long, score long")


def _block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame | None:
    """(item_id, doc_id, score) of one block of queries: the k best of each task."""
    spark = docs.sparkSession
    asked = items.select("item_id", "text").collect()  # at most BLOCK_BYTES of text, or one query
    counted = [Counter(t for piece in terms_of(row["text"]) for t in piece) for row in asked]
    vocabulary = {term: i for i, term in enumerate(sorted(set().union(*counted)))}
    if not vocabulary:
        return None
    index, _ = stored(build_index(docs, vocabulary), "posting-lists")
    documents, terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    # one row per term of the block
    counts = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("list")).groupBy("list.terms").agg(F.sum("list.counts").alias("df")).collect()
    weights = {row["terms"]: weight(documents, row["df"]) for row in counts}
    queries = [[(vocabulary[t], times * weights[vocabulary[t]]) for t, times in c.items() if weights.get(vocabulary[t], 0) > 0] for c in counted]
    names = spark.createDataFrame(list(enumerate(row["item_id"] for row in asked)), f"number int, item_id {items.schema['item_id'].dataType.simpleString()}")
    return _search(index, queries, documents, terms, k).join(names, "number").select("number", "item_id", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents (doc_id, text) of each query (item_id, text) that score highest."""
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").alias("item_id"), whole_text().alias("text")).distinct()
    n, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, min(n, -(-size // BLOCK_BYTES)))
    out = None
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else asked
        found = _block(docs, part, k)
        if found is not None:
            found = found.withColumn("block", F.lit(block))
            out = found if out is None else out.union(found)
    kind = asked.schema["item_id"].dataType.simpleString()
    if out is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    best = Window.partitionBy("block", "number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
