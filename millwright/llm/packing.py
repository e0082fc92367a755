"""Best-fit packing by minimum bin slack.

Documents become token ids with an end id; those longer than a sequence are cut into pieces of a
whole sequence, the last of which may be shorter. Pieces of one length are alike, so packing needs
only how many pieces each length has: at most ``capacity`` numbers, whatever the corpus. Bin by bin,
the largest piece left is taken and a subset-sum over the lengths left, one bit per fill, finds the
fullest combination with it; a combination is used again as long as its lengths last, since the
fullest stays the fullest while the rest shrinks. So there are about as many combinations as lengths.

Pieces find their place by their rank among the pieces of their length: a rank within the task that
cut them plus the counts of the tasks before, so no length gathers in one task.

Defined cases: a null text is empty and gives one piece, the end id. Repeated rows are separate
documents. A null doc_id stays null. An empty table gives an empty one. Extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.common import stored, whole_text
from millwright.llm.tokens import encoder

CAPACITY = 4096
PIECES = "doc_id long, piece int, start long, length int, ids binary, part int, rank long"


def binary_rows(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary array of the runs of ``flat`` that end at ``ends``, without a copy per row."""
    width = flat.dtype.itemsize
    offsets = np.concatenate([[0], ends]).astype(np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(flat).tobytes())]).cast(pa.binary())


def cut_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document with their ids (little-endian unsigned 32-bit), written once.

    ``part`` is the task that cut a piece, ``rank`` its place among the task's pieces of its length.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            numbers = batch.column(0)
            for first, ids, counts in encoder(tokenizer_path).encode(batch.column(1)):
                pieces = -(-counts // capacity)
                owner = np.repeat(np.arange(len(counts)), pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(counts[owner] - start, capacity)
                order = np.argsort(length, kind="stable")
                found, at, many = np.unique(length[order], return_index=True, return_counts=True)
                rank = np.empty(len(length), np.int64)
                rank[order] = np.arange(len(length)) - np.repeat(at, many) + np.repeat(seen[found], many)
                seen[found] += many
                yield pa.RecordBatch.from_arrays([
                    numbers.take(pa.array(first + owner)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()),
                    binary_rows(ids.astype("<u4"), np.cumsum(length)), pa.array(np.full(len(length), part), pa.int32()), pa.array(rank, pa.int64()),
                ], ["doc_id", "piece", "start", "length", "ids", "part", "rank"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return stored(rows.mapInArrow(cut, PIECES), "pieces")[0]


def combinations(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(bins, [(length, times), ...]) with lengths descending: how often to use each combination."""
    left = {length: n for length, n in counts.items() if n}
    lengths = sorted(left)
    out = []
    while lengths:
        largest = lengths[-1]
        left[largest] -= 1
        room = capacity - largest
        chosen = {largest: 1}
        # one bit per fill, large lengths first; ``steps`` keeps the fills before each item, to walk back
        # from the fullest, and a full bin ends the search
        fills, steps, limit = 1, [], (1 << (room + 1)) - 1
        for length in reversed(lengths[:bisect_right(lengths, room)]):
            many, chunk = min(left[length], room // length), 1
            while many > 0:
                chunk = min(chunk, many)
                steps.append((length, chunk, fills))
                fills |= (fills << (length * chunk)) & limit
                many -= chunk
                chunk *= 2
            if fills >> room:
                break
        fill = fills.bit_length() - 1
        for length, chunk, before in reversed(steps):
            if not before >> fill & 1:
                chosen[length] = chosen.get(length, 0) + chunk
                fill -= length * chunk
        left[largest] += 1
        bins = min(left[length] // times for length, times in chosen.items())
        out.append((bins, sorted(chosen.items(), reverse=True)))
        for length, times in chosen.items():
            left[length] -= bins * times
        lengths = [length for length in lengths if left[length]]
    return out


def _layout(plan: list, capacity: int) -> tuple[np.ndarray, ...]:
    """Per use of a length, ascending by (length, rank): key, first rank, times a bin, first bin, offset."""
    used: dict[int, int] = {}
    rows, bin_number = [], 0
    for bins, items in plan:
        offset = 0
        for length, times in items:
            rank = used.get(length, 0)
            rows.append((length, rank, times, bin_number, offset))
            used[length] = rank + times * bins
            offset += length * times
        bin_number += bins
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return tuple(columns)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` without part and rank, with sequence_id and offset.

    Needs the columns length, part and rank of ``cut_documents``; any others pass through, so a
    caller that wants a digest of the ids derives it first and spares the shuffle the ids.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    layout = spark.sparkContext.broadcast(_layout(combinations(totals, capacity), capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    names = [c for c in pieces.columns if c not in ("part", "rank")]

    @F.pandas_udf("struct<sequence_id long, offset long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, first, times, first_bin, offset = layout.value
        width = np.int64(2**44)  # ranks of one length stay below
        at = np.searchsorted(lengths * width + first, length.to_numpy(np.int64) * width + rank.to_numpy(np.int64), side="right") - 1
        inside = rank.to_numpy(np.int64) - first[at]
        return pd.DataFrame({"sequence_id": first_bin[at] + inside // times[at], "offset": offset[at] + inside % times[at] * lengths[at]})

    placed = pieces.join(before, ["length", "part"]).withColumn("placed", place(F.col("length"), F.col("before") + F.col("rank")))
    return placed.select(*names, "placed.sequence_id", "placed.offset")
