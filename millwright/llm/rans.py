"""Token files coded with static range asymmetric numeral systems (rANS).

A coded corpus is a folder of two Parquet tables. ``model`` holds one frequency per token id, summed
over the whole corpus, scaled to 2**``SCALE`` with at least 1 for every id that occurs: every block
shares it. ``blocks`` holds independent blocks of up to ``BLOCK`` ids in ascending doc_id order. A
block's ids are dealt in turn to ``LANES`` interleaved coders that share one stream of 32-bit words.
The states of all lanes are kept at every ``STRIDE``-th step together with the place in the stream:
checkpoints from which the parts of a block are decoded side by side. A checksum of the
whole record of a block, its words, states, checkpoints, documents and numbers, guards it; a block that fails it is an error, never wrong ids.

Defined cases: a null text is empty; each document ends with the end id, so none has no ids. Rows
that repeat a doc_id are documents of their own, ordered by a hash of their text; null ids come
first. A document longer than a block goes on in the next ones. An empty table gives a folder
without blocks. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm.common import discard, stored, whole_text
from millwright.llm.packing import binary_rows
from millwright.llm.tokens import encoder

SCALE = 20
LANES = 512
STRIDE = 256
BLOCK = 1 << 18
LOW = np.uint64(1 << 31)
HALF = np.uint64(32)

TOKENS = "part int, block int, start long, first_doc long, doc_ids array<long>, lengths array<int>, goes_on boolean, ids binary"
BLOCKS = "part int, block int, start long, n_tokens int, first_doc long, doc_ids array<long>, lengths array<int>, goes_on boolean, states binary, at array<int>, words binary, checksum long"
DOCUMENTS = "part int, ordinal long, piece int, doc_id long, start long, ids binary"


def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies that sum to 2**scale, at least 1 where a count is positive."""
    total, size = int(counts.sum()), 1 << scale
    if np.count_nonzero(counts) > size:
        raise ValueError("more token ids than the scale can tell apart")
    freq = np.where(counts > 0, np.maximum(1, counts * (size / max(total, 1))).astype(np.int64), 0)
    order = np.argsort(-freq, kind="stable")
    surplus = int(freq.sum()) - size
    for at in order if total else ():  # what rounding left over goes to or comes from the most frequent
        if surplus == 0:
            break
        take = min(surplus, int(freq[at]) - 1) if surplus > 0 else surplus
        freq[at] -= take
        surplus -= take
    return freq


class Coder:
    """Codes and decodes blocks under one table of frequencies."""

    def __init__(self, freq: np.ndarray) -> None:
        self.freq = freq.astype(np.uint64)
        self.low = (np.cumsum(freq) - freq).astype(np.uint64)
        self.most = self.freq << np.uint64(63 - SCALE)
        self.common = int(np.argmax(freq))
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(states, at, words): the lanes' states at each checkpoint, where each reads on, the stream."""
        steps = -(-len(ids) // LANES)
        rows = np.full(steps * LANES, self.common, np.int64)  # the last row is filled with the cheapest id
        rows[:len(ids)] = ids
        rows = rows.reshape(steps, LANES)
        state = np.full(LANES, LOW, np.uint64)
        states, sent = [], []
        shift = np.uint64(SCALE)
        for step in range(steps - 1, -1, -1):
            row = rows[step]
            freq = self.freq[row]
            over = state >= self.most[row]
            sent.append(state[over].astype(np.uint32))
            state = np.where(over, state >> HALF, state)
            whole = state // freq
            state = (whole << shift) + (state - whole * freq) + self.low[row]
            if step % STRIDE == 0:
                states.append(state)
        sent.reverse()
        at = np.cumsum([0, *map(len, sent)])[:-1][::STRIDE]
        return np.array(states[::-1], np.uint64).reshape(-1, LANES), at.astype(np.int32), np.concatenate(sent) if sent else np.empty(0, np.uint32)

    def decode(self, n: int, states: np.ndarray, at: np.ndarray, words: np.ndarray, parts: slice = slice(None)) -> np.ndarray:
        """The ids of a block; all checkpoints advance together. ``parts`` picks some checkpoints."""
        steps = -(-n // LANES)
        chosen = range(len(states))[parts]
        state, place = states[parts].copy(), at[parts].astype(np.int64)
        out = np.empty((len(chosen), STRIDE, LANES), np.uint32)
        mask, shift = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
        words = np.append(words, np.uint32(0)).astype(np.uint64)
        for step in range(STRIDE):
            live = sum(k * STRIDE + step < steps for k in chosen)
            if not live:
                break
            now = state[:live]
            slot = now & mask
            ids = self.slots[slot]
            out[:live, step] = ids
            now = self.freq[ids] * (now >> shift) + slot - self.low[ids]
            short = now < LOW
            order = np.cumsum(short, axis=1)
            source = np.minimum(place[:live, None] + order - 1, len(words) - 1)
            state[:live] = np.where(short, (now << HALF) | words[np.where(short, source, 0)], now)
            place[:live] += order[:, -1]
        flat = [out[i, :min(STRIDE, steps - k * STRIDE)].reshape(-1) for i, k in enumerate(chosen)]
        ids = np.concatenate(flat) if flat else np.empty(0, np.uint32)
        return ids[:n - chosen[0] * STRIDE * LANES] if flat else ids


def block_checksum(row: dict) -> int:
    """The CRC-32 of a block's record, its checksum aside."""
    numbers = [row[name] for name in ("part", "block", "start", "n_tokens", "first_doc", "goes_on")]
    ids = [(d is None, d or 0) for d in row["doc_ids"]]
    whole = 0
    for values in (numbers, [len(ids)], *zip(*ids), row["lengths"], [len(row["at"])], row["at"]):
        whole = zlib.crc32(np.asarray(values, "<i8").tobytes(), whole)
    return zlib.crc32(row["words"], zlib.crc32(row["states"], whole))


def _token_blocks(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Ids in ascending doc_id order, gathered in blocks; ``start`` counts from the part's first id."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        block, start, ordinal = 0, 0, 0
        kept: list[tuple[int | None, np.ndarray]] = []
        held = 0
        kind = np.dtype("<u2") if encoder(tokenizer_path).size <= 1 << 16 else np.dtype("<u4")

        def emit(rows: list, goes_on: bool) -> pa.RecordBatch:
            nonlocal block, start
            ids = np.concatenate([r[1] for r in rows])
            out = pa.RecordBatch.from_pylist([{
                "part": part, "block": block, "start": start, "first_doc": ordinal, "doc_ids": [r[0] for r in rows],
                "lengths": [len(r[1]) for r in rows], "goes_on": goes_on, "ids": ids.astype(kind).tobytes()}], schema=schema)
            block, start = block + 1, start + len(ids)
            return out

        schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("first_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                            ("lengths", pa.list_(pa.int32())), ("goes_on", pa.bool_()), ("ids", pa.binary())])
        for batch in batches:
            numbers = batch.column(0).to_pylist()
            for first, ids, counts in encoder(tokenizer_path).encode(batch.column(1)):
                ends = np.cumsum(counts)
                for n, (a, b) in enumerate(zip(ends - counts, ends)):
                    if kept and held + b - a > BLOCK:
                        yield emit(kept, False)
                        ordinal, kept, held = ordinal + len(kept), [], 0
                    if b - a > BLOCK:
                        for at in range(a, b, BLOCK):
                            yield emit([(numbers[first + n], ids[at:min(at + BLOCK, b)])], at > a)
                        ordinal += 1
                    else:
                        kept.append((numbers[first + n], ids[a:b]))
                        held += b - a
        if kept:
            yield emit(kept, False)

    text = whole_text()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    ordered = rows.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash").select("doc_id", "text")
    return ordered.mapInArrow(gather, TOKENS)


def encode_corpus(docs: DataFrame, tokenizer_path: str, folder: str) -> str:
    """Write ``docs`` as a coded corpus under ``folder``; returns the folder."""
    spark = docs.sparkSession
    blocks = _token_blocks(docs, tokenizer_path)
    path = f"{folder}/tokens"
    blocks.write.option("compression", "zstd").parquet(path)
    staged = spark.read.schema(blocks.schema).parquet(path)
    wide = encoder(tokenizer_path).size > 1 << 16
    kind = "<u4" if wide else "<u2"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                found = np.bincount(np.frombuffer(ids.as_buffer(), kind))
                if len(found) > len(total):
                    total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
                total[:len(found)] += found
        present = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(present, pa.int32()), pa.array(total[present], pa.int64())], ["id", "n"])

    found = staged.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # at most the vocabulary
    counts = np.zeros(max([r["id"] for r in found], default=0) + 1, np.int64)
    for r in found:
        counts[r["id"]] = r["n"]
    freq = scaled(counts)
    model = spark.createDataFrame([(int(i), int(freq[i])) for i in np.flatnonzero(freq)], "id int, frequency long")
    model.coalesce(1).write.parquet(f"{folder}/model")

    sizes = staged.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n")).orderBy("part").collect()  # one row per part
    first, total = {}, 0
    for r in sizes:
        first[r["part"]] = total
        total += r["n"]
    shared = spark.sparkContext.broadcast((freq, first))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, starts = shared.value
        coder = Coder(table)
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], kind)
                states, at, words = coder.encode(ids)
                states, words = states.astype("<u8").tobytes(), words.astype("<u4").tobytes()
                record = {**{k: row[k] for k in ("part", "block", "first_doc", "doc_ids", "lengths", "goes_on")},
                          "start": starts[row["part"]] + row["start"], "n_tokens": len(ids), "states": states, "at": at.tolist(), "words": words}
                yield pa.RecordBatch.from_pylist([{**record, "checksum": block_checksum(record)}], schema=coded)

    coded = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int32()), ("first_doc", pa.int64()),
                       ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("goes_on", pa.bool_()), ("states", pa.binary()),
                       ("at", pa.list_(pa.int32())), ("words", pa.binary()), ("checksum", pa.int64())])
    staged.mapInArrow(code, BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")
    discard(spark, path)
    return folder


def decode_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """(part, ordinal, piece, doc_id, start, ids) of a coded corpus, the ids as little-endian unsigned
    32-bit integers; a document has one row but for those longer than a block, which have one a block."""
    rows = spark.read.parquet(f"{folder}/model").collect()  # at most the vocabulary
    freq = np.zeros(max([r["id"] for r in rows], default=0) + 1, np.int64)
    for r in rows:
        freq[r["id"]] = r["frequency"]
    shared = spark.sparkContext.broadcast(freq)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                if block_checksum(row) != row["checksum"]:
                    raise ValueError(f"block {row['block']} of part {row['part']} is damaged")
                states = np.frombuffer(row["states"], "<u8").reshape(-1, LANES)
                ids = coder.decode(row["n_tokens"], states, np.array(row["at"], np.int64), np.frombuffer(row["words"], "<u4"))
                ends = np.cumsum(row["lengths"])
                n = len(ends)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, row["part"]), pa.int32()), pa.array(row["first_doc"] + np.arange(n), pa.int64()),
                    pa.array(np.full(n, row["block"] if n == 1 else 0), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["start"] + ends - row["lengths"], pa.int64()), binary_rows(ids.astype("<u4"), ends),
                ], ["part", "ordinal", "piece", "doc_id", "start", "ids"])

    return spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").mapInArrow(read, DOCUMENTS)


def joined_crc32(pieces: list[tuple[int, int]]) -> int:
    """The CRC-32 of concatenated pieces from (crc32, bytes) of each, by products modulo its polynomial."""
    def times(a: int, b: int) -> int:  # bit 31 is the coefficient of x**0
        out = 0
        while b:
            if b & 0x80000000:
                out ^= a
            b = b << 1 & 0xFFFFFFFF
            a = a >> 1 ^ (0xEDB88320 if a & 1 else 0)
        return out

    whole = 0
    for crc, size in pieces:
        power, square, bits = 0x80000000, 0x40000000, 8 * size
        while bits:
            if bits & 1:
                power = times(power, square)
            square, bits = times(square, square), bits >> 1
        whole = times(whole, power) ^ crc
    return whole
