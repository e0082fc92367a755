"""Whitening of embeddings with Spark MLlib's block matrices.

Each entry c counts as x = floor(64 * c) + 1000000, so sums and deviations are exact. Rows are
written as blocks: ids, exact deviations and x of up to as many rows as ``rows_per_block`` says, numbered so that no
shuffle is needed; the last block of a task is filled up with rows of zeros, which add nothing. Their centred
rows form a ``BlockMatrix``. Its transpose times itself is the scatter, whose blocks are dealt out along
the middle dimension, so no task multiplies more than a few; the local scatter has as many rows
and columns as a vector has entries. Its eigenvectors over the roots of their eigenvalues are a small block matrix, by which the
first is multiplied. The covariance of the outcome is measured again from its rows.

Covariances divide by the number of rows. Components are numbered from 1 by falling eigenvalue. One whose
eigenvalue is below ``LEAST_SHARE`` of the largest has no variance to scale and is not returned.

Defined cases: rows whose vector is null, empty, or holds a null or non-finite entry are dropped, as are rows
whose vector is not as long as most are (of equally many, the longer). A null vec_id is
kept; repeated rows each count and each give their rows. An entry is held within 2**40 either way, and a
deviation that no 64-bit integer holds is null. An empty table, one row, or equal rows give no
rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import stored

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0 ** 40
LEAST_SHARE = 1e-10
#: Blocks multiplied by one task of the scatter, about.
BLOCKS_PER_TASK = 8
OUT_ROWS = 1024

OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_vectors(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, x) of the rows that remain, x an array of longs, and its length."""
    number = F.col("embedding")
    fine = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(
        number.isNotNull() & (F.size(number) > 0)
        & F.forall(number, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    )
    most = fine.groupBy(F.size("embedding").alias("width")).count().orderBy(F.col("count").desc(), F.col("width").desc()).first()
    width = most["width"] if most else 0
    x = F.transform(number, lambda c: F.floor(SCALE * F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST))).cast("long") + SHIFT)
    return fine.where(F.size("embedding") == width).select("vec_id", x.alias("x")), width


def totals(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of rows and the sums of their entries."""
    found = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect()
    sums = {r["at"]: int(r["s"]) for r in found}  # as many rows as a vector has entries
    return (found[0]["n"] if found else 0), [sums[i] for i in range(width)] if found else []


def rows_per_block(n: int) -> int:
    """Large enough for few blocks, as their places are listed on the driver; small enough for a task."""
    return min(65_536, max(256, -(-n // 20_000)))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of (n * x - S) ** 2 of each row, exactly."""
    reach = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    if n * reach < 2**62 and max(map(abs, sums), default=0) < 2**62:
        gaps = n * x - np.array(sums, np.int64)
        if int(np.abs(gaps).max(initial=0)) ** 2 * x.shape[1] < 2**63:
            return (gaps * gaps).sum(axis=1).tolist()
    whole = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return [v if v < 2**63 else None for v in whole]


def blocked(rows: DataFrame, n: int, sums: list[int], size: int) -> DataFrame:
    """(block, vec_ids, deviations, x): numbered blocks of at most ``size`` rows, x by row."""
    width = len(sums)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        ids: list = []
        held: list[np.ndarray] = []

        def ended(last: int) -> pa.RecordBatch:
            x = np.concatenate(held)
            row, rest = x[:last], x[last:]
            out = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int64()), "place": pa.array([place], pa.int64()), "vec_ids": pa.array([ids[:last]], pa.list_(pa.int64())),
                "deviations": pa.array([deviations(row, n, sums)], pa.list_(pa.int64())), "x": pa.array([row.ravel()], pa.list_(pa.int64()))})
            ids[:], held[:] = ids[last:], [rest] if len(rest) else []
            return out

        for batch in batches:
            if batch.num_rows:
                ids += batch.column(0).to_pylist()
                held.append(batch.column(1).flatten().to_numpy().reshape(-1, width))
            while len(ids) >= size:
                yield ended(size)
                place += 1
        if ids:
            yield ended(len(ids))

    kept, _ = stored(rows.select("vec_id", "x").mapInArrow(blocks, "part long, place long, vec_ids array<long>, deviations array<long>, x array<long>"), "vector-blocks")
    parts = kept.agg(F.max("part")).first()[0] or 0
    return kept.select((F.col("place") * (parts + 1) + F.col("part")).cast("int").alias("block"), "vec_ids", "deviations", "x")


def centred(blocks: DataFrame, n: int, sums: list[int], size: int) -> BlockMatrix:
    """The centred rows as a matrix of blocks; rows that fill up a block are zeros."""
    mean = np.array([s / n for s in sums])
    last = blocks.agg(F.max("block")).first()[0] or 0

    def dense(part) -> Iterator:
        for row in part:
            x = np.frombuffer(row["x"], "<i8").reshape(-1, len(mean))
            full = np.zeros((size, len(mean)))
            full[:len(x)] = x - mean
            yield (row["block"], 0), DenseMatrix(size, len(mean), full.ravel(order="F"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = [batch.column(1)[i].values.to_numpy().astype("<i8").tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(flat, pa.binary())], names=["block", "x"])

    rdd: RDD = blocks.select("block", "x").mapInArrow(packed, "block int, x binary").rdd.mapPartitions(dense)
    return BlockMatrix(rdd, size, len(mean), (last + 1) * size, len(mean)).persist(StorageLevel.MEMORY_AND_DISK)


def scatter(matrix: BlockMatrix, n_blocks: int) -> np.ndarray:
    """The transpose times the matrix. The number of splits of the middle dimension is an argument that the
    Python class does not name, so it goes to the class it wraps."""
    wrapped = matrix.transpose()._java_matrix_wrapper
    product = wrapped.call("multiply", matrix._java_matrix_wrapper._java_model, max(1, -(-n_blocks // BLOCKS_PER_TASK)))
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


@dataclass
class Components:
    """Unit eigenvectors by falling eigenvalue, as columns."""

    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    @classmethod
    def of(cls, covariance: np.ndarray, most: int = COMPONENTS) -> Components:
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        order = np.argsort(-values, kind="stable")[:most]
        order = order[values[order] > LEAST_SHARE * max(values.max(initial=0), 0)]
        return cls(vectors[:, order], values[order], values[order] / np.trace(covariance) if len(order) else values[order])

    @property
    def whitener(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def projected(spark, matrix: BlockMatrix, whitener: np.ndarray) -> DataFrame:
    """(block, whitened): the matrix times the whitener, each block's values by row."""
    width, k = whitener.shape
    small = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(width, k, whitener.ravel(order="F")))], 1), width, k, width, k)
    product = matrix.multiply(small).blocks.map(lambda block: (block[0][0], bytearray(np.ascontiguousarray(block[1].toArray(), "<f8").tobytes())))
    return spark.createDataFrame(product, "block int, whitened binary")


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """The largest absolute entry of the covariance of the whitened rows minus the identity."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for data in batch["whitened"]:
                rows = np.frombuffer(data, "<f8").reshape(-1, k)
                total[:k] += rows.T @ rows
                total[k] += rows.sum(axis=0)
        yield pd.DataFrame({"at": np.arange(total.size), "value": total.ravel()})

    found = whitened.select("whitened").mapInPandas(sums, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((k + 1) * k)
    for r in found:  # (k + 1) * k rows
        total[r["at"]] = r["value"]
    total = total.reshape(k + 1, k) / n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    rows, width = whole_vectors(vectors)
    n, sums = totals(rows, width) if width else (0, [])
    if n < 2:
        return spark.createDataFrame([], OUT)
    size = rows_per_block(n)
    blocks = blocked(rows, n, sums, size)
    matrix = centred(blocks, n, sums, size)
    found = Components.of(scatter(matrix, blocks.count()) / n, components)
    k = len(found.values)
    if not k:
        return spark.createDataFrame([], OUT)
    whitened, _ = stored(projected(spark, matrix, found.whitener), "whitened-blocks")
    error, explained = identity_error(whitened, n, k), found.explained

    def unfolded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, gaps = batch.column(0)[i].values, batch.column(1)[i].values
                values = np.frombuffer(batch.column(2)[i].as_py(), "<f8").reshape(-1, k)
                for start in range(0, len(ids), OUT_ROWS):
                    own = np.repeat(np.arange(start, min(start + OUT_ROWS, len(ids))), k)
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(own)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(own) // k)), pa.array(np.full(len(own), n, np.int64)),
                        gaps.take(pa.array(own)), pa.array(values[start:start + OUT_ROWS][:len(own) // k].ravel()), pa.array(np.tile(explained, len(own) // k)),
                        pa.array(np.full(len(own), error))], names=[c.split(" ")[0] for c in OUT.split(", ")])

    return blocks.select("block", "vec_ids", "deviations").join(whitened, "block").select("vec_ids", "deviations", "whitened").mapInArrow(unfolded, OUT)
