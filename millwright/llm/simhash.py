"""SimHash near-dedup with deletion-variant signatures.

A fingerprint has 64 bits. Two that differ in at most three bits agree, in one of their two 32-bit
halves, but for at most one bit. So each half is indexed under its 32 one-wildcard variants (one bit
deleted); fingerprints are joined by equal variants and verified by their whole distance.

Copies fall together first: links run between distinct fingerprints. A bucket of the index gives a
spanning forest of its links, never all its pairs, so its output is below its size. A bucket of over
``BUCKET`` fingerprints is split again the same way on the bits it leaves free (32, then 16, then
8): after the third split at most 8 free bits and three deleted ones remain, so no bucket can exceed
2,048 distinct fingerprints, whatever the data, and no link is lost.

Defined cases: a null text is empty; a text without words has fingerprint zero, which links like any
other; a text of fewer words than a shingle is one shingle. Rows that repeat a doc_id each give a
row; a component of null ids alone has a null id. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import discard, held, packed, stored, unpacked, whole_text
from millwright.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BUCKET = 2048
BITS = 64
NO_ID = -(2**63)


def text_fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, as an unsigned integer."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and white space x20, x09-x0D only
    if not words:
        return 0
    grams = [b" ".join(g) for g in zip(*(words[i:] for i in range(shingle)))] if len(words) >= shingle else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64, len(grams))
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[start:start + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column as a signed long."""
    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            values = np.fromiter((text_fingerprint(t, shingle) for t in batch), np.uint64, len(batch))
            yield pd.Series(values.view(np.int64))
    return prints(text)


def _variants(frame: DataFrame) -> DataFrame:
    """Rows (key, base, width, fp) under the variants of the two halves of their free bits.

    ``key`` stands for all bits agreed upon so far. The free bits are ``width`` bits from ``base``.
    A variant takes one half without one bit into the key and leaves the other half free. ``bit`` is
    the place of the deleted bit, ``first`` marks the first deletion of a half.
    """
    cut = frame.withColumn("half", F.expr("width div 2")).select("*", F.explode(F.expr("sequence(0, CAST(width AS INT) - 1)")).alias("place"))
    side = F.expr("place div half")
    segment = F.expr("shiftrightunsigned(fp, CAST(base + (place div half) * half AS INT)) & (shiftleft(1L, CAST(half AS INT)) - 1)")
    masked = segment.bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, CAST(place % half AS INT))")))
    return cut.select(
        F.xxhash64("key", "place", masked).alias("key"), (F.col("base") + (1 - side) * F.col("half")).cast("long").alias("base"),
        F.col("half").cast("long").alias("width"), "fp",
        F.expr("shiftrightunsigned(fp, CAST(base + place AS INT)) & 1").alias("bit"),
        (F.col("place") % F.col("half") == 0).alias("first"),
    )


def _forest(values: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that connect what distances of at most ``most`` connect: each member with its part's first."""
    left = values.view(np.uint64)
    out: list[tuple[int, int]] = []
    while len(left) > 1:
        inside = np.zeros(len(left), bool)
        inside[0] = True
        edge = left[:1]
        while len(edge):
            near = np.zeros(len(left), bool)
            for start in range(0, len(edge), 256):
                gaps = np.bitwise_count(left[None, :] ^ edge[start:start + 256, None])
                near |= (gaps <= most).any(axis=0)
            edge = left[near & ~inside]
            inside |= near
        part = left[inside].view(np.int64)
        out += [(int(part[0]), int(x)) for x in part[1:]]
        left = left[~inside]
    return out


def _bucket_links(buckets: DataFrame, most: int) -> DataFrame:
    """(a, b): a spanning forest of the links within each bucket, an array column ``fps``."""
    def forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: set[tuple[int, int]] = set()
            for fps in batch["fps"]:
                found.update(_forest(np.unique(np.asarray(fps, np.int64)), most))
            yield pd.DataFrame(sorted(found), columns=["a", "b"], dtype=np.int64)
    return buckets.mapInPandas(forests, "a long, b long")


def _buckets(variants: DataFrame) -> DataFrame:
    """Members of each variant, where some pair needs this variant: equal halves meet under their first
    deletion alone, halves that differ in one bit under that bit."""
    return (
        variants.groupBy("key").agg(F.collect_list("fp").alias("fps"), F.min("bit").alias("low"), F.max("bit").alias("high"), F.max("first").alias("first"))
        .where((F.size("fps") > 1) & (F.col("first") | (F.col("low") != F.col("high")))).select("fps")
    )


def links(prints: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> tuple[DataFrame, list[str]]:
    """(a, b) links that connect the distinct fingerprints ``fp`` at ``max_bits`` or fewer, and folders.

    With three bits two halves suffice; a smaller bound needs no more.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves with one deletion find distances of three bits at most")
    rows = prints.select(F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("base"), F.lit(BITS).cast("long").alias("width"), "fp")
    found, folders = [], []
    # no bucket holds more than two values of a half; few halves are frequent, mostly none
    halves = prints.select(F.explode(F.array(F.expr("struct(0, fp & 4294967295L)"), F.expr("struct(1, shiftrightunsigned(fp, 32))"))).alias("half"))
    crowded = halves.groupBy("half").count().where(F.col("count") > bucket // 2).limit(1).count() > 0
    for level in range(3):
        variants = _variants(rows)
        if not crowded or level == 2:
            found.append(_bucket_links(_buckets(variants), max_bits))
            break
        full, path = stored(variants.groupBy("key").count().where(F.col("count") > bucket).select("key"), "full-buckets")
        folders.append(path)
        found.append(_bucket_links(_buckets(variants.join(full, "key", "left_anti")), max_bits))
        rows, path = stored(variants.join(full, "key").select("key", "base", "width", "fp"), "split-buckets")
        folders.append(path)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct(), folders


def classes(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``prints`` with the least fingerprint of its component as ``root`` and the smallest doc_id
    reachable as ``component_id``."""
    spark = prints.sparkSession
    kinds, _ = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fingerprints")
    near, folders = links(kinds, max_bits)
    roots, _ = components(near)
    for path in folders:
        discard(spark, path)
    rooted = kinds.join(roots, kinds["fp"] == roots["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return prints.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp")


def _prints(docs: DataFrame, shingle: int, **more: Column) -> DataFrame:
    """(doc_id, text_hash, fp) and ``more`` per row of ``docs``, written once."""
    text = whole_text()
    columns = {"doc_id": F.col("doc_id").cast("long"), "text_hash": F.xxhash64(text), "fp": fingerprint(text, shingle), **more}
    return stored(docs.select(*[c.alias(name) for name, c in columns.items()]), "prints")[0]


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) per row of ``docs``."""
    return classes(_prints(docs, shingle), max_bits)


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The columns of ``docs``; of each component one document with its smallest doc_id stays.

    Where rows of a component share that id, the one with the least text hash stays, of rows
    equal in both the one whose values hash least, and of wholly equal rows any one. Keepers are
    chosen among rows of a few numbers; texts are met once, by a join with the kept or the dropped rows.
    """
    def whole_row() -> Column:
        return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])

    key = ["number", "text_hash", "row_hash"]
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    classed = classes(_prints(docs, shingle, row_hash=whole_row()), max_bits)
    least = F.col("doc_id").eqNullSafe(F.col("component_id"))
    rows, _ = stored(classed.groupBy("root", number.alias("number"), "text_hash", "row_hash").agg(
        F.count(F.lit(1)).alias("times"), F.max(least).alias("least")), "row-classes")
    chosen, _ = stored(rows.where("least").groupBy("root").agg(F.min(F.struct(*key, "times")).alias("one")).select("one.*"), "keepers")
    dropped, _ = stored(rows.join(chosen, key, "left_anti").select(*key).union(chosen.where("times > 1").select(*key)), "dropped")
    source = packed(docs, number=number, text_hash=F.xxhash64(whole_text()), row_hash=whole_row())
    # whichever list is shorter meets the texts
    if dropped.count() <= chosen.count():
        kept = source.join(held(dropped), key, "left_anti").select("row")
    else:
        kept = source.join(held(chosen.where("times = 1").select(*key)), key, "left_semi").select("row")
    repeated = chosen.where("times > 1").select(*key)
    if repeated.limit(1).count():
        again = source.join(held(repeated), key, "left_semi").groupBy(*key).agg(F.first("row").alias("row"))
        kept = kept.union(again.select("row"))
    return unpacked(kept, docs.columns)
