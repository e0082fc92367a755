"""Line dedup: lines that many documents share stay in one of them.

Lines are exploded and normalised (white space stripped at both ends, A-Z in lower case) and
hashed; documents are counted per hash; lines over the threshold go from every document but the
one with the largest id; what is left is put together again by position.

Defined cases: a null text is empty and an empty text is one empty line. Rows with the same doc_id
count as one document and each gives a row. A null doc_id counts as one document below all others.
An empty table gives an empty table. Extra columns pass through unchanged.
"""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.llm.common import BLANKS, ascii_lower, packed, two_hashes, unpacked, whole_text

MIN_CHARS = 20
MIN_DOCS = 3
MARK = "line:"
NO_ID = -(2**63)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, n_docs, keeper) of each line key found in ``min_docs`` documents or more."""
    return _counted(_line_documents(docs, min_chars)).where(F.col("n_docs") >= min_docs)


def _line_documents(docs: DataFrame, min_chars: int) -> DataFrame:
    """The distinct pairs of line hash and document; a line all documents share is dealt out by document."""
    lines = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.explode(F.split(whole_text(), "\n", -1)).alias("line"))
    keys = lines.select("doc", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    h1, h2 = two_hashes(F.col("key"), MARK)
    return keys.select("doc", h1.alias("h1"), h2.alias("h2")).distinct()


def _counted(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("keeper"))


CUT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_dropped", T.LongType())])


@F.pandas_udf(CUT)
def _without(text: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
    """Each text without the lines whose two hashes are listed; null where nothing is listed."""
    texts, counts = [], []
    for body, h1, h2 in zip(text, first, second):
        if body is None or h1 is None:
            texts.append(None)
            counts.append(0)
            continue
        gone = set(zip(h1.tolist(), h2.tolist()))
        lines, kept = body.split("\n"), []
        for line in lines:
            key = line.strip(BLANKS).encode().lower()
            pair = tuple(h - 2**64 if h >= 2**63 else h for h in (xxhash.xxh64_intdigest(key, 42), xxhash.xxh64_intdigest(MARK.encode() + key, 42)))
            if pair not in gone:
                kept.append(line)
        texts.append("\n".join(kept))
        counts.append(len(lines) - len(kept))
    return pd.DataFrame({"text": texts, "n_dropped": counts})


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(row, text, n_lines, n_dropped) per row of ``docs``: ``row`` is the whole row, ``text`` what is kept."""
    pairs = _line_documents(docs, min_chars)
    shared = _counted(pairs).where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper")
    gone = (
        pairs.join(shared, ["h1", "h2"]).where(F.col("doc") != F.col("keeper"))
        .groupBy("doc").agg(F.collect_list(F.struct("h1", "h2")).alias("lines"))
        .select("doc", F.col("lines.h1").alias("h1"), F.col("lines.h2").alias("h2"))
    )
    rows = packed(docs, doc=F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), text=whole_text())
    joined = rows.join(gone, "doc", "left")
    # a text that keeps every line does not travel to Python
    cut = _without(F.when(F.col("h1").isNotNull(), F.col("text")), F.col("h1"), F.col("h2"))
    cleaned = joined.select("row", "text", cut.alias("cut"))
    return cleaned.select(
        "row",
        F.coalesce(F.col("cut.text"), F.col("text")).alias("text"),
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce(F.col("cut.n_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def with_clean_text(docs: DataFrame) -> DataFrame:
    """``docs`` with its own columns, the text without shared lines, n_chars counted anew."""
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return unpacked(dedup_lines(docs), docs.columns, new)
