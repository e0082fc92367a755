"""Secret scan with corpus-wide ownership frequency.

Three kinds of candidates are found in every whole text: assigned values, access key ids and long
hex runs. Their values travel as hashes only. Each hash is counted by distinct repositories and
owners over the whole corpus: a value that more than ``max_owners`` owners or more than
``max_repositories`` repositories hold is a copied example; one that few of both hold
and whose characters vary like a key's is a live-looking credential, whose value gets a span of the
kind ``live`` beside the base spans.

On documents, the owner is the source and a repository is a source with a language.

Counting starts with distinct (hash, owner, repository) rows, so a value that a third of all
documents hold is combined before it is shuffled by its hash.

Defined cases: a null text is empty; null owners and repositories count as one unknown each; rows
that repeat a doc_id each give a row. An empty table gives an empty one. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import stored, whole_text

# fixed values of the contract: kinds, patterns and least lengths
KINDS = ("assign", "access", "hex", "live")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_VALUE = 8

#: A value held by more owners, or more repositories, than this is a copied example.
MAX_OWNERS, MAX_REPOSITORIES = 2, 3
#: Bits of entropy a character, and different characters, of a live-looking value.
MIN_ENTROPY, MIN_DISTINCT = 2.5, 6


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(kind, start, end, value start, value end) by start, then kind; a match never crosses a line end,
    so only lines with a colon or an equals sign are searched for assignments."""
    found, at = [], 0
    while True:
        signs = [p for p in (text.find(":", at), text.find("=", at)) if p >= 0]
        if not signs:
            break
        start = text.rfind("\n", 0, min(signs)) + 1
        end = text.find("\n", min(signs))
        end = len(text) if end < 0 else end
        for m in ASSIGN.finditer(text, max(start, at), end):
            if m.end(2) - m.start(2) >= MIN_VALUE:
                found.append((0, m.start(), m.end(), m.start(2), m.end(2)))
        at = end
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        found += [(kind, m.start(), m.end(), m.start(), m.end()) for m in pattern.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def looks_live(value: str) -> bool:
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    return len(counts) >= MIN_DISTINCT and entropy >= MIN_ENTROPY


SCANNED = "row long, doc_id long, owner string, repository string, spans array<struct<kind:int,start:int,end:int>>, found array<struct<hash:string,start:int,end:int,live:boolean>>"
SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
FOUND = pa.list_(pa.struct([("hash", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("live", pa.bool_())]))


def scan(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """One row per document with its base spans and candidate values, written once.

    Ids pass through as Arrow columns: in pandas a null beside them would make them doubles."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, values = [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b, _, _ in base])
                places = sorted({(a, b) for _, _, _, a, b in base})
                values.append([{"hash": hashlib.sha256(text[a:b].encode()).hexdigest()[:32], "start": a, "end": b, "live": looks_live(text[a:b])} for a, b in places])
            carried = {name: batch.column(name) for name in ("row", "doc_id", "owner", "repository")}
            yield pa.RecordBatch.from_pydict({**carried, "spans": pa.array(spans, SPANS), "found": pa.array(values, FOUND)})

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"), F.coalesce(repository.cast("string"), F.lit("")).alias("repository"), whole_text().alias("text"),
    )
    return stored(rows.mapInArrow(look, SCANNED), "candidates")[0]


def ownership(scanned: DataFrame) -> DataFrame:
    """(hash, owners, repositories) of every candidate value in the corpus."""
    held = scanned.select("owner", "repository", F.explode("found.hash").alias("hash")).distinct()
    by_owner = held.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories"))


def find_secrets(docs: DataFrame, owner: Column | None = None, repository: Column | None = None, max_owners: int = MAX_OWNERS,
                 max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """(doc_id, spans, live, n_copied) per document: its base spans, the places of its live-looking
    values and how many of its values are copied examples."""
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", F.col("source"), F.col("lang")) if repository is None else repository
    scanned = scan(docs, owner, repository)
    copied = (F.col("owners") > max_owners) | (F.col("repositories") > max_repositories)
    judged = (
        scanned.select("row", F.explode("found").alias("value")).select("row", "value.*").join(ownership(scanned), "hash")
        .groupBy("row").agg(
            F.collect_list(F.when(F.col("live") & ~copied, F.struct("start", "end"))).alias("live"),
            F.count_if(copied).alias("n_copied"),
        )
    )
    return scanned.join(judged, "row", "left").select(
        "doc_id", "spans", F.coalesce("live", F.array().cast("array<struct<start:int,end:int>>")).alias("live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )


def n_of_kind(spans: Column, kind: str) -> Column:
    """How many spans are of a kind; the function takes one argument, as Spark gives a second one the place in the array."""
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind)))


def span_list(spans: Column) -> Column:
    """Spans as kind:start:end by start, then kind, comma-joined."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
