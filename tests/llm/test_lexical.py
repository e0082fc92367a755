"""Ranked search against a plain reading of its formula."""

import math
import random
import re
from collections import Counter

import pytest

from millwright.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, score string, rank string, number string"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def ranked(docs, items, k=10):
    """Every query against every document."""
    read = [(d, Counter(terms(t))) for d, t in docs]
    filled = [sum(c.values()) for _, c in read if c]
    n_docs, total = len(filled), sum(filled)
    df = Counter(t for _, c in read for t in c)
    out = []
    for item, text in {(i, t or "") for i, t in items}:
        scores = []
        for doc, counts in read:
            n = sum(counts.values())
            if not n:
                continue
            m = 100 - 75 + 75 * n * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in terms(text) if t in counts
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k=10):
    frame = spark.createDataFrame([(d, t, "x", "y", "z") for d, t in docs], SCHEMA).repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in lexical.search(frame, asked, k).collect()), key=repr)


@pytest.fixture
def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    common = ["the", "of", "and", "É", "ß"]

    def text(n):
        return " ".join(rng.choice(common) if rng.random() < 0.5 else words[min(int(rng.expovariate(0.02)), 399)] for _ in range(n))

    docs = [(i, text(rng.randint(1, 60))) for i in range(700)]
    docs += [(700 + i, docs[3][1]) for i in range(40)] + [(3, docs[3][1]), (None, docs[3][1]), (None, None), (800, ""), (801, "!? -"), (802, "The THE the,of"), (803, text(5000))]
    items = [(i, text(rng.randint(1, 40))) for i in range(25)] + [(30, docs[3][1]), (30, docs[3][1]), (30, "of"), (31, None), (32, "nowhere"), (33, "the the the w1")]
    return docs, items


@pytest.mark.parametrize("shard, width", [(8192, 512), (64, 16), (5, 2)])
def test_equals_every_query_against_every_document(spark, corpus, monkeypatch, shard, width):
    docs, items = corpus
    monkeypatch.setattr(lexical, "SHARD", shard)
    monkeypatch.setattr(lexical, "RANGE", width)
    assert found(spark, docs, items) == ranked(docs, items)


def test_blocks_of_queries_give_the_same(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 1500)
    assert found(spark, docs, items, 3) == ranked(docs, items, 3)


def test_long_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE_BYTES", 7)
    text = "one twoÉ, three-FOUR " * 50 + "last"
    assert [t.decode() for piece in lexical.terms_of(text) for t in piece] == terms(text)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None)], [(1, "a")]) == []


def test_ranges_below_the_bar_are_skipped():
    """A shard whose best documents come first: later ranges cannot reach them."""
    import numpy as np

    size = 4096
    docs = np.arange(size, dtype=np.int32)
    row = {
        "doc_ids": list(range(size)), "lengths": np.full(size, 10, np.int64), "terms": np.array([0, 1], np.int32), "counts": np.array([size, 20], np.int32),
        "docs": np.concatenate([docs, docs[:20]]), "tfs": np.ones(size + 20, np.int32),
    }
    best = lexical.Best(10)
    read = lexical.search_shard(lexical.Shard(row, size, 10 * size), [(0, 5), (1, 4000)], best)
    assert read == 1 and [r[2] for r in best.rows] == list(range(10))
    again = lexical.search_shard(lexical.Shard({**row, "terms": np.array([0, 2], np.int32)}, size, 10 * size), [(0, 5), (1, 4000)], best)
    assert again == 0


def test_large_numbers_stay_exact():
    import numpy as np

    lengths = np.array([5, 10**9], np.int64)
    assert lexical.normaliser(lengths, 10**11, 3 * 10**13).tolist() == [25 + 75 * n * 10**11 // (3 * 10**13) for n in (5, 10**9)]
