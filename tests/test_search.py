"""Vector and text indexes, bounded chunks, retrieved protocols, tail probabilities."""

import math
import random
import re
from collections import Counter
from decimal import Decimal, getcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright import constants as K
from millwright.functions import columns as C
from millwright.functions.significance import chi_square_tail, erfc, two_sided_normal
from millwright.operators import retrieval as L
from millwright.operators import text_index, vector_index
from millwright.operators.text_index import TextIndex
from millwright.operators.vector_index import PivotIndex
from millwright.session import names_in


# ---- pivot index

def vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id long, embedding array<float>").repartition(5)


def nearest(corpus, queries, k):
    def unit(m):
        m = np.asarray(m, np.float32).astype(float)
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n == 0, 1, n)
    scores = np.round(unit(queries) @ unit(corpus).T, 9)
    return sorted((q, int(i), float(scores[q, i]), rank) for q in range(len(queries))
                  for rank, i in enumerate(sorted(range(len(corpus)), key=lambda i: (-scores[q, i], i))[:k], 1))


def clusters(n=600, groups=12, width=16, spread=0.05, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, width))
    return centres[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, width))


@pytest.mark.parametrize("rows", [clusters(), np.random.default_rng(1).normal(size=(400, 8)), np.zeros((20, 4)),
                                  np.vstack([clusters(200), np.zeros((3, 16)), np.repeat(clusters(1), 150, axis=0)])])
@pytest.mark.parametrize("k, pivots", [(1, None), (5, 7)])
def test_pivot_search_equals_all_pairs(spark, rows, k, pivots):
    queries = np.vstack([rows[::37], -rows[:2], np.zeros((1, rows.shape[1]))])
    asked = vectors(spark, queries).withColumnRenamed("vec_id", "query_id")
    found = PivotIndex.build(vectors(spark, rows), pivots=pivots).search(asked, k)
    got = sorted((r["query_id"], r["vec_id"], r["score"], r["rank"]) for r in found.collect())
    want = nearest(rows, queries, k)
    assert [(q, r, s) for q, _, s, r in got] == [(q, r, pytest.approx(s, abs=2e-9)) for q, _, s, r in want]
    assert sum(a[1] == b[1] for a, b in zip(got, want)) >= 0.98 * len(want)  # the last digit of a score may part equal vectors


def test_clustered_vectors_are_mostly_skipped(spark):
    rows = clusters(1500, 30, 16, 0.02)
    asked = vectors(spark, rows[::50]).withColumnRenamed("vec_id", "query_id")
    found, skipped = PivotIndex.build(vectors(spark, rows)).search_counted(asked, 3)
    assert skipped > 0.7 and found.count() == 90


def test_pivot_search_in_blocks_and_on_nothing(spark, monkeypatch):
    rows = clusters(120)
    asked = vectors(spark, rows[:30]).withColumnRenamed("vec_id", "query_id")
    index = PivotIndex.build(vectors(spark, rows))
    whole = sorted(map(tuple, index.search(asked).collect()))
    monkeypatch.setattr(vector_index, "QUERY_BLOCK", 7)
    assert sorted(map(tuple, index.search(asked).collect())) == whole
    assert index.search(asked.limit(0)).count() == 0
    assert PivotIndex.build(vectors(spark, rows).limit(0)).search(asked).count() == 0


# ---- inverted index

def text_rows(n=300, seed=2):
    rng = random.Random(seed)
    words = ["the", "of", "É"] + [f"w{i}" for i in range(120)]
    return [(i // 3, i % 3, " ".join(rng.choice(words[:3]) if rng.random() < 0.6 else words[min(2 + int(rng.expovariate(0.05)), 122)] for _ in range(rng.randint(1, 40)))) for i in range(n)]


def scored(rows, questions, k):
    def terms(text):
        return [t for t in re.split(r"[^\w]+|_", (text or "").lower()) if t]
    counts = [(d, c, Counter(terms(t))) for d, c, t in rows]
    sizes = [sum(c.values()) for _, _, c in counts if c]
    n, mean = len(sizes), sum(sizes) / len(sizes)
    df = Counter(t for _, _, c in counts for t in c)
    idf = {t: math.floor(1000 * math.log(1 + (n - x + 0.5) / (x + 0.5))) for t, x in df.items()}
    out = []
    for q, text in questions:
        found = []
        for d, c, held in counts:
            size = sum(held.values())
            score = sum(m * idf[t] * math.floor(2200000.0 * held[t] / (held[t] + 0.3 + 0.9 * (size / mean))) for t, m in Counter(terms(text)).items() if t in held)
            if score:
                found.append((-score, d, c))
        out += [(q, d, c, -s, rank) for rank, (s, d, c) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("few", [0, 100_000])
def test_term_search_equals_scoring_every_text(spark, monkeypatch, few):
    monkeypatch.setattr(text_index, "FEW_ROWS", few)
    rows = text_rows() + [(200, 0, ""), (201, 0, None), (202, 0, "the")]
    questions = [(1, "the w1 w2 w3"), (2, "the of"), (3, "w7 w7 w9 of the É"), (4, "unknown"), (5, None), (6, rows[5][2]), (7, " ".join(t for _, _, t in rows[:9]))]
    chunks = spark.createDataFrame(rows, "doc_id long, chunk_id int, chunk string").repartition(4)
    asked = spark.createDataFrame(questions, "query_id long, text string")
    for found in (TextIndex.build(chunks).search(asked, 4), text_index.scan_search(chunks, asked, 4)):
        assert sorted(tuple(r[c] for c in ("query_id", "doc_id", "chunk_id", "score", "rank")) for r in found.collect()) == scored(rows, questions, 4)


def test_term_index_reloads_and_searches_nothing(spark, tmp_path):
    chunks = spark.createDataFrame(text_rows(30), "doc_id long, chunk_id int, chunk string")
    asked = spark.createDataFrame([(1, "w1 of")], "query_id long, text string")
    path = str(tmp_path / "index")
    whole = sorted(map(tuple, TextIndex.build(chunks, path).search(asked).collect()))
    assert whole and sorted(map(tuple, TextIndex.load(spark, path).search(asked).collect())) == whole
    for make in (lambda c, q: TextIndex.build(c).search(q), text_index.scan_search):
        assert make(chunks.limit(0), asked).count() == 0 and make(chunks, asked.limit(0)).count() == 0


# ---- chunks

def test_separator_chunks_cover_texts_and_stay_short(spark):
    rng = random.Random(9)
    texts = ["", "a", "x" * 450, "y" * 451, "z" * 2000, "word " * 400, "line\n" * 300, "para\n\n" * 200]
    texts += ["".join(rng.choice(["ab", " ", "\n", "\n\n", "é", "𝄞", "longerword"]) for _ in range(rng.randint(1, 900))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in L.chunk_separators(docs).orderBy("doc_id", "chunk_id").collect():
        found.setdefault(r["doc_id"], []).append(r["chunk"])
    assert set(found) == {i for i, t in enumerate(texts) if t}
    for i, chunks in found.items():
        assert all(len(c) <= L.CHUNK_SIZE for c in chunks)
        whole, piece = chunks[0], chunks[0]
        for c in chunks[1:]:
            led = piece[-L.CHUNK_OVERLAP:]
            assert c.startswith(led)
            piece = c[len(led):]
            whole += piece
        assert whole == texts[i]
    assert found[5][0].endswith(" ") and found[7][0].endswith("\n\n") and len(found[2]) == 1 and len(found[3]) == 2


# ---- protocols

def test_protocols_are_joined_by_rule_set(spark):
    machines = spark.createDataFrame([(1, 0.9, K.HIGH_RISK, [0, 2]), (2, 0.9, K.HIGH_RISK, []), (3, 0.1, "other", [0]), (4, 0.8, K.HIGH_RISK, [1]), (5, 0.8, K.HIGH_RISK, [0, 1, 2])],
                                     "machine_id long, failure_risk double, status string, rules array<int>")
    protocols = spark.createDataFrame([(0, "first"), (2, "third"), (1, None)], "rule_order int, protocol string")
    got = {r["machine_id"]: r["context"] for r in L.risk_protocols(machines, protocols, 3).collect()}
    assert got == {1: "first\n\nthird", 2: K.NOT_FOUND, 4: K.NOT_FOUND, 5: "first\n\nthird"}
    same = spark.createDataFrame([(0, "same"), (2, "same")], "rule_order int, protocol string")
    assert {r["machine_id"]: r["context"] for r in L.risk_protocols(machines, same, 3).collect()}[1] == "same"


# ---- tails and exact means

def exact_erfc(x):
    """By the Taylor series in 500 digits."""
    getcontext().prec = 500
    x = Decimal(x)
    term, total, n = x, x, 0
    while abs(term) > Decimal(10) ** -480:
        n += 1
        term = -term * x * x / n
        total += term / (2 * n + 1)
    root = Decimal(2) / Decimal(str(_pi())).sqrt()
    return float(1 - total * root)


def _pi():
    getcontext().prec = 500
    def arctan(inverse):
        power, total, n, sign = Decimal(1) / inverse, Decimal(1) / inverse, 1, -1
        while power > Decimal(10) ** -495:
            power /= inverse * inverse
            n += 2
            total += sign * power / n
            sign = -sign
        return total
    return 4 * (4 * arctan(5) - arctan(239))


def test_tails_to_twelve_digits(spark):
    points = [0.0, 1e-9, 0.1, 0.5, 1.0, 1.5, 1.9999, 2.0, 2.0001, 3.0, 5.0, 8.0, 12.0, 16.0, 21.0]
    rows = spark.createDataFrame([(x,) for x in points], "x double")
    for r in rows.select("x", erfc(F.col("x")).alias("tail"), two_sided_normal(F.col("x") * 2**0.5).alias("p")).collect():
        want = exact_erfc(r["x"])
        assert r["tail"] == pytest.approx(want, rel=1e-12, abs=0) and r["tail"] == pytest.approx(math.erfc(r["x"]), rel=1e-12, abs=0)
        assert r["p"] == pytest.approx(want, rel=1e-12, abs=0)
    assert exact_erfc(21.0) < 1e-192
    far = spark.createDataFrame([(900.0, d) for d in (1, 2, 3, 4, 7)], "x double, dof int")
    for r in far.select("dof", chi_square_tail(F.col("x"), F.col("dof")).alias("p")).collect():
        half = 450.0
        want = math.exp(-half) * sum(half**i / math.factorial(i) for i in range(r["dof"] // 2)) if r["dof"] % 2 == 0 else (
            exact_erfc(math.sqrt(half)) + math.exp(-half) * sum(half ** (i - 0.5) / math.gamma(i + 0.5) for i in range(1, (r["dof"] + 1) // 2)))
        assert r["p"] == pytest.approx(want, rel=1e-11, abs=0)


@pytest.fixture(scope="module")
def duck(small):
    from tools.compare import connect
    return connect(small)


def test_statement_tail_is_another_form_with_the_same_digits(duck):
    from oracles.exploration import _erfc
    for x in (0.0, 1e-12, 0.01, 0.3, 1.0, 2.0, 4.0, 6.2, 6.3, 9.0, 21.0):
        assert duck.execute(f"SELECT {_erfc(f'{x:.17e}')}").fetchone()[0] == pytest.approx(math.erfc(x), rel=1e-11, abs=0)


def test_exact_mean_does_not_depend_on_order(spark):
    rows = spark.createDataFrame([(0.1 * (i % 7) + 1e-5 * i,) for i in range(6000)], "x double")
    means = {rows.repartition(n).agg(C.exact_mean("x", 6, 100)).first()[0] for n in (1, 3, 17)}
    assert len(means) == 1
    tie = spark.createDataFrame([(0.000001,), (0.0,)], "x double")
    assert tie.agg(C.exact_mean("x", 6)).first()[0] == 0.000001
    assert rows.limit(0).agg(C.exact_mean("x", 6)).first()[0] is None


def test_text_index_shuffles_chunks_and_postings_once(spark):
    """Terms are counted, and questions' parts summed, where the rows of a text already lie together."""
    chunks = spark.createDataFrame([(n, 0, f"wear of tool {n % 3} and tool") for n in range(20)] + [(3, 0, "wear of tool 0 and tool")], "doc_id long, chunk_id int, chunk string")
    index = TextIndex.build(chunks)
    assert not names_in(spark, index.postings.inputFiles()[0].rsplit("/postings/", 1)[0] + "/counts")
    wanted = spark.createDataFrame([(q, "tool", 2) for q in range(5)] + [(0, "0", 1)], "question int, term string, weight long")
    lists = index._lists(wanted)
    got = {(r["question"], r["doc_id"]): r["part"] for r in lists.collect()}
    share = {(r["term"], r["doc_id"]): r["share"] for r in index.postings.collect()}
    assert got == {(q, d): 2 * share["tool", d] + (share.get(("0", d), 0) if q == 0 else 0) for q in range(5) for d in range(20)}
    assert "hashpartitioning(question" not in lists._jdf.queryExecution().executedPlan().toString()


def test_only_texts_that_reach_the_bar_are_ranked(spark, monkeypatch):
    """Questions whose common terms could lift any text sum whole lists; sums below the k-th best so far are left where they are."""
    rows = [(n, 0, f"the w{n % 40} a{n}" + " often" * (n % 7 == 0)) for n in range(400)]
    questions = [(q, " ".join(f"w{10 * q + i}" for i in range(10)) + " often" * 16 + " the") for q in range(4)]
    ranked, own = [], text_index.ranked_within
    monkeypatch.setattr(text_index, "ranked_within", lambda df, *more: ranked.append(df.count()) or own(df, *more))
    chunks = spark.createDataFrame(rows, "doc_id long, chunk_id int, chunk string").repartition(4)
    found = TextIndex.build(chunks).search(spark.createDataFrame(questions, "query_id long, text string"))
    assert sorted(tuple(r[c] for c in ("query_id", "doc_id", "chunk_id", "score", "rank")) for r in found.collect()) == scored(rows, questions, 3)
    assert 4 * 3 <= ranked[-1] < 4 * 200  # every text holds a term of every question
