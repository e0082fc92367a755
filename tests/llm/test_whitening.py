"""Whitening against numpy on whole matrices."""

import math

import numpy as np
import pytest

from millwright.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label string, block int, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1, "b") for i, v in rows], SCHEMA).repartition(3)


def whitened(spark, rows, k=32):
    return [r.asDict() for r in whitening.whiten(frame(spark, rows), k).collect()]


def table(width, n, seed=1):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(width, width)) * np.geomspace(1, 0.05, width)
    return [(i, (rng.normal(size=width) @ mix.T).astype(np.float32).tolist()) for i in range(n)]


def expected(rows):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in rows], object)
    n, s = len(x), x.sum(axis=0)
    gaps = (n * x - s) ** 2
    centred = (x - s / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, gaps.sum(axis=1), centred, values[::-1], vectors[:, ::-1]


@pytest.mark.parametrize("width, n, size", [(5, 300, 256), (40, 500, 16), (3, 7, 2)])
def test_equals_whole_matrices(spark, monkeypatch, width, n, size):
    monkeypatch.setattr(whitening, "rows_per_block", lambda n: size)
    rows = table(width, n)
    count, gaps, centred, values, vectors = expected(rows)
    k = min(32, width)
    out = whitened(spark, rows)
    assert len(out) == n * k and {r["n"] for r in out} == {count}
    assert {r["vec_id"]: r["deviation"] for r in out} == dict(enumerate(gaps))
    got = np.zeros((n, k))
    for r in out:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
    want = centred @ vectors[:, :k] / np.sqrt(values[:k])
    signs = np.sign((got * want).sum(axis=0))
    np.testing.assert_allclose(got * signs, want, atol=1e-6)
    error = np.abs(np.cov(got.T, bias=True).reshape(k, k) - np.eye(k)).max()
    assert {r["identity_error"] for r in out} == {out[0]["identity_error"]} and out[0]["identity_error"] < 1e-6 and error < 1e-6


def test_rows_that_cannot_count_are_dropped(spark):
    good = table(4, 50)
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, float("nan"), 2.0, 3.0]), (103, [float("inf"), 1.0, 2.0, 3.0]), (104, []), (105, [1.0, 2.0])]
    out = whitened(spark, good + bad)
    assert {r["vec_id"] for r in out} == set(range(50)) and out[0]["n"] == 50


def test_repeated_rows_and_null_ids_count(spark):
    rows = table(3, 40)
    out = whitened(spark, rows + [rows[0], rows[0], (None, rows[1][1])], 2)
    assert len(out) == 43 * 2 and out[0]["n"] == 43
    assert sum(r["vec_id"] == 0 for r in out) == 6 and sum(r["vec_id"] is None for r in out) == 2


def test_components_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0, float(2 * i)]) for i in range(30)]
    out = whitened(spark, rows)
    assert {r["component"] for r in out} == {1} and out[0]["explained"] == pytest.approx(1)
    assert whitened(spark, [(1, [1.0, 2.0])] * 5) == [] and whitened(spark, [(1, [1.0, 2.0])]) == [] and whitened(spark, []) == []


def test_deviations_beyond_64_bits():
    x = np.array([[2**46, 0], [0, 1]], np.int64)
    assert whitening.deviations(x, 2, [2**46, 1]) == [None, None]
    x = np.array([[2**30, 0], [2**30 - 4, 1]], np.int64)
    assert whitening.deviations(x, 2, [2**31 - 4, 1]) == [17, 17]
    assert whitening.deviations(np.array([[2**61, 2**61]]), 4, [2**63 - 1, 2**63]) == [1]


def test_huge_entries_do_not_break(spark):
    rows = table(3, 30) + [(50, [3e38, 1.0, 1.0])]
    out = whitened(spark, rows)
    assert {r["vec_id"] for r in out} == {*range(30), 50}
