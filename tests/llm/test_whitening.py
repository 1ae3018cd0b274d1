import math
from collections import Counter

import numpy as np
import pytest

from roomsight.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x string, row string, index string, n string"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if e is None else float(e) for e in v], 0, "x", "r", "i", "n")
            for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def slow(vectors, k=16):
    """(exact deviations, whitened up to sign, explained) of good vectors."""
    x = [tuple(math.floor(64 * float(np.float32(e))) + 1000000 for e in v) for v in vectors]
    fit = sorted(set(x))
    n, d = len(fit), len(fit[0])
    sums = [sum(r[j] for r in fit) for j in range(d)]
    off = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    centre = np.array([[n * r[j] - sums[j] for j in range(d)] for r in fit]) / n
    values, vectors_ = np.linalg.eigh(centre.T @ centre / n)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    keep = min(k, int((values > 1e-12 * values.sum()).sum()))
    white = np.array(off) / n @ vectors_[:, :keep] / np.sqrt(values[:keep])
    return [sum(v * v for v in r) for r in off], white, values[:keep] / values.sum(), n


def compare(got, ids, vectors, k=16):
    deviation, white, explained, n = slow(vectors, k)
    assert len(got) == white.size
    by = {(r["vec_id"], r["component"]): r for r in got}
    for c in range(white.shape[1]):
        mine = np.array([by[i, c + 1]["whitened"] for i in ids])
        sign = 1 if mine @ white[:, c] > 0 else -1
        assert np.abs(sign * mine - white[:, c]).max() < 1e-6
    assert [by[i, 1]["deviation"] for i in ids] == deviation
    for r in got:
        assert r["n"] == n and abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
        assert r["identity_error"] < 1e-9 and r["identity_error"] == got[0]["identity_error"]


@pytest.mark.parametrize("d,n", [(24, 300), (5, 2500)])
def test_against_numpy(spark, d, n):
    r = np.random.default_rng(d)
    vectors = (r.normal(0, 1, (n, d)) @ r.normal(0, 1, (d, d)) + r.normal(0, 3, d)).astype(np.float32)
    vectors[n // 2:n // 2 + n // 3] = vectors[0]  # a third of all rows are copies of one
    got = W.report(table(spark, vectors)).collect()
    compare(got, range(n), vectors)


def test_messy(spark):
    r = np.random.default_rng(3)
    good = r.normal(0, 1, (40, 6)).astype(np.float32).tolist()
    bad = [None, [], [1.0], [None] * 6, [float("nan")] + [0.0] * 5, [float("inf")] * 6, [0.0, None] * 3,
           [1e30] * 6]
    ids = list(range(40)) + list(range(100, 100 + len(bad)))
    got = W.report(table(spark, good + bad, ids)).collect()
    compare(got, range(40), good)
    assert [f for f in W.report(table(spark, good)).columns] == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_null_and_repeated_ids(spark):
    r = np.random.default_rng(4)
    good = r.normal(0, 1, (30, 3)).astype(np.float32).tolist()
    got = W.report(table(spark, good + good[:2], [None, None] + list(range(28)) + [0, 0])).collect()
    assert Counter(r["vec_id"] for r in got) == Counter([None, None, *range(28), 0, 0] * 3)


def test_without_variance(spark):
    assert W.report(table(spark, [])).count() == 0
    assert W.report(table(spark, [None, None])).count() == 0
    same = W.report(table(spark, [[1.0, 2.0]] * 5))
    assert same.count() == 0
    flat = W.report(table(spark, [[i / 3, 5.0, i / 3] for i in range(50)])).collect()
    assert {r["component"] for r in flat} == {1} and abs(flat[0]["explained"] - 1) < 1e-12


def test_large_entries(spark):
    """Sums of squares beyond a long are NULL, the projections stay right."""
    r = np.random.default_rng(5)
    good = (r.normal(0, 1, (20, 2)) * 1e9).astype(np.float32).tolist()
    got = W.report(table(spark, good)).collect()
    assert all(r["deviation"] is None for r in got if abs(r["whitened"]) > 1)
    _, white, _, _ = slow(good)
    for c in range(2):
        mine = np.array([r["whitened"] for r in sorted(got, key=lambda r: r["vec_id"]) if r["component"] == c + 1])
        assert min(np.abs(mine - white[:, c]).max(), np.abs(mine + white[:, c]).max()) < 1e-6


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_ROWS", 16)
    monkeypatch.setattr(W, "BLOCK_COLUMNS", 4)
    r = np.random.default_rng(6)
    good = r.normal(0, 1, (333, 10)).astype(np.float32)
    compare(W.report(table(spark, good)).collect(), range(333), good)


def test_given_embeddings(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    given = rows.collect()
    compare(W.report(rows).collect(), [r["vec_id"] for r in given], [r["embedding"] for r in given])
