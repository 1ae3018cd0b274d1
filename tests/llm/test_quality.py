import random

import numpy as np
import pytest

from llm_rows import CLASHING, frame, invented
from roomsight.llm import quality as Q


def walk(trees, x):
    """One tree and one row at a time."""
    out = []
    for row in x:
        total = trees.bias
        for node in trees.start:
            while trees.left[node] != node:
                low = row[trees.statistic[node]] <= trees.threshold[node]
                node = trees.left[node] if low else trees.right[node]
            total += trees.value[node]
        out.append(1 / (1 + np.exp(-total)))
    return np.array(out)


def test_flat_trees_walk_like_trees():
    r = np.random.default_rng(1)
    x = r.normal(size=(900, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = Q.train(x[:600], y[:600], trees=30)
    p = trees.score(x)
    assert np.allclose(p, walk(trees, x))
    assert ((p[600:] >= 0.5) == y[600:]).mean() > 0.93


def test_first_split_is_the_best_of_all():
    r = np.random.default_rng(2)
    x = np.round(r.normal(size=(300, 3)), 1)
    y = (x[:, 2] + r.normal(size=300) > 0.3).astype(float)
    trees = Q.train(x, y, trees=1, depth=1)
    p = y.mean()
    g, h = p - y, np.full(300, p * (1 - p))

    def gain(mask):
        return sum(g[m].sum() ** 2 / (h[m].sum() + 2) for m in (mask, ~mask))

    best = max(gain(x[:, j] <= c) for j in range(3) for c in np.unique(
        np.quantile(x[:, j], np.linspace(0, 1, Q.BINS + 1)[1:-1])))
    node = trees.start[0]
    assert gain(x[:, trees.statistic[node]] <= trees.threshold[node]) == pytest.approx(best)


@pytest.mark.parametrize("labels", [[], [1.0, 1.0], [0.0]])
def test_one_label_only(labels):
    x = np.ones((len(labels), 3))
    p = Q.train(x, np.array(labels)).score(np.ones((2, 3)))
    assert len(p) == 2 and ((p >= 0) & (p <= 1)).all()


def test_statistics_of_odd_texts():
    for text in (None, b"", b" \n ", b"x", "ÉÉ".encode(), b"a " * 100_000):
        s = Q.statistics(text)
        assert len(s) == len(Q.STATISTICS) and np.isfinite(s).all()


def test_held_out_accuracy(spark):
    r, rows, labels = random.Random(3), [], []
    for i, text in enumerate(invented(400, 60, seed=4)):
        bad = r.random() < 0.4
        if bad:
            text = r.choice([text.upper(), " ".join(w + "###" for w in text.split()), "the " * 60])
        rows.append((i, text, "en", "s", 0, *CLASHING))
        labels.append((i, int(not bad), 0))
    docs = frame(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = Q.report(docs, Q.learn(docs, marks)).collect()
    good = {i: q for i, q, _ in labels}
    held = [r for r in got if r["held_out"]]
    assert len(got) == 400 and 40 < len(held) < 130
    assert np.mean([r["predicted"] == good[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_messy(spark, messy, messy_rows, nothing, labels, no_labels):
    for known in (labels, no_labels):
        assert Q.report(messy, Q.learn(messy, known)).count() == len(messy_rows)
    assert Q.report(nothing, Q.learn(nothing, labels)).count() == 0
