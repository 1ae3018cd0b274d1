import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from roomsight.llm import minhash as M

from llm_rows import CLASHING, frame, invented, rows_of


def slow_set(text, k=5):
    ws = (text or "").encode().lower().split()
    return {tuple(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set()


def slow_roots(sets, percent=85):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def slow_report(rows, percent=85):
    sets = [slow_set(r[1]) for r in rows]
    roots, least = slow_roots(sets, percent), {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    return Counter((r[0], len(s), least.get(root), r[0] == least.get(root))
                   for r, s, root in zip(rows, sets, roots))


def copies(n, seed, words=90, most=8, near=6):
    """Texts around a few others, some words exchanged: similar, hardly similar and not."""
    r, out = random.Random(seed), []
    for base in invented(n, words, seed):
        out.append(base)
        for _ in range(r.randint(0, near)):
            ws = base.split()
            for _ in range(r.randint(1, most)):
                ws[r.randrange(len(ws))] = f"changed{r.randrange(30)}"
            out.append(" ".join(ws))
    return out


@pytest.mark.parametrize("text", [None, "", " \n", "one", "One TWO three", "a b c d e", "a a a a a a a a a",
                                  "a b c d e f a b c d e", "É é ß x 中 文 字 \x1c z", " ".join(invented(1, 3000))])
def test_shingles(text):
    got = M.Functions().shingles(None if text is None else text.encode())
    assert len(got) == len(slow_set(text)) and (np.diff(got.astype(object)) > 0).all()


def test_shingles_equal_where_the_words_are():
    f = M.Functions()
    a = f.shingles(b"x One two three four five six")
    b = f.shingles(b"y one TWO three four five seven")
    assert len(np.intersect1d(a, b)) == 1
    assert len(np.intersect1d(f.shingles(b"one two"), f.shingles(b"one two three"))) == 0


def test_minima_estimate_the_similarity():
    f, r = M.Functions(bands=100, rows=10), np.random.default_rng(1)
    for share in (0.3, 0.6, 0.85):
        pool = r.integers(0, 2 ** 64, 4000, np.uint64)
        common = int(2000 * 2 * share / (1 + share))
        a, b = pool[:2000], pool[2000 - common:4000 - common]
        low = f.minima(np.concatenate([a, b]), np.array([0, 2000]))
        assert abs((low[0] == low[1]).mean() - common / (4000 - common)) < 0.05


def test_least_agreement():
    t = M.least_agreement(125)
    draws = np.random.default_rng(2).binomial(125, 0.85, 2_000_000)
    assert (draws < t).sum() == 0 and 70 < t < 100
    assert M.least_agreement(125, 100) == 125


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1), min_size=1, max_size=30), st.integers(40, 100))
def test_set_links(sets, percent):
    made = [np.array(sorted(s), np.uint64) for s in sets]
    pairs = M.set_links(made, percent)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        assert 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
        assert find(a) != find(b)
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(sets))] == slow_roots(sets, percent)


@pytest.mark.parametrize("width", [4, 60])
def test_sketch_links(width):
    r = np.random.default_rng(width)
    sketch = r.integers(0, 3, (width * 5, 12)).astype(np.uint8)
    task, n = np.repeat(np.arange(5), width), np.tile(np.sort(r.integers(90, 130, width)), 5)
    got = M.sketch_links(task, n, sketch, 8)
    root = list(range(len(task)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(task)):
        for j in range(i):
            if (task[i] == task[j] and 100 * min(n[i], n[j]) >= 85 * max(n[i], n[j])
                    and (sketch[i] == sketch[j]).sum() >= 8):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert got.tolist() == [find(i) for i in range(len(task))]


@pytest.mark.parametrize("small", [False, True])
def test_against_all_pairs(spark, messy_rows, small):
    rows = rows_of(copies(14, 3), 300) + messy_rows
    random.Random(1).shuffle(rows)
    options = {"group_rows": 3, "group_shingles": 200} if small else {}
    got = M.report(frame(spark, rows), **options)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert Counter(tuple(r) for r in got.collect()) == slow_report(rows)


def test_short_texts_and_other_thresholds(spark):
    r = random.Random(5)
    rows = rows_of([" ".join(r.choice("abc") for _ in range(r.randint(0, 9))) for _ in range(120)])
    got = M.report(frame(spark, rows), percent=60, bands=60, rows=2).collect()
    assert Counter(tuple(r) for r in got) == slow_report(rows, 60)


def test_large_group_of_near_copies_makes_few_rows(spark):
    rows = rows_of(copies(1, 8, words=200, most=3, near=0) * 3 + copies(1, 9, words=200, most=3, near=400))
    while len(rows) < 300:
        rows += rows_of(copies(1, len(rows), words=200, most=3, near=400), len(rows))
    got = M.near_duplicates(frame(spark, rows)).collect()
    sets = [slow_set(r[1]) for r in rows]
    assert len({r["root"] for r in got}) == len(set(slow_roots(sets)))
    slim = M.signatures(frame(spark, rows)).dropDuplicates(["sid"]).selectExpr(
        "monotonically_increasing_id() AS node", "n", "keys", "sketch").cache()
    assert M.alike(slim).count() < 26 * len(rows)


def test_copies_stay_once(spark, messy, messy_rows):
    kept = M.keep_first(messy)
    assert kept.columns == messy.columns
    want = slow_report(messy_rows)
    ids = Counter(k[0] for k, n in want.items() if k[3] for _ in range(n))
    assert {r["doc_id"] for r in kept.collect()} == set(ids)


def test_empty(nothing, spark):
    assert M.report(nothing).count() == 0 and M.keep_first(nothing).count() == 0
    lone = frame(spark, [(None, None, None, None, None, *CLASHING)])
    assert [tuple(r) for r in M.report(lone).collect()] == [(None, 0, None, True)]


def test_on_the_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert Counter(tuple(r) for r in M.report(docs).collect()) == slow_report(rows)
