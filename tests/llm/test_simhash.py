import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from roomsight.llm import simhash as S

from llm_rows import CLASHING, frame, invented, rows_of


def slow_fingerprint(text, k=4):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    grams = [b" ".join(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, distance=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", [None, "", " \n", "one", "One TWO three", "a b c d", "a a a a a a a",
                                  "É é ß x 中 文 字 \x1c z", " ".join(invented(1, 3000))])
def test_fingerprint(text):
    assert S.fingerprint(None if text is None else text.encode()) == slow_fingerprint(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 2 ** 64 - 1), st.sets(st.integers(0, 63), max_size=5)),
                min_size=1, max_size=60), st.integers(0, 6))
def test_trie(rows, distance):
    made = []
    for group, key, flips in rows:
        made += [(group, key), (group, key ^ sum(1 << f for f in flips))]
    made.sort()
    group, keys = (np.array(x, t) for x, t in zip(zip(*made), (np.int64, np.uint64)))
    got = S.trie_links(group, keys, distance)
    for g in set(group.tolist()):
        at = np.flatnonzero(group == g)
        want = slow_components([int(k) for k in keys[at]], distance)
        assert [int(x) - int(at[0]) for x in got[at]] == want


def cluster(n, seed):
    """Texts around a few others, single words exchanged."""
    r, out = random.Random(seed), []
    for base in invented(n, 120, seed):
        out.append(base)
        for _ in range(r.randint(0, 6)):
            ws = base.split()
            ws[r.randrange(len(ws))] = "changed"
            out.append(" ".join(ws))
    return out


@pytest.mark.parametrize("group_rows", [50_000, 3])
def test_components(spark, messy_rows, group_rows):
    rows = rows_of(cluster(12, 3), 300) + messy_rows
    random.Random(1).shuffle(rows)
    got = S.report(frame(spark, rows), group_rows=group_rows).collect()
    fps = [slow_fingerprint(r[1]) for r in rows]
    roots = slow_components(fps)
    least = {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    want = Counter((r[0], f"{fp:016x}", least.get(root)) for r, fp, root in zip(rows, fps, roots))
    assert Counter(tuple(r) for r in got) == want
    assert len({r["component_id"] for r in got}) < len({r["fingerprint"] for r in got})


def test_chains_reach_their_smallest(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(500, 400), (400, 450), (7, 7)]
    found = dict(S.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(1, 201)}, 500: 400, 450: 400}


def test_one_of_each_stays(spark, messy, messy_rows):
    kept = S.keep_first(messy)
    assert kept.columns == messy.columns
    rows = [tuple(r) for r in kept.collect()]
    assert len(rows) == len(set(rows)) == len({r["root"] for r in S.near_duplicates(messy).collect()})
    assert set(rows) <= set(messy_rows)
    assert not any(r[0] is None for r in rows)


def test_wide_group_makes_few_rows(spark):
    """Many texts within reach of each other: links go by a tree, not by all pairs."""
    r = random.Random(4)
    base = r.getrandbits(64)
    fps = {base ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(400)}
    rows = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    found = S.links(spark.createDataFrame(rows, "fp long"))
    assert found.count() < 5 * len(fps)


def test_empty(nothing, spark):
    assert S.report(nothing).count() == 0 and S.keep_first(nothing).count() == 0
    lone = frame(spark, [(None, None, None, None, None, *CLASHING)])
    assert [r["component_id"] for r in S.report(lone).collect()] == [None]
    assert S.keep_first(lone).count() == 1
