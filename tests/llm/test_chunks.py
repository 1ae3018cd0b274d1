import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from llm_rows import frame, invented, rows_of
from roomsight.llm import chunks as K


def slow_chunks(data):
    """Chunk by chunk, the hash of the 32 bytes before each place computed anew."""
    out, start = [], 0
    while start < len(data):
        end = min(len(data), start + K.MOST)
        for at in range(start + K.LEAST, end + 1):
            h = 0
            for b in data[at - 32:at]:
                h = (h << 1) + int(K.GEAR[b]) & 0xFFFFFFFF
            bits = K.HARD_BITS if at < start + K.USUAL else K.EASY_BITS
            if h >> (32 - bits) == 0:
                end = at
                break
        out.append((start, end))
        start = end
    return out


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=900), max_size=5))
def test_boundaries(texts):
    owner, start, stop, _ = K.boundaries(texts)
    base = np.cumsum([0] + [len(t) for t in texts])
    for i, t in enumerate(texts):
        mine = sorted((int(a - base[i]), int(b - base[i])) for o, a, b in zip(owner, start, stop) if o == i)
        assert mine == slow_chunks(t)


def test_likeness():
    a, b = invented(2, 800)
    one, two, both, none = K.chunk_sets([a.encode(), b.encode(), (a + " " + b).encode(), b""])
    assert K.likeness(one, one) == 1 and K.likeness(one, two) < 0.02
    assert K.likeness(one, both) > 0.95 and 0.4 < K.likeness(both, one) < 0.6
    assert K.likeness(none, none) == 1 and K.likeness(none, one) == 0 and K.likeness(one, none) == 0
    shifted = K.chunk_sets([("new start " + a).encode()])[0]
    assert K.likeness(one, shifted) > 0.9


def want(rows):
    """In descending order of the ids (each once): id, length, edited text's hash."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (i, text, *_), (_, nxt, *_) in zip(rows, rows[1:] + rows[:1]):
        text, nxt = text or "", nxt or ""
        half = len(text) // 2
        out[i] = (len(text), hashlib.sha256((text[:len(text) - half] + nxt[:half]).encode()).hexdigest())
    return out


@pytest.mark.parametrize("parts", [None, 1, 7, 60])
def test_next_documents(spark, messy_rows, parts):
    seen, rows = set(), []
    for r in messy_rows + rows_of(invented(40, 150, seed=8) + [None, "", "é" * 33], 1000):
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            rows.append(r)
    random.Random(3).shuffle(rows)
    got = K.report(frame(spark, rows).repartition(5), parts).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == want(rows)
    assert len(got) == len(rows)
    sets = {r[0]: K.chunk_sets([(r[1] or "").encode()])[0] for r in rows}
    order = sorted(sets, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    for r in got:
        own = sets[r["doc_id"]]
        assert r["fingerprint"] == K.written(own)
        assert r["near_next"] == K.likeness(own, sets[following[r["doc_id"]]])
        if r["n_chars"] > 800 and r["doc_id"] >= 1000:
            assert 0.3 < r["near_edited"] < 0.75


def test_repeated_and_missing_ids(spark, messy, messy_rows):
    got = K.report(messy).collect()
    assert len(got) == len(messy_rows)
    assert sorted(((r["doc_id"], r["n_chars"]) for r in got), key=str) == sorted(
        ((r[0], len(r[1] or "")) for r in messy_rows), key=str)
    by_text = {r[1]: K.written(K.chunk_sets([(r[1] or "").encode()])[0]) for r in messy_rows}
    assert {r["fingerprint"] for r in K.fingerprints(messy).collect()} == set(by_text.values())


def test_one_row_and_none(spark, nothing):
    assert K.report(nothing).count() == 0
    one = K.report(frame(spark, rows_of(["abcdef"]))).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and one[0]["near_next"] == 1.0
