import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from llm_rows import frame, rows_of
from roomsight.llm import tokens as T
from roomsight.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60),
                          st.text("aéÉ́    \x1c\x85\x00\t\n'sT<|endofx>Σς", max_size=40)),
                min_size=1, max_size=8))
def test_parts_give_the_ids_of_the_whole(texts):
    texts = [t and t.encode("utf-8", "ignore").decode() for t in texts]
    got = T.encode_texts(PATH, [None if t is None else t.encode() for t in texts])
    assert [x.tolist() for x in got] == [ids_of(t) for t in texts]


def test_special_tokens_and_small_cache(monkeypatch):
    monkeypatch.setattr(T, "PIECES", 2)
    for text in ("a <|endoftext|> b", "x<|startoftext|>y", "one two three four five six", "\x00 a \x00b"):
        assert T.encode_texts(PATH, [text.encode()])[0].tolist() == ids_of(text)


def test_a_tokenizer_of_another_kind_gets_whole_texts(tmp_path):
    """One that makes tokens across blanks."""
    from tokenizers import models

    other = Tokenizer(models.WordLevel({"a b": 1, "?": 0}, unk_token="?"))  # texts are single words
    other.save(str(tmp_path / "other.json"))
    got = T.encode_texts(str(tmp_path / "other.json"), [b"a b", None, b"a", b""])
    assert [x.tolist() for x in got] == [[1], [], [0], []]


def test_very_long_texts_and_runs_of_texts(spark, monkeypatch):
    monkeypatch.setattr(T, "TEXT_BYTES", 500)
    texts = ["one Two, three's 4 five." * 400, "", None, "kurz", "É è " * 300, "中文 and more " * 99] * 3
    docs = frame(spark, rows_of(texts)).coalesce(1)
    got = T.report(docs, scratch_path(spark, "t"), PATH).orderBy("doc_id").collect()
    at = 0
    for r, t in zip(got, texts):
        ids = [*ids_of(t), 1]
        assert (r["start"], r["n_tokens"]) == (at, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 10 ** 9), min_size=1, max_size=40), st.integers(6, 16))
def test_lengths_are_a_code(counts, limit):
    counts = np.array(counts)
    lengths = T.code_lengths(counts, limit)
    used = counts > 0
    assert ((lengths > 0) == used).all() and lengths.max(initial=0) <= limit
    if used.sum() > 1:
        assert sum(2.0 ** -int(x) for x in lengths[used]) == 1.0


def test_lengths_are_optimal():
    import heapq

    counts = np.random.default_rng(1).integers(1, 50, 60)  # far from the limit: plain Huffman
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert int((counts * T.code_lengths(counts)).sum()) == cost


def test_limit_binds():
    counts = np.array([2 ** i for i in range(30)])
    assert T.code_lengths(counts, 6).max() == 6


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=1200), min_size=1, max_size=6), st.integers(0, 9))
def test_round_trip(blocks, seed):
    r = np.random.default_rng(seed)
    counts = (r.integers(0, 2, 301) * r.integers(1, 10 ** 6, 301) ** r.integers(1, 3, 301)).astype(np.int64)
    for b in blocks:
        np.add.at(counts, np.array(b, int), 1)
    lengths = T.code_lengths(counts)
    codes = T.canonical(lengths)
    packed = []
    for b in blocks:
        payload, marks = T.pack(np.array(b, int), codes, lengths)
        packed.append((payload, marks, len(b)))
        assert len(payload) == (int(lengths[np.array(b, int)].sum()) + 7) // 8
    got = T.unpack(packed, T.decode_table(lengths))
    assert [x.tolist() for x in got] == blocks


def want(rows):
    """Rows in order of the files: NULL ids first; rows of one id in any order."""
    made = []
    for doc_id, text, *_ in rows:
        ids = ids_of(text) + [1]
        made.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return made


def test_files(spark, messy, messy_rows):
    path = scratch_path(spark, "tokens")
    rows = [tuple(r) for r in T.report(messy, path, PATH).collect()]
    rows.sort(key=lambda r: r[1])
    start = 0
    for doc_id, at, n, _ in rows:
        assert at == start
        start += n
    order = [-1 if r[0] is None else r[0] for r in rows]
    assert order == sorted(order)
    assert sorted(((r[0], r[2], r[3]) for r in rows), key=str) == sorted(want(messy_rows), key=str)
    full = {(r["doc_id"], tuple(r["ids"])) for r in T.read(spark, path).collect()}
    assert full == {(r[0], tuple(ids_of(r[1]) + [1])) for r in messy_rows}


def test_many_blocks(spark, monkeypatch):
    r = random.Random(2)
    rows = rows_of([" ".join(r.choice("abc xyz hello world".split()) for _ in range(r.randint(0, 400)))
                    for _ in range(150)])
    path = scratch_path(spark, "tokens")
    got = sorted(tuple(x) for x in T.report(frame(spark, rows), path, PATH).collect())
    ends = np.cumsum([n for _, n, _ in want(rows)])
    assert [(i, n, c) for i, _, n, c in got] == want(rows)
    assert [x[1] for x in got] == [0, *ends[:-1].tolist()]


def test_empty(spark, nothing):
    assert T.report(nothing, scratch_path(spark, "tokens"), PATH).count() == 0
