import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_rows import CLASHING, frame
from roomsight.llm import language as L


@settings(max_examples=60, deadline=None)
@given(st.text("abc", min_size=1, max_size=40))
def test_automaton_accepts_the_substrings(text):
    codes = np.array([ord(c) - 96 for c in text])
    table = L.automaton(codes, 4)
    parts = {text[i:j] for i in range(len(text)) for j in range(i, len(text) + 1)}

    def accepts(s):
        state = 0
        for c in s:
            state = table[state, ord(c) - 96]
            if state < 0:
                return False
        return True

    assert all(accepts(p) for p in parts)
    r = random.Random(len(text))
    for _ in range(40):
        s = "".join(r.choice("abc") for _ in range(r.randint(1, 6)))
        assert accepts(s) == (s in parts)


def slow_phrases(learned, text):
    """Greedy parse of a text into the longest substrings of the learned one."""
    n, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in learned:
            end += 1
        at = max(at + 1, end - 1)
        n += 1
    return n


def test_phrases(monkeypatch):
    r = random.Random(5)
    a, b = ("".join(r.choice(s) for _ in range(500)) for s in ("abcab", "bcdde"))
    model = L.build({"x": [a], "y": [b]})
    texts = ["".join(r.choice(s) for _ in range(r.randint(1, 300))) for s in ("abcd", "abce", "zabc")]
    got = model.phrases([model.codes(L.normalise(t.encode())) for t in texts])
    assert got.tolist() == [[slow_phrases(a, t), slow_phrases(b, t)] for t in texts]


@pytest.mark.parametrize("together", [1, 3, 100])
def test_long_texts_are_parsed_whole(monkeypatch, together):
    """Phrases go on over any number of letters, in step or alone."""
    monkeypatch.setattr(L, "TOGETHER", together)
    r = random.Random(6)
    a, b = ("".join(r.choice(s) for _ in range(2500)) for s in ("abcab", "bcdde"))
    model = L.build({"x": [a], "y": [b]})
    texts = [a[100:2300], b[:2400] + a[:50], "", "".join(r.choice("abcdez") for _ in range(3000)), a, "b"]
    got = model.phrases([model.codes(L.normalise(t.encode())) for t in texts])
    assert got.tolist() == [[slow_phrases(a, t), slow_phrases(b, t)] for t in texts]
    assert got[0, 0] == got[4, 0] == 1


def test_texts_to_learn_from_are_whole():
    texts = ["abc" * 30, "bcd" * 400, "cde" * 20, "fgh" * 10]
    model = L.build({"x": texts, "y": ["zyx" * 500]}, 200)
    assert model.sizes.tolist() == [90 + 60 + 30 + 1, 1500 + 1]


def test_alphabets_of_any_size():
    """Letters beyond the most frequent ones count as any other: by brute force, and for languages
    whose alphabets share no letter."""
    r = random.Random(8)
    signs = [chr(0x4E00 + i) for i in range(1500)]
    pairs = [r.choice(signs) + r.choice(signs) for _ in range(400)]
    a = "".join(r.choice(pairs) for _ in range(3000))
    b = "".join(r.choice(signs[:700]) for _ in range(6000))
    latin = "".join(r.choice("abcdefghij ") for _ in range(6000)).strip()
    model = L.build({"han": [a], "other": [b], "latin": [latin]})
    learned = {n: "".join(chr(p) for p in L.normalise(x.encode()))
               for n, x in (("han", a), ("other", b), ("latin", latin))}
    texts = ["".join(r.choice(pairs) for _ in range(200)), "".join(r.choice(signs) for _ in range(200)),
             "".join(r.choice("abcdefghij" + signs[5]) for _ in range(200))]
    got = model.phrases([model.codes(L.normalise(t.encode())) for t in texts])
    assert got.tolist() == [[slow_phrases(learned[n], t) for n in model.names] for t in texts]
    assert len(np.unique(model.codes(L.normalise(a.encode())))) == len(set(a))
    assert [x for x, _ in model.predict([texts[0].encode(), texts[2].encode()])] == ["han", "latin"]


SYLLABLES = {"p": "ka to mi ra su ne".split(), "q": "erst ung ich der sch ein".split(),
             "r": "ção lhe ão nha qué os".split()}


def sentence(lang, words, r):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(1)
    rows = []
    for i in range(240):
        lang = "pqr"[i % 3]
        rows.append((i, sentence(lang, r.choice([8, 30, 100]), r), lang, "s", 0, *CLASHING))
    return rows


def test_held_out_rows_are_known(spark, docs):
    frame_ = frame(spark, docs)
    got = {r["doc_id"]: r for r in L.report(frame_, L.learn(frame_)).collect()}
    lang = {r[0]: r[2] for r in docs}
    held = [i for i in got if got[i]["held_out"]]
    assert len(got) == 240 and 50 < len(held) < 110
    assert np.mean([got[i]["lang_pred"] == lang[i] for i in held]) >= 0.97
    assert all(0.5 <= r["score"] <= 1 for r in got.values())


def test_nothing_held_out_is_learned(spark, docs):
    wrong = [(r[0], r[1], "wrong", *r[3:]) for r in docs]
    frame_ = frame(spark, docs).withColumn("h", L.fold(F.col("doc_id"), 3) == 1)
    other = frame(spark, wrong).withColumn("h", L.fold(F.col("doc_id"), 3) == 1)
    mixed = frame_.where("not h").unionByName(other.where("h")).drop("h")
    assert L.sample(mixed) == L.sample(frame(spark, docs))


def test_messy(spark, messy, messy_rows):
    got = L.report(messy, L.learn(messy)).collect()
    assert len(got) == len(messy_rows)
    und = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert {100, 101, 102, 103, None} - und <= {None} and 104 not in und
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")


def test_empty(spark, nothing, messy):
    assert L.report(nothing, L.learn(nothing)).count() == 0
    assert {r["lang_pred"] for r in L.report(messy, L.learn(nothing)).collect()} == {"und"}
