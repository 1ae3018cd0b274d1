from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_rows import CLASHING, frame, invented
from roomsight.llm import scoring as S
from roomsight.llm.common import byte_words


def test_gradient(monkeypatch):
    """The step's gradient against differences of the mean log-probability."""
    r = np.random.default_rng(1)
    p = {k: (v + r.normal(0, 0.2, v.shape)).astype(np.float64) for k, v in S.start_parameters().items()}
    codes = r.integers(0, S.CELLS, 60).astype(np.uint16)
    context = S.contexts(codes, np.array([25, 0, 35]))
    trainer = S.Trainer(p, rate=1.0)
    for v in trainer.sums.values():
        v[...] = 1e12  # then a step is the gradient divided by 1e6
    trainer.step(context, codes)
    for k, v in p.items():
        flat = v.reshape(-1)
        grad = (flat - trainer.p[k].reshape(-1)) * 1e6
        for i in [*r.choice(len(flat), 6), *np.flatnonzero(grad)[:40:5]]:
            old = flat[i]
            flat[i] = old + 1e-5
            up = -S.log_probabilities(p, context, codes).mean()
            flat[i] = old - 1e-5
            down = -S.log_probabilities(p, context, codes).mean()
            flat[i] = old
            assert grad[i] == pytest.approx((up - down) / 2e-5, abs=2e-5)


def test_powers():
    z = np.concatenate([np.linspace(-87, 87, 20_001), np.arange(-87, 88, 0.5), [0.0, -0.0]])
    got = S._powers(z.astype(np.float32))
    assert np.abs(got / np.exp2(z.astype(np.float32).astype(float)) - 1).max() < 5e-6
    assert S._powers(z.copy()).tolist() == np.exp2(z).tolist()


@pytest.mark.parametrize("scale", [0.5, 40.0])
def test_stretches_do_not_change_results(monkeypatch, scale):
    """Groups cut anywhere, logits within and beyond the bound."""
    r = np.random.default_rng(6)
    p = {k: (v + r.normal(0, scale, v.shape)).astype(np.float64) for k, v in S.start_parameters().items()}
    codes = np.sort(r.integers(0, 5 * S.SUB, 300) ** 2 % S.CELLS).astype(np.uint16)
    context = S.contexts(codes, np.array([120, 180]))
    found = []
    for piece in (7, 64, 1_000):
        monkeypatch.setattr(S, "PIECE", piece)
        trainer = S.Trainer(p)
        trainer.step(context, codes)
        found.append(np.concatenate([S.log_probabilities(p, context, codes), S._pack(trainer.p)]))
    assert found[0] == pytest.approx(found[2], rel=1e-6, abs=1e-6) and found[1] == pytest.approx(found[2], rel=1e-6, abs=1e-6)


def test_contexts_stay_within_a_text():
    got = S.contexts(np.array([5, 6, 7, 8], np.uint16), np.array([3, 0, 1]))
    p = S.PAD
    assert got.tolist() == [[p, p, 6, 7], [p, 5, 7, p], [5, 6, p, p], [p, p, p, p]]


def cell_and_share(v, word):
    """By the vocabulary: the cell of a word and the logarithm of its share, counts of others left out."""
    i = v.numbers.get(word, -1)
    return (S.tail_cell(word), -v.mass[S.tail_cell(word)]) if i < 0 else (v.cells[i], v.shares[i])


def test_shares_sum_to_one(spark, monkeypatch):
    monkeypatch.setattr(S, "HEAD", 96)
    texts = invented(30, 80, seed=3, vocabulary=700)
    counts = Counter(w for t in texts for w in t.split())
    docs = frame(spark, [(i, t, "en", "s", 0, *CLASHING) for i, t in enumerate(texts)])
    v = S.vocabulary(docs, listed=200)
    mass = Counter()
    for w, n in counts.items():
        c, share = cell_and_share(v, w.encode())
        mass[c] += np.exp(share) * (1 if w.encode() in v.numbers else n)
    assert all(m == pytest.approx(1) for m in mass.values())
    common = sorted(counts, key=lambda w: (-counts[w], w))[:S.HEAD]
    assert all(cell_and_share(v, w.encode())[1] == 0 for w in common)


def test_split_by_words(spark):
    texts = invented(9, 50, seed=4, vocabulary=200) + [None, "", "!", "Zz-9"]
    docs = frame(spark, [(i, t, "en", "s", 0, *CLASHING) for i, t in enumerate(texts)])
    v = S.vocabulary(docs, listed=60)
    for t, (codes, n, share, others) in zip(texts, v.split([t and t.encode() for t in texts])):
        ws = [w.encode() for w in (t or "").lower().replace("-", " ").replace("!", "").split()]
        want = [cell_and_share(v, w) for w in ws]
        assert np.frombuffer(codes, np.uint16).tolist() == [c for c, _ in want] and n == len(ws)
        assert share == pytest.approx(sum(s for _, s in want)) and others == [w for w in ws if w not in v.numbers]


def test_words_of_a_slice():
    texts = [None, "", " !", "Zz-9 zz", "é\x00x\ty", "a" * 70, "-", "b", None]
    words, length = S.word_array([t and t.encode() for t in texts])
    each = [byte_words(t and t.encode()) for t in texts]
    assert words.to_pylist() == [w for ws in each for w in ws] and length.tolist() == [len(ws) for ws in each]
    assert len(S.word_array([])[0]) == 0 and S.word_array([None])[1].tolist() == [0]


def test_a_share_does_not_depend_on_the_texts_around(monkeypatch):
    r = np.random.default_rng(2)
    vocab = [f"w{i}".encode() for i in range(3_000)]
    shares = r.normal(-5, 2, len(vocab) + 1)
    v = S.Vocabulary(S.Numbers({w: i for i, w in enumerate(vocab)}), np.zeros(len(shares), np.int64), shares,
                     r.normal(5, 2, S.CELLS))
    texts = [b" ".join(vocab[i] if i < 3_000 else b"other%d" % i for i in r.integers(0, 3_100, n)) for n in (90, 0, 7, 200, 1)]
    assert v.split(texts) == [v.split([t])[0] for t in texts]


def test_slices_hold_every_row(monkeypatch):
    monkeypatch.setattr(S, "SLICE", 10)
    texts = [b"abc", None, b"x" * 25, b"", b"defg", b"hi", b"y" * 10, None]
    parts = list(S.slices(pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"]), 0))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts and len(parts) > 2


def test_order_matters_after_training(spark):
    """Texts of a fixed pattern score better than the same words in another order."""
    r = np.random.default_rng(0)
    base = "one two three four five six seven eight".split()
    rows = [(i, " ".join(base * 25), "en", "s", 0, *CLASHING) for i in range(60)]
    rows += [(1000 + i, " ".join(r.permutation(base * 25)), "en", "s", 0, *CLASHING) for i in range(4)]
    got = {x["doc_id"]: x for x in S.report(frame(spark, rows).repartition(3), rounds=3, size=256).collect()}
    plain = np.mean([got[i]["per_word"] for i in range(60)])
    mixed = np.mean([got[1000 + i]["per_word"] for i in range(4)])
    assert plain > -1.0 and mixed < plain - 0.5


def test_learns_with_the_registered_parameters(spark):
    """Texts of a fixed pattern among others: their words are told from the context."""
    r = np.random.default_rng(0)
    vocab = [f"w{i}" for i in range(400)]
    follow = {w: vocab[i] for w, i in zip(vocab, r.permutation(400))}
    rows = []
    for i in range(150):
        t = [vocab[r.integers(400)]]
        while len(t) < 2000:
            t.append(follow[t[-1]] if r.random() < 0.9 else vocab[r.integers(400)])
        rows.append((i, " ".join(t if i else r.permutation(t)), "en", "s", 0, *CLASHING))
    got = {x["doc_id"]: x["per_word"] for x in S.report(frame(spark, rows)).collect()}
    assert np.mean([v for k, v in got.items() if k]) > got[0] + 0.5


def test_same_scores_however_the_rows_lie(spark, monkeypatch):
    monkeypatch.setattr(S, "WORDS_A_PART", 700)  # several parts
    texts = invented(40, 90, seed=2, vocabulary=300)
    docs = frame(spark, [(i, t, "en", "s", 0, *CLASHING) for i, t in enumerate(texts)])
    a, b = (dict(S.report(d).select("doc_id", "log_likelihood").collect())
            for d in (docs.coalesce(1), docs.orderBy(F.desc("doc_id")).repartition(7)))
    assert a == b


def test_every_word_is_a_target(spark, monkeypatch):
    """With the registered parameters, each round takes each word as a target once."""
    import inspect

    used = {n: v.default for n, v in inspect.signature(S.report).parameters.items() if n != "docs"}
    texts = invented(12, 90, seed=9, vocabulary=60)
    docs = frame(spark, [(i, t, "en", "s", 0, *CLASHING) for i, t in enumerate(texts)])
    v = S.vocabulary(docs, used["listed"])
    seen = []

    class Counting(S.Trainer):
        def step(self, context, target):
            seen.extend(target.tolist())
            super().step(context, target)

    codes = [c for c, *_ in v.split([t.encode() for t in texts])]
    steps = []
    monkeypatch.setattr(S, "Trainer", Counting)

    def here(df, run, schema):
        import pyarrow as pa
        batches = [pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(c, pa.binary())],
                                              names=["part", "codes"])
                   for p, c in (([0] * 5, codes[:5]), ([0, 0, 1, 1, 2, 2, 2], codes[5:]))]
        steps.append(len(list(run(iter(batches)))))
        return spark.createDataFrame([], schema)

    encoded = S.encode(docs, v)
    monkeypatch.setattr(S, "map_arrow", here)
    S.train(encoded, used["rounds"], used["size"])
    assert steps == [3] * used["rounds"]
    once = Counter(c for text in codes for c in np.frombuffer(text, np.uint16).tolist())
    assert Counter(seen) == Counter({c: n * used["rounds"] for c, n in once.items()})


def test_every_word_has_its_own_share(spark):
    """Words beyond the listed ones keep their frequency; repeated identifiers keep their rows."""
    texts = invented(40, 900, seed=5, vocabulary=5_000) + [""]
    docs = frame(spark, [(i // 2, t, "en", "s", 0, *CLASHING) for i, t in enumerate(texts)])

    def rows(listed):
        got = S.report(docs, listed=listed, rounds=0).collect()
        return sorted((r["doc_id"], r["n_words"], r["log_likelihood"]) for r in got)

    few, all_ = rows(S.HEAD + 1_500), rows(10_000)
    assert [r[:2] for r in few] == [r[:2] for r in all_] and len(few) == len(texts)
    assert [r[2] for r in few] == pytest.approx([r[2] for r in all_], abs=1e-3)


def test_scores_by_brute_force(spark):
    texts = invented(6, 30, seed=7) + ["", "one"]
    docs = frame(spark, [(i, t, "en", "s", 0, *CLASHING) for i, t in enumerate(texts)])
    v = S.vocabulary(docs)
    p = S.start_parameters()
    got = {r["doc_id"]: r for r in S.score(S.encode(docs, v), p).collect()}
    for i, t in enumerate(texts):
        made = [cell_and_share(v, w.encode()) for w in t.split()]
        codes = [c for c, _ in made]
        total = 0.0
        for at, (c, share) in enumerate(made):
            around = [codes[at + d] if 0 <= at + d < len(codes) else S.PAD for d in S.PLACES]
            h = np.tanh(p["hidden"] + sum(p["embed"][j][x] for j, x in enumerate(around)))
            z, y = h @ p["top"] + p["top_bias"], h @ p["sub"][c // S.SUB] + p["sub_bias"][c // S.SUB]
            total += z[c // S.SUB] - np.log(np.exp(z).sum()) + y[c % S.SUB] - np.log(np.exp(y).sum()) + share
        assert got[i]["n_words"] == len(codes) and got[i]["log_likelihood"] == pytest.approx(total, abs=1e-3)


def test_messy(spark, messy, messy_rows, nothing):
    got = S.report(messy).collect()
    assert len(got) == len(messy_rows)
    none = {r["doc_id"] for r in got if r["n_words"] == 0}
    assert {100, 101, 102, 103} <= none
    assert all((r["per_word"] is None) == (r["n_words"] == 0) and r["log_likelihood"] <= 0 for r in got)
    assert S.report(nothing).count() == 0
