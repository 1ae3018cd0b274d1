"""Toxicity by ordinal regression: severity grades from sparse text features.

A cumulative-link model: the score ``f = sum of weights * (1 + ln count)`` over known words is
shared by all thresholds, ``P(grade >= k) = sigmoid(f - t_k)`` with ``t_1 < t_2 < ...``, and the
expected severity is the sum of these probabilities.

The model is learned from at most ``fit_rows`` labelled rows (half of them from either side of
grade 0, taken in hash order and weighted back to their share). Features are words and
word beginnings whose presence depends on the label beyond chance (chi-square at least ``LEAST_CHI2``), the
``max_words`` strongest at most; others could only repeat what single rows happen to be labelled.
Scoring is one pass over whole texts without an exchange.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .common import fold, fresh, per_row, byte_words, uniform, words

FIT_ROWS = 20_000
MAX_WORDS = 20_000
MIN_DOCUMENTS = 4
LEAST_CHI2 = 15.0
BEGINNINGS = (4, 5, 6, 8)
SEEN = 300_000
FOLDS = 5


def features_of(word: bytes) -> list[bytes]:
    """The word and its beginnings, marked as such, so that inflected forms share features."""
    return [word, *[b"^" + word[:n] for n in BEGINNINGS if len(word) >= n]]


class Known:
    """The features of words that are in a given set, remembered word by word."""

    def __init__(self, known):
        self.known, self.seen = known, {}

    def __call__(self, text: bytes | None) -> Counter:
        if len(self.seen) > SEEN:
            self.seen.clear()
        seen, hits = self.seen, Counter()
        for w in byte_words(text):
            found = seen.get(w)
            if found is None:
                found = seen[w] = tuple(f for f in features_of(w) if f in self.known)
            if found:
                hits.update(found)
        return hits


@dataclass(frozen=True)
class Severity:
    """A fitted model: weight of each feature, and the ascending thresholds."""

    weights: dict[bytes, float]
    thresholds: tuple[float, ...]

    def scorer(self):
        """A function giving (P(grade >= 1), expected severity, likeliest grade by the 0.5 mark)
        of each text of a list."""
        weights, cuts, known = self.weights, np.array(self.thresholds), Known(self.weights)

        def score(texts: list[bytes | None]) -> list[tuple[float, float, int]]:
            f = np.array([sum(weights[w] * (1 + np.log(n)) for w, n in sorted(known(t).items()))
                          for t in texts])
            if not len(cuts):
                return [(0.0, 0.0, 0)] * len(texts)
            over = _sigmoid(f[:, None] - cuts[None, :])
            return list(zip(over[:, 0].tolist(), over.sum(1).tolist(),
                            (over >= 0.5).sum(1).tolist()))

        return score


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def train(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray,
          weights: np.ndarray, width: int, steps: int = 150, rate: float = 0.1,
          ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and thresholds of a cumulative-link model by Adam over all rows.

    The features are triples (row, column, value). Thresholds are kept in order by learning the
    first one and the logarithms of the gaps.
    """
    n, top = len(grades), int(grades.max())
    share = np.array([weights[grades >= k].sum() for k in range(1, top + 1)]) / weights.sum()
    start = -np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6)))
    gaps = np.log(np.maximum(np.diff(start), 0.1))
    params = np.concatenate([np.zeros(width), start[:1], gaps])
    m, v = np.zeros_like(params), np.zeros_like(params)
    over = (grades[:, None] >= np.arange(1, top + 1)[None, :]).astype(float)
    w = (weights / weights.sum())[:, None]
    for step in range(1, steps + 1):
        beta, first, spread = params[:width], params[width], np.exp(params[width + 1:])
        cuts = first + np.concatenate([[0.0], np.cumsum(spread)])
        f = np.bincount(rows, beta[cols] * values, minlength=n)
        p = _sigmoid(f[:, None] - cuts[None, :])
        # P(grade = k) is the difference of neighbouring cumulative probabilities.
        upper = np.hstack([np.ones((n, 1)), p])
        lower = np.hstack([p, np.zeros((n, 1))])
        at = np.arange(n), grades
        mass = np.maximum(upper[at] - lower[at], 1e-12)
        slope = p * (1 - p)
        up = np.where(grades > 0, slope[np.arange(n), np.maximum(grades - 1, 0)], 0.0)
        low = np.where(grades < top, slope[np.arange(n), np.minimum(grades, top - 1)], 0.0)
        scale = (w[:, 0] / mass)
        d_f = -(up - low) * scale
        d_cut = np.zeros(top)
        np.add.at(d_cut, np.maximum(grades - 1, 0), np.where(grades > 0, up * scale, 0.0))
        np.add.at(d_cut, np.minimum(grades, top - 1), np.where(grades < top, -low * scale, 0.0))
        d_beta = np.bincount(cols, d_f[rows] * values, minlength=width) + ridge * beta
        after = np.cumsum(d_cut[::-1])[::-1]
        grad = np.concatenate([d_beta, [d_cut.sum()], after[1:] * spread])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        params = params - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    cuts = params[width] + np.concatenate([[0.0], np.cumsum(np.exp(params[width + 1:]))])
    return params[:width], cuts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, fit_rows: int = FIT_ROWS,
                    keep: Column | None = None) -> DataFrame:
    """At most about ``fit_rows`` labelled documents: (doc_id, text, label, share).

    Rows are taken in hash order of the identifier, up to half of the bound from label 0 and
    half from the others; ``share`` is the part taken. Of several labels of one document the
    largest counts, of several texts the smallest.
    """
    ident = F.col("doc_id")
    known = labels.where(F.col(label).isNotNull() & ident.isNotNull())
    if keep is not None:
        known = known.where(keep)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    sizes = {r["side"]: r["n"] for r in known.groupBy((F.col("label") > 0).alias("side"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {side: min(1.0, fit_rows / 2 / n) for side, n in sizes.items()}
    known = known.withColumn("share", F.when(F.col("label") > 0, share.get(True, 1.0))
                             .otherwise(share.get(False, 1.0)))
    taken = known.where(uniform(ident, F.lit("fit")) < F.col("share"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    # The sample is bounded by fit_rows, and so is its broadcast.
    return (texts.join(F.broadcast(taken), "doc_id").groupBy("doc_id", "label", "share")
            .agg(F.min("text").alias("text")))


def _chi2(positive: int, other: int) -> Column:
    """Chi-square of a word's documents (``n``, of which ``positive``) against the label."""
    n, a = F.col("n").cast("double"), F.col("positive").cast("double")
    total = float(positive + other)
    return total * F.pow(a * other - (n - a) * positive, 2) / (
        n * F.greatest(total - n, F.lit(0.5)) * float(positive) * float(other))


def fit(sample: DataFrame, max_words: int = MAX_WORDS,
        min_documents: int = MIN_DOCUMENTS) -> Severity:
    """Learn from (doc_id, text, label, share), the label a grade from 0.

    Where all positive labels are 1, severity is graded from the texts: a positive document is
    graded by the most occurrences of one marker, a feature of 1 % or more of the positive
    documents and of no other: up to one 1, up to three 2, beyond 3. Without positive or
    without other rows the model gives 0 to every text.
    """
    sample = cut_lineage(sample.select("doc_id", "label", "share", "text"))
    sides = {r[0]: r[1] for r in sample.groupBy((F.col("label") > 0).alias("p"))
             .agg(F.count(F.lit(1))).collect()}
    if len(sides) < 2:
        return Severity({}, ())

    def distinct():
        return lambda columns: [(sorted({f for w in set(byte_words(t)) for f in features_of(w)}),)
                                for t in columns[0]]

    seen = per_row(sample, "f array<binary>", distinct, ["text"], ["label"])
    known = (seen.select((F.col("label") > 0).cast("int").alias("p"), F.explode_outer("f").alias("w"))
             .groupBy("w").agg(F.sum("p").alias("positive"), F.count(F.lit(1)).alias("n"))
             .where(F.col("w").isNotNull() & (F.col("n") >= min_documents))
             .withColumn("chi2", _chi2(sides[True], sides[False]))
             .where(F.col("chi2") >= LEAST_CHI2)
             .orderBy(F.desc("chi2"), "w").limit(max_words).collect())
    index = {bytes(r["w"]): i for i, r in enumerate(known)}
    marks = {i for w, i in index.items() if known[i]["positive"] == known[i]["n"]
             and known[i]["n"] >= max(min_documents, 0.01 * sides[True])}

    def counts():
        found = Known(index)

        def work(columns):
            out = []
            for text in columns[0]:
                hits = found(text)
                out.append(([index[f] for f in hits], list(hits.values())))
            return out
        return work

    rows = sorted(per_row(sample, "ids array<int>, counts array<int>", counts, ["text"],
                          ["doc_id", "label", "share"]).collect(), key=lambda r: r["doc_id"])
    grades = np.array([r["label"] for r in rows])
    if grades.max() == 1:
        marked = np.array([max((c for i, c in zip(r["ids"], r["counts"]) if i in marks), default=0)
                           for r in rows])
        grades = np.where(grades == 0, 0, 1 + (marked > 1) + (marked > 3))
        grades = np.unique(grades, return_inverse=True)[1]
    sizes = [len(r["ids"]) for r in rows]
    beta, cuts = train(np.repeat(np.arange(len(rows)), sizes),
                       np.concatenate([np.array(r["ids"], int) for r in rows]),
                       1 + np.log(np.concatenate([np.array(r["counts"], float) for r in rows])),
                       grades, np.array([1 / r["share"] for r in rows]), len(index))
    return Severity({w: float(beta[i]) for w, i in index.items()}, tuple(cuts.tolist()))


def _work(model: Severity):
    def make():
        score = model.scorer()
        return lambda columns: score(columns[0])
    return make


def score(docs: DataFrame, model: Severity, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: doc_id) plus p_toxic, severity and grade of each row.

    NULL and empty texts hold no known word and get the scores of such a text. Extra columns
    of ``docs`` are read only if kept; a kept name that clashes is the caller's to rename.
    """
    return per_row(docs, "p_toxic double, severity double, grade int",
                   _work(model), ["text"], ["doc_id"] if keep is None else keep)


def reject(docs: DataFrame, model: Severity, least: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose probability of grade 1 or more is below ``least``."""
    names = docs.columns
    text, plain = fresh(docs, "_text"), [f"_c{i}" for i in range(len(names))]
    inner = docs.toDF(*plain).withColumn(text, F.col(plain[names.index("text")]))
    scored = per_row(inner, "p_toxic double, severity double, grade int",
                     _work(model), [text], plain)
    return scored.where(F.col("p_toxic") < least).select(*plain).toDF(*names)


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Severity:
    """Fit on labels.toxic of the documents that are not held out (fold 0 of five is)."""
    keep = fold(F.col("doc_id"), FOLDS) != 0
    return fit(labelled_sample(docs, labels, "toxic", fit_rows, keep))


def report(docs: DataFrame, model: Severity) -> DataFrame:
    """doc_id, held_out, p_toxic, severity, grade and rejected of every row."""
    return score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "p_toxic", "severity",
        "grade", (F.col("p_toxic") >= 0.5).alias("rejected"))
