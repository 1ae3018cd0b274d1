"""Language identification by cross-parsing entropy.

Per language a suffix automaton of labelled text accepts exactly the substrings of that text. A
text is parsed greedily into the longest stretches that an automaton accepts; the phrases needed,
times the logarithm of the length learned from, per letter, estimate its entropy under that
language, and the language with the fewest such normalised phrases wins.

Texts are lower-cased, runs of anything but letters become one blank. Parsing runs in step over
many whole texts and all languages: one table lookup a letter, a binary search for letters beyond the
``TABLE_LETTERS`` most frequent. The ends of the few longest texts of a batch are parsed one by one.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import fold, per_row, uniform

SAMPLES = 64
TRAIN_CHARS = 60_000
ALL_CHARS = 400_000
MAX_LANGUAGES = 200
TABLE_LETTERS = 80
#: So many texts at least are parsed in step.
TOGETHER = 12
FOLDS = 3
HELD_OUT = 1

_letters = None


def letter_table() -> np.ndarray:
    """Whether a code point is a letter (any Unicode category L)."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)),
                               bool, 0x110000)
    return _letters


def normalise(text: bytes | None) -> np.ndarray:
    """Code points of the lower-cased text, other than letters one blank (32) a run."""
    if not text:
        return np.zeros(0, np.uint32)
    points = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)
    letters = letter_table()[points]
    keep = letters | np.concatenate([[False], letters[:-1]])
    return np.where(letters, points, 32)[keep]


def transitions(codes: np.ndarray) -> list[dict[int, int]]:
    """By state of the suffix automaton of a sequence, the state that each letter leads to."""
    following, link, length = [{}], [-1], [0]
    last = 0
    for c in codes.tolist():
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p != -1:
            q = following[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and following[p].get(c) == q:
                    following[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return following


def split(following: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """A table of the transitions by letters below ``width`` (-1 where there is none), and rows
    (state, letter, to) of the others."""
    table = np.full((len(following), width), -1, np.int32)
    rest = []
    for state, out in enumerate(following):
        for c, to in out.items():
            if c < width:
                table[state, c] = to
            else:
                rest.append((state, c, to))
    return table, np.array(rest, np.int64).reshape(-1, 3)


def automaton(codes: np.ndarray, width: int) -> np.ndarray:
    """Transitions (state, letter) of the suffix automaton of a sequence; -1 where there is none."""
    return split(transitions(codes), width)[0]


@dataclass(frozen=True)
class Languages:
    """Learned languages: their names, letters (sorted code points) and codes (by frequency from
    1; 0 is a letter of no language), the transitions of all automata, the state each begins in,
    and the lengths learned from. Transitions by the first codes are in one table, those by
    others in sorted ``keys`` (state times letters, plus code) with their ``targets``."""

    names: tuple[str, ...]
    letters: np.ndarray
    numbers: np.ndarray
    table: np.ndarray
    keys: np.ndarray
    targets: np.ndarray
    roots: np.ndarray
    sizes: np.ndarray

    def codes(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, self.numbers[at], 0)

    def follow(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states (sequence, language) after one more letter of each sequence, or -1."""
        width = self.table.shape[1]
        rare = np.flatnonzero(codes >= width) if len(self.keys) else ()
        if not len(rare):
            return self.table.reshape(-1)[state * width + codes[:, None]]
        to = self.table.reshape(-1)[state * width + np.where(codes < width, codes, 0)[:, None]]
        key = np.broadcast_to(state, to.shape)[rare] * (len(self.letters) + 1) + codes[rare, None]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        to[rare] = np.where(self.keys[at] == key, self.targets[at], -1)
        return to

    def phrases(self, codes: list[np.ndarray]) -> np.ndarray:
        """Phrases of each sequence under each language."""
        size = np.array([len(c) for c in codes])
        order = np.argsort(-size, kind="stable")
        order = order[size[order] > 0]
        n = np.zeros((len(codes), len(self.names)))
        if not len(order):
            return n
        size = size[order]
        everything = np.concatenate([codes[i] for i in order])
        start = np.cumsum(size) - size
        state = np.tile(self.roots, (len(order), 1))
        count = np.zeros((len(order), len(self.names)))
        alive = len(order)
        for step in range(int(size[0])):
            alive = int(np.searchsorted(-size, -step, side="left"))
            if alive < TOGETHER and not len(self.keys):
                break
            c = everything[start[:alive] + step]
            at = state[:alive]
            to = self.follow(at, c)
            stop = to < 0
            count[:alive] += stop | (at == self.roots)
            if stop.any():
                # The phrase ends before this letter, which begins the next one; a letter that
                # the language does not have is a phrase of its own.
                again = self.follow(self.roots[None, :], c)
                to = np.where(stop, np.where(again < 0, self.roots[None, :], again), to)
            state[:alive] = to
        else:
            alive = 0
        for i in range(alive):
            rest = everything[start[i] + step:start[i] + size[i]].tolist()
            for j, root in enumerate(self.roots.tolist()):
                count[i, j] += self._one(rest, root, int(state[i, j]))
        n[order] = count
        return n

    def _one(self, codes: list[int], root: int, state: int) -> int:
        """Phrases that begin in the rest of one sequence under one language."""
        table, width, n = memoryview(self.table.reshape(-1)), self.table.shape[1], 0
        for c in codes:
            to = table[state * width + c]
            if to < 0:
                n += 1
                to = table[root * width + c]
                if to < 0:
                    to = root
            elif state == root:
                n += 1
            state = to
        return n

    def predict(self, texts: list[bytes | None]) -> list[tuple[str, float]]:
        """(language, score) of each text; ``und`` and 0 without a letter or a learned language."""
        points = [normalise(t) for t in texts]
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        some = [i for i, p in enumerate(points) if len(p)]
        if not some or not self.names:
            return out
        count = self.phrases([self.codes(points[i]) for i in some])
        lengths = np.array([len(points[i]) for i in some])[:, None]
        entropy = count * np.log2(self.sizes)[None, :] / lengths
        order = np.argsort(entropy, axis=1, kind="stable")
        best = entropy[np.arange(len(some)), order[:, 0]]
        if len(self.names) > 1:
            second = entropy[np.arange(len(some)), order[:, 1]]
            score = 1 - best / (best + second)
        else:
            score = np.ones(len(some))
        for i, o, s in zip(some, order[:, 0], score):
            out[i] = (self.names[o], float(s))
        return out


def build(samples: dict[str, list[str]], train_chars: int = TRAIN_CHARS) -> Languages:
    """Automata of each language's texts: whole ones, in their order, as long as they fit into
    ``train_chars`` letters (the shortest one, if none does); fewer letters where all languages together would
    exceed ``ALL_CHARS``."""
    learned = {}
    train_chars = min(train_chars, ALL_CHARS // max(1, len(samples)))
    for name in sorted(samples):
        every = [p for p in (normalise(text.encode()) for text in samples[name]) if len(p)]
        points, total = [], 0
        for p in every:
            if total + len(p) <= train_chars:
                points.append(p)
                total += len(p)
        points = points or sorted(every, key=len)[:1]
        if points:
            learned[name] = np.concatenate(points)
    if not learned:
        none = np.zeros(0, np.int64)
        return Languages((), np.array([32], np.uint32), np.array([1]),
                         np.full((1, 2), -1, np.int32), none, none, none, np.zeros(0))
    letters, times = np.unique(np.concatenate(list(learned.values())), return_counts=True)
    numbers = np.empty(len(letters), np.int64)
    numbers[np.lexsort((letters, -times))] = np.arange(1, len(letters) + 1)
    width = min(TABLE_LETTERS, len(letters)) + 1
    tables, others, roots, base = [], [], [], 0
    for name in learned:
        table, rest = split(transitions(numbers[np.searchsorted(letters, learned[name])]), width)
        roots.append(base)
        tables.append(np.where(table < 0, -1, table + base).astype(np.int32))
        others.append(rest + [base, 0, base])
        base += len(table)
    rest = np.concatenate(others)
    keys = rest[:, 0] * (len(letters) + 1) + rest[:, 1]
    order = np.argsort(keys)
    return Languages(tuple(learned), letters, numbers, np.concatenate(tables), keys[order],
                     rest[order, 2], np.array(roots),
                     np.array([len(p) for p in learned.values()], float) + 1)


def sample(docs: DataFrame, samples: int = SAMPLES) -> dict[str, list[str]]:
    """Per language the texts of at most ``samples`` documents that are not held out.

    From each of ``samples`` hash buckets of a language the document of the smallest hash is
    taken; identifiers first, texts in a second scan.
    """
    text, lang = F.col("text").cast("string"), F.col("lang").cast("string")
    known = docs.where(lang.isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                       & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    place = uniform(F.col("doc_id"), F.lit("lang"))
    found = known.select(lang.alias("lang"), "doc_id", place.alias("at")).groupBy(
        "lang", F.floor(F.col("at") * samples).alias("bucket")).agg(
        F.min(F.struct("at", "doc_id")).alias("m"))
    chosen = found.select("lang", "m.doc_id", "m.at").limit(MAX_LANGUAGES * samples + 1).collect()
    if len(chosen) > MAX_LANGUAGES * samples:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    ids = sorted({r["doc_id"] for r in chosen})
    texts = known.where(F.col("doc_id").isin(ids)) if ids else known.where("false")
    rows = texts.select(lang.alias("lang"), "doc_id", text.alias("text")).groupBy(
        "lang", "doc_id").agg(F.min("text").alias("text")).collect()
    by_id = {(r["lang"], r["doc_id"]): r["text"] for r in rows}
    out: dict[str, list[str]] = {}
    for r in sorted(chosen, key=lambda r: (r["lang"], r["at"], r["doc_id"])):
        out.setdefault(r["lang"], []).append(by_id[r["lang"], r["doc_id"]])
    return out


def learn(docs: DataFrame, samples: int = SAMPLES, train_chars: int = TRAIN_CHARS) -> Languages:
    """Languages of the column ``lang``, from rows that are not held out (crc32 of the id modulo
    3 is 1); at most ``train_chars`` letters each."""
    return build(sample(docs, samples), train_chars)


def report(docs: DataFrame, model: Languages) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    NULL texts and texts without a letter are ``und`` with score 0. The score is the second
    best entropy's share of the sum of the two best: 0.5 for a tie, which goes to the name that
    sorts first. A NULL doc_id counts as fold 0. Very long texts are parsed whole. An empty table gives no
    rows. Extra columns are not read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by MAX_LANGUAGES and TRAIN_CHARS

    def make():
        found = shared.value

        def work(columns):
            texts, out = columns[0], []
            at = 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (held < 8_000_000 or end == at):
                    held += len(texts[end] or b"")
                    end += 1
                out += found.predict(texts[at:end])
                at = end
            return out
        return work

    rows = docs.select("doc_id", "text")
    return per_row(rows, "lang_pred string, score double", make, ["text"], ["doc_id"]).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
