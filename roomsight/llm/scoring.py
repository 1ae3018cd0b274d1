"""Language-model scoring by masked pseudo-likelihood.

Every word is predicted from the words on both sides of it (two each) by a small network: embeddings per
place, a hidden layer, and a softmax of two levels, both from the hidden vector: the group of the
word, then its cell within the group. The most frequent words have cells of their own; the others share
cells by their last letters. A word's probability is that of its group, times that of its cell, times its
share of the cell. Shares come from the counts of all words of all documents: the ``LISTED`` most
frequent ones go to every task, the others are joined to the written counts.

The network is trained in numpy on all documents. These are dealt out by hash into parts of about
``WORDS_A_PART`` words, whose number grows with the corpus and not with the tasks; in each round every part takes
the current parameters through all its words, each the target once, and the results are averaged by
words seen (summed in ``GROUPS`` groups before the driver sees them). So scores do not depend on how
the documents lie in files. A score is the sum of the logarithms of all conditional probabilities of a text. Words
become cell numbers once, written to the shared folder, and rounds and scoring read those.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .common import byte_blanks, map_arrow, reach

TOP = 32
SUB = 64
CELLS = TOP * SUB
HEAD = 1_536
LISTED = 200_000
#: Counts below are told apart one by one, larger ones by steps of about a hundredth.
EXACT = 4_096
HIDDEN = 16
PLACES = (-2, -1, 1, 2)
ROUNDS = 2
GROUPS = 8
BATCH = 8_192
RATE = 0.15
#: Squares of gradients that the step sizes start from.
FIRST = 1e-7
PAD = CELLS
WORDS_A_PART = 2_000_000
#: Logits are cut there, far beyond any that training reaches; their exponentials stay finite.
FAR = 60.0
LN2 = 0.6931471805599453
#: Added to a small number of 4 bytes, it leaves the nearest whole number in the last bits.
ROUNDER = np.float32(1.5 * 2 ** 23)
#: Of 2 ** x, |x| <= 0.5: the powers 4 to 1.
POWERS = [np.float32(c) for c in (0.00958285, 0.05590643, 0.24024099, 0.69312419)]
#: Words whose logits are made at a time: 96 of 4 bytes each, 384 KB.
PIECE = 1_024
#: Bytes of texts whose words are listed at a time.
SLICE = 8 << 20


class Numbers(dict):
    """-1 for words that are not listed."""

    def __missing__(self, word: bytes) -> int:
        return -1


@dataclass(frozen=True)
class Vocabulary:
    """Counts of the corpus: the listed words' numbers, and by number the cell and the logarithm of
    the word's share of it; ``mass`` has the logarithm of a cell's count."""

    numbers: Numbers
    cells: np.ndarray
    shares: np.ndarray
    mass: np.ndarray

    def split(self, texts: list[bytes | None]) -> list[tuple[bytes, int, float, list[bytes]]]:
        """Of each text the cells (two bytes each), their number, the logarithms of the shares summed but for
        the counts of the words that are not listed, and these words."""
        words, length = word_array(texts)
        words = words.dictionary_encode()
        # Each different word is looked up once.
        found = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.numbers.__getitem__, found), np.int64, len(found))
        cell, share = self.cells[number].astype(np.uint16), self.shares[number]
        for i in np.flatnonzero(number < 0).tolist():
            cell[i] = c = tail_cell(found[i])
            share[i] = -self.mass[c]
        place = words.indices.to_numpy()
        end = np.cumsum(length)
        others: list[list[bytes]] = [[] for _ in texts]
        missing = np.flatnonzero((number < 0)[place])
        for i, k in zip(np.searchsorted(end, missing, side="right").tolist(), place[missing].tolist()):
            others[i].append(found[k])
        total = np.zeros(len(texts))
        some = length > 0
        if some.any():  # a text's sum does not depend on the texts around it
            total[some] = np.add.reduceat(share[place], (end - length)[some])
        cells = cell[place]
        return [(cells[e - k:e].tobytes(), k, t, o)
                for e, k, t, o in zip(end.tolist(), length.tolist(), total.tolist(), others)]


def word_array(texts: list[bytes | None]) -> tuple[pa.BinaryArray, np.ndarray]:
    """The words of ``byte_words`` of all texts in a row, and their number in each text."""
    whole = byte_blanks(b" ".join([b"", *(t or b"" for t in texts), b""]))
    letters = np.frombuffer(whole, np.uint8)
    inside = letters != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # begins and ends in turn
    begin, end = edge[::2], edge[1::2]
    offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets),
                                                                 pa.py_buffer(letters[inside])])
    stop = np.cumsum([len(t or b"") + 1 for t in texts], dtype=np.int64)
    return words, np.diff(np.searchsorted(begin, stop, side="right"), prepend=0)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with together about ``SLICE`` bytes of a text."""
    size = np.cumsum([len(t or b"") for t in batch.column(column).to_pylist()]) // SLICE
    edge = [0, *(np.flatnonzero(size[1:] != size[:-1]) + 1).tolist(), batch.num_rows]
    for a, b in zip(edge, edge[1:]):
        if a < b:
            yield batch.slice(a, b - a)


def tail_cell(word: bytes) -> int:
    """Cell of a word that is not frequent: by crc32 of its last three bytes."""
    return HEAD + zlib.crc32(word[-3:]) % (CELLS - HEAD)


def word_counts(docs: DataFrame) -> DataFrame:
    """(w binary, n) of all words of all documents, written once; a task adds up what it reads first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                found = word_array(part.column(0).to_pylist())[0].value_counts()
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["w", "n"])

    texts = docs.select(F.col("text").cast("string").cast("binary").alias("text"))
    return cut_lineage(map_arrow(texts, count, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n")))


def vocabulary(docs: DataFrame, listed: int = LISTED, counts: DataFrame | None = None) -> Vocabulary:
    """Of the counts of all words at most the ``listed`` largest, and the sums per cell, reach the driver.

    Counts are listed down to the least level of counts that keeps to that number.
    """
    counts = word_counts(docs) if counts is None else counts
    level = F.when(F.col("n") < EXACT, F.col("n")).otherwise(EXACT + F.floor(F.log2("n") * 64)).cast("long")
    most, least = 0, 1 << 60
    for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("level")).collect():
        most += r["k"]
        if most > listed:
            break
        least = r["level"]
    top = sorted(((bytes(r["w"]), r["n"]) for r in counts.where(level >= least).collect()),
                 key=lambda x: (-x[1], x[0]))
    end = F.when(F.octet_length("w") <= 3, F.col("w")).otherwise(F.substring("w", -3, 3))
    tail = HEAD + F.pmod(F.crc32(end), F.lit(CELLS - HEAD))
    mass = np.zeros(CELLS)
    for r in counts.groupBy(tail.cast("int").alias("c")).agg(F.sum("n").alias("n")).collect():
        mass[r["c"]] = r["n"]
    cells = np.zeros(len(top) + 1, np.int64)
    for i, (w, n) in enumerate(top):
        cells[i] = i if i < HEAD else tail_cell(w)
        if i < HEAD:  # a cell of its own
            mass[tail_cell(w)] -= n
            mass[i] = n
    log_mass = np.log(np.maximum(mass, 1))
    number = np.array([n for _, n in top] + [1.0])
    return Vocabulary(Numbers({w: i for i, (w, _) in enumerate(top)}), cells, np.log(number) - log_mass[cells], log_mass)


def start_parameters(seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    draw = lambda *shape: r.normal(0, 0.1, shape).astype(np.float32)
    return {"embed": draw(len(PLACES), CELLS + 1, HIDDEN), "hidden": np.zeros(HIDDEN, np.float32),
            "top": draw(HIDDEN, TOP), "top_bias": np.zeros(TOP, np.float32),
            "sub": draw(TOP, HIDDEN, SUB), "sub_bias": np.zeros((TOP, SUB), np.float32)}


def _pack(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    shapes = start_parameters()
    for k in sorted(shapes):
        n = shapes[k].size
        out[k] = flat[at:at + n].reshape(shapes[k].shape).astype(np.float32)
        at += n
    return out


def contexts(codes: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(word, place) cells around each word; the padding cell beyond its own text's ends."""
    n = len(codes)
    text = np.repeat(np.arange(len(length), dtype=np.int32), length)
    out = np.full((n, len(PLACES)), PAD, np.uint16)
    for j, d in enumerate(PLACES):
        k = abs(d)
        near = text[k:] == text[:-k]  # pairs of words of one text
        if d > 0:
            out[:-k, j] = np.where(near, codes[k:], PAD)
        else:
            out[k:, j] = np.where(near, codes[:-k], PAD)
    return out


def _by_group(context: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Rows sorted by the target's group: (context, group, cell within it, runs of a group)."""
    group = (target // SUB).astype(np.uint8)  # one byte sorts by radix
    order = np.argsort(group, kind="stable")
    group = group[order]
    edge = np.searchsorted(group, np.arange(TOP + 1)).tolist()
    runs = [(g, a, b) for g, (a, b) in enumerate(zip(edge, edge[1:])) if a < b]
    return context.take(order, axis=0), order, target.take(order) % SUB, runs


def _levels(p: dict) -> tuple[np.ndarray, np.ndarray, bool]:
    """Weights (group, hidden, ``TOP + SUB``) and biases (group, ``TOP + SUB``, 1) of both levels for every group of
    the target, times the logarithm of e to base 2; and whether no hidden vector, entries within 1 of 0, takes a
    logit beyond ``FAR``."""
    both = np.empty((TOP, HIDDEN, TOP + SUB), p["top"].dtype)
    bias = np.empty((TOP, TOP + SUB, 1), both.dtype)
    both[:, :, :TOP], both[:, :, TOP:] = p["top"], p["sub"]
    bias[:, :TOP, 0], bias[:, TOP:, 0] = p["top_bias"], p["sub_bias"]
    both *= 1 / LN2
    bias *= 1 / LN2
    return both, bias, bool((np.abs(both).sum(1) + np.abs(bias[:, :, 0])).max() <= FAR / LN2)


def _hidden(p: dict, context: np.ndarray) -> np.ndarray:
    """(hidden, word): hidden vectors."""
    s = p["embed"][0].take(context[:, 0], axis=0)
    for j in range(1, len(PLACES)):
        s += p["embed"][j].take(context[:, j], axis=0)
    s += p["hidden"]
    return np.ascontiguousarray(np.tanh(s, out=s).T)


def _pieces(runs: list) -> Iterator[tuple[int, int, list]]:
    """Stretches of at most ``PIECE`` rows, whose logits stay in a core's cache: (first, end, runs of a group, counted
    from the first)."""
    n = runs[-1][2] if runs else 0
    at = 0
    for a in range(0, n, PIECE):
        b, own = min(a + PIECE, n), []
        while at < len(runs) and runs[at][1] < b:
            g, c, d = runs[at]
            own.append((g, max(a, c) - a, min(b, d) - a))
            if d > b:
                break
            at += 1
        yield a, b, own


def _logits(both: np.ndarray, bias: np.ndarray, h: np.ndarray, own: list, near: bool) -> np.ndarray:
    """(``TOP + SUB``, word): logits of both levels to base 2, within ``FAR`` of 0."""
    z = np.empty((TOP + SUB, h.shape[1]), h.dtype)
    for g, a, b in own:
        np.matmul(both[g].T, h[:, a:b], out=z[:, a:b])
        z[:, a:b] += bias[g]
    return z if near else np.clip(z, -FAR / LN2, FAR / LN2, out=z)


def _powers(z: np.ndarray) -> np.ndarray:
    """2 ** z, in place, for z within 126 of 0.

    For 4 bytes by a polynomial in the fraction, right to 3e-6, in passes that the processor takes several numbers at a
    time; the whole part is added to the exponent's bits.
    """
    if z.dtype != np.float32:
        return np.exp2(z, out=z)
    near = z + ROUNDER
    whole = near.view(np.int32) << 23
    near -= ROUNDER
    near = np.subtract(z, near, out=near)
    np.multiply(near, POWERS[0], out=z)
    for c in POWERS[1:]:
        z += c
        z *= near
    z += np.float32(1)
    bits = z.view(np.int32)
    bits += whole
    return z


def log_probabilities(p: dict, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Logarithm of each target cell's probability given its context."""
    context, order, within, runs = _by_group(context, target)
    h, (both, bias, near) = _hidden(p, context), _levels(p)
    hit, top, sub = np.empty((3, len(target)), h.dtype)
    group, cell = target.take(order) // SUB, TOP + within.astype(np.intp)
    each, ones = np.arange(PIECE), np.ones(SUB, h.dtype)
    for a, b, own in _pieces(runs):
        z = _logits(both, bias, h[:, a:b], own, near)
        np.add(z[group[a:b], each[:b - a]], z[cell[a:b], each[:b - a]], out=hit[a:b])
        _powers(z)
        np.matmul(ones[:TOP], z[:TOP], out=top[a:b])
        np.matmul(ones, z[TOP:], out=sub[a:b])
    out = np.empty(len(target), h.dtype)
    out[order] = hit * h.dtype.type(LN2) - np.log(top) - np.log(sub)
    return out


class Trainer:
    """Adagrad over batches of target words."""

    def __init__(self, p: dict[str, np.ndarray], rate: float = RATE):
        self.p, self.rate = {k: v.copy() for k, v in p.items()}, rate
        self.sums = {k: np.full(v.shape, FIRST, v.dtype) for k, v in p.items()}

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        p, n = self.p, len(target)
        context, _, within, runs = _by_group(context, target)
        cell = TOP + within.astype(np.intp)
        h, (both, bias, near) = _hidden(p, context), _levels(p)
        back, grads, bias_grads = np.empty_like(h), np.zeros_like(both), np.zeros_like(bias[:, :, 0])
        each, ones = np.arange(PIECE), np.ones(max(SUB, PIECE), h.dtype)
        for a, b, own in _pieces(runs):
            z = _powers(_logits(both, bias, h[:, a:b], own, near))
            z[:TOP] *= 1 / (n * (ones[:TOP] @ z[:TOP]))
            z[TOP:] *= 1 / (n * (ones[:SUB] @ z[TOP:]))
            z[cell[a:b], each[:b - a]] -= 1 / n
            for g, c, d in own:
                part = z[:, c:d]
                part[g] -= 1 / n
                np.matmul(both[g], part, out=back[:, a + c:a + d])
                grads[g] += h[:, a + c:a + d] @ part.T
                bias_grads[g] += part @ ones[:d - c]
        self._move(p["top"], self.sums["top"], grads[:, :, :TOP].sum(0))
        self._move(p["top_bias"], self.sums["top_bias"], bias_grads[:, :TOP].sum(0))
        self._move(p["sub"], self.sums["sub"], grads[:, :, TOP:])
        self._move(p["sub_bias"], self.sums["sub_bias"], bias_grads[:, TOP:])
        back *= (1 - h * h) * h.dtype.type(LN2)
        self._move(p["hidden"], self.sums["hidden"], back.sum(1))
        back = np.ascontiguousarray(back.T)
        pairs = back.view(np.result_type(back, np.complex64))  # two numbers are added at a time
        for j in range(len(PLACES)):
            place = context[:, j]
            order = np.argsort(place, kind="stable")  # two bytes sort by radix
            c = place[order]
            first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            grad = np.add.reduceat(pairs.take(order, axis=0), first, axis=0).view(back.dtype)
            at = c[first].astype(np.intp)
            cells, sums = p["embed"][j].take(at, axis=0), self.sums["embed"][j].take(at, axis=0)
            self._move(cells, sums, grad)
            p["embed"][j][at], self.sums["embed"][j][at] = cells, sums

    def _move(self, values: np.ndarray, sums: np.ndarray, grad: np.ndarray) -> None:
        sums += grad * grad
        values -= self.rate * grad / np.sqrt(sums)


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(part, row, doc_id, n, codes, share, others) of every row, written once, a file per part.

    ``others`` has the words whose counts the share lacks. Parts are dealt by the hash of id and text, and
    sorted by it, so they do not depend on how the rows lie in files.
    """
    spark = docs.sparkSession
    reach(spark)
    shared = spark.sparkContext.broadcast(vocab)  # bounded by LISTED
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64("doc_id", text).alias("key"), text.cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                codes, n, share, others = zip(*shared.value.split(part.column(2).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(codes, pa.binary()),
                     pa.array(share), pa.array(others, pa.list_(pa.binary()))],
                    names=["doc_id", "key", "n", "codes", "share", "others"])

    ident = rows.schema["doc_id"].dataType.simpleString()
    made = cut_lineage(map_arrow(rows, run, f"doc_id {ident}, key long, n long, codes binary, share double, "
                                            "others array<binary>"))
    words = made.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-words // WORDS_A_PART))
    part = F.pmod("key", F.lit(parts)).cast("int")
    dealt = made.withColumn("part", part).repartitionById(parts, "part").sortWithinPartitions("part", "key", "n")
    return cut_lineage(dealt.withColumn("row", F.monotonically_increasing_id()))


def other_shares(encoded: DataFrame, counts: DataFrame) -> DataFrame:
    """(row, more): logarithms of the counts of a row's other words, summed as whole numbers of
    2**-36, so that their order does not matter."""
    fine = F.lit(2.0 ** 36)
    found = encoded.select("row", F.explode("others").alias("w")).join(counts, "w", "left")
    n = F.coalesce(F.col("n").cast("double"), F.lit(0.5))
    return found.groupBy("row").agg(
        (F.sum(F.round(F.log(n) * fine).cast("long")) / fine).alias("more"))


def _blocks(batch_codes: list[bytes], most: int = 100_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with together about ``most`` words: (first, last, codes, lengths)."""
    at = 0
    while at < len(batch_codes):
        end, held = at, 0
        while end < len(batch_codes) and (held < most or end == at):
            held += len(batch_codes[end]) // 2
            end += 1
        part = batch_codes[at:end]
        yield (at, end, np.frombuffer(b"".join(part), np.uint16), np.array([len(c) // 2 for c in part]))
        at = end


def train(encoded: DataFrame, rounds: int = ROUNDS, size: int = BATCH) -> dict[str, np.ndarray]:
    """Parameters after ``rounds`` averages over all parts; the start values without any word.

    Every word is a target in every round.
    """
    p = start_parameters()
    for number in range(rounds):
        now, current = number, p

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, trainer, seen, rng = None, None, 0, None

            def out():
                return pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([seen]), pa.array([_pack(trainer.p).tobytes()])],
                    names=["part", "n", "params"])

            for batch in batches:
                own = batch.column(0).to_numpy()
                edge = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
                for a, b in zip(edge, edge[1:]):
                    if a == b:
                        continue
                    if own[a] != part:  # the next part of this task
                        if seen:
                            yield out()
                        part, trainer, seen = int(own[a]), Trainer(current), 0
                        rng = np.random.default_rng([now, part])
                    for _, _, codes, length in _blocks(batch.column(1).slice(a, b - a).to_pylist()):
                        pick = rng.permutation(len(codes))
                        context = contexts(codes, length)
                        for i in range(0, len(pick), size):
                            at = pick[i:i + size]
                            trainer.step(context.take(at, axis=0), codes.take(at))
                        seen += len(pick)
            if seen:
                yield out()

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("part")
            total = sum(n * np.frombuffer(b, np.float32).astype(float)
                        for n, b in zip(pdf["n"], pdf["params"]))
            return pd.DataFrame({"g": [int(pdf["part"].iloc[0] % GROUPS)], "n": [int(pdf["n"].sum())],
                                 "params": [np.asarray(total, float).tobytes()]})

        sums = (map_arrow(encoded.select("part", "codes"), run, "part int, n long, params binary")
                .groupBy(F.pmod("part", F.lit(GROUPS))).applyInPandas(add, "g int, n long, params binary")
                .collect())
        sums = sorted(sums, key=lambda r: r["g"])
        if sums:
            p = _unpack(sum(np.frombuffer(r["params"]) for r in sums) / sum(r["n"] for r in sums))
    return p


def score(encoded: DataFrame, p: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, row, n_words, log_likelihood) of every row, without the counts of the other words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            out = []
            for _, _, codes, length in _blocks(batch.column(2).to_pylist()):
                lp = np.empty(len(codes))
                context = contexts(codes, length)
                for i in range(0, len(codes), 4 * BATCH):
                    lp[i:i + 4 * BATCH] = log_probabilities(p, context[i:i + 4 * BATCH], codes[i:i + 4 * BATCH])
                stop = np.cumsum(length)
                sums = np.concatenate([[0.0], np.cumsum(lp)])
                out.append(sums[stop] - sums[stop - length])
            whole = np.concatenate(out) + batch.column(3).to_numpy()
            n = batch.column(4).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4),
                                              pa.array(np.where(n > 0, whole, 0.0))],
                                             names=["doc_id", "row", "n_words", "log_likelihood"])

    ident = encoded.schema["doc_id"].dataType.simpleString()
    return map_arrow(encoded.select("doc_id", "row", "codes", "share", "n"), run,
                     f"doc_id {ident}, row long, n_words long, log_likelihood double")


def report(docs: DataFrame, listed: int = LISTED, rounds: int = ROUNDS, size: int = BATCH) -> DataFrame:
    """doc_id, n_words, log_likelihood (summed) and per_word (mean; NULL without words).

    NULL, empty and wordless texts have no words and likelihood 0. Repeated rows count and are
    scored each. An empty table gives no rows. Very long texts are read whole, in blocks of words within a
    task. Extra columns are not read.
    """
    counts = word_counts(docs)
    encoded = encode(docs, vocabulary(docs, listed, counts))
    scored = score(encoded, train(encoded, rounds, size))
    whole = F.col("log_likelihood") + F.coalesce("more", F.lit(0.0))
    return scored.join(other_shares(encoded, counts), "row", "left").select(
        "doc_id", "n_words", whole.alias("log_likelihood"),
        F.when(F.col("n_words") > 0, whole / F.col("n_words")).alias("per_word"))
