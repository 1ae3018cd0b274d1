"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

Trees grow level by level on 64 quantile bins of each statistic, with gradients and curvatures
of the logistic loss summed per (node, statistic, bin). The fitted trees are flat arrays (statistic,
threshold, children, value), which many documents walk at once.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import fold, per_row
from .toxicity import labelled_sample

FIT_ROWS = 20_000
FOLDS = 5
THRESHOLD = 0.3
BINS = 64

_kinds = np.zeros((256, 8))
for _b in range(256):
    _c = chr(_b)
    _kinds[_b] = [_b < 128 and _c.isupper(), _b < 128 and _c.islower(), _c.isdigit() and _b < 128,
                  _b in b" \t\n\r\x0b\x0c", _b in b".,;:'\"()-?", _b in b"#$%&*|!<>{}[]=@\\^_~+/`",
                  _b in b"!", _b >= 128]

STATISTICS = ("bytes", "upper", "lower", "digit", "blank", "mark", "symbol", "shout", "beyond",
              "entropy", "words", "word_length", "distinct", "top_word", "repeats", "odd_ends",
              "short_words", "lines", "line_length", "line_copies", "sentences", "word_spread")


def statistics(text: bytes | None) -> list[float]:
    """The numbers the trees see; all 0 for NULL and empty texts."""
    if not text:
        return [0.0] * len(STATISTICS)
    n = len(text)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = count @ _kinds
    share = count[count > 0] / n
    ws = text.split()
    m = max(1, len(ws))
    sizes = np.fromiter(map(len, ws), np.int64, len(ws))
    times = Counter(ws)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [np.log1p(n), *(kinds / n).tolist(), float(-(share * np.log(share)).sum()),
            np.log1p(len(ws)), float(sizes.mean()) if len(ws) else 0.0, len(times) / m,
            max(times.values(), default=0) / m,
            sum(map(bytes.__eq__, ws, ws[1:])) / m,
            sum(map(_odd.__contains__, [w[-1] for w in ws])) / m,
            float((sizes <= 3).mean()) if len(ws) else 0.0,
            np.log1p(len(lines)), np.log1p(n / max(1, len(lines))),
            1 - len(set(lines)) / max(1, len(lines)), (count[46] + count[63]) / m,
            float(sizes.std()) if len(ws) else 0.0]


_odd = frozenset(b"#$%&*|!<>{}[]=@\\^_~+/`")


@dataclass(frozen=True)
class Trees:
    """Trees in flat arrays; a leaf is its own child. ``start`` has the root of each tree."""

    bias: float
    start: np.ndarray
    statistic: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        node = np.tile(self.start, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            low = x[rows, self.statistic[node]] <= self.threshold[node]
            node = np.where(low, self.left[node], self.right[node])
        total = self.bias + self.value[node].sum(1)
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None, trees: int = 80,
          depth: int = 4, rate: float = 0.12, ridge: float = 2.0, least: float = 1.0) -> Trees:
    """Boost trees on rows of statistics and 0/1 labels.

    ``least`` is the curvature a child must have. With one label only, every score is that
    label's share, and 0.5 without rows.
    """
    w = np.ones(len(y)) if weights is None else weights
    share = float((w * y).sum() / w.sum()) if len(y) else 0.5
    share = min(max(share, 1e-3), 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    width = x.shape[1]
    flat: dict[str, list] = {k: [] for k in ("statistic", "threshold", "left", "right", "value")}
    start = []
    if len(y) and 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
        raw = np.full(len(y), bias)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            g, h = w * (p - y), w * p * (1 - p)
            base = len(flat["value"])
            start.append(base)
            ids = np.full(len(y), base)
            level = [base]
            for v in flat.values():
                v.append(0)
            flat["left"][base] = flat["right"][base] = base
            for d in range(depth + 1):
                slot = {node: i for i, node in enumerate(level)}
                local = np.array([slot.get(i, -1) for i in range(base, len(flat["value"]))])[ids - base]
                live = local >= 0
                at = ((local[live, None] * width + np.arange(width)) * BINS + binned[live]).ravel()
                size = len(level) * width * BINS
                gs = np.bincount(at, np.repeat(g[live], width), size).reshape(len(level), width, BINS)
                hs = np.bincount(at, np.repeat(h[live], width), size).reshape(len(level), width, BINS)
                G, H = gs[:, 0].sum(1), hs[:, 0].sum(1)
                for i, node in enumerate(level):
                    flat["value"][node] = float(-rate * G[i] / (H[i] + ridge))
                if d == depth:
                    break
                gl, hl = gs.cumsum(2)[:, :, :-1], hs.cumsum(2)[:, :, :-1]
                gr, hr = G[:, None, None] - gl, H[:, None, None] - hl
                gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - (G ** 2 / (H + ridge))[:, None, None]
                gain = np.where((hl >= least) & (hr >= least), gain, -1.0)
                following = []
                for i, node in enumerate(level):
                    j, b = divmod(int(gain[i].argmax()), BINS - 1)
                    if gain[i, j, b] <= 1e-9 or b >= len(cuts[j]):
                        continue
                    low = len(flat["value"])
                    for child in (low, low + 1):
                        for v in flat.values():
                            v.append(0)
                        flat["left"][child] = flat["right"][child] = child
                    flat["statistic"][node], flat["threshold"][node] = j, float(cuts[j][b])
                    flat["left"][node], flat["right"][node] = low, low + 1
                    mine = ids == node
                    ids[mine] = np.where(binned[mine, j] <= b, low, low + 1)
                    following += [low, low + 1]
                if not following:
                    break
                level = following
            raw += np.array(flat["value"][base:])[ids - base]
    return Trees(bias, np.array(start, int), np.array(flat["statistic"], int),
                 np.array(flat["threshold"], float), np.array(flat["left"], int),
                 np.array(flat["right"], int), np.array(flat["value"], float), depth)


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Trees:
    """Fit on labels.quality (1 above 0) of at most about ``fit_rows`` rows, none held out."""
    keep = fold(F.col("doc_id"), FOLDS) != 0
    sample = labelled_sample(docs, labels, "quality", fit_rows, keep)

    def make():
        return lambda columns: [(statistics(t),) for t in columns[0]]

    rows = sorted(per_row(sample, "x array<double>", make, ["text"],
                          ["doc_id", "label", "share"]).collect(), key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in rows]).reshape(-1, len(STATISTICS))
    return train(x, np.array([r["label"] > 0 for r in rows], float),
                 np.array([1 / r["share"] for r in rows]))


def report(docs: DataFrame, model: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out (crc32 of the id modulo 5 is 0), score and predicted of every row.

    Only the text is scored; NULL counts as empty, and both get the score of such a text. A
    NULL doc_id counts as held out. Extra columns are not read.
    """
    def make():
        def work(columns):
            x = np.array([statistics(t) for t in columns[0]])
            return [(s,) for at in range(0, len(x), 2000) for s in model.score(x[at:at + 2000]).tolist()]
        return work

    rows = per_row(docs.select("doc_id", F.col("text").cast("string").alias("text")),
                   "score double", make, ["text"], ["doc_id"])
    return rows.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))
