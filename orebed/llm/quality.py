"""Quality by a generalised additive model with pairwise interactions.

Numbers that describe a text (lengths, shares of kinds of characters, repetition) are cut into
bins. Shallow trees are boosted in turn on one feature at a time; as each sees one feature,
their sum is a table by bin. Then the pairs of features that explain most of what is left get
tables of two bins, boosted the same way. A score is a sum of table look-ups.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame

from orebed.llm.common import label_counts, labelled_texts, per_text

BINS = 48
PAIR_BINS = 12
PAIRS = 8
ROUNDS = 120
RATE = 0.15
LEAST = 12  # rows in a leaf

#: Bounds of the sample: documents of each label, and bytes of text in all.
PER_CLASS = 4_000
SAMPLE_BYTES = 40_000_000

FEATURES = (
    "bytes words mean_word upper digit space newline period comma exclamation question bar other_ascii non_ascii"
    " distinct_words top_word repeats distinct_lines short_lines capital_words odd_words sentence"
).split()

_KINDS = np.zeros((256, 12), dtype=np.int64)
for _column, _chars in enumerate(
    [range(65, 91), range(48, 58), b" ", b"\n", b".", b",", b"!", b"?", b"|"]
):
    _KINDS[list(_chars), _column] = 1
_KINDS[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,!?|"], 9] = 1
_KINDS[128:, 10] = 1
_PLAIN = bytes(range(256)).lower()


def features(text: bytes | None) -> list[float]:
    """The numbers of ``FEATURES`` for a text; all zero for a null or empty one."""
    if not text:
        return [0.0] * len(FEATURES)
    n = len(text)
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) @ _KINDS
    words = text.split()
    k = max(1, len(words))
    lower = text.translate(_PLAIN).split()
    seen: dict[bytes, int] = {}
    for w in lower:
        seen[w] = seen.get(w, 0) + 1
    repeats = sum(map(bytes.__eq__, lower, lower[1:]))
    capital = sum(map(bytes.isupper, words))
    odd = sum(1 for w in seen if not w.rstrip(b".,;:!?").isalnum() and w.isascii())
    lines = text.split(b"\n")
    short = sum(1 for x in lines if len(x) < 25)
    stops = counts[4] + counts[6] + counts[7]
    return [
        np.log1p(n),
        np.log1p(len(words)),
        n / k,
        *(counts[[0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]] / n).tolist(),
        len(seen) / k**0.8,
        max(seen.values(), default=0) / k,
        repeats / k,
        len(set(lines)) / len(lines),
        short / len(lines),
        capital / k,
        odd / max(1, len(seen)),
        k / (1 + stops),
    ]


def _tree(grad: np.ndarray, hess: np.ndarray, count: np.ndarray, depth: int, least: int = LEAST) -> np.ndarray:
    """Leaf values by bin of a shallow tree over ordered bins."""
    out = np.zeros(len(grad))

    def grow(a: int, b: int, left: int) -> None:
        g, h, c = (np.cumsum(x[a:b]) for x in (grad, hess, count))
        value = g[-1] / (h[-1] + 1.0)
        if left and b - a > 1:
            gain = g[:-1] ** 2 / (h[:-1] + 1) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1)
            gain[(c[:-1] < least) | (c[-1] - c[:-1] < least)] = -1
            cut = int(gain.argmax())
            if gain[cut] > g[-1] ** 2 / (h[-1] + 1) + 1e-9:
                grow(a, a + cut + 1, left - 1)
                grow(a + cut + 1, b, left - 1)
                return
        out[a:b] = value

    grow(0, len(grad), depth)
    return out


class Model:
    """Edges and tables of features and of pairs."""

    constant: float | None = None

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Model:
        self.edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
        self.coarse = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
        bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]
        coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.coarse)]
        share = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        z = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            for j, b in enumerate(bins):
                step = RATE * _tree(*_sums(b, len(self.tables[j]), z, y, weight), depth=2)
                self.tables[j] += step
                z += step[b]
        self.pairs = self._best_pairs(coarse, z, y, weight)
        self.pair_tables = [np.zeros((len(self.coarse[a]) + 1, len(self.coarse[b]) + 1)) for a, b in self.pairs]
        for _ in range(ROUNDS // 2):
            for (a, b), table in zip(self.pairs, self.pair_tables):
                step = RATE * self._pair_tree(coarse[a], coarse[b], table.shape, z, y, weight)
                table += step
                z += step[coarse[a], coarse[b]]
        return self

    @staticmethod
    def _pair_tree(a, b, shape, z, y, weight) -> np.ndarray:
        """A cut along one feature, then a shallow tree along the other on each side."""
        sums = [s.reshape(shape) for s in _sums(a * shape[1] + b, shape[0] * shape[1], z, y, weight)]
        rows = [s.sum(axis=1) for s in sums]
        halves = _tree(*rows, depth=1)
        out = np.zeros(shape)
        for value in np.unique(halves):
            at = halves == value
            out[at] = _tree(*(s[at].sum(axis=0) for s in sums), depth=2)
        return out

    def _best_pairs(self, coarse, z, y, weight) -> list[tuple[int, int]]:
        """The pairs whose table of bins explains most of the residual."""
        gains = []
        for a, b in combinations(range(len(coarse)), 2):
            size = len(self.coarse[b]) + 1
            g, h, c = _sums(coarse[a] * size + coarse[b], (len(self.coarse[a]) + 1) * size, z, y, weight)
            gains.append((float((g**2 / (h + 1))[c >= LEAST].sum()), a, b))
        return [(a, b) for _, a, b in sorted(gains, reverse=True)[:PAIRS]]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            z += table[np.searchsorted(edges, x[:, j], side="right")]
        coarse = {j: np.searchsorted(self.coarse[j], x[:, j], side="right") for pair in self.pairs for j in pair}
        for (a, b), table in zip(self.pairs, self.pair_tables):
            z += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def _sums(bins: np.ndarray, size: int, z: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Gradients, second derivatives and rows by bin, of the logistic loss at ``z``."""
    p = 1 / (1 + np.exp(-z))
    return (
        np.bincount(bins, weight * (y - p), size),
        np.bincount(bins, weight * p * (1 - p), size),
        np.bincount(bins, minlength=size),
    )


def fit(
    documents: DataFrame,
    labels: DataFrame,
    of: int = 4,
    held_out: int = 2,
    per_class: int = PER_CLASS,
    max_bytes: int = SAMPLE_BYTES,
) -> Model:
    """A model of ``labels.quality``.

    Learns from about ``per_class`` documents of each label and not more than ``max_bytes`` of text,
    never from rows whose crc32(doc_id) modulo ``of`` is ``held_out``; rows weigh as their labels do in the whole
    table. With no text or one label only, the score is that label for all (0 without any).
    """
    sample = labelled_texts(documents, labels, "quality", of, held_out, per_class, max_bytes)
    return learn(sample, label_counts(labels, "quality", of, held_out))


def learn(sample: list[tuple], counts: dict[int, int]) -> Model:
    """Train on ``(text, label, ...)``; ``counts`` are the labels' numbers in the whole table, held-out rows left out."""
    y = np.array([int(row[1]) for row in sample], dtype=np.int64)
    model = Model()
    if len(set(y.tolist())) < 2:
        model.constant = float(y[0]) if len(y) else 0.0
        return model
    x = np.array([features(row[0]) for row in sample])
    weight = np.array([counts.get(v, 1) / (y == v).sum() for v in y.tolist()])
    return model.fit(x, y, weight * len(y) / weight.sum())


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``documents``: ``id_col, score``. Whole texts are read; null and empty texts
    score as a text whose numbers are all zero. Repeated rows each get their row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda texts: [shared.value.score(np.array([features(t) for t in texts]).reshape(-1, len(FEATURES)))]

    return per_text(documents, [id_col], text_col, ["score double"], make)
