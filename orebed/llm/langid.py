"""Language of a text by a byte convolutional network.

Windows of a fixed number of bytes are embedded byte by byte, filters of several widths slide over
them, each filter's maximum over the window goes to a softmax layer. The network is trained in
numpy on a bounded sample of labelled texts. A whole text is cut into such windows, and their
scores averaged.

As a filter is linear in the embedded bytes, what byte ``b`` adds at place ``k`` of a filter is one
number: training keeps tables by byte, scoring tables by pairs of bytes, so that a filter
of four bytes is the sum of two rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import bounded, per_text, remainder, sample_by_class

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
DIM = 8
UNKNOWN = "und"

#: Bounds of the sample: documents of each language, bytes of text in all, windows of a document.
PER_CLASS = 1_200
SAMPLE_BYTES = 32_000_000
PER_TEXT = 10

EPOCHS = 6
BATCH = 64
RATE = 0.01

#: Windows scored at once.
_AT_ONCE = 128


def windows(text: bytes) -> np.ndarray:
    """The text's bytes in rows of ``WINDOW``, the last filled up with zeros."""
    n = -(-len(text) // WINDOW)
    return np.frombuffer(text.ljust(n * WINDOW, b"\0"), dtype=np.uint8).reshape(n, WINDOW)


class Adam:
    """Adam steps for a list of arrays."""

    def __init__(self, arrays, rate: float):
        self.arrays, self.rate, self.t = arrays, rate, 0
        self.m = [np.zeros_like(a) for a in arrays]
        self.v = [np.zeros_like(a) for a in arrays]

    def step(self, gradients) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for a, m, v, g in zip(self.arrays, self.m, self.v, gradients):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= scale * m / (np.sqrt(v) + 1e-8)


class Network:
    """Byte embedding, convolutions, max pooling, softmax. Byte zero, the filling, embeds as zero."""

    def __init__(self, classes: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        normal = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.classes = classes
        self.embed = normal(256, DIM)
        self.embed[0] = 0
        self.filters = [normal(w, DIM, FILTERS) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS]
        self.out = normal(len(WIDTHS) * FILTERS, len(classes))
        self.out_bias = np.zeros(len(classes), dtype=np.float32)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> None:
        """Fit to windows ``x`` and class numbers ``y``; each class weighs the same in all."""
        weight = (len(y) / len(self.classes) / np.maximum(1, np.bincount(y, minlength=len(self.classes))))[y]
        rng = np.random.default_rng(5)
        adam = Adam([self.embed, *self.filters, *self.bias, self.out, self.out_bias], RATE)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for i in range(0, len(y), BATCH):
                at = order[i : i + BATCH]
                adam.step(self._gradients(x[at], y[at], weight[at].astype(np.float32)))
                self.embed[0] = 0

    def _gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        n, pooled, places = len(y), [], []
        for filters, bias in zip(self.filters, self.bias):
            tables = self.embed @ filters  # place, byte, filter
            size = WINDOW - len(filters) + 1
            total = tables[0][x[:, :size]]
            for k in range(1, len(filters)):
                total += tables[k][x[:, k : k + size]]
            best = total.argmax(axis=1)
            places.append(best)
            pooled.append(np.take_along_axis(total, best[:, None, :], axis=1)[:, 0] + bias)
        p = np.concatenate(pooled, axis=1)
        hidden = np.maximum(p, 0)
        logits = hidden @ self.out + self.out_bias
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        d = e / e.sum(axis=1, keepdims=True)
        d[np.arange(n), y] -= 1
        d *= (weight / n)[:, None]
        back = (d @ self.out.T) * (p > 0)
        d_embed, d_filters, d_bias = np.zeros_like(self.embed), [], []
        columns = np.arange(FILTERS)
        for j, (filters, best) in enumerate(zip(self.filters, places)):
            g = back[:, j * FILTERS : (j + 1) * FILTERS]
            d_bias.append(g.sum(axis=0))
            d_filter = np.zeros_like(filters)
            for k in range(len(filters)):
                table = np.zeros((256, FILTERS), dtype=np.float32)
                np.add.at(table, (np.take_along_axis(x, best + k, axis=1), np.broadcast_to(columns, best.shape)), g)
                d_filter[k] = self.embed.T @ table
                d_embed += table @ filters[k].T
            d_filters.append(d_filter)
        return [d_embed, *d_filters, *d_bias, hidden.T @ d, d.sum(axis=0)]

    def ready(self) -> Network:
        """With the tables for scoring."""
        t = [self.embed @ f for f in self.filters]
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(-1, FILTERS)
        self.first = np.concatenate([pair(t[0][0], t[0][1]), pair(t[1][0], t[1][1]), pair(t[2][0], t[2][1])], axis=1)
        self.third, self.fourth = t[1][2], pair(t[2][2], t[2][3])
        return self

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Scores before the softmax of each window; places run along the first axis."""
        out = np.empty((len(x), len(self.classes)), dtype=np.float32)
        bias, f = np.concatenate(self.bias), FILTERS
        for i in range(0, len(x), _AT_ONCE):
            b = np.ascontiguousarray(x[i : i + _AT_ONCE].T)
            pairs = b[:-1].astype(np.uint16) << 8 | b[1:]
            a = self.first[pairs]
            a[:-1, :, f : 2 * f] += self.third[b[2:]]
            a[:-2, :, 2 * f :] += self.fourth[pairs[2:]]
            a[-1, :, f : 2 * f] = a[-2:, :, 2 * f :] = -np.inf
            hidden = np.maximum(a.max(axis=0) + bias, 0)
            out[i : i + _AT_ONCE] = hidden @ self.out + self.out_bias
        return out

    def predict(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities by text: the softmax of the mean over its windows."""
        x = [windows(t) for t in texts]
        starts = np.cumsum([0, *map(len, x)])[:-1]
        sums = np.add.reduceat(self.logits(np.concatenate(x)).astype(np.float64), starts, axis=0)
        mean = sums / np.array([len(w) for w in x])[:, None]
        e = np.exp(mean - mean.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def has_letter(text: bytes | None) -> bool:
    return text is not None and next(filter(str.isalpha, text.decode(errors="replace")), None) is not None


def fit(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    of: int = 4,
    held_out: int = 2,
    per_class: int = PER_CLASS,
    max_bytes: int = SAMPLE_BYTES,
) -> Network | None:
    """A network for the languages of ``lang_col``, or None if no labelled text has a letter.

    Learns from about ``per_class`` texts of each language and not more than ``max_bytes`` of text,
    never from rows whose crc32(id) modulo ``of`` is ``held_out``.
    """
    rows = documents.select(
        F.col(id_col).alias("__id"), F.col(text_col).cast("binary").alias("__text"), F.col(lang_col).cast("string").alias("__lang")
    )
    rows = rows.where(F.col("__lang").isNotNull() & F.col("__text").isNotNull() & (remainder("__id", of) != held_out))
    sample = [(t, lang) for t, lang in bounded(sample_by_class(rows, "__lang", "__id", per_class), max_bytes) if has_letter(t)]
    if not sample:
        return None
    classes = sorted({lang for _, lang in sample})
    number = {c: i for i, c in enumerate(classes)}
    rng, x, y = np.random.default_rng(3), [], []
    for text, lang in sample:
        cut = windows(text)
        if len(cut) > PER_TEXT:
            cut = cut[np.sort(rng.choice(len(cut), PER_TEXT, replace=False))]
        x.append(cut)
        y += [number[lang]] * len(cut)
    network = Network(classes)
    network.train(np.concatenate(x), np.array(y))
    return network.ready()


def identify(
    documents: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``documents``: ``id_col, lang_pred, score``.

    Null texts and texts without a letter are ``und`` with score 0, and so is every text if
    there is no network. Whole texts are scored, whatever their length; repeated rows each get their row.
    """
    shared = documents.sparkSession.sparkContext.broadcast(network)

    def make():
        net = shared.value

        def score(texts):
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            at = [i for i, t in enumerate(texts) if net is not None and has_letter(t)]
            if at:
                p = net.predict([texts[i] for i in at])
                for i, best, value in zip(at, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                    langs[i], scores[i] = net.classes[best], min(1.0, value)
            return langs, scores

        return score

    return per_text(documents, [id_col], text_col, ["lang_pred string", "score double"], make)
