"""Toxicity by a convolutional text classifier.

Words are embedded as the sum of hashed rows (the word, and its beginnings, so that
forms of one stem share a row), filters of one to three words slide over the whole text, each
filter's maximum goes to a logistic layer. All is trained in numpy on every labelled text that is not
held out: texts are dealt to shards, a task trains on its shard for an epoch, and the shards' networks
are averaged, each row of the table over the shards that changed it.

The threshold is calibrated by language: a language is guessed from the words of the text itself
(naive Bayes over hashed words; counts of all texts trained on), and the score is the logistic function of the distance from that
language's threshold, so that 0.5 is the threshold everywhere.
"""

from __future__ import annotations

import copy
import zlib
from itertools import groupby
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import change_rows, label_counts, labelled_shards, parts, per_text, plain_words

BUCKET_BITS = 18
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8

#: Bytes of a word's beginnings that have rows of their own.
BEGINNINGS = (4, 5, 6, 7)

#: Size of a shard: twice as many documents, and bytes of text.
PER_CLASS = 4_000
SAMPLE_BYTES = 40_000_000

#: Of so many texts of a shard, the last is for the thresholds alone.
CHECK_EVERY = 4

EPOCHS = 4
BATCH = 32
RATE = 0.02

_LANG_BITS = 14
_PAD = max(WIDTHS) - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


def hashed(words: list[bytes]) -> np.ndarray:
    """Rows of each word: one for the whole word, one for each beginning. Shape: words, rows."""
    whole = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    start = np.array(words, dtype="S8").view("<u8") if words else np.zeros(0, "<u8")
    shift = np.uint64(64 - BUCKET_BITS)
    rows = [((whole + np.uint64(1)) * _MIX) >> shift]
    for n in BEGINNINGS:
        mask = np.uint64((1 << 8 * n) - 1)
        rows.append((((start & mask) + np.uint64(n)) * _MIX) >> shift)
    return np.stack(rows, axis=1).astype(np.int32)


class Batch:
    """Texts as one run of hashed words, each text followed by empty places."""

    def __init__(self, texts: list[list[bytes]]):
        sizes = np.array([max(1, len(t)) for t in texts])
        self.rows = hashed([w for t in texts for w in t])
        self.n = int(sizes.sum()) + _PAD * len(texts)
        self.starts = np.cumsum(sizes + _PAD) - sizes - _PAD
        filled = np.array([len(t) for t in texts])
        shift = np.repeat(self.starts - (np.cumsum(filled) - filled), filled)
        self.at = np.arange(len(self.rows)) + shift
        self.sizes = sizes

    def embed(self, table: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, table.shape[1]), dtype=np.float32)
        total = table[self.rows[:, 0]]
        for k in range(1, self.rows.shape[1]):
            total += table[self.rows[:, k]]
        out[self.at] = total
        return out


class Classifier:
    """The network, the guess of a language, and a threshold for each language."""

    def __init__(self, seed: int = 17):
        rng = np.random.default_rng(seed)
        normal = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        self.table = normal(1 << BUCKET_BITS, DIM) * 0.1
        self.filters = [normal(w, DIM, FILTERS) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS]
        self.out = np.full(len(WIDTHS) * FILTERS, 0.3, dtype=np.float32)
        self.out_bias = np.float32(-1.0)
        self.langs: list[str] = []
        self.lang_table = np.zeros((1 << _LANG_BITS, 1), dtype=np.float32)
        self.thresholds = np.zeros(1)
        self.constant: float | None = None
        self.squares = np.full(len(self.table), 1e-3, dtype=np.float32)
        self.sums = [np.full_like(a, 1e-3) for a in self.dense()]

    def dense(self) -> list[np.ndarray]:
        return [*self.filters, *self.bias, self.out]

    def state(self) -> np.ndarray:
        """All that training changes, as rows of ``DIM + 1``: those of the table with their squares, then the rest."""
        rest = np.concatenate([*(a.ravel() for a in (*self.dense(), *self.sums)), [self.out_bias]])
        rest = np.pad(rest, (0, -len(rest) % (DIM + 1))).reshape(-1, DIM + 1)
        return np.concatenate([np.column_stack([self.table, self.squares]), rest]).astype(np.float32)

    def set_state(self, state: np.ndarray) -> None:
        n = len(self.table)
        self.table[:], self.squares[:] = state[:n, :DIM], state[:n, DIM]
        rest, at = state[n:].ravel(), 0
        for a in (*self.dense(), *self.sums):
            a[...] = rest[at : at + a.size].reshape(a.shape)
            at += a.size
        self.out_bias = np.float32(rest[at])

    def _start(self, seen: np.ndarray, share: float) -> None:
        """The first dimension starts as how much oftener a row is in texts of label 1 than chance
        has it; the first filter of each width reads it. ``seen``: texts of each label with a row."""
        wanted = seen.sum(axis=0) * share
        surprise = (seen[1] - wanted) / np.sqrt(wanted * (1 - share) + 1)
        self.table[:, 0] = np.clip(surprise / 4, -0.5, 2.0)
        for filters in self.filters:
            filters[:, 0, :2] = 1.0 / len(filters)

    def _forward(self, batch: Batch) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        x = batch.embed(self.table)
        totals = []
        for filters in self.filters:
            total = filters[0].T @ x.T
            for k in range(1, len(filters)):
                total[:, :-k] += filters[k].T @ x[k:].T
            totals.append(total)
        return x, totals, np.concatenate(
            [np.maximum.reduceat(self._within(t, batch), batch.starts, axis=1).T + b for t, b in zip(totals, self.bias)], axis=1
        )

    def _within(self, total: np.ndarray, batch: Batch) -> np.ndarray:
        """Places after a text's end never win: they hold no word."""
        for k in range(_PAD):
            total[:, batch.starts + batch.sizes + k] = -np.inf
        return total

    def logits(self, batch: Batch) -> np.ndarray:
        return np.maximum(self._forward(batch)[2], 0) @ self.out + self.out_bias

    def train(self, texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS) -> None:
        """Texts are split batch by batch: the words of all of them would need many times their memory."""
        self._start(texts_with_rows(texts, labels), labels.mean())
        for number in range(epochs):
            self.epoch(texts, labels, labels.mean(), number)

    def epoch(self, texts: list[bytes], labels: np.ndarray, share: float, number: int) -> None:
        """Epoch ``number`` over some texts; ``share`` is that of label 1 in all."""
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        rng = np.random.default_rng(2)
        for _ in range(number + 1):
            order = rng.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            at = order[i : i + BATCH]
            self._step(Batch([plain_words(texts[j]) for j in at]), labels[at], weight[at])

    def _step(self, batch: Batch, y: np.ndarray, weight: np.ndarray) -> None:
        """A step of AdaGrad. Only the places that won a maximum have a gradient."""
        x, totals, pooled = self._forward(batch)
        hidden = np.maximum(pooled, 0)
        p = 1 / (1 + np.exp(-(hidden @ self.out + self.out_bias)))
        d = ((p - y) * weight / len(y)).astype(np.float32)
        back = d[:, None] * self.out[None, :] * (pooled > 0)
        gradients = []
        d_x: dict[int, np.ndarray] = {}
        for j, (filters, total) in enumerate(zip(self.filters, totals)):
            g, gradient = back[:, j * FILTERS : (j + 1) * FILTERS], np.zeros_like(filters)
            for t, (start, size) in enumerate(zip(batch.starts.tolist(), batch.sizes.tolist())):
                if not g[t].any():
                    continue
                best = total[:, start : start + size].argmax(axis=1) + start
                for k in range(len(filters)):
                    gradient[k] += x[best + k].T * g[t]
                    for f, place in enumerate((best + k).tolist()):
                        if g[t, f]:
                            d_x[place] = d_x.get(place, 0) + g[t, f] * filters[k][:, f]
            gradients.append(gradient)
        gradients += [back[:, j * FILTERS : (j + 1) * FILTERS].sum(axis=0) for j in range(len(WIDTHS))]
        gradients.append(hidden.T @ d)
        for a, s, g in zip(self.dense(), self.sums, gradients):
            s += g * g
            a -= RATE * g / np.sqrt(s)
        self.out_bias -= np.float32(RATE * d.sum())
        word = np.full(batch.n, -1)
        word[batch.at] = np.arange(len(batch.rows))
        found = [(word[p], g) for p, g in d_x.items() if word[p] >= 0]
        if found:
            rows = batch.rows[[w for w, _ in found]]
            g = np.repeat(np.array([g for _, g in found], dtype=np.float32)[:, None, :], rows.shape[1], axis=1).reshape(-1, DIM)
            rows = rows.ravel()
            np.add.at(self.squares, rows, (g * g).mean(axis=1))
            np.add.at(self.table, rows, -RATE * g / np.sqrt(self.squares[rows])[:, None])

    def learn_langs(self, texts: list[bytes], langs: list[str | None]) -> None:
        """Log probabilities of hashed words by language, of the languages of ``texts``."""
        self._set_langs(words_of_langs(texts, langs))

    def _set_langs(self, counts: dict[str, np.ndarray]) -> None:
        self.langs = sorted(counts)
        seen = np.ones((max(1, len(self.langs)), 1 << _LANG_BITS))
        for i, lang in enumerate(self.langs):
            seen[i] += counts[lang]
        self.lang_table = np.log(seen / seen.sum(axis=1, keepdims=True)).T.astype(np.float32)

    def guess(self, batch: Batch) -> np.ndarray:
        """The number of each text's likeliest language; 0 without a word."""
        out = np.zeros((batch.n, self.lang_table.shape[1]), dtype=np.float32)
        out[batch.at] = self.lang_table[_lang_rows(batch.rows)]
        return np.add.reduceat(out, batch.starts, axis=0, dtype=np.float64).argmax(axis=1)

    def calibrate(self, texts: list[bytes], labels: np.ndarray, weight: np.ndarray) -> None:
        """For each language the threshold with the least weight of wrong verdicts; of a language with few
        texts of either label, that of all languages."""
        z, lang = self.judge(texts)
        every = _threshold(z, labels, weight)
        self.thresholds = np.full(self.lang_table.shape[1], every)
        for i in range(len(self.thresholds)):
            mine = lang == i
            if min(labels[mine].sum(), (1 - labels[mine]).sum()) >= 10:
                self.thresholds[i] = _threshold(z[mine], labels[mine], weight[mine])

    def judge(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Logits and guessed languages, one text at a time."""
        z, lang = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            batch = Batch([plain_words(text)])
            z[i], lang[i] = self.logits(batch)[0], self.guess(batch)[0]
        return z, lang

    def score(self, texts: list[list[bytes]]) -> np.ndarray:
        """Scores from 0 to 1; 0.5 is the threshold of the text's language."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        batch = Batch(texts)
        z = self.logits(batch).astype(np.float64) - self.thresholds[self.guess(batch)]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def texts_with_rows(texts: list[bytes], labels: np.ndarray) -> np.ndarray:
    """How many texts of each label have each row of the table."""
    seen = np.zeros((2, 1 << BUCKET_BITS))
    for text, label in zip(texts, labels):
        seen[label, np.unique(hashed(plain_words(text)))] += 1
    return seen


def words_of_langs(texts: list[bytes], langs: list[str | None]) -> dict[str, np.ndarray]:
    """How many words of each language's texts have each number."""
    seen: dict[str, np.ndarray] = {}
    for text, lang in zip(texts, langs):
        if lang is not None:
            counts = seen.setdefault(lang, np.zeros(1 << _LANG_BITS, dtype=np.int64))
            np.add.at(counts, _lang_rows(hashed(plain_words(text))), 1)
    return seen


def _lang_rows(rows: np.ndarray) -> np.ndarray:
    return rows[:, 0] >> (BUCKET_BITS - _LANG_BITS)


def _threshold(z: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The middle of the gap between scores where most weight is on its right side."""
    order = np.argsort(z, kind="stable")
    z, good = z[order], np.where(labels[order] == 1, weight[order], -weight[order])
    wrong = np.r_[0, np.cumsum(good)]  # of a cut before each place, up to a constant
    wrong[1:-1][z[1:] == z[:-1]] = np.inf
    cut = int(wrong.argmin())
    if cut in (0, len(z)):
        return float(z[0] - 1 if cut == 0 else z[-1] + 1)
    return float((z[cut - 1] + z[cut]) / 2)


def fit(
    documents: DataFrame,
    labels: DataFrame,
    of: int = 5,
    held_out: int = 0,
    per_class: int = PER_CLASS,
    max_bytes: int = SAMPLE_BYTES,
) -> Classifier:
    """A classifier of ``labels.toxic``.

    Learns from all labelled documents but rows whose crc32(doc_id) modulo ``of`` is ``held_out``. They are
    dealt by id to shards of about twice ``per_class`` documents and ``max_bytes`` of text, a task each. A quarter of
    them is for the thresholds alone. With no text or one label only, the score is that label for all
    (0 without any). The driver gets counts by row of the table, the averaged network, and a row per
    language and partition of logits.
    """
    with labelled_shards(documents, labels, "toxic", of, held_out, 2 * per_class, max_bytes, lang=True) as shards:
        return _learn_shards(shards, label_counts(labels, "toxic", of, held_out), 2 * max_bytes)


def _learn_shards(shards: DataFrame, counts: dict[int, int], max_bytes: int) -> Classifier:
    """As ``learn``, to which one shard is equal, over ``words, label, lang, shard`` of all."""
    classifier = Classifier()
    found = _texts_by_label(shards)
    labels = {label: sum(n for (_, y), n in found.items() if y == label) for label in {y for _, y in found}}
    if len(labels) < 2:
        classifier.constant = float(next(iter(labels), 0))
        return classifier
    train, check = set(range(CHECK_EVERY - 1)), {CHECK_EVERY - 1}
    if len({y for rest, y in found if not rest}) < 2 or not any(rest for rest, _ in found):
        train = check = set(range(CHECK_EVERY))
    sizes = [sum(n for (rest, y), n in found.items() if y == label and (rest in (False, len(train) == CHECK_EVERY))) for label in (0, 1)]
    share = sizes[1] / sum(sizes)
    seen, langs = _counted(shards, train, max_bytes)
    classifier._start(seen, share)
    for number in range(EPOCHS):
        _epoch(shards, classifier, train, share, number, max_bytes)
    classifier._set_langs(langs)
    weight = [counts.get(label, 1) / max(1, labels[label]) for label in (0, 1)]
    _calibrate(shards, classifier, check, weight, max_bytes)
    return classifier


def _shards(batches) -> Iterator[Iterator[pa.RecordBatch]]:
    """The rows of a task, shard by shard."""

    def pieces():
        for batch in batches:
            for part in parts(batch, 0):
                shard = part.column(part.num_columns - 1).to_numpy()
                ends = [*(np.flatnonzero(np.diff(shard)) + 1).tolist(), part.num_rows]
                for start, end in zip([0, *ends], ends):
                    yield int(shard[start]), part.slice(start, end - start)

    for _, group in groupby(pieces(), key=lambda piece: piece[0]):
        yield (part for _, part in group)


def _blocks(shard, wanted: set[int], max_bytes: int) -> Iterator[tuple[list[bytes], np.ndarray, list[str | None]]]:
    """Texts, labels and languages of a shard's rows whose place modulo ``CHECK_EVERY`` is ``wanted``; what is
    held at once is about ``max_bytes`` and a text."""
    rows, size, place = [], 0, 0
    for part in shard:
        for row in zip(*(column.to_pylist() for column in part.columns)):
            if place % CHECK_EVERY in wanted:
                rows.append(row)
                size += len(row[0]) + 100
            place += 1
        if size > max_bytes:
            yield _columns(rows)
            rows, size = [], 0
    if rows:
        yield _columns(rows)


def _columns(rows: list[tuple]) -> tuple[list[bytes], np.ndarray, list[str | None]]:
    return [r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.int64), [r[2] for r in rows]


def _texts_by_label(shards: DataFrame) -> dict[tuple[bool, int], int]:
    """How many texts there are by whether they are for the thresholds, and label."""

    def count(batches):
        for shard in _shards(batches):
            place = 0
            for part in shard:
                rest = (place + np.arange(part.num_rows)) % CHECK_EVERY == CHECK_EVERY - 1
                place += part.num_rows
                yield pa.RecordBatch.from_arrays([pa.array(rest), part.column(1)], ["rest", "label"])

    few = shards.select(F.lit(b"").alias("__words"), "__label", "__shard")
    rows = few.mapInArrow(count, "rest boolean, label int")
    return {(rest, label): n for rest, label, n in rows.groupBy("rest", "label").count().collect()}


def _counted(shards: DataFrame, wanted: set[int], max_bytes: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Texts of each label by row of the table, words of each language by number, added up in Spark."""

    def count(batches):
        names, types = ["label", "lang", "row", "n"], [pa.int32(), pa.string(), pa.int32(), pa.int64()]

        def batch(label, lang, at, n):
            columns = [[label] * len(at), [lang] * len(at), at, n]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names)

        for texts, labels, langs in (block for shard in _shards(batches) for block in _blocks(shard, wanted, max_bytes)):
            for label, seen in enumerate(texts_with_rows(texts, labels).astype(np.int64)):
                at = np.flatnonzero(seen)
                yield batch(label, None, at, seen[at])
            for lang, seen in words_of_langs(texts, langs).items():
                at = np.union1d(np.flatnonzero(seen), [0])
                yield batch(None, lang, at, seen[at])

    rows = shards.mapInArrow(count, "label int, lang string, row int, n long")
    found = rows.groupBy("label", "lang", "row").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    seen, langs = np.zeros((2, 1 << BUCKET_BITS)), {}
    of_label = found[found["label"].notna()]
    seen[of_label["label"].astype(int), of_label["row"]] = of_label["n"]
    for lang, of_lang in found[found["lang"].notna()].groupby("lang"):
        langs[lang] = np.zeros(1 << _LANG_BITS, dtype=np.int64)
        langs[lang][of_lang["row"]] = of_lang["n"]
    return seen, langs


def _epoch(shards: DataFrame, classifier: Classifier, wanted: set[int], share: float, number: int, max_bytes: int) -> None:
    """Each shard trains a copy; what several changed is averaged."""
    shared = shards.sparkSession.sparkContext.broadcast(classifier)
    names = [f"v{i}" for i in range(DIM + 1)]

    def run(batches):
        for shard in _shards(batches):
            model = copy.deepcopy(shared.value)
            for texts, labels, _ in _blocks(shard, wanted, max_bytes):
                model.epoch(texts, labels, share, number)
            state = model.state()
            at = np.flatnonzero((state != shared.value.state()).any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at, type=pa.int32()), *map(pa.array, state[at].T.astype(float))], ["row", *names])

    rows = shards.mapInArrow(run, "row int, " + ", ".join(f"{n} double" for n in names))
    found = rows.groupBy("row").agg(*[F.avg(n).alias(n) for n in names]).toArrow()
    state = classifier.state()
    state[found["row"].to_numpy()] = np.stack([found[n].to_numpy() for n in names], axis=1)
    shared.destroy()
    classifier.set_state(state)


def _calibrate(shards: DataFrame, classifier: Classifier, wanted: set[int], weight: list[float], max_bytes: int) -> None:
    """The thresholds of ``Classifier.calibrate``, from logits sorted in Spark by language; -1 is all of them."""
    shared = shards.sparkSession.sparkContext.broadcast(classifier)

    def judge(batches):
        for texts, labels, _ in (block for shard in _shards(batches) for block in _blocks(shard, wanted, max_bytes)):
            z, lang = shared.value.judge(texts)
            yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(z), pa.array(labels.astype(np.int32))], ["lang", "z", "label"])

    judged = shards.mapInArrow(judge, "lang int, z double, label int")
    judged = judged.withColumn("lang", F.explode(F.array(F.lit(-1), F.col("lang"))))
    counted = judged.groupBy("lang", "z").agg(F.sum(1 - F.col("label")).alias("n0"), F.sum("label").alias("n1"))
    cuts = best_cuts(counted.repartitionByRange("lang", "z").sortWithinPartitions("lang", "z"), weight)
    shared.destroy()
    classifier.thresholds = np.full(classifier.lang_table.shape[1], cuts[-1][0])
    for lang, (cut, least) in cuts.items():
        if lang >= 0 and least >= 10:
            classifier.thresholds[lang] = cut


_CUTS = "lang int, first double, last double, n0 long, n1 long, best0 long, best1 long, low double, high double"


def best_cuts(rows: DataFrame, weight: list[float]) -> dict[int, tuple[float, int]]:
    """By language the cut of ``_threshold``, and how many there are of the rarer label. ``rows``: ``lang, z, n0, n1``, each
    logit of a language once, sorted over all partitions. A partition's best place does not depend on what lies before it."""

    def scan(batches):
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        lang, z, n0, n1 = (table[c].to_numpy() for c in ("lang", "z", "n0", "n1"))
        found = []
        for i in np.unique(lang):
            mine = lang == i
            at, before0, before1 = z[mine], np.cumsum(n0[mine]), np.cumsum(n1[mine])
            best = int((weight[1] * before1 - weight[0] * before0).argmin())
            high = float(at[best + 1]) if best + 1 < len(at) else None
            sums = [int(v) for v in (before0[-1], before1[-1], before0[best], before1[best])]
            found.append((int(i), float(at[0]), float(at[-1]), *sums, float(at[best]), high))
        types = [pa.int32(), pa.float64(), pa.float64(), *[pa.int64()] * 4, pa.float64(), pa.float64()]
        names = [c.split()[0] for c in _CUTS.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*found), types)], names)

    pieces = sorted(rows.mapInArrow(scan, _CUTS).collect(), key=lambda r: (r["lang"], r["first"]))
    cuts = {}
    for lang in sorted({r["lang"] for r in pieces}):
        mine = [r for r in pieces if r["lang"] == lang]
        cut, least, n0, n1 = mine[0]["first"] - 1, 0.0, 0, 0
        for r, after in zip(mine, [*mine[1:], None]):
            wrong = weight[1] * (n1 + r["best1"]) - weight[0] * (n0 + r["best0"])
            if wrong < least:
                high = r["high"] if r["high"] is not None else after["first"] if after else None
                cut, least = (r["last"] + 1 if high is None else (r["low"] + high) / 2), wrong
            n0, n1 = n0 + r["n0"], n1 + r["n1"]
        cuts[lang] = (float(cut), min(n0, n1))
    return cuts


def learn(sample: list[tuple], counts: dict[int, int]) -> Classifier:
    """Train on ``(text, label, lang)`` at hand; ``counts`` are the labels' numbers in the whole table, held-out rows left out."""
    classifier = Classifier()
    y = np.array([int(label) for _, label, _ in sample], dtype=np.int64)
    if len(set(y.tolist())) < 2:
        classifier.constant = float(y[0]) if len(y) else 0.0
        return classifier
    texts, langs = [t for t, _, _ in sample], [lang for _, _, lang in sample]
    rest = np.arange(len(y)) % 4 == 3
    if len(set(y[~rest].tolist())) < 2 or not rest.any():
        rest[:] = False
    train, check = np.flatnonzero(~rest), np.flatnonzero(rest) if rest.any() else np.arange(len(y))
    classifier.train([texts[i] for i in train], y[train])
    classifier.learn_langs([texts[i] for i in train], [langs[i] for i in train])
    weight = np.array([counts.get(v, 1) / max(1, (y == v).sum()) for v in y.tolist()])
    classifier.calibrate([texts[i] for i in check], y[check], weight[check])
    return classifier


def _scorer(classifier, session):
    shared = session.sparkContext.broadcast(classifier)
    return lambda: lambda texts: shared.value.score([plain_words(t) for t in texts])


def score(documents: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``documents``: ``id_col, score``. Whole texts are scored; null and empty
    texts, and texts without a word, as a text whose filters find nothing. Repeated rows each get their row."""
    make = _scorer(classifier, documents.sparkSession)
    return per_text(documents, [id_col], text_col, ["score double"], lambda: _as_columns(make()))


def _as_columns(scorer):
    return lambda texts: [scorer(texts)]


def drop_toxic(documents: DataFrame, classifier: Classifier, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``documents``, all their columns, with a score below ``least``."""
    make = _scorer(classifier, documents.sparkSession)

    def keep():
        scorer = make()
        return lambda texts: ((scorer(texts) < least).tolist(), None)

    return change_rows(documents, text_col, keep)
