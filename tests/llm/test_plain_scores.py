"""The queries of trained operators against plain versions of their models, text by text and word by word."""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pytest

from orebed.llm import langid, quality, queries, toxicity

SMALL = "/root/testdata/sf0.001"
MIX, BITS = 0x9E3779B97F4A7C15, 1 << 64


@pytest.fixture(scope="module")
def given(spark):
    documents, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    return documents, labels, {r["doc_id"]: (r["text"] or "").encode() for r in documents.collect()}


def logistic(z):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def word_rows(word: bytes) -> list[int]:
    keys = [zlib.crc32(word) + 1] + [int.from_bytes(word[:n].ljust(8, b"\0"), "little") + n for n in (4, 5, 6, 7)]
    return [(k * MIX % BITS) >> (64 - toxicity.BUCKET_BITS) for k in keys]


def plain_toxicity(model, text: bytes) -> float:
    """Every filter at every word, the guess of the language word by word."""
    rows = [word_rows(w) for w in re.findall(rb"[a-z0-9\x80-\xff]+", text.lower())]
    embedded = [sum(model.table[i].astype(float) for i in r) for r in rows] or [np.zeros(toxicity.DIM)]
    hidden = []
    for filters, bias in zip(model.filters, model.bias):
        best = np.full(toxicity.FILTERS, -np.inf)
        for p in range(len(embedded)):
            best = np.maximum(best, sum(embedded[p + k] @ f for k, f in enumerate(filters) if p + k < len(embedded)))
        hidden += np.maximum(best + bias, 0).tolist()
    z = float(np.dot(hidden, model.out) + model.out_bias)
    guess = sum((model.lang_table[r[0] >> (toxicity.BUCKET_BITS - 14)].astype(float) for r in rows), np.zeros(len(model.thresholds)))
    return logistic(z - model.thresholds[int(np.argmax(guess))])


def test_toxicity_of_whole_texts(spark, given):
    documents, labels, texts = given
    model = toxicity.fit(documents, labels, of=5, held_out=0)
    found = queries.op4_toxicity(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        assert abs(r["score"] - plain_toxicity(model, texts[r["doc_id"]])) < 1e-3
        assert r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert len({round(r["score"], 6) for r in found}) > 100


def plain_language(net, text: bytes) -> tuple[str, float]:
    """Every filter at every byte of every window."""
    if not any(c.isalpha() for c in text.decode()):
        return "und", 0.0
    total, n = np.zeros(len(net.classes)), 0
    for start in range(0, len(text), langid.WINDOW):
        x = net.embed[list(text[start : start + langid.WINDOW].ljust(langid.WINDOW, b"\0"))].astype(float)
        hidden = []
        for filters, bias in zip(net.filters, net.bias):
            places = [sum(x[p + k] @ f for k, f in enumerate(filters)) for p in range(langid.WINDOW - len(filters) + 1)]
            hidden += np.maximum(np.max(places, axis=0) + bias, 0).tolist()
        total, n = total + np.dot(hidden, net.out) + net.out_bias, n + 1
    e = np.exp(total / n - (total / n).max())
    return net.classes[int(e.argmax())], float(e.max() / e.sum())


def test_languages_of_whole_texts(spark, given):
    documents, _, texts = given
    net = langid.fit(documents, of=4, held_out=2)
    found = queries.op6_language(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    long = 0
    for r in found:
        text = texts[r["doc_id"]]
        if len(text) > 30_000:  # the plain version takes a second for these
            long += 1
            if long > 2:
                continue
        lang, score = plain_language(net, text)
        assert abs(r["score"] - score) < 1e-3
        assert r["lang_pred"] == lang or score < 0.51
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def plain_features(text: bytes) -> list[float]:
    if not text:
        return [0.0] * len(quality.FEATURES)
    n, words = len(text), re.findall(rb"[^ \t\n\r\x0b\x0c]+", text)
    lower, lines = [w.lower() for w in words], text.split(b"\n")
    k = max(1, len(words))
    seen, chars = Counter(lower), Counter(text.decode("latin-1"))
    share = lambda chosen: sum(c for x, c in chars.items() if chosen(x)) / n
    other = set("\"#$%&'()*+-/:;<=>@[\\]^_`{}~")
    odd = [w for w in seen if w.isascii() and not re.fullmatch(rb"[0-9A-Za-z]+", re.sub(rb"[.,;:!?]+$", b"", w))]
    capital = [w for w in words if re.search(rb"[A-Z]", w) and not re.search(rb"[a-z]", w)]
    kinds = [lambda x: "A" <= x <= "Z", lambda x: "0" <= x <= "9", *(lambda x, c=c: x == c for c in " \n.,!?|")]
    kinds += [lambda x: x in other, lambda x: x >= "\x80"]
    return [
        math.log(1 + n),
        math.log(1 + len(words)),
        n / k,
        *map(share, kinds),
        len(seen) / k**0.8,
        max(seen.values(), default=0) / k,
        sum(a == b for a, b in zip(lower, lower[1:])) / k,
        len(set(lines)) / len(lines),
        sum(len(x) < 25 for x in lines) / len(lines),
        len(capital) / k,
        len(odd) / max(1, len(seen)),
        k / (1 + sum(chars[c] for c in ".!?")),
    ]


def plain_quality(model, x: list[float]) -> float:
    z = model.base
    for value, edges, table in zip(x, model.edges, model.tables):
        z += table[bisect_right(edges.tolist(), value)]
    for (a, b), table in zip(model.pairs, model.pair_tables):
        z += table[bisect_right(model.coarse[a].tolist(), x[a]), bisect_right(model.coarse[b].tolist(), x[b])]
    return logistic(z)


def test_quality_of_whole_texts(spark, given):
    documents, labels, texts = given
    model = quality.fit(documents, labels, of=4, held_out=2)
    for text in [*texts.values(), b" ", b"A B! a? a? x|y \xc3\xa9\xc3\xa9 12.\r\n\nB", b"...", b"(a) ~b\x0b c"]:
        assert np.allclose(plain_features(text), quality.features(text), rtol=1e-12, atol=1e-12), text[:80]
    found = queries.op9_quality(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        assert abs(r["score"] - plain_quality(model, quality.features(texts[r["doc_id"]]))) < 1e-9
        assert r["predicted"] == (r["score"] >= 0.7) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    assert len({round(r["score"], 6) for r in found}) > 100
