"""Ranked search against scores computed one by one."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from orebed.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top):
    """Rows (item, rank, doc, score), by plain integers."""
    split = [(d, terms(t)) for d, t in docs]
    n_docs, total = sum(bool(t) for _, t in split), sum(len(t) for _, t in split)
    out = []
    for item, text in items:
        scored = []
        for doc, words in split:
            score = 0
            for term in set(terms(text)) & set(words):
                df = sum(term in w for _, w in split)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                m = 100 - 50 + (50 * len(words) * n_docs) // total
                tf = words.count(term)
                score += w * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        best = sorted(scored, key=lambda s: s[:3])[:top]
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(best)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def data():
    r = random.Random(5)
    vocabulary = ["Alpha", "beta", "éa", "x1", "Gamma", "d", "zeta's", "größe", "mu", "NU"]
    text = lambda n: " ".join(r.choices(vocabulary, k=n))
    docs = [(i, text(r.randint(1, 30))) for i in range(80)]
    docs += [(200 + i, "alpha, beta; alpha") for i in range(30)]
    docs += [(7, "alpha"), (7, "alpha"), (None, "beta mu nu"), (None, None), (300, ""), (301, "..."), (302, "mu " * 40_000)]
    items = [(i, text(r.randint(1, 8))) for i in range(12)]
    items += [(3, "alpha"), (3, "alpha"), (None, "beta"), (50, None), (51, "unheard"), (52, "-")]
    return docs, items


@pytest.mark.parametrize("top,block_pairs,tile", [(5, 2_000_000, 512), (50, 10, 7), (1, 2_000_000, 1)])
def test_ranks_are_those_of_brute_force(spark, rows, monkeypatch, data, top, block_pairs, tile):
    monkeypatch.setattr(lexical_search, "TILE_DOCS", tile)
    monkeypatch.setattr(lexical_search, "TILE_TERMS", 3)
    docs, items = data
    d = spark.createDataFrame([(*x, 1, "y") for x in docs], "doc_id long, text string, score int, rank string")
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    found = lexical_search.search(d.repartition(4), b, top, block_pairs=block_pairs)
    assert rows(found, "item_id", "rank", "doc_id", "score") == brute(docs, items, top)


def test_tiles_add_up_exactly():
    """Scores beyond 2^53 come from tiles that each stay below."""
    n = 400_000
    weights = np.full(n, 25_000, np.int64)
    searcher = lexical_search.Searcher([np.arange(n)], weights, 10**6, 10**8, 5)
    assert searcher.width * 25_000 * 1_000_000 < 1 << 53
    counts = np.full(n, 10**6)
    lengths = np.array([1])
    impact = int(lexical_search.impacts(counts[:1], lengths, 10**6, 10**8)[0])
    searcher.add([1], lengths, np.array([n]), np.arange(n), counts)
    assert list(searcher.found()) == [(0, n * 25_000 * impact, 1)] and n * 25_000 * impact > 1 << 53


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert lexical_search.search(d, b).count() == 0
    some = spark.createDataFrame([(1, "alpha")], "doc_id long, text string")
    found = lexical_search.search(some, b.limit(0))
    assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]
