from __future__ import annotations

import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orebed.llm import packing

PATHS = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATHS[0])
    return t


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(*PATHS)


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


@pytest.mark.parametrize(
    "text",
    ["", " ", "a", " a b", "a  b", "a   b", "a \n b", "a\n\nb c", "\n a", "a ", "it's we'll I'm", "é à ñ ß", "12 345,67 %%%",
     "<|endoftext|> x", "a\tb c", "日本語 текст", "x y z", "a\x1cb c", " a b", "don 't 'll", "a" * 5000, "🙂 x", "hello <|endoftext|> world", "a<|endoftext|>"],
)
def test_ids(encoder, tokenizer, text):
    assert ids(encoder, text) == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab '\n\t.,!1é \x1fñ|#")), max_size=30))
def test_ids_of_any_text(text):
    t = Tokenizer.from_file(PATHS[0]) if not hasattr(test_ids_of_any_text, "t") else test_ids_of_any_text.t
    e = packing.Encoder(*PATHS) if not hasattr(test_ids_of_any_text, "e") else test_ids_of_any_text.e
    test_ids_of_any_text.t, test_ids_of_any_text.e = t, e
    assert ids(e, text) == t.encode(text, add_special_tokens=False).ids


def brute_best_fit(sizes, capacity):
    """The remaining capacities of best-fit decreasing, piece by piece."""
    open_, n = [], 0
    for s in sorted(sizes, reverse=True):
        at = bisect.bisect_left(open_, s)
        room = open_.pop(at) if at < len(open_) else capacity
        n += room == capacity
        bisect.insort(open_, room - s)
    return sorted(open_)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=80))
def test_plan_is_best_fit_decreasing(sizes):
    capacity = 20
    counts: dict[int, int] = {}
    for s in sizes:
        counts[s] = counts.get(s, 0) + 1
    rows = packing.plan(counts, capacity)
    bins: dict[int, list] = {}
    for i, (length, first, bin_, per, offset) in enumerate(rows):
        ends = [r[1] for r in rows if r[0] == length and r[1] > first]
        last = min(ends, default=counts[length])
        for k in range(last - first):
            bins.setdefault(bin_ + k // per, []).append((offset + k % per * length, length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(capacity - sum(x for _, x in p) for p in bins.values()) == brute_best_fit(sizes, capacity)
    assert sorted(bins) == list(range(len(bins)))


def test_plan_does_not_grow_with_the_pieces():
    rng = random.Random(1)
    counts = {n: rng.randint(1, 10**9) for n in range(1, 2049)}
    rows = packing.plan(counts)
    assert len(rows) < 100_000


def test_segment_tree():
    tree, open_, rng = packing.Capacities(50), set(), random.Random(3)
    for _ in range(2_000):
        at = rng.randint(0, 50)
        tree.set(at, at not in open_)
        open_ ^= {at}
        least = rng.randint(0, 50)
        assert tree.tightest(least) == min((x for x in open_ if x >= least), default=None)


def test_pieces_and_places(spark, tokenizer):
    texts = ["one two three", None, "", "word " * 5_000, "word " * 2_047, "word " * 2_048, "same", "same", "x  y"] + ["copy of it"] * 40
    docs = spark.createDataFrame(
        [(i if i != 7 else 6, t, 1, "z") for i, t in enumerate(texts)] + [(None, "null id", 1, "z")],
        "doc_id long, text string, offset int, length string",
    )
    out = packing.pack_documents(docs, *PATHS, with_ids=True)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    rows = out.collect()
    bins: dict[int, list] = {}
    by_doc: dict[tuple, list] = {}
    for r in rows:
        got = np.frombuffer(r["ids"], "<u4")
        assert len(got) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], got.tolist()))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    for i, t in enumerate(texts):
        if i in (6, 7):
            continue
        whole = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        found = sorted(by_doc[i])
        assert [x for _, _, part in found for x in part] == whole
        assert [p for p, _, _ in found] == list(range(len(found)))
        assert all(whole[s : s + len(part)] == part for _, s, part in found)
        assert [len(part) for _, _, part in found] == packing.cut(len(whole))
    assert len(by_doc[6]) == 2 and len(by_doc[None]) == 1
    assert packing.pack_documents(docs.limit(0), *PATHS).count() == 0
