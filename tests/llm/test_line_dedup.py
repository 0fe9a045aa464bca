"""Line dedup against a plain version, and documents that come and go."""

from __future__ import annotations

import numpy as np
import pytest

from orebed.llm import line_dedup
from orebed.llm.line_dedup import CuckooFilter

FOOTER = "  All rights RESERVED by us \t"
DOCS = [
    (3, f"first line of three\n{FOOTER}\nshort\nshort"),
    (1, f"only here, a line\nALL rights reserved by us\nshort\n{FOOTER.strip()}"),
    (2, None),
    (4, ""),
    (5, f"{FOOTER}\r\n\nonly here, a line\n" + "x" * 50),
    (5, f"twice in one id!\n{FOOTER}"),
    (5, "twice in one id!\nTwice in one ID!"),
    (None, "nobody's line, twice\nonly here, a line"),
    (None, "nobody's line, twice"),
    (7, "äöüäöüäöü\näöüäöüäöüß\n" + "long " * 100_000),
    (8, "ÄÖÜÄÖÜÄÖÜ\näöüäöüäöüß\nÄöüäöüäöüß\n" + "long " * 100_000),
    (9, " all rights reserved by us"),
]


def plain_key(line):
    line = line.strip(" \t\n\r\x0b\x0c")
    line = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    return line if len(line) >= 10 else None


def brute(docs, held=None):
    """Rows (id, n_lines, n_dropped, kept) by the lines of ``held`` documents."""
    holders = {}
    for doc, text in held or docs:
        for line in (text or "").split("\n"):
            if plain_key(line) is not None:
                holders.setdefault(plain_key(line), set()).add((doc is None, doc))
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            of = holders.get(plain_key(line), ())
            if len(of) < 2 or min(of, key=lambda d: (d[0], d[1] or 0)) == (doc is None, doc):
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def frame(spark, docs):
    rows = [(*d, 1, "x") for d in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, key int, shard string").repartition(3)


def test_lines_are_those_of_brute_force(spark, rows):
    docs = frame(spark, DOCS)
    ours = rows(line_dedup.dedupe(docs, line_dedup.insert(docs)), "doc_id", "n_lines", "n_dropped", "kept")
    assert ours == brute(DOCS)


def test_many_shards_and_full_filters(spark, rows, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 40)
    docs = [(i, "\n".join(f"line number {j} of them" for j in range(i, i + 30))) for i in range(0, 600, 20)]
    index = line_dedup.insert(frame(spark, docs))
    assert index.shards > 5
    ours = rows(line_dedup.dedupe(frame(spark, docs), index), "doc_id", "n_lines", "n_dropped", "kept")
    assert ours == brute(docs)


def state(index, rows):
    return rows(index.references.distinct()), rows(index.repeated)


def test_in_parts_and_back(spark, rows):
    """Documents inserted in two parts are as inserted at once; deleting the second part undoes it."""
    first, second = frame(spark, DOCS[:5]), frame(spark, DOCS[5:])
    one = line_dedup.insert(first)
    before, filters = state(one, rows), rows(one.filters)
    both = line_dedup.insert(second, one)
    every = frame(spark, DOCS)
    assert state(both, rows) == state(line_dedup.insert(every), rows)
    ours = rows(line_dedup.dedupe(every, both), "doc_id", "n_lines", "n_dropped", "kept")
    assert ours == brute(DOCS)
    # Rows with id 5 are in both parts, so that document goes from both.
    back = line_dedup.delete(both, second.select("doc_id"))
    left = [d for d in DOCS[:5] if d[0] != 5]
    assert state(back, rows) == state(line_dedup.insert(frame(spark, left)), rows)
    ours = rows(line_dedup.dedupe(frame(spark, left), back), "doc_id", "n_lines", "n_dropped", "kept")
    assert ours == brute(left)
    again = line_dedup.delete(line_dedup.insert(frame(spark, [(50, "not seen so far, this")]), one), spark.createDataFrame([(50,)], "doc_id long"))
    assert state(again, rows) == before and rows(again.filters) == filters


def test_no_documents(spark, rows):
    none = frame(spark, DOCS).limit(0)
    index = line_dedup.insert(none)
    assert line_dedup.dedupe(none, index).count() == 0
    some = line_dedup.insert(frame(spark, DOCS), index)
    ours = rows(line_dedup.dedupe(frame(spark, DOCS), some), "doc_id", "n_lines", "n_dropped", "kept")
    assert ours == brute(DOCS)


@pytest.mark.parametrize("capacity", [10, 5000])
def test_filter_finds_all_keys_and_forgets_deleted_ones(capacity):
    random = np.random.default_rng(3)
    keys = random.integers(0, 1 << 63, (5000, 2)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    held = CuckooFilter(capacity)
    for a in range(0, len(keys), 700):
        held.insert(keys[a : a + 700])
    held = CuckooFilter.from_bytes(held.to_bytes())
    assert held.contains(keys).all()
    others = random.integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    assert held.contains(others).mean() < 0.01
    held.delete(keys[:2500])
    assert held.contains(keys[2500:]).all() and held.contains(keys[:2500]).mean() < 0.01
    held.delete(keys[2500:])
    assert not any(t.any() for t in held.tables)
