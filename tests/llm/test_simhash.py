from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from orebed.llm import simhash
from orebed.llm.components import components


def brute_fingerprint(text: str | None) -> int:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[int]) -> list[int]:
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize(
    "text", [None, "", " \n\t", "One", "one two", "a b c", "a B c d", "x " * 500, "é É x y z w", "a\x1fb c d e f g"]
)
def test_fingerprint(text):
    assert simhash.fingerprint(text and text.encode()) == brute_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    found = spark.createDataFrame([("a b é",)], ["s"]).select(F.xxhash64("s")).first()[0]
    assert found % (1 << 64) == xxhash.xxh64_intdigest("a b é".encode(), 42)


def test_every_near_pair_is_joined(spark):
    rng = np.random.default_rng(1)
    prints = [int(x) for x in rng.integers(0, 1 << 63, 300)]
    for base in prints[:60]:
        for flips in (1, 2, 3, 4, 5):
            near = base
            for bit in rng.choice(64, flips, replace=False).tolist():
                near ^= 1 << bit
            prints.append(near)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    root = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in simhash.groups(df).collect()}
    ours: dict[int, set] = {}
    for p in prints:
        ours.setdefault(root.get(p, p), set()).add(p)
    theirs: dict[int, set] = {}
    for p, r in zip(prints, brute_components(prints)):
        theirs.setdefault(r, set()).add(p)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


@pytest.mark.parametrize("bits", [0, 3, 8])
def test_buckets_do_not_change_the_links(bits):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40, dtype=np.int64).view(np.uint64)
    values = np.unique(np.concatenate([base, base ^ np.uint64(1 << 5), base ^ np.uint64((1 << 5) | (1 << 40) | (1 << 41))]))
    found = set()
    for bucket in range(1 << bits):
        a, b = simhash.links_in_bucket(values, bucket, bits)
        found |= {frozenset(p) for p in zip(a.tolist(), b.tolist())}
    near = {
        frozenset((x, y)) for x in values.tolist() for y in values.tolist() if x < y and (x ^ y).bit_count() <= 3
    }
    assert found <= near
    joined = lambda links: sorted(_groups(values.tolist(), links))
    assert joined(found) == joined(near)


def _groups(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in map(tuple, links):
        a, b = sorted((find(a), find(b)))
        root[b] = a
    out: dict[int, list] = {}
    for n in nodes:
        out.setdefault(find(n), []).append(n)
    return map(sorted, out.values())


TEXTS = [
    (5, "the quick brown fox jumps over the lazy dog again and again"),
    (3, "The quick brown fox jumps over the lazy dog again and again"),
    (9, None),
    (8, ""),
    (8, " \n"),
    (1, "something else entirely is written in this one here"),
    (1, "something else entirely is written in this one here"),
    (None, "something else entirely is written in this one here"),
    (None, "alone without an id but with words of its own, many"),
]


def test_rows_and_components(spark, rows):
    df = spark.createDataFrame([(*t, "x", 1) for t in TEXTS], "doc_id long, text string, fp string, component_id int")
    found = rows(simhash.near_duplicates(df).select("doc_id", "component_id"))
    assert found == sorted([(5, 3), (3, 3), (9, 8), (8, 8), (8, 8), (1, 1), (1, 1), (None, 1), (None, None)], key=repr)


def test_keeps_one_row_of_each_group(spark):
    df = spark.createDataFrame([(*t, "x", 1) for t in TEXTS], "doc_id long, text string, fp string, root int")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == ["1", "3", "8", "None"]
    clash = df.selectExpr("*", "1 AS __Row", "2 AS `a.b`")
    kept = simhash.keep_one(clash)
    assert kept.columns == clash.columns and kept.count() == 4


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0
    assert simhash.keep_one(df).count() == 0


def test_long_text():
    text = "word " * 300_000 + "end"
    assert simhash.fingerprint(text.encode()) == brute_fingerprint("word " * 3_000 + "end")


def test_components(spark, rows):
    links = [(i + 1, i) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (102, 100)] + [(200 + i, 300) for i in range(50)]
    found = rows(components(spark.createDataFrame(links, "a long, b long")))
    wanted = [(i, 0) for i in range(41)] + [(i, 100) for i in (100, 101, 102)] + [(200 + i, 200) for i in range(50)] + [(300, 200)]
    assert found == sorted(wanted, key=repr)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
