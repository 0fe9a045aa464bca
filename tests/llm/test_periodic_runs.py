"""Periodic runs against a search of all stretches."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orebed.llm import periodic_runs
from orebed.llm.queries import op11_periodic_runs, planted_repeats


def brute(words):
    """All runs (start, length, period), each period's maximal stretches looked at one by one."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                best.setdefault((i, length), q)
            i = max(j, i) + 1
    return sorted((s, n, q) for (s, n), q in best.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_text(r):
    words = []
    for _ in range(r.randint(1, 12)):
        part = [r.choice("abcde") * r.randint(1, 2) for _ in range(r.randint(1, r.choice([2, 5, 40])))]
        words += part * r.choice([1, 1, 2, 3, 4, 5, 9]) + part[: r.randint(0, len(part))]
    return words


@pytest.fixture(scope="module")
def texts():
    r = random.Random(7)
    fixed = [
        "",
        "a",
        "a a a a a",
        "a a a a a a",
        "a b a b a b a b",
        "a b a b a b a",
        "x " + "a b c " * 4 + "y",
        "a " * 3000,
        "a b " * 700 + "c " + "a b " * 700,
        " ".join(["p", "q", "r", "s", "t"] * 4 + ["p"]),
    ]
    return fixed + [" ".join(random_text(r)) for _ in range(120)]


def test_runs_are_those_of_brute_force(spark, texts):
    rows = [(i, t, 5, "x") for i, t in enumerate(texts)] + [(None, None, 1, "y"), (3, texts[3], 2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, runs string").repartition(5)
    found = {}
    for row in periodic_runs.find(docs).collect():
        found.setdefault(row["doc_id"], []).append(row)
    assert len(found[3]) == 2 and found[3][0] == found[3][1]
    assert found[None][0]["n_words"] == 0 and found[None][0]["runs"] == []
    for i, text in enumerate(texts):
        words, row = text.split(), found[i][0]
        runs = brute(words)
        assert [tuple(r) for r in row["runs"]] == runs, text[:200]
        assert row["n_words"] == len(words)
        left = collapsed(words, runs)
        assert row["collapsed"] == (left if runs else None)
        assert row["collapsed_sha256"] == hashlib.sha256(left.encode()).hexdigest()


def test_tiles_alone_hold_no_more_than_their_words(texts):
    words = np.array([ord(c) for c in "ab" * 500])
    for octave, _, cuts in periodic_runs.cuts_to_solve(words, np.array([0]), np.array([len(words)])):
        step = periodic_runs.octave_step(octave)
        for cut in cuts.tolist():
            first, last = max(0, cut - step), min(len(words), cut + 3 * step)
            for q, start, end in periodic_runs.solve_tile(words[first:last], first, cut, octave, len(words)):
                assert first <= start and end <= last and q >> octave == 1


def test_z_function():
    r = random.Random(1)
    for _ in range(200):
        s = [r.randint(0, 1) for _ in range(r.randint(0, 30))]
        naive = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert periodic_runs.z_function(s) == naive


def test_long_text(spark):
    """A text of a million words, half of it one run and half one word."""
    words = [f"w{i % 1013}" for i in range(500_000)] + ["z"] * 500_000
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    runs = periodic_runs.find(docs).first()["runs"]
    assert [tuple(r) for r in runs] == [(0, 500_000, 1013), (500_000, 500_000, 1)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.find(docs).count() == 0


def test_query_is_that_of_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    ours = {r["doc_id"]: r for r in op11_periodic_runs(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(ours) == len(docs)
    some = 0
    for doc, text in docs:
        words = planted_repeats(doc, (text or "").encode().split())
        if len(words) > 3000:
            continue
        runs = brute(words)
        some += bool(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        row = ours[doc]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        left = collapsed([w.decode() for w in words], runs)
        assert row["collapsed_sha256"] == hashlib.sha256(left.encode()).hexdigest()
    assert some > 5


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a " * 9)], "doc_id long, text string").withColumn("__row", F.lit("x"))
    docs = docs.withColumn("period", F.lit(1)).withColumn("words", F.lit(1))
    assert [tuple(r) for r in periodic_runs.find(docs).first()["runs"]] == [(0, 9, 1)]
