from __future__ import annotations

import numpy as np
import pytest

from orebed.llm import vectors


def brute(rows, least=0.9):
    """``n_links, component`` by all pairs."""
    good = {}
    for i, (_, v) in enumerate(rows):
        if rows[i][0] is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, dtype=np.float64) / np.linalg.norm(np.array(v, dtype=np.float64))
    root, n = {i: i for i in good}, dict.fromkeys(good, 0)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in good:
        for j in good:
            if i < j and len(good[i]) == len(good[j]) and good[i] @ good[j] >= least:
                n[i] += 1
                n[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    lowest = {}
    for i in good:
        lowest[find(i)] = min(lowest.get(find(i), rows[i][0]), rows[i][0])
    return [
        (rows[i][0], n.get(i, 0), lowest[find(i)] if i in good else rows[i][0]) for i in range(len(rows))
    ]


def made(seed: int, n: int, dim: int = 16, noise: float = 0.02):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    near = [base[i % 40] + noise * rng.standard_normal(dim) for i in range(3 * n // 4)]
    copies = [base[i % 7] for i in range(60)]
    order = rng.permutation(n + len(near) + len(copies))
    every = np.concatenate([base, near, copies])[order].astype(np.float32)
    return [(int(i), [float(x) for x in v]) for i, v in enumerate(every)]


@pytest.mark.parametrize("leaf, largest", [(1_024, 4_096), (32, 4_096), (64, 48)])
def test_links_of_brute_force(spark, leaf, largest):
    rows = made(1, 300)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = vectors.near_duplicates(df, leaf=leaf, largest=largest)
    ours = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found.collect()}
    theirs = {i: (n, c) for i, n, c in brute(rows)}
    assert len(ours) == len(rows)
    assert sum(n for n, _ in ours.values()) >= 0.99 * sum(n for n, _ in theirs.values())
    assert all(ours[i][0] <= theirs[i][0] for i in theirs)
    assert ours == theirs


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(5)
    a = rng.standard_normal((2_000, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2_000, 32))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    angle = np.arccos(0.905)
    near = np.cos(angle) * a + np.sin(angle) * b
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, near]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vectors.near_duplicates(df, leaf=64)
    linked = found.where("n_links > 0").count()
    assert linked >= 0.9 * len(rows)


ROWS = [
    (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [0.0, 3.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]),
    (7, [float("inf"), 1.0]), (8, [None, 1.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (0, [1.0, 0.01]), (10, [1e-30, 0.0]), (11, [3e30, 0.0]),
]


def test_odd_vectors(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in ROWS], "vec_id long, embedding array<float>, class int, v int")
    found = rows(vectors.near_duplicates(df).select("vec_id", "n_links", "component_id"))
    assert found == sorted(brute(ROWS), key=repr)
    kept = {r["vec_id"]: r["kept"] for r in vectors.near_duplicates(df).collect()}
    assert kept[0] and not kept[1] and kept[3] and kept[9]


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_duplicates(df).count() == 0


def test_all_the_same(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(500)], "vec_id long, embedding array<float>")
    found = vectors.near_duplicates(df, leaf=16, largest=32).collect()
    assert {(r["n_links"], r["component_id"]) for r in found} == {(499, 0)}


def test_a_leaf_of_ties_does_not_end_the_splitting(spark):
    rng = np.random.default_rng(3)
    rows = [(4, 0, 2, i, [float(i + 1)] * 4) for i in range(400)]
    rows += [(4, 0, 3, 1_000 + i, rng.standard_normal(4).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "dim int, tree int, node long, id long, v array<double>")
    out = vectors._split_large(df, 48)
    assert out.columns == df.columns
    sizes: dict = {}
    for r in out.collect():
        sizes.setdefault((r["id"] < 1_000, r["node"]), set()).add(r["id"])
    assert max(len(v) for (tied, _), v in sizes.items() if not tied) <= 48
    assert set().union(*sizes.values()) == {r[3] for r in rows}


def test_multiples_are_one_vector(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((60, 8)))]
    rows += [(100 + i, [x * (i + 1) / 7 for x in rows[5][1]]) for i in range(200)]
    seen, plain = [], vectors.leaves

    def leaves(distinct, n, *rest):
        seen.append(n)
        return plain(distinct, n, *rest)

    monkeypatch.setattr(vectors, "leaves", leaves)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vectors.near_duplicates(df, leaf=16, largest=32).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == sorted(brute(rows))
    assert seen[0] < 70
