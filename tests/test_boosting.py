"""Boosted trees against a search of all splits on few rows."""

from __future__ import annotations

import numpy as np
import pytest

from orebed.operators import boosting

FEATURES = ["a", "b", "c"]
P = {"learning_rate": 0.3, "n_trees": 3, "max_depth": 3, "row_share": 1.0, "column_share": 1.0, "min_child": 4.0,
     "least_gain": 0.2, "l2": 2.0, "l1": 0.5, "seed": 1}


def data():
    random = np.random.default_rng(4)
    x = np.column_stack([random.integers(0, 9, 200), random.normal(size=200).round(1), random.integers(0, 2, 200)]).astype(float)
    y = x[:, 0] * 0.5 + np.where(x[:, 1] > 0.3, 2.0, 0.0) * x[:, 2] + random.normal(size=200) * 0.3
    return x, y


def value(g, h):
    return -np.sign(g) * max(abs(g) - P["l1"], 0) / (h + P["l2"])


def score(g, h):
    return max(abs(g) - P["l1"], 0) ** 2 / (h + P["l2"])


def brute_tree(x, g, depth):
    """(feature, cut, left, right) or a leaf's value, by trying every value of every feature."""
    best = (0.0, None)
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f]):
            left = x[:, f] <= cut
            if left.sum() >= P["min_child"] and (~left).sum() >= P["min_child"]:
                sides = score(g[left].sum(), left.sum()) + score(g[~left].sum(), (~left).sum())
                gain = 0.5 * (sides - score(g.sum(), len(g))) - P["least_gain"]
                if gain > best[0] + 1e-9:
                    best = (gain, (f, cut))
    if best[1] is None or depth == 0:
        return value(g.sum(), len(g)) * P["learning_rate"]
    f, cut = best[1]
    left = x[:, f] <= cut
    return f, cut, brute_tree(x[left], g[left], depth - 1), brute_tree(x[~left], g[~left], depth - 1)


def brute_apply(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def frame(spark, x, y):
    rows = [(*map(float, r), float(v), "k") for r, v in zip(x, y)]
    return spark.createDataFrame(rows, "a double, b double, c double, stars double, prediction string").repartition(3)


def test_trees_are_those_of_a_search_of_all_splits(spark, tmp_path):
    x, y = data()
    df = frame(spark, x, y)
    model = boosting.fit(df, features=FEATURES, cuts=[np.unique(x[:, i]) for i in range(3)], **P)
    margin = np.full(len(y), y.mean())
    assert model.base == pytest.approx(y.mean()) and len(model.trees) == 3
    for tree in model.trees:
        brute = brute_tree(x, margin - y, P["max_depth"])
        own = np.array([brute_apply(brute, r) for r in x])
        assert tree.values(x) == pytest.approx(own)
        margin += own
    found = boosting.predict(model, df).collect()
    by_row = {tuple(r): m for r, m in zip(x.tolist(), margin.tolist())}
    assert all(r["prediction"] == pytest.approx(by_row[r["a"], r["b"], r["c"]]) for r in found) and len(found) == 200
    boosting.save(spark, model, str(tmp_path / "m"))
    again = boosting.load(spark, str(tmp_path / "m"))
    assert again == model


def test_margins_are_written_every_few_trees(spark, monkeypatch):
    x, y = data()
    df, cuts = frame(spark, x, y), [np.unique(x[:, i]) for i in range(3)]
    whole = boosting.fit(df, features=FEATURES, cuts=cuts, **P)
    monkeypatch.setattr(boosting, "TREES_A_TABLE", 1)
    each = boosting.fit(df, features=FEATURES, cuts=cuts, **P)
    assert boosting.Booster.margins(whole, x) == pytest.approx(each.margins(x))


def test_regularisation_shares_and_bins(spark):
    x, y = data()
    df = frame(spark, x, y)
    few = boosting.fit(df, features=FEATURES, **{**P, "least_gain": 1e6})
    assert [len(t.feature) for t in few.trees] == [1, 1, 1]
    shares = {**P, "row_share": 0.7, "column_share": 0.4, "n_trees": 8, "learning_rate": 0.4}
    model = boosting.fit(df, features=FEATURES, bins=16, **shares)
    assert all(len({f for f in t.feature if f >= 0}) <= 1 for t in model.trees)
    error = lambda m: float(np.mean((m - y) ** 2))
    assert error(model.margins(x)) < 0.5 * error(np.full(len(y), y.mean()))


def test_odd_rows(spark):
    schema = "a double, b double, c double, stars double"
    none = spark.createDataFrame([], schema)
    assert boosting.fit(none, features=FEATURES, **P).trees == []
    rows = [(float(i % 5), None, float("nan"), float(i % 5 > 2)) for i in range(60)] + [(1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, schema)
    model = boosting.fit(df, features=FEATURES, **{**P, "n_trees": 5, "learning_rate": 0.6})
    found = {r["a"]: r["prediction"] for r in boosting.predict(model, df.where("b IS NULL")).collect()}
    assert found[0.0] < 0.2 and found[4.0] > 0.8


def test_halving_chooses_as_a_full_search_does(spark):
    x, y = data()
    df = frame(spark, np.repeat(x, 5, axis=0), np.repeat(y, 5))
    grid = {"learning_rate": [0.01, 0.3], "max_depth": [1, 2]}
    same = {**{k: v for k, v in P.items() if k not in grid}, "n_trees": 4}
    found = boosting.search(df, features=FEATURES, grid=grid, **same)
    full = boosting.search(df, features=FEATURES, grid=grid, keep_one_in=4, **same)
    assert [t for t, _, _ in found.tried] == [0] * 4 + [1] * 2 and [t for t, _, _ in full.tried] == [0] * 4
    assert found.settings == full.settings == {"learning_rate": 0.3, "max_depth": 2}
    assert found.model == full.model


def test_search_draws_from_the_fixed_values(spark):
    x, y = data()
    small = {"n_trees": [1], "max_depth": [1, 2]}
    found = boosting.search(frame(spark, x, y), features=FEATURES, grid={**boosting.SEARCH, **small}, most_settings=3)
    assert len(found.tried) == 3 and all(set(s) == set(boosting.SEARCH) for _, s, _ in found.tried)
    for _, settings, _ in found.tried:
        assert all(v in {**boosting.SEARCH, **small}[k] for k, v in settings.items())


def test_steps_and_shares_by_level_and_node(spark):
    x, y = data()
    model = boosting.fit(frame(spark, x, y), features=FEATURES, **{**P, "most_step": 0.1, "level_share": 0.7, "node_share": 0.5})
    assert max(abs(v) for t in model.trees for v in t.value) <= 0.1 * P["learning_rate"] + 1e-12
    assert any(len(t.feature) > 1 for t in model.trees)


def test_small_trees_are_walked_node_by_node(monkeypatch):
    """Both ways through a tree lead to the same leaves, NaN goes right, and bins are read from a slice in place."""
    import pyarrow as pa

    tree = boosting.Tree()
    left, right = tree.grow(0, 1, 0.5, (1.0, 2.0))
    tree.grow(left, 0, 3.0, (3.0, 4.0))
    tree.grow(right, 2, 0.0, (5.0, 6.0))
    x, _ = data()
    x[::7, 1] = np.nan
    few = tree.nodes(x)
    monkeypatch.setattr(boosting, "SMALL_TREE", 0)
    assert (few == tree.nodes(x)).all() and set(few) == {3, 4, 5, 6}
    assert len(tree.nodes(x[:0])) == 0
    bins = pa.array([bytes([i, 2 * i, 255 - i]) for i in range(9)], pa.binary())
    codes = boosting._codes(bins.slice(2, 5), 3)
    assert codes.tolist() == [[i, 2 * i, 255 - i] for i in range(2, 7)] and codes[:, 1].flags.c_contiguous
    assert boosting._codes(bins.slice(0, 0), 3).shape == (0, 3)


def test_rows_that_do_not_count_go_through_no_tree(spark):
    """Only the rows of the sample are looked at: the sums are those of the sampled rows."""
    x, y = data()
    rows = boosting.binned(frame(spark, x, y), FEATURES, [np.unique(x[:, i]) for i in range(3)], "stars")
    tree = boosting.Tree()
    tree.grow(0, 2, 0.0, (0.5, -0.5))
    got = boosting.histogram(rows, 1.0, [tree], boosting.Tree(), [0], [0], 3, (1, 0.5)).toPandas()
    local = rows.toPandas()
    kept = boosting._sampled(local["row"].to_numpy(), 1, 0.5)
    codes = np.array([list(b) for b in local["bins"]])[kept]
    g = 1.0 + np.where(codes[:, 2] <= 0, 0.5, -0.5) - local["y"].to_numpy()[kept]
    want = {b: (g[codes[:, 0] == b].sum(), float((codes[:, 0] == b).sum())) for b in set(codes[:, 0].tolist())}
    assert {int(r.bin): (r.g, r.h) for r in got.itertuples()} == {b: pytest.approx(v) for b, v in want.items()}
