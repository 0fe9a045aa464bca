"""Rating regression by boosted trees with second-order gain and L1, L2 and least-gain regularisation.

Features are cut into bins once. A level of a tree is one aggregate: the sums of gradients and second derivatives of each node, feature
and bin, added up in the tasks before they are shuffled, and a running sum over the bins gives the gain of every split. What the driver holds are
the cuts and the trees; rows stay where they are, and their margins are written every few trees.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orebed.operators.features import FEATURES
from orebed.session import stage

# Learning rate, trees, depth, row and column share, least weight of a leaf, least gain, L2 and L1
# weights, seed. Shares of columns by level and node of 1 and a step of 0 leave them alone.
PARAMETERS = {
    "learning_rate": 0.05,
    "n_trees": 300,
    "max_depth": 15,
    "row_share": 0.7,
    "column_share": 0.6,
    "min_child": 5.0,
    "least_gain": 1.0,
    "l2": 2.0,
    "l1": 0.5,
    "level_share": 1.0,
    "node_share": 1.0,
    "most_step": 0.0,
    "seed": 2000,
}

# The settings to try.
SEARCH = {
    "learning_rate": [0.05, 0.1, 0.2],
    "n_trees": [200, 300, 400],
    "max_depth": [10, 15, 20],
    "row_share": [0.6, 0.7, 0.8],
    "column_share": [0.5, 0.6, 0.7],
    "min_child": [5, 10, 15],
    "least_gain": [0, 1, 2],
    "l2": [1, 2, 3],
    "l1": [0, 0.5, 1],
    "level_share": [0.5, 0.6, 0.7],
    "node_share": [0.5, 0.6, 0.7],
    "most_step": [0, 1, 2],
}

# Bins of a feature, 256 at most, and trees after which margins are written.
BINS = 64
TREES_A_TABLE = 10

# Nodes of a tree that rows are sent through node by node.
SMALL_TREE = 64


@dataclass
class Tree:
    """Nodes by number, the root is 0: those with a feature go left up to ``split``, the others have a value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    split: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def grow(self, node: int, feature: int, split: float, values: tuple[float, float]) -> tuple[int, int]:
        """Split a node; returns the numbers of its children."""
        children = len(self.feature), len(self.feature) + 1
        self.feature[node], self.split[node] = feature, split
        self.left[node], self.right[node] = children
        for value in values:
            self.feature.append(-1)
            self.split.append(0.0)
            self.left.append(0)
            self.right.append(0)
            self.value.append(value)
        return children

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row of ``x`` comes to; NaN goes right."""
        if len(self.feature) <= SMALL_TREE:
            return self._nodes_of_few(x)
        feature, split, left, right = (np.array(v) for v in (self.feature, self.split, self.left, self.right))
        node = np.zeros(len(x), np.int64)
        inner = np.flatnonzero(feature[node] >= 0)
        while len(inner):
            at = node[inner]
            go_left = x[inner, feature[at]] <= split[at]
            node[inner] = np.where(go_left, left[at], right[at])
            inner = inner[feature[node[inner]] >= 0]
        return node

    def _nodes_of_few(self, x: np.ndarray) -> np.ndarray:
        """Node by node, one column of its rows each: for small trees several times faster than row by row."""
        node = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            if self.feature[at] < 0:
                node[rows] = at
            elif len(rows):
                go_left = x[:, self.feature[at]][rows] <= self.split[at]
                todo += [(self.left[at], rows[go_left]), (self.right[at], rows[~go_left])]
        return node

    def values(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes(x)]


@dataclass
class Booster:
    """A base value and trees over the features' values."""

    features: list[str]
    base: float
    trees: list[Tree]

    def margins(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((t.values(x) for t in self.trees), np.zeros(len(x)))


def cuts_of(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Quantiles of each feature over all rows, ascending; a split is at one of them."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.approxQuantile(list(features), shares, 1 / (8 * bins))
    return [np.unique(np.array(q, dtype=float)) for q in found]


def binned(rows: DataFrame, features: Sequence[str], cuts: Sequence[np.ndarray], label: str) -> DataFrame:
    """Rows as ``row, y, margin, bins``, the bins one byte a feature: the number of cuts below the value."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch, 2)
            places = [np.searchsorted(c, x[:, i], "left").astype(np.uint8) for i, c in enumerate(cuts)]
            codes = np.column_stack(places) if places else np.zeros((len(x), 0), np.uint8)
            ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(len(places))
            bins = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(codes.tobytes())])
            zero = pa.array(np.zeros(len(x)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), zero, bins], ["row", "y", "margin", "bins"])

    doubles = [F.col(f).cast("double") for f in features]
    # Rows are small and looked at for every level of every tree: a number of partitions given is not merged by size.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = rows.select(label, *features).repartition(tasks).select(F.monotonically_increasing_id().alias("row"), F.col(label).cast("double").alias("y"), *doubles)
    return source.mapInArrow(run, "row long, y double, margin double, bins binary")


def _matrix(batch: pa.RecordBatch, first: int) -> np.ndarray:
    """Columns from ``first`` on as an array of doubles, NULL as NaN."""
    columns = [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns[first:]]
    return np.column_stack(columns) if columns else np.zeros((batch.num_rows, 0))


def _codes(column: pa.Array, n: int) -> np.ndarray:
    """The bins of ``n`` features as rows, each column in one piece; read where they lie, not as a list."""
    if not len(column) or not n:
        return np.zeros((len(column), n), np.uint8)
    _, ends, data = column.cast(pa.binary()).buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.asfortranarray(np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].reshape(-1, n))


def histogram(
    rows: DataFrame,
    base: float,
    trees: Sequence[Tree],
    tree: Tree,
    active: Sequence[int],
    features: Sequence[int],
    n_features: int,
    sample: tuple[int, float] | None = None,
) -> DataFrame:
    """Sums of gradients and second derivatives of the squared error: ``node, feature, bin, g, h``.

    ``rows`` are those of ``binned``; ``trees`` are to be added to their margins and ``tree`` is the one that grows. Only rows in
    ``active`` nodes count and, with ``sample`` (a seed and a share), only a share of the rows, chosen by their number.
    """
    wanted, columns = np.array(sorted(active)), list(features)

    def run(batches):
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            number, y, margin = (batch.column(i).to_numpy() for i in range(3))
            x = _codes(batch.column(3), n_features)
            # Rows that do not count go through no tree.
            if sample:
                keep = _sampled(number, *sample)
                y, margin, x = y[keep], margin[keep], x.T[:, keep].T
            node = tree.nodes(x)
            place = np.searchsorted(wanted, node)
            keep = wanted[np.minimum(place, len(wanted) - 1)] == node
            if not keep.all():
                y, margin, x, place = y[keep], margin[keep], x.T[:, keep].T, place[keep]
            g = base + margin + sum(t.values(x) for t in trees) - y
            place = place * 256
            for f in columns:
                code = place + x[:, f]
                size = 256 * len(wanted)
                own = sums.setdefault(f, [np.zeros(size), np.zeros(size)])
                own[0] += np.bincount(code, g, size)
                own[1] += np.bincount(code, minlength=size)
        for f, (g, h) in sums.items():
            at = np.flatnonzero(h)
            arrays = [wanted[at // 256], np.full(len(at), f), at % 256, g[at], h[at]]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            arrays = [pa.array(a, t) for a, t in zip(arrays, types)]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "feature", "bin", "g", "h"])

    parts = rows.mapInArrow(run, "node long, feature long, bin long, g double, h double")
    # Tasks have added up their rows; dealt like this, the sums and the running sums of split_gains need one exchange.
    parts = parts.repartition("node", "feature")
    return parts.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def _sampled(number: np.ndarray, seed: int, share: float) -> np.ndarray:
    """A share of the rows by a mixed hash of their number and the seed."""
    x = number.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x >> np.uint64(11)).astype(float) < share * float(1 << 53)


def split_gains(sums: DataFrame, least_gain: float, l2: float, l1: float, min_child: float) -> DataFrame:
    """Every split of a histogram that leaves ``min_child`` on both sides: ``node, feature, bin, g_left, h_left, g, h, gain``.

    Bins up to ``bin`` go left. The gain is half of what the scores ``max(|G| - l1, 0)^2 / (H + l2)`` of both sides add to the node's,
    less ``least_gain``.
    """
    whole = Window.partitionBy("node", "feature")
    so_far = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    left = sums.select(
        "node",
        "feature",
        "bin",
        F.sum("g").over(so_far).alias("g_left"),
        F.sum("h").over(so_far).alias("h_left"),
        F.sum("g").over(whole).alias("g"),
        F.sum("h").over(whole).alias("h"),
    )

    def score(g: Column, h: Column) -> Column:
        return F.pow(F.greatest(F.abs(g) - F.lit(l1), F.lit(0.0)), F.lit(2.0)) / (h + F.lit(l2))

    g, h, g_left, h_left = (F.col(c) for c in ("g", "h", "g_left", "h_left"))
    both = score(g_left, h_left) + score(g - g_left, h - h_left)
    gain = F.lit(0.5) * (both - score(g, h)) - F.lit(least_gain)
    enough = (h_left >= min_child) & (h - h_left >= min_child) & (h_left > 0) & (h > h_left)
    return left.where(enough).withColumn("gain", gain)


def leaf_value(g: float, h: float, l1: float, l2: float, most_step: float = 0.0) -> float:
    """The value that lowers a leaf's regularised error most, no larger than ``most_step`` unless that is 0."""
    value = -float(np.sign(g)) * max(abs(g) - l1, 0.0) / (h + l2)
    return max(-most_step, min(most_step, value)) if most_step else value


def fit(
    rows: DataFrame,
    label: str = "stars",
    features: Sequence[str] = FEATURES,
    cuts: Sequence[np.ndarray] | None = None,
    **parameters,
) -> Booster:
    """Train on the feature columns of ``rows`` and a label; ``parameters`` replace those of ``PARAMETERS``.

    Rows without a label are left out; NULL and NaN features go right at every split. Equal gains go to the first
    feature and cut. No row gives a model that predicts 0.
    """
    p = {**PARAMETERS, **parameters}
    rows = rows.where(F.col(label).isNotNull())
    cuts = cuts_of(rows, features, min(256, p.pop("bins", BINS))) if cuts is None else [np.asarray(c, float) for c in cuts]
    table = stage(binned(rows, features, cuts, label))
    base = table.agg(F.avg("y")).first()[0]
    model = Booster(list(features), float(base or 0.0), [])
    if base is None:
        return model
    rng = np.random.default_rng(p["seed"])
    grown: list[Tree] = []
    pending: list[Tree] = []
    for number in range(p["n_trees"]):
        columns = _some(rng, range(len(features)), p["column_share"])
        sample = (p["seed"] + number, p["row_share"]) if p["row_share"] < 1 else None
        tree = _grown(table, model.base, pending, columns, len(features), sample, p, rng)
        grown.append(tree)
        pending.append(tree)
        if len(pending) == TREES_A_TABLE:
            table, pending = stage(_with_margins(table, pending, len(features))), []
    model.trees = [_over_values(t, cuts) for t in grown]
    return model


def _some(rng: np.random.Generator, columns: Sequence[int], share: float) -> list[int]:
    """A share of the columns, one at least."""
    n = max(1, round(share * len(columns)))
    return sorted(rng.choice(list(columns), n, replace=False).tolist()) if n < len(columns) else list(columns)


def _grown(
    table: DataFrame, base: float, pending: list[Tree], columns: list[int], n: int, sample, p: Mapping, rng
) -> Tree:
    """One tree over bins, level by level; only the best split of each node passes through the driver."""
    tree, active = Tree(), [0]
    order = F.struct("gain", -F.col("feature"), -F.col("bin"))
    best = F.max_by(F.struct("feature", "bin", "g_left", "h_left", "g", "h", "gain"), order).alias("best")
    value = lambda g, h: p["learning_rate"] * leaf_value(g, h, p["l1"], p["l2"], p["most_step"])
    for _ in range(p["max_depth"]):
        of_level = _some(rng, columns, p["level_share"])
        sums = histogram(table, base, pending, tree, active, of_level, n, sample)
        if p["node_share"] < 1:
            allowed = [(node, f) for node in active for f in _some(rng, of_level, p["node_share"])]
            sums = sums.join(table.sparkSession.createDataFrame(allowed, "node long, feature long"), ["node", "feature"])
        gains = split_gains(sums, p["least_gain"], p["l2"], p["l1"], p["min_child"])
        found = gains.where(F.col("gain") > 0).groupBy("node").agg(best).collect()
        active = []
        for node, s in sorted(found, key=lambda row: row[0]):
            right = s.g - s.g_left, s.h - s.h_left
            children = tree.grow(node, s.feature, s.bin, (value(s.g_left, s.h_left), value(*right)))
            sizes = s.h_left, right[1]
            active += [c for c, h in zip(children, sizes) if h >= 2 * p["min_child"]]
        if not active:
            break
    return tree


def _with_margins(table: DataFrame, trees: Sequence[Tree], n: int) -> DataFrame:
    """The rows with the trees added to their margins."""

    def run(batches):
        for batch in batches:
            x = _codes(batch.column(3), n)
            margin = batch.column(2).to_numpy() + sum(t.values(x) for t in trees)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(margin), batch.column(3)], schema=batch.schema)

    return table.mapInArrow(run, table.schema)


def _over_values(tree: Tree, cuts: Sequence[np.ndarray]) -> Tree:
    """The tree with cuts in place of bins."""
    split = [float(cuts[f][int(b)]) if f >= 0 else 0.0 for f, b in zip(tree.feature, tree.split)]
    return Tree(tree.feature, split, tree.left, tree.right, tree.value)


def predict(model: Booster, rows: DataFrame) -> DataFrame:
    """The rows with a ``prediction`` column, in place of one of that name."""
    rows = rows.drop("prediction")
    n = len(rows.columns)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = [f"__x{i}" for i in range(len(model.features))]
    source = rows.select("*", *(F.col(f).cast("double").alias(x) for f, x in zip(model.features, names)))

    def run(batches):
        for batch in batches:
            found = shared.value.margins(_matrix(batch, n))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(found)], [*batch.schema.names[:n], "prediction"])

    schema = rows.schema.add("prediction", "double")
    return source.mapInArrow(run, schema)


def save(spark: SparkSession, model: Booster, path: str) -> None:
    """Write the model as a table of nodes and a row of its base value and features, replacing an older one."""
    rows = [
        (t, i, *(v[i] for v in (tree.feature, tree.split, tree.left, tree.right, tree.value)))
        for t, tree in enumerate(model.trees)
        for i in range(len(tree.feature))
    ]
    schema = "tree int, node int, feature int, split double, left int, right int, value double"
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/nodes")
    head = spark.createDataFrame([(model.base, json.dumps(model.features))], "base double, features string")
    head.write.mode("overwrite").parquet(f"{path}/head")


def load(spark: SparkSession, path: str) -> Booster:
    """Read a model folder."""
    base, features = spark.read.parquet(f"{path}/head").first()
    trees: list[Tree] = []
    for tree, *row in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
        if tree == len(trees):
            trees.append(Tree([], [], [], [], []))
        for values, v in zip(vars(trees[tree]).values(), row[1:]):
            values.append(v)
    return Booster(json.loads(features), base, trees)


@dataclass
class Found:
    """The settings chosen, their model of all training rows, and what was tried: ``(round, settings, rmse)``."""

    settings: dict
    model: Booster
    tried: list[tuple[int, dict, float]]


def search(
    rows: DataFrame,
    label: str = "stars",
    features: Sequence[str] = FEATURES,
    grid: Mapping[str, Sequence] = SEARCH,
    most_settings: int = 27,
    keep_one_in: int = 3,
    seed: int = PARAMETERS["seed"],
    **parameters,
) -> Found:
    """Successive halving: all settings are tried with few trees on few rows, the best of them with more, the last with all.

    ``grid`` has the values of each parameter; of more than ``most_settings`` combinations that many are drawn by ``seed``. A round keeps the
    best one in ``keep_one_in`` by the error on a quarter of the rows, which no round learns from; the last round has all trees
    and all other rows. ``parameters`` hold for all settings.
    """
    names = list(grid)
    n_all = int(np.prod([len(grid[k]) for k in names], dtype=object))
    rng = np.random.default_rng(seed)
    drawn = range(n_all) if n_all <= most_settings else sorted(rng.choice(n_all, most_settings, replace=False).tolist())
    left = []
    for number in drawn:
        settings = {}
        for k in names:
            number, at = divmod(number, len(grid[k]))
            settings[k] = grid[k][at]
        left.append(settings)
    numbered = stage(rows.where(F.col(label).isNotNull()).withColumn("__row", F.monotonically_increasing_id()))
    place = F.pmod(F.xxhash64(F.lit(seed), "__row"), F.lit(1 << 20))
    check, train = numbered.where(place < 1 << 18), numbered.where(place >= 1 << 18)
    rounds = 1
    while keep_one_in**rounds < len(left):
        rounds += 1
    tried: list[tuple[int, dict, float]] = []
    for turn in range(rounds):
        share = float(keep_one_in) ** (turn + 1 - rounds)
        part = train.where(place < F.lit((1 << 18) + int(share * (3 << 18))))
        results = []
        for settings in left:
            given = {**PARAMETERS, **parameters, **settings}
            given["n_trees"] = max(1, round(share * given["n_trees"]))
            model = fit(part, label, features, **given)
            scored = predict(model, check)
            rmse = scored.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col(label), F.lit(2.0))))).first()[0]
            results.append((float("inf") if rmse is None else rmse, len(results), settings, model))
            tried.append((turn, settings, results[-1][0]))
        results.sort(key=lambda r: r[:2])
        left = [r[2] for r in results[: max(1, -(-len(left) // keep_one_in))]]
    return Found(results[0][2], results[0][3], tried)
