"""Near-duplicate vectors by a forest of random-projection trees.

Every tree splits the vectors again and again at the median of a random projection; those near the
median go to both sides (spill). Vectors are compared within leaves of many trees, pairs at the
wanted cosine verified in double precision, and united. A pair in one leaf of any tree is found, so
more trees miss fewer. The links of a vector are then counted within its component, in blocks, so that
what one tree misses and another joins is counted too.

Splits are fitted on a bounded sample down to where it gives reliable medians; leaves of the whole
table that are still too large are split further by medians of all their rows, level by level.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.llm.components import components
from orebed.session import stage

COSINE = 0.9
TREES = 10

#: Share of a node's vectors on either side of the median that go to both children.
SPILL = 0.05

#: Vectors in a leaf, about, and the most that a task compares at once.
LEAF = 1_024
LARGEST = 4_096

#: Vectors that the splits near the roots are fitted on, and bytes of them at most; vectors of the sample that
#: a fitted node needs.
SAMPLE = 20_000
SAMPLE_BYTES = 64_000_000
PER_NODE = 64

#: A split that leaves a child more than this share of its leaf's rows is the last one there.
PROGRESS = 0.9

#: Steps of a unit vector's components; vectors that agree in all of them have one direction.
STEPS = 1e12

#: Rows of a component that are compared with as many others at once.
BLOCK = 2_048

SEED = 7


def usable(vector_col: str) -> Column:
    """Whether a vector can link: not null, no null or non-finite component, not zero."""
    v = F.col(vector_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))


def directions(tree: int, node: int, dim: int) -> np.ndarray:
    """The random direction of a node: the same wherever it is asked for."""
    return np.random.default_rng([SEED, tree, node]).standard_normal(dim)


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow for very large or small components."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def fit(sample: np.ndarray, depth: int, trees: int = TREES, spill: float = SPILL) -> list[dict]:
    """For each tree, by node: the bounds of the overlap in the node's projection. Nodes are
    numbered as in a heap from 1; a node whose sample is small stays a leaf."""
    forest = []
    for tree in range(trees):
        bounds: dict[int, tuple[float, float]] = {}
        work = [(1, np.arange(len(sample)))]
        while work:
            node, rows = work.pop()
            if node >= 1 << depth or len(rows) < PER_NODE:
                continue
            at = sample[rows] @ directions(tree, node, sample.shape[1])
            low, high = np.quantile(at, [0.5 - spill, 0.5 + spill])
            bounds[node] = float(low), float(high)
            work += [(2 * node, rows[at <= high]), (2 * node + 1, rows[at >= low])]
        forest.append(bounds)
    return forest


def _route(x: np.ndarray, tree: int, bounds: dict) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of each row in a tree: row numbers and nodes."""
    rows, nodes, work = [], [], [(1, np.arange(len(x)))]
    while work:
        node, mine = work.pop()
        if node not in bounds:
            rows.append(mine)
            nodes.append(np.full(len(mine), node, dtype=np.int64))
            continue
        low, high = bounds[node]
        at = x[mine] @ directions(tree, node, x.shape[1])
        work += [(2 * node, mine[at <= high]), (2 * node + 1, mine[at >= low])]
    return np.concatenate(rows), np.concatenate(nodes)


_LEAVES = "dim int, tree int, node long, id long, v array<double>"


def _leaf_batches(routed) -> pa.RecordBatch:
    """A batch of ``_LEAVES`` from ``dim, tree, nodes, ids, vector array`` pieces."""
    dims, trees, nodes, ids, vectors = zip(*routed)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(dims), type=pa.int32()),
            pa.array(np.concatenate(trees), type=pa.int32()),
            pa.array(np.concatenate(nodes), type=pa.int64()),
            pa.concat_arrays(ids),
            pa.concat_arrays(vectors),
        ],
        ["dim", "tree", "node", "id", "v"],
    )


def leaves(distinct: DataFrame, n: int, trees: int, leaf: int = LEAF, largest: int = LARGEST) -> DataFrame:
    """Every vector of ``distinct (id, dim, v)`` in each tree's leaves that it belongs to."""
    forests = {}
    for row in distinct.groupBy("dim").count().collect():
        most = min(SAMPLE, SAMPLE_BYTES // (8 * max(1, row["dim"])))
        chosen = distinct.where(F.col("dim") == row["dim"]).orderBy(F.xxhash64("id")).limit(most).select("v")
        sample = unit(_matrix(chosen.toArrow().column(0)))
        depth = max(0, math.ceil(math.log2(max(1.0, row["count"] / leaf))))
        forests[row["dim"]] = fit(sample, depth, trees)
    shared = distinct.sparkSession.sparkContext.broadcast(forests)

    def run(batches):
        forest = shared.value
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            for dim in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == dim))
                x, ids, vectors = unit(_matrix(part.column(2))), part.column(0), part.column(2)
                for tree in range(trees):
                    rows, nodes = _route(x, tree, forest[dim][tree])
                    at = pa.array(rows)
                    same = np.full(len(rows), dim), np.full(len(rows), tree)
                    yield _leaf_batches([(*same, nodes, ids.take(at), vectors.take(at))])

    placed = stage(distinct.select("id", "dim", "v").mapInArrow(run, _LEAVES))
    return _split_large(placed, largest)


def _split_large(placed: DataFrame, largest: int) -> DataFrame:
    """Split leaves of more than ``largest`` vectors at the median of all their rows until none
    is left but those that a split did not make smaller. Each leaf is judged alone."""
    keys, done = ["dim", "tree", "node"], None
    placed = placed.withColumn("whole", F.lit(None).cast("long"))
    while True:
        sizes = stage(placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max("whole").alias("whole")))
        shrunk = F.col("whole").isNull() | (F.col("n") <= PROGRESS * F.col("whole"))
        large = sizes.where((F.col("n") > largest) & shrunk)
        if large.isEmpty():
            return (placed if done is None else done.unionByName(placed)).drop("whole")
        small = placed.join(large.select(*keys), keys, "left_anti")
        done = small if done is None else done.unionByName(small)
        split = placed.drop("whole").join(large.select(*keys, F.col("n").alias("whole")), keys)
        projected = stage(split.mapInArrow(_projections, _LEAVES + ", whole long, p double"))
        bounds = F.percentile_approx("p", [0.5 - SPILL, 0.5 + SPILL], 1_000).alias("c")
        cuts = projected.groupBy(*keys).agg(bounds, (F.min("p") == F.max("p")).alias("tied"))
        # A leaf of ties only goes on whole, but once.
        sides = F.filter(
            F.array(
                F.when(F.col("tied") | (F.col("p") <= F.col("c")[1]), F.col("node") * 2),
                F.when(~F.col("tied") & (F.col("p") >= F.col("c")[0]), F.col("node") * 2 + 1),
            ),
            lambda s: s.isNotNull(),
        )
        placed = projected.join(cuts, keys).withColumn("node", F.explode(sides))
        placed = stage(placed.select("dim", "tree", "node", "id", "v", "whole"))


def _projections(batches):
    for batch in batches:
        dims, trees, nodes = (batch.column(i).to_numpy() for i in range(3))
        p = np.zeros(batch.num_rows)
        for dim, tree, node in set(zip(dims.tolist(), trees.tolist(), nodes.tolist())):
            at = np.flatnonzero((dims == dim) & (trees == tree) & (nodes == node))
            p[at] = unit(_matrix(batch.column(4).take(pa.array(at)))) @ directions(tree, node, dim)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*batch.schema.names, "p"])


def _with_direction(batches):
    """Batches ``id, v`` with the direction of each vector, the same for all its multiples."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column(1)).to_numpy()
        for dim in np.unique(sizes).tolist():
            part = batch.filter(pa.array(sizes == dim))
            steps = np.rint(unit(_matrix(part.column(1))) * STEPS).astype(np.int64)
            ways = pa.array([x.tobytes() for x in steps], type=pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns, ways], [*part.schema.names, "way"])


def _near(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    return x @ y.T >= least


def spanning(x: np.ndarray, ids: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is joined within a leaf: each vector to the first of its group."""
    linked = np.zeros(len(ids), dtype=bool)
    for a in range(0, len(ids), BLOCK):
        for b in range(a, len(ids), BLOCK):
            near = _near(x[a : a + BLOCK], x[b : b + BLOCK], least)
            if a == b:
                np.fill_diagonal(near, False)
            linked[a : a + BLOCK] |= near.any(axis=1)
            linked[b : b + BLOCK] |= near.any(axis=0)
    x, ids = x[linked], ids[linked]
    free, one, other = np.ones(len(ids), dtype=bool), [], []
    for seed in range(len(ids)):
        if not free[seed]:
            continue
        free[seed], queue = False, [np.array([seed])]
        while queue:
            rest, front = np.flatnonzero(free), queue.pop()
            if len(front) > BLOCK:
                queue.append(front[BLOCK:])
            found = rest[_near(x[front[:BLOCK]], x[rest], least).any(axis=0)]
            if len(found):
                free[found] = False
                one.append(ids[found])
                other.append(np.full(len(found), ids[seed]))
                queue.append(found)
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *one]), np.concatenate([none, *other])


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = COSINE,
    trees: int = TREES,
    leaf: int = LEAF,
    largest: int = LARGEST,
) -> DataFrame:
    """One row per row of ``vectors``: ``id_col, n_links, component_id, kept``.

    ``n_links`` are the other rows at a cosine of ``least`` or more that were found,
    ``component_id`` the smallest id reachable over such links, itself included, and ``kept``
    whether that is the row's own. Vectors that are null, zero, or hold a null or non-finite
    component link with nothing, nor do vectors of different lengths; rows with a null id have no
    component and link with nothing. Repeated ids are rows of their own. An empty
    table gives none.

    Vectors of one direction are one vector with a count, so copies make no pairs. Neither do
    leaves or components: a leaf sends one link per vector, a component's blocks one count per vector.
    """
    source = vectors.select(id_col, vector_col)
    mark = F.col(id_col).isNotNull() & usable(vector_col)
    rows = source.where(mark).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.mapInArrow(_with_direction, f"id {rows.schema['id'].dataType.simpleString()}, v array<double>, way binary")
    classes = rows.groupBy("way").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.min("v").alias("v"))
    # A repeated id with two vectors may be the least of both: classes have numbers of their own.
    classes = stage(classes.select(F.monotonically_increasing_id().alias("class"), "id", "copies", F.size("v").alias("dim"), "v", "way"))
    distinct = classes.select(F.col("class").alias("id"), "dim", "v")
    placed = leaves(distinct, distinct.count(), trees, leaf, largest)

    def compare(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        a, b = spanning(unit(_matrix(table.column("v"))), ids, least)
        return pa.table({"a": pa.array(a, type=pa.int64()), "b": pa.array(b, type=pa.int64())})

    links = placed.groupBy("dim", "tree", "node").applyInArrow(compare, "a long, b long")
    rooted = components(links)
    members = stage(classes.drop("way").join(rooted.withColumnRenamed("node", "class"), "class"))
    counted = _count_links(members, least)
    known = classes.join(counted, "class", "left").select(
        "way",
        F.coalesce("n", F.lit(0)).alias("__others"),
        "copies",
        F.coalesce("root", "class").alias("__root"),
        F.col("id").alias("__id"),
    )
    known = stage(known)
    least_id = known.groupBy("__root").agg(F.min("__id").alias("__component"))
    known = known.join(least_id, "__root").select("way", "__others", "copies", "__component")
    good = rows.drop("v").join(known, "way").select(
        F.col("id").alias(id_col),
        (F.col("__others") + F.col("copies") - 1).alias("n_links"),
        F.col("__component").alias("component_id"),
    )
    alone = source.where(~mark).select(id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"))
    return good.unionByName(alone).withColumn("kept", F.col(id_col) == F.col("component_id"))


def _count_links(members: DataFrame, least: float) -> DataFrame:
    """``class, root, n``: how many rows of other classes of its component are near each class.

    A component is cut into blocks and every two blocks are compared in a task of their own, so
    a large one is spread; only a count per class leaves a task.
    """
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("__n"))
    blocks = F.ceil(F.col("__n") / BLOCK).cast("int")
    placed = members.join(sizes, "root").withColumn("__blocks", blocks)
    placed = placed.withColumn("mine", F.pmod(F.xxhash64("class"), F.col("__blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    pairs = placed.withColumn("other", other).select(
        "root",
        F.least("mine", "other").alias("one"),
        F.greatest("mine", "other").alias("two"),
        "mine",
        "class",
        "copies",
        "v",
    )

    def compare(table: pa.Table) -> pa.Table:
        x = unit(_matrix(table.column("v")))
        mine, copies = table.column("mine").to_numpy(), table.column("copies").to_numpy()
        one, two = table.column("one")[0].as_py(), table.column("two")[0].as_py()
        n = np.zeros(len(mine), dtype=np.int64)
        first, second = np.flatnonzero(mine == one), np.flatnonzero(mine == two)
        for i in range(0, len(first), BLOCK):
            for j in range(0, len(second), BLOCK):
                a, b = first[i : i + BLOCK], second[j : j + BLOCK]
                near = _near(x[a], x[b], least)
                near &= a[:, None] != b[None, :]
                n[a] += near @ copies[b]
                if one != two:
                    n[b] += copies[a] @ near
        return pa.table({"class": table.column("class"), "root": table.column("root"), "n": pa.array(n)})

    counted = pairs.groupBy("root", "one", "two").applyInArrow(compare, "class long, root long, n long")
    return counted.groupBy("class", "root").agg(F.sum("n").alias("n"))
