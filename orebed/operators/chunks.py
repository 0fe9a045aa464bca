"""Phase one of two-phase mining: the frequent itemsets of each chunk, found depth first in the chunk's own task.

A chunk's baskets meet once. Its items become bitmaps over its baskets, and itemsets with the same first items are one class: the
bitmaps of a class are the AND of its prefix with each further item, so a longer set is one AND and a bit count, and
nothing is exchanged until the sets found are united. Chunks are of a bounded size, so their number grows with the data; a chunk
that is given and larger is mined in parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StructField, StructType

# Itemsets in an Arrow batch.
BATCH_SETS = 10_000


def mine(rows: DataFrame, support: int, total: int) -> DataFrame:
    """Itemsets frequent in a chunk: ``chunk, itemset``.

    ``rows`` are ``chunk, basket, item`` with repeats. Where they have a ``part``, each part of a chunk is mined by itself, and a set
    is listed for each part it is frequent in. A chunk with ``m`` of the ``total`` baskets needs a count ``n`` with
    ``n * total >= support * m``; single items count every occurrence, larger sets once a basket. Null items are in no set.
    """
    item = rows.schema["item"].dataType
    schema = StructType([rows.schema["chunk"], StructField("itemset", ArrayType(item))])
    keys = [c for c in ("chunk", "part") if c in rows.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = pa.Table.from_batches(batches).combine_chunks()
        basket, values, codes = _coded(chunk["basket"], chunk["item"])
        m = int(basket.max()) + 1
        need = max(1, -(-m * support // total))
        for found in batched(frequent(basket, codes, m, need)):
            offsets = np.r_[0, np.cumsum([len(s) for s in found])].astype(np.int32)
            flat = values.take(pa.array([x for s in found for x in s], pa.int64()))
            of = pa.repeat(chunk["chunk"][0], len(found))
            yield pa.RecordBatch.from_arrays([of, pa.ListArray.from_arrays(pa.array(offsets), flat)], ["chunk", "itemset"])

    return rows.select(*keys, "basket", "item").groupBy(*keys).applyInArrow(run, schema)


def _coded(baskets: pa.ChunkedArray, items: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Baskets as numbers from 0, the sorted items, and the items as places there (-1: null)."""
    basket = pc.dictionary_encode(baskets.combine_chunks(), null_encoding="encode").indices.to_numpy()
    coded = pc.dictionary_encode(items.combine_chunks())
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order) + 1, np.int64)
    rank[order] = np.arange(len(order))
    rank[-1] = -1
    return basket, coded.dictionary.take(pa.array(order)), rank[pc.fill_null(coded.indices, -1).to_numpy()]


def batched(sets: Iterator[tuple]) -> Iterator[list[tuple]]:
    some = []
    for s in sets:
        some.append(s)
        if len(some) == BATCH_SETS:
            yield some
            some = []
    if some:
        yield some


def frequent(basket: np.ndarray, item: np.ndarray, m: int, need: int) -> Iterator[tuple[int, ...]]:
    """The sets of ``counted`` without their counts."""
    return (s for s, _ in counted(basket, item, m, need))


def counted(
    basket: np.ndarray, item: np.ndarray, m: int, need: int, first: int | None = None
) -> Iterator[tuple[tuple[int, ...], int]]:
    """Sets of item numbers in at least ``need`` of ``m`` baskets, numbers ascending, and their counts.

    Single items count every row. The bitmaps of a class hold the baskets of its first item only. With ``first``, only
    sets whose least number is below it.
    """
    basket, item = basket[item >= 0], item[item >= 0]
    counts = np.bincount(item) if len(item) else np.zeros(0, np.int64)
    singles = np.flatnonzero(counts >= need)
    heads = len(singles) if first is None else int(np.searchsorted(singles, first))
    for i in singles[:heads].tolist():
        yield (i,), int(counts[i])
    # Distinct baskets of each item left, one after the other.
    order = np.lexsort((basket, item))
    basket, item = basket[order], item[order]
    new = np.r_[True, (np.diff(item) != 0) | (np.diff(basket) != 0)] if len(item) else np.zeros(0, bool)
    basket, item = basket[new], item[new]
    starts, ends = np.searchsorted(item, singles), np.searchsorted(item, singles, "right")
    place = np.full(m, -1, np.int64)
    for a in range(heads):
        own = basket[starts[a] : ends[a]]
        if len(own) < need:
            continue
        place[own] = np.arange(len(own))
        inside, rows = [], []
        for b in range(a + 1, len(singles)):
            at = place[basket[starts[b] : ends[b]]]
            at = at[at >= 0]
            if len(at) >= need:
                bits = np.zeros(-(-len(own) // 64) * 64, bool)
                bits[at] = True
                inside.append(int(singles[b]))
                rows.append(np.packbits(bits).view(np.uint64))
        place[own] = -1
        if rows:
            yield from _class((int(singles[a]),), inside, np.array(rows), need)


def _class(
    prefix: tuple[int, ...], items: list[int], bitmaps: np.ndarray, need: int
) -> Iterator[tuple[tuple[int, ...], int]]:
    """Frequent sets that begin with ``prefix`` and go on with one or more of ``items``, with counts; all of these do once."""
    stack = [(prefix, items, bitmaps)]
    while stack:
        prefix, items, bitmaps = stack.pop()
        counts = np.bitwise_count(bitmaps).sum(axis=1).tolist()
        for i, x in enumerate(items):
            yield (*prefix, x), counts[i]
            if i + 1 < len(items):
                both = bitmaps[i + 1 :] & bitmaps[i]
                enough = np.flatnonzero(np.bitwise_count(both).sum(axis=1) >= need)
                if len(enough):
                    stack.append(((*prefix, x), [items[i + 1 + k] for k in enough.tolist()], both[enough]))
