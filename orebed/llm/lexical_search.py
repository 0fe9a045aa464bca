"""Ranked lexical search of all documents for each item by dense blocked matrix products.

The items' distinct terms are the vocabulary. Each document is read once and becomes the counts of vocabulary
terms in it; document frequencies and lengths are summed over all documents. Then tiles of documents, as dense impact
matrices over the vocabulary that occurs in the tile, are multiplied by tiles of item weights with BLAS in
float64. All numbers are integers: a tile of the vocabulary is so narrow that no partial sum reaches 2^53, so products are
exact, and tiles are added as 64-bit integers. Each task keeps the best documents of each item, ties by id, and Spark ranks what the tasks
have kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebed.llm.common import per_text, plain_words
from orebed.session import stage

#: The scale of weights and impacts, the weight of a document's length of 100, and the saturation.
WEIGHT_SCALE = 1000
IMPACT_SCALE = 1_000_000_000
LENGTH_SHARE = 50
SATURATION = 20

#: Documents in a tile, items in a tile, and vocabulary terms in a tile at most.
TILE_DOCS = 512
TILE_ITEMS = 512
TILE_TERMS = 4096

#: Pairs of item and term in one block of items; the documents are searched for one block after the other.
BLOCK_PAIRS = 2_000_000

#: No integer from here on is sure to be exact in float64.
EXACT = 1 << 53


def weight(n_docs: int, frequency: int) -> int:
    """How much a term counts that ``frequency`` of ``n_docs`` documents hold."""
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * frequency + 1)))


def impacts(counts: np.ndarray, lengths: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """The saturated counts of terms in documents of so many terms, all as 64-bit integers."""
    counts, lengths = counts.astype(np.int64), lengths.astype(np.int64)
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * n_docs) // max(1, total)
    return (IMPACT_SCALE * counts) // (1000 * counts + SATURATION * m)


class Searcher:
    """Scores tiles of documents for items and keeps the best of each item.

    ``items`` are arrays of term numbers, ``weights`` the terms' weights.
    """

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, n_docs: int, total: int, top: int):
        self.items, self.weights, self.n_docs, self.total, self.top = items, weights, n_docs, total, top
        self.best: list[list[tuple]] = [[] for _ in items]
        self.least = np.ones(len(items), np.int64)
        most = max(1, int(weights.max(initial=1))) * (IMPACT_SCALE // 1000)
        #: So many products of a weight and an impact add up to less than 2^53.
        self.width = max(1, min(TILE_TERMS, (EXACT - 1) // most))

    def scores(self, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> Iterator:
        """``(first item, scores)`` of documents whose ``sizes`` terms with ``counts`` lie one after the other."""
        present, column = np.unique(terms, return_inverse=True)
        row = np.repeat(np.arange(len(sizes)), sizes)
        value = impacts(counts, lengths[row], self.n_docs, self.total)
        place = np.full(len(self.weights), -1, np.int64)
        place[present] = np.arange(len(present))
        tiles = []
        for a in range(0, len(present), self.width):
            inside = (column >= a) & (column < a + self.width)
            tile = np.zeros((min(self.width, len(present) - a), len(sizes)))
            tile[column[inside] - a, row[inside]] = value[inside]
            tiles.append(tile)
        for first in range(0, len(self.items), TILE_ITEMS):
            block = self.items[first : first + TILE_ITEMS]
            item = np.repeat(np.arange(len(block)), [len(t) for t in block])
            term = np.concatenate([*block, np.zeros(0, np.int64)]).astype(np.int64)
            at = place[term]
            item, term, at = item[at >= 0], term[at >= 0], at[at >= 0]
            total = np.zeros((len(block), len(sizes)), np.int64)
            for k, tile in enumerate(tiles):
                inside = at // self.width == k
                if inside.any():
                    wanted = np.zeros((len(block), len(tile)))
                    wanted[item[inside], at[inside] - k * self.width] = self.weights[term[inside]]
                    total += (wanted @ tile).astype(np.int64)
            yield first, total

    def add(self, ids: list, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> None:
        """Look at a tile of documents. Those as good as the worst kept are taken in, so that ties are decided by id."""
        for first, scores in self.scores(lengths, sizes, terms, counts):
            good = scores >= self.least[first : first + len(scores), None]
            if scores.shape[1] > self.top:
                # Below the tile's own best ones there is no way in either.
                place = scores.shape[1] - self.top
                good &= scores >= np.partition(scores, place, axis=1)[:, place, None]
            for i in np.flatnonzero(good.any(1)).tolist():
                best = self.best[first + i]
                best += [(-int(scores[i, d]), ids[d] is None, ids[d]) for d in np.flatnonzero(good[i]).tolist()]
                # Python compares the ids only among equal scores, and never a null with another id.
                best.sort(key=lambda b: b if not b[1] else b[:2])
                del best[self.top :]
                if len(best) == self.top:
                    self.least[first + i] = max(1, -best[-1][0])

    def found(self) -> Iterator[tuple]:
        """``(item, score, id)`` of the documents kept."""
        for i, best in enumerate(self.best):
            for score, _, doc in best:
                yield i, -score, doc


def _item_terms(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """The items numbered as ``__item`` with their ids and distinct terms."""

    def make():
        return lambda texts: ([sorted(set(plain_words(t))) for t in texts],)

    numbered = benchmark.select(
        F.monotonically_increasing_id().alias("__item"), F.col(item_col).alias("__id"), F.col(text_col).alias("__text")
    )
    return stage(per_text(numbered, ["__item", "__id"], "__text", ["terms array<binary>"], make))


def _counted(documents: DataFrame, id_col: str, text_col: str, vocabulary) -> DataFrame:
    """Each document's id, its terms with repeats ``n``, and its vocabulary terms with their counts as int32 arrays."""

    def make():
        numbers = {term: i for i, term in enumerate(vocabulary.value)}

        def counted(texts):
            lengths, terms, counts = [], [], []
            for text in texts:
                words = plain_words(text)
                known = np.fromiter(map(numbers.get, words, repeat(-1)), np.int64, len(words))
                own, often = np.unique(known[known >= 0], return_counts=True)
                lengths.append(len(words))
                terms.append(own.astype(np.int32).tobytes())
                counts.append(often.astype(np.int32).tobytes())
            return lengths, terms, counts

        return counted

    source = documents.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("__text"))
    return stage(per_text(source, ["__doc"], "__text", ["n long", "terms binary", "counts binary"], make))


def _frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each vocabulary term."""

    def run(batches):
        held = np.zeros(size, np.int64)
        for batch in batches:
            terms = b"".join(batch.column(0).to_pylist())
            held += np.bincount(np.frombuffer(terms, np.int32), minlength=size)
        own = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(held[own], pa.int64())], ["term", "df"])

    found = counted.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    frequencies = np.zeros(size, np.int64)
    for term, df in found.collect():  # one row per term of the vocabulary at most
        frequencies[term] = df
    return frequencies


def search(
    documents: DataFrame,
    items: DataFrame,
    top: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """The ``top`` best documents of each item: ``item_col, rank, id_col, score``.

    Scores are above 0; equal ones are ranked by ascending id, null ids last. Rows with one id are so many documents or items, each
    ranked by itself. Null, empty and blank texts have no term: such documents are never found, such items find none. Other
    columns may have any name. Where the items' distinct terms are more than ``block_pairs`` in all, the documents are
    searched for blocks of items one after the other; weights are those of all documents in each.
    """
    wanted = _item_terms(items, item_col, item_text)
    pairs = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = -(-pairs // block_pairs) or 1
    found = None
    for block in range(n):
        part = wanted.where(F.pmod(F.xxhash64("__item"), F.lit(n)) == block)
        best = _search_block(documents, part, top, id_col, text_col)
        found = best if found is None else found.unionByName(best)
    best_first = Window.partitionBy("__item").orderBy(F.desc("score"), F.col("__doc").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)
    named = ranked.join(wanted.select("__item", "__id"), "__item")
    return named.select(F.col("__id").alias(item_col), "rank", F.col("__doc").alias(id_col), "score")


def _search_block(documents: DataFrame, wanted: DataFrame, top: int, id_col: str, text_col: str) -> DataFrame:
    """The documents that tasks keep for a block of items: ``__item, __doc, score``."""
    spark = documents.sparkSession
    # Bounded by the number of pairs in a block.
    rows = wanted.select("__item", "terms").orderBy("__item").collect()
    vocabulary = sorted(set(chain.from_iterable((bytes(t) for t in terms) for _, terms in rows)))
    number = {term: i for i, term in enumerate(vocabulary)}
    terms_of = [np.array([number[bytes(t)] for t in terms], np.int64) for _, terms in rows]
    names = [item for item, _ in rows]
    counted = _counted(documents, id_col, text_col, spark.sparkContext.broadcast(vocabulary))
    n_docs, total = counted.where(F.col("n") > 0).agg(F.count(F.lit(1)), F.sum("n")).first()
    frequencies = _frequencies(counted, len(vocabulary))
    weights = np.array([weight(n_docs, int(df)) for df in frequencies], np.int64)
    shared = spark.sparkContext.broadcast((names, terms_of, weights, n_docs, total or 0))
    id_type = counted.schema["__doc"].dataType.simpleString()

    def run(batches):
        names, terms_of, weights, n_docs, total = shared.value
        searcher, doc_type = Searcher(terms_of, weights, n_docs, total, top), None
        for batch in batches:
            doc_type = batch.schema.field(0).type
            for a in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(a, TILE_DOCS)
                ids, lengths, terms, counts = (c.to_pylist() for c in part.columns)
                sizes = np.array([len(t) // 4 for t in terms], np.int64)
                terms, counts = (np.frombuffer(b"".join(v), np.int32) for v in (terms, counts))
                searcher.add(ids, np.array(lengths, np.int64), sizes, terms, counts)
        if doc_type is not None:
            found = list(searcher.found())
            columns = [pa.array([names[i] for i, _, _ in found], pa.int64())]
            columns.append(pa.array([doc for _, _, doc in found], doc_type))
            columns.append(pa.array([score for _, score, _ in found], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["__item", "__doc", "score"])

    held = counted.where(F.length("terms") > 0).select("__doc", "n", "terms", "counts")
    return held.mapInArrow(run, f"__item long, __doc {id_type}, score long")
