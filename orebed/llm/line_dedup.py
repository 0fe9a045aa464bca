"""Line dedup over a growing corpus: sharded cuckoo filters in front of exact reference counts.

An index of lines holds two written tables. ``references`` has one row per line key and document, so a
key's reference count is exact and a document can be taken out again. ``filters`` has, per shard of keys, a cuckoo filter of all
keys present: two bytes a key, no false negative, and fingerprints can be deleted. Documents that come in send the keys of their lines to
the shards, where the filter tells keys that are certainly new from those that may be known; only the latter are
counted exactly. So unique lines, nearly all of a corpus, cost a fingerprint and one written row, and no exact look-up.

Keys are 128-bit BLAKE2 digests of the normalised line.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.functions.skew import heavy_keys, heavy_of, replicated, salted
from orebed.llm.common import parts, per_text
from orebed.session import stage

#: Shorter keys, in code points, are no duplicates.
LEAST_CHARS = 10

#: Keys of one shard when an index is made; one filter of a shard has room for about as many.
SHARD_KEYS = 200_000

#: A key with more than a thousandth of all rows, and at least so many, is split over tasks.
HOT_ROWS = 1_000

#: Fingerprints in a bucket, and moves tried before a filter counts as full.
SLOTS = 4
MOVES = 200


def line_key(line: bytes) -> bytes | None:
    """The digest of a line without white space at its ends, A-Z lower-cased; None if it is too short to count."""
    key = line.strip().lower()
    if len(key) < LEAST_CHARS:
        return None
    if len(key) < 4 * LEAST_CHARS and not key.isascii() and len(key.decode(errors="replace")) < LEAST_CHARS:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


class CuckooFilter:
    """A set of 128-bit keys by 16-bit fingerprints, each in one of two buckets of a table.

    Distinct keys may be inserted and deleted; a key that is in is always found. A full table is followed by
    another of twice the size.
    """

    def __init__(self, capacity: int = 1024, tables: list[np.ndarray] | None = None):
        self.tables = tables if tables is not None else [self._table(capacity)]

    @staticmethod
    def _table(capacity: int) -> np.ndarray:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, capacity) / SLOTS / 0.85))))
        return np.zeros((buckets, SLOTS), np.uint16)

    @staticmethod
    def _places(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints (never 0) and both buckets of keys, an array of shape (n, 2) of uint64."""
        prints = ((keys[:, 1] >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        mask = np.uint64(len(table) - 1)
        first = keys[:, 0] & mask
        return prints, first.astype(np.int64), CuckooFilter._other(first, prints, mask).astype(np.int64)

    @staticmethod
    def _other(bucket, prints, mask):
        """The other bucket of a fingerprint; the other's other is the bucket itself."""
        return (bucket ^ (prints.astype(np.uint64) * np.uint64(0x5BD1E995))) & mask

    def contains(self, keys: np.ndarray) -> np.ndarray:
        found = np.zeros(len(keys), bool)
        for table in self.tables:
            prints, one, two = self._places(keys, table)
            found |= (table[one] == prints[:, None]).any(1) | (table[two] == prints[:, None]).any(1)
        return found

    def insert(self, keys: np.ndarray) -> None:
        """Add keys, each once."""
        while len(keys):
            keys = self._fill(self.tables[-1], keys)
            if len(keys):
                self.tables.append(self._table(2 * self.tables[-1].size))

    def _fill(self, table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Place keys in a table and return those that found no room."""
        prints, one, two = self._places(keys, table)
        left = np.arange(len(keys))
        # All at once into free slots; of keys that want the same slot one gets it.
        for bucket in (one, two) * SLOTS:
            free = (table[bucket[left]] == 0).any(1)
            wants = left[free]
            slot = (table[bucket[wants]] == 0).argmax(1)
            _, winners = np.unique(bucket[wants] * SLOTS + slot, return_index=True)
            table[bucket[wants[winners]], slot[winners]] = prints[wants[winners]]
            placed = np.zeros(len(keys), bool)
            placed[wants[winners]] = True
            left = left[~placed[left]]
            if not len(left):
                return keys[:0]
        lost = [i for i in left.tolist() if not self._push(table, int(one[i]), prints[i])]
        return keys[lost]

    def _push(self, table: np.ndarray, bucket: int, fingerprint: np.uint16) -> bool:
        """Move fingerprints to their other buckets until one finds a free slot; undo it all if none does."""
        moves, mask = [], np.uint64(len(table) - 1)
        for turn in range(MOVES):
            free = np.flatnonzero(table[bucket] == 0)
            if len(free):
                table[bucket, free[0]] = fingerprint
                return True
            slot = (bucket + turn) % SLOTS
            moves.append((bucket, slot, table[bucket, slot]))
            fingerprint, table[bucket, slot] = table[bucket, slot], fingerprint
            bucket = int(self._other(np.uint64(bucket), fingerprint, mask))
        for bucket, slot, old in reversed(moves):
            table[bucket, slot] = old
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that are in, each once."""
        for key in keys:
            for table in self.tables:
                prints, one, two = self._places(key[None, :], table)
                bucket = next((b for b in (one[0], two[0]) if (table[b] == prints[0]).any()), None)
                if bucket is not None:
                    table[bucket, (table[bucket] == prints[0]).argmax()] = 0
                    break

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.tables), *(len(t) for t in self.tables)], np.int64)
        return sizes.tobytes() + b"".join(t.tobytes() for t in self.tables)

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        tables, at = [], 8 * (n + 1)
        for buckets in np.frombuffer(data, np.int64, n, 8).tolist():
            tables.append(np.frombuffer(data, np.uint16, buckets * SLOTS, at).reshape(buckets, SLOTS).copy())
            at += 2 * SLOTS * buckets
        return cls(tables=tables)


@dataclass
class LineIndex:
    """Lines of documents: ``references`` (shard, key, doc) and ``filters`` (shard, filter), both written.

    ``repeated`` has the exact counts of the keys that more than one document holds: ``shard, key, n_docs, first_doc``.
    """

    references: DataFrame
    filters: DataFrame
    repeated: DataFrame
    shards: int


def _lines(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``documents`` and key in it: ``key, doc``."""

    def make():
        def keys(texts):
            found = []
            for text in texts:
                own = {line_key(line) for line in text.split(b"\n")} if text else set()
                found.append(list(own - {None}))
            return (found,)

        return keys

    per_row = per_text(documents, [id_col], text_col, ["keys array<binary>"], make)
    return per_row.select(F.explode("keys").alias("key"), F.col(id_col).alias("doc"))


def _matrix(keys: pa.Array) -> np.ndarray:
    """Digests as rows of two numbers."""
    return np.frombuffer(b"".join(keys.to_pylist()), np.uint64).reshape(-1, 2)


def _once_a_batch(rows: DataFrame) -> DataFrame:
    """Rows ``shard, key`` with ``many``, whether the key came more often in its batch; so a line that is everywhere is sent once
    a batch, not once a document."""

    def run(batches):
        for batch in batches:
            counted = pa.table(batch).group_by(["shard", "key"]).aggregate([([], "count_all")])
            many = pc.greater(counted["count_all"], 1)
            yield from pa.table({"shard": counted["shard"], "key": counted["key"], "many": many}).to_batches()

    return rows.mapInArrow(run, "shard int, key binary, many boolean")


def _through_filters(keys: DataFrame, filters: DataFrame | None, shards: int, capacity: int) -> DataFrame:
    """Put keys through their shards' filters: rows ``shard, key`` of keys that may have been seen before, in
    the filter or among these, and a row ``shard, filter`` of each shard as it is then.

    Rows stream through a task ordered by shard, the old filter first, so a task holds one filter and one batch.
    """
    rows = keys.select("shard", "key", "many", F.lit(None).cast("binary").alias("filter"))
    if filters is not None:
        no = [F.lit(None).cast("binary").alias("key"), F.lit(False).alias("many")]
        rows = rows.unionByName(filters.select("shard", *no, "filter"))
    n = min(shards, 4 * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartition(n, "shard").sortWithinPartitions("shard", F.col("filter").isNull())

    def known(held: CuckooFilter, part: pa.RecordBatch) -> pa.Array:
        """Keys that may be known, and all others added to the filter."""
        own = part.filter(pc.is_valid(part.column(1)))
        if not own.num_rows:
            return own.column(1)
        matrix = _matrix(own.column(1))
        _, first, back, counts = np.unique(matrix, axis=0, return_index=True, return_inverse=True, return_counts=True)
        seen = held.contains(matrix[first])
        held.insert(matrix[first[~seen]])
        twice = seen | (counts > 1)
        np.logical_or.at(twice, back.reshape(-1), own.column(2).to_numpy(zero_copy_only=False))
        return own.column(1).take(pa.array(first[twice]))

    def run(batches) -> Iterator[pa.RecordBatch]:
        shard, held = None, None
        names = ["shard", "key", "filter"]

        def written():
            columns = [pa.array([shard], pa.int32()), pa.array([None], pa.binary()), pa.array([held.to_bytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            of = batch.column(0).to_numpy(zero_copy_only=False)
            turns = np.r_[0, np.flatnonzero(np.diff(of)) + 1, len(of)]
            for a, b in zip(turns[:-1].tolist(), turns[1:].tolist()):
                if a == b:
                    continue
                if of[a] != shard:
                    if shard is not None:
                        yield written()
                    shard, held = int(of[a]), CuckooFilter(capacity)
                part = batch.slice(a, b - a)
                old = part.column(3)[0].as_py()
                if old is not None:
                    held = CuckooFilter.from_bytes(old)
                found = known(held, part)
                if len(found):
                    nothing = pa.nulls(len(found), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([shard] * len(found), pa.int32()), found, nothing], names)
        if shard is not None:
            yield written()

    return dealt.mapInArrow(run, "shard int, key binary, filter binary")


def insert(
    documents: DataFrame, index: LineIndex | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> LineIndex:
    """The index with the lines of ``documents`` added; a new one if there is none.

    Rows with one id are one document, null ids too, and a document that is in already only gains the lines it has not;
    keys in the old index are looked up only where the filter says that they may be there.
    """
    lines = stage(_lines(documents, id_col, text_col))
    if index is None:
        shards, capacity = -(-lines.count() // SHARD_KEYS) or 1, SHARD_KEYS
    else:
        shards, capacity = index.shards, SHARD_KEYS
    sharded = lines.select(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), "key", "doc")
    sent = _once_a_batch(sharded.select("shard", "key"))
    passed = stage(_through_filters(sent, index and index.filters, shards, capacity))
    filters = passed.where(F.col("key").isNull()).select("shard", "filter")
    maybe = passed.where(F.col("key").isNotNull()).select("shard", "key").distinct()
    references = sharded if index is None else index.references.unionByName(sharded)
    counted = _counted(references, maybe)
    if index is not None:
        # What was repeated and did not come again stays as it was.
        counted = counted.unionByName(index.repeated.join(maybe, ["shard", "key"], "left_anti"))
    return LineIndex(references, filters, stage(counted), shards)


def _counted(references: DataFrame, keys: DataFrame) -> DataFrame:
    """Exact counts of the ``keys`` that two documents or more hold: ``shard, key, n_docs, first_doc``."""
    key = ["shard", "key"]
    heavy = stage(heavy_keys(references, key, min_rows=HOT_ROWS))
    spread = salted(references, heavy, key, ["doc"])
    held = spread.join(replicated(keys, heavy, key), [*key, "salt"], "left_semi").drop("salt").distinct()
    # A null id is the greatest, so min leaves it out unless it is alone.
    counts = held.groupBy("shard", "key").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc").alias("first_doc"))
    return counts.where(F.col("n_docs") > 1)


def delete(index: LineIndex, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
    """The index without the documents of ``ids``, as if they had never come in.

    Only the keys of these documents are counted again, and those that no other document holds are taken out of the filters.
    """
    key = ["shard", "key"]
    gone = ids.select(F.col(id_col).alias("gone")).distinct()
    is_gone = F.col("doc").eqNullSafe(F.col("gone"))
    touched = stage(index.references.join(gone, is_gone, "left_semi").select(*key).distinct())
    references = stage(index.references.join(gone, is_gone, "left_anti"))
    counted = _counted(references, touched)
    repeated = index.repeated.join(touched, key, "left_anti").unionByName(counted)
    orphans = touched.join(references, key, "left_anti")
    return LineIndex(references, stage(_without(index.filters, orphans)), stage(repeated), index.shards)


def _without(filters: DataFrame, keys: DataFrame) -> DataFrame:
    """The filters after deleting distinct keys that are in them."""
    nothing = F.lit(None).cast("binary")
    rows = filters.select("shard", nothing.alias("key"), "filter")
    rows = rows.unionByName(keys.select("shard", "key", nothing.alias("filter")))
    dealt = rows.repartition("shard").sortWithinPartitions("shard", F.col("filter").isNull())

    def run(batches):
        shard, held = None, None
        for batch in batches:
            for of, key, data in zip(*(c.to_pylist() for c in batch.columns)):
                if of != shard:
                    if shard is not None:
                        yield _filter_row(shard, held)
                    shard, held = of, CuckooFilter.from_bytes(data)
                else:
                    held.delete(np.frombuffer(key, np.uint64)[None, :])
        if shard is not None:
            yield _filter_row(shard, held)

    return dealt.mapInArrow(run, "shard int, filter binary")


def _filter_row(shard: int, held: CuckooFilter) -> pa.RecordBatch:
    columns = [pa.array([shard], pa.int32()), pa.array([held.to_bytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["shard", "filter"])


def dedupe(documents: DataFrame, index: LineIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``documents``: ``id_col, n_lines, n_dropped, kept``.

    ``documents`` are some or all of those in the index. A line goes if its key is found in two documents of the index or more and
    this is not the one with the smallest id; ``kept`` are the other lines, as they were, joined by line feeds. A null
    or empty text is one empty line. A null id counts as one document, greater than all others. Rows with
    one id are one document: none of them loses a line to another. Other columns may have any name.
    """
    key = ["shard", "key"]
    repeated = index.repeated.where(F.col("n_docs") > 1)
    counts = repeated.select(*key, F.col("n_docs").alias("n_rows"))
    heavy = heavy_of(counts, min_rows=HOT_ROWS)
    later = ~F.col("doc").eqNullSafe(F.col("first_doc"))
    held = salted(index.references, heavy, key, ["doc"])
    first = replicated(repeated.select(*key, "first_doc"), heavy, key)
    drops = held.join(first, [*key, "salt"]).where(later).groupBy("doc").agg(F.collect_set("key").alias("__drop"))
    texts = documents.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    both = texts.join(drops, F.col("__id").eqNullSafe(F.col("doc")), "left").select("__id", "__drop", "__text")
    return _rewritten(both).withColumnRenamed("__id", id_col)


def _rewritten(rows: DataFrame) -> DataFrame:
    """Rows ``__id, __drop, __text`` with the lines counted, and those whose key is in ``__drop`` left out."""
    id_type = rows.schema["__id"].dataType.simpleString()
    names = ["__id", "n_lines", "n_dropped", "kept"]

    def run(batches):
        for part in chain.from_iterable(parts(batch, 2) for batch in batches):
            texts = part.column(2).cast(pa.binary()).to_pylist()
            n_lines, n_dropped, kept = [], [], []
            for text, drop in zip(texts, part.column(1).to_pylist()):
                lines = (text or b"").split(b"\n")
                left = lines
                if drop:
                    drop = set(drop)
                    left = [line for line in lines if line_key(line) not in drop]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
                kept.append(b"\n".join(left))
            columns = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    return rows.mapInArrow(run, f"__id {id_type}, n_lines long, n_dropped long, kept string")
