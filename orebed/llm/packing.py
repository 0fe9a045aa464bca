"""Best-fit-decreasing packing of tokenised documents into fixed-length sequences.

Pieces of one length can be exchanged for each other, so best-fit decreasing over all pieces of a
corpus follows from how many there are of each length. The plan is made from those counts (at most
``capacity`` numbers): a segment tree over the remaining capacities finds the
tightest open bin, and bins of the same remainder are filled as ranges, with the same result as
piece by piece. Every piece then looks up its place by its number among the pieces of its length.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebed.llm.common import parts
from orebed.session import stage

CAPACITY = 2048

#: The id that ends a document.
END = 0

#: Texts of many pieces are numbered in groups of about so many.
GROUP = 500_000

#: Word pieces whose ids a task remembers.
REMEMBERED = 250_000

# White space that the fast path does not cut at, and letters beyond Latin.
_ODD = re.compile(r"[\x1c-\x1f\x85\xa0ɐ-\U0010ffff]")
_SPACES = re.compile(r"\s\s")


class Encoder:
    """Token ids of a text as packed little-endian unsigned 32-bit numbers.

    A byte-level BPE never merges across the pieces its pattern makes, and a single space before
    a character that is no space always starts a piece. Such texts are cut there and the ids of
    each piece remembered; the rare others go to the tokenizer whole, as do texts with the string of an added token,
    which the tokenizer takes for that token.
    """

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None):
        self.tokenizer, self.known, self.whole, self.short = tokenizer, {}, None, None
        with open(tokenizer, "rb") as file:
            self.added = [token["content"] for token in json.load(file).get("added_tokens") or ()]
        if ranks and pattern:
            import base64

            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.short = tiktoken.Encoding("piece", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def _whole(self, text: str) -> bytes:
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.tokenizer)
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        found = self.known.get(piece)
        if found is None:
            found = np.array(self.short.encode_ordinary(piece), dtype="<u4").tobytes()
            if len(self.known) < REMEMBERED and len(piece) < 64:
                self.known[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.short is None or _ODD.search(text) or _SPACES.search(text) or any(a in text for a in self.added):
            return self._whole(text)
        first, *rest = text.split(" ")
        rest = [" " + piece for piece in rest]
        found = list(map(self.known.get, rest))
        if None in found:
            found = [f if f is not None else self._piece(p) for f, p in zip(found, rest)]
        return b"".join([self._piece(first), *found])


def cut(length: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of ``length`` ids: full ones, a shorter one first."""
    short, full = length % capacity, length // capacity
    return [short] * (short > 0) + [capacity] * full


_PIECES = "piece int, start long, length int, ids_crc32 long, ids binary"


def pieces(
    documents: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document: ``id_col, piece, start, length, ids_crc32, ids``.

    A document is the ids of its whole text and then id 0. ``tokenizer`` is the path of a tokenizers
    file; ``ranks`` and ``pattern`` name the same vocabulary for the faster piece-wise path.
    ``ids`` are packed little-endian unsigned 32-bit numbers, left out unless ``with_ids``.
    """
    source = documents.select(id_col, F.col(text_col).cast("string").alias("__text"))
    kind = source.schema[id_col].dataType.simpleString()
    end = np.array([END], dtype="<u4").tobytes()

    def run(batches):
        encoder = Encoder(tokenizer, ranks, pattern)
        for batch in batches:
            for part in parts(batch, 1):
                owners, rows = [], []
                for i, text in enumerate(part.column(1).cast(pa.binary()).to_pylist()):
                    ids = encoder.encode((text or b"").decode(errors="replace")) + end
                    at = 0
                    for n, size in enumerate(cut(len(ids) // 4, capacity)):
                        data = ids[4 * at : 4 * (at + size)]
                        owners.append(i)
                        rows.append((n, at, size, zlib.crc32(data), data if with_ids else None))
                        at += size
                columns = [pa.array(v, type=t) for v, t in zip(zip(*rows), _TYPES)] if rows else []
                if rows:
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owners)), *columns], [id_col, *_NAMES])

    return source.mapInArrow(run, f"`{id_col}` {kind}, {_PIECES}")


_NAMES = [c.split()[0] for c in _PIECES.split(", ")]
_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]


class Capacities:
    """A segment tree over remaining capacities: whether bins of each remainder are open, and
    the tightest that a piece still fits in, found in logarithmic time."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1 - 1).bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, remainder: int, open_: bool) -> None:
        at = self.size + remainder
        self.open[at] = open_
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest open remainder of at least ``least``."""
        at = self.size + least
        if self.open[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing of ``counts[length]`` pieces: rows ``length, first, bin, per, offset``.

    The pieces of a length numbered from ``first`` up to the next row's go, ``per`` to a bin, into the
    bins from ``bin`` on, at ``offset`` and after. Bins of one remainder are ranges, and each length opens
    or splits a few of them, so the plan depends on the lengths, not on how many pieces there are.
    """
    ranges: dict[int, list[tuple[int, int]]] = {}
    tree, rows, bins = Capacities(capacity), [], 0

    def put(remainder: int, first: int, n: int) -> None:
        if n and remainder:
            ranges.setdefault(remainder, []).append((first, n))
            tree.set(remainder, True)

    for length in sorted(counts, reverse=True):
        done, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first = capacity, bins
                n = -(-left // (capacity // length))
                bins += n
            else:
                first, n = ranges[room].pop()
                if not ranges[room]:
                    tree.set(room, False)
            per = room // length
            full = min(n, left // per)
            if full:
                rows.append((length, done, first, per, capacity - room))
                put(room - per * length, first, full)
                done, left = done + full * per, left - full * per
            if full < n and left:
                rows.append((length, done, first + full, left, capacity - room))
                put(room - left * length, first + full, 1)
                done, left, full = done + left, 0, full + 1
            put(room, first + full, n - full)
    return rows


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` for each row of ``found``, which has a ``length`` of 1 to
    ``capacity``; all other columns stay but those whose names begin with two underscores, which are for the columns made
    here. Offsets in a sequence have no gap from 0 on.

    Pieces are counted by length and group; a window numbers those of one length and group, so
    that a common length is no single task. Only counts by length come to the driver.
    """
    staged = stage(found.withColumn("__row", F.monotonically_increasing_id()))
    total = staged.agg(F.count(F.lit(1))).first()[0]
    groups = max(1, -(-total // GROUP))
    staged = staged.withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups)).cast("int"))
    sizes = stage(staged.groupBy("length", "__group").agg(F.count(F.lit(1)).alias("n")))
    counts = {r[0]: r[1] for r in sizes.groupBy("length").agg(F.sum("n")).collect()}
    before = Window.partitionBy("length").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "__group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    number = F.row_number().over(Window.partitionBy("length", "__group").orderBy("__row")) - 1
    numbered = staged.withColumn("__n", number).join(starts, ["length", "__group"])
    numbered = numbered.withColumn("__n", F.col("__n") + F.col("__before"))
    rows = staged.sparkSession.sparkContext.broadcast(np.array(plan(counts, capacity), dtype=np.int64).reshape(-1, 5))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, n: pd.Series) -> pd.DataFrame:
        # Lengths in descending order and numbers in ascending order, as one sorted key.
        table, span = rows.value, np.int64(1) << 48
        keys = (capacity - table[:, 0]) * span + table[:, 1]
        length, n = length.to_numpy(np.int64), n.to_numpy(np.int64)
        row = table[np.searchsorted(keys, (capacity - length) * span + n, side="right") - 1]
        at = n - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 2] + at // row[:, 3], "offset": row[:, 4] + at % row[:, 3] * length})

    placed = numbered.withColumn("__place", place("length", "__n"))
    columns = [c for c in staged.columns if not c.startswith("__")]
    return placed.select(*columns, "__place.sequence_id", "__place.offset")


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """All documents as pieces with their place in a sequence: ``id_col, piece, start, length,
    ids_crc32, sequence_id, offset``, and ``ids`` with ``with_ids``.

    A null or empty text is the end id alone. Repeated rows and ids each have their pieces; an
    empty table gives none. Only documents longer than ``capacity`` are cut.
    """
    found = pieces(documents, tokenizer, ranks, pattern, id_col, text_col, capacity, with_ids)
    packed = pack(found if with_ids else found.drop("ids"), capacity)
    return packed.withColumn("length", F.col("length").cast("long"))
