"""Periodic runs of words: stretches that repeat with a smallest period, four times or more.

Scale-tiled distribution. Periods are taken by octave, ``[2^k, 2^(k+1))``. With ``S = 2 * 2^k``, a document is
cut at every multiple of ``S``, and each cut gets the tile of words from ``S`` before to ``3 S`` after it; tiles overlap, and
each is solved by itself on any task. Z-functions at the cut give, for every period of the octave, how far
the words before and after the cut agree with those one period later, so a tile yields the fragments of
runs around its cut. A run of period ``q`` and at least ``4 q`` words has a cut with a whole period and a gram of words
to its right, so it is found; from a cut to the next such cut its fragments overlap by ``q`` words or
more, so joining fragments of one document and period that overlap so much gives the whole run. A tile is only sent if the gram
at its cut is met three times at a distance of the octave and what repeats there is not seen to end too soon; neighbouring tiles travel in one strip.

Fragments are shuffled by document and period, and of equal stretches the smallest period stays: in a
stretch of four periods any smaller period divides it (Fine and Wilf) and has the same ends.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebed.llm.common import parts
from orebed.session import stage

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4

#: Words compared at a cut before its tile is sent.
GRAM = 8

#: Words in a strip of neighbouring tiles, and in the strips of one Arrow batch; a larger one comes alone.
STRIP_WORDS = 2048
BATCH_WORDS = 500_000

_HASH = np.uint64(0x9E3779B97F4A7C15)

#: Rows of documents (``octave`` null) and of tiles, after the row number and the document's id.
_FIELDS = [
    ("n_words", pa.int64(), "long"),
    ("plain", pa.string(), "string"),
    ("words", pa.binary(), "binary"),
    ("octave", pa.int32(), "int"),
    ("cut", pa.int64(), "long"),
    ("last_cut", pa.int64(), "long"),
    ("tile", pa.binary(), "binary"),
]


def z_function(s: list) -> list[int]:
    """For each place of ``s``, how many items from there on equal those from the start on."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


@lru_cache(maxsize=100_000)
def _prime_factors(n: int) -> tuple[int, ...]:
    found, r = [], 2
    while r * r <= n:
        if n % r == 0:
            found.append(r)
            while n % r == 0:
                n //= r
        r += 1
    return tuple(found + [n] if n > 1 else found)


def octave_step(octave: int) -> int:
    """The distance of the cuts for the periods ``[2^octave, 2^(octave+1))``."""
    return 2 << octave


def solve_tile(tile: np.ndarray, first: int, cut: int, octave: int, n: int) -> list[tuple[int, int, int]]:
    """Fragments ``(period, start, end)`` of runs around ``cut``, by the tile's words alone.

    ``tile`` are the words from ``first`` on of a document of ``n``. What ends inside the tile on both sides is a
    whole stretch, and left out if it is no run.
    """
    words = tile.tolist()
    at, least, last = cut - first, 1 << octave, first + len(words)
    most = min(2 * least - 1, len(words) - at - 1)
    after = z_function(words[at:])
    # Common ends of what stands before the cut and before the cut's copy, one period later.
    before = words[:at][::-1]
    ends = z_function(before + [-1] + words[: at + most][::-1]) if before else []
    found = []
    for q in range(least, most + 1):
        forward = after[q]
        # What is repeats of a part of the period is a run of that part.
        if forward < min(least, GRAM) or any(after[q // r] >= q - q // r for r in _prime_factors(q)):
            continue
        back = ends[len(before) + 1 + most - q] if before else 0
        start, end = cut - back, cut + q + forward
        whole = (start > first or first == 0) and (end < last or last == n)
        if not whole or end - start >= max(LEAST_WORDS, LEAST_PERIODS * q):
            found.append((q, start, end))
    return found


def _agree(words: np.ndarray, at: int, p: int, most: int) -> int:
    """How many words from ``at`` on, ``most`` at most, equal those ``p`` later."""
    same = words[at : at + most] == words[at + p : at + p + most]
    return len(same) if same.all() else int(same.argmin())


def _may_be_run(words: np.ndarray, at: int, p: int, tile: tuple[int, int], open_at: tuple[bool, bool]) -> bool:
    """Whether the stretch of period ``p`` at a cut is long enough or goes on beyond its tile, at an end that is open."""
    end = at + p + _agree(words, at, p, tile[1] - at - p)
    before = words[tile[0] : at][::-1] == words[tile[0] + p : at + p][::-1]
    start = at - (len(before) if before.all() else int(before.argmin()))
    beyond = (open_at[0] and start == tile[0]) or (open_at[1] and end == tile[1])
    return beyond or end - start >= max(LEAST_WORDS, LEAST_PERIODS * p)


def cuts_to_solve(
    words: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per octave the documents and cuts, ``(octave, document, cut)``, that a run may have.

    ``words`` are the numbered words of several documents, which lie at ``starts`` to ``ends``. A run of period ``q`` with a
    cut has the cut's gram three times, ``q`` apart, and the ``q`` words from the cut on are not themselves repeats of
    fewer: a cut of one octave is one of all lower ones too, so such smaller periods were met at it before.
    """
    grams, size, octave = words.astype(np.uint64), 1, 0
    sizes = ends - starts
    met: dict[int, list[int]] = {}
    while True:
        least = 1 << octave
        docs = np.flatnonzero(sizes >= max(LEAST_WORDS, LEAST_PERIODS * least))
        if not len(docs):
            return
        while size < min(least, GRAM):
            grams = grams * _HASH + np.r_[grams[size:], np.zeros(size, np.uint64)] + np.uint64(1)
            grams ^= grams >> np.uint64(29)
            size *= 2
        step = octave_step(octave)
        counts = -(-sizes[docs] // step)
        doc = np.repeat(docs, counts)
        cut = (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)) * step
        at, room = starts[doc] + cut, sizes[doc] - cut - size
        cuts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        # Whichever is the shorter loop: over the octave's periods, or over the cuts.
        if least <= len(doc):
            for q in range(least, 2 * least):
                can = np.flatnonzero(room >= q)
                can = can[grams[at[can]] == grams[at[can] + q]]
                cuts.append(can)
                periods.append(np.full(len(can), q))
        else:
            for i in np.flatnonzero(room >= least).tolist():
                near = grams[at[i] + least : at[i] + min(2 * least - 1, room[i]) + 1]
                own = np.flatnonzero(near == grams[at[i]])
                cuts.append(np.full(len(own), i))
                periods.append(own + least)
        i, q = np.concatenate(cuts), np.concatenate(periods)
        here, end = at[i], len(grams) - 1
        later = (room[i] >= 2 * q) & (grams[np.minimum(here + 2 * q, end)] == grams[here])
        earlier = (cut[i] >= q) & (grams[np.maximum(here - q, 0)] == grams[here])
        thrice = later | earlier
        i, q = i[thrice], q[thrice]
        order = np.lexsort((q, i))
        i, q = i[order], q[order]
        hit = np.zeros(len(doc), bool)
        turns = np.r_[0, np.flatnonzero(np.diff(i)) + 1, len(i)]
        for a, b in zip(turns[:-1].tolist(), turns[1:].tolist()):
            if a < b:
                place, own = int(at[i[a]]), q[a:b]
                for p in met.get(place, ()):
                    most = min(2 * least, int(ends[doc[i[a]]]) - place - p)
                    own = own[(own % p != 0) | (_agree(words, place, p, most) < own - p)]
                if len(own):
                    met.setdefault(place, []).extend(own.tolist())
                    d = doc[i[a]]
                    tile = max(int(starts[d]), place - step), min(int(ends[d]), place + 3 * step)
                    open_at = tile[0] > starts[d], tile[1] < ends[d]
                    hit[i[a]] = any(_may_be_run(words, place, p, tile, open_at) for p in own.tolist())
        yield octave, doc[hit], cut[hit]
        octave += 1


def strips(octave: int, docs: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Neighbouring cuts of a document together, ``(document, first cut, last cut)``, so that their tiles lie in one strip of
    ``STRIP_WORDS`` words or little more."""
    step = octave_step(octave)
    most = max(0, STRIP_WORDS // step - 4)
    first = last = None
    for d, cut in zip(docs.tolist(), cuts.tolist()):
        if first is not None and d == doc and cut == last + step and cut - first <= most * step:
            last = cut
            continue
        if first is not None:
            yield doc, first, last
        doc, first, last = d, cut, cut
    if first is not None:
        yield doc, first, last


def solve_strip(
    words: np.ndarray, first: int, cuts: tuple[int, int], octave: int, n: int
) -> list[tuple[int, int, int]]:
    """The fragments of the tiles of all cuts from one to another, those that overlap by a period joined."""
    step = octave_step(octave)
    found: dict[int, list[list[int]]] = defaultdict(list)
    for cut in range(cuts[0], cuts[1] + 1, step):
        a, b = max(0, cut - step), min(n, cut + 3 * step)
        for q, start, end in solve_tile(words[a - first : b - first], a, cut, octave, n):
            of_period = found[q]
            if of_period and of_period[-1][1] - start >= q:
                of_period[-1][1] = max(end, of_period[-1][1])
                of_period[-1][0] = min(start, of_period[-1][0])
            else:
                of_period.append([start, end])
    return [(q, start, end) for q, pieces in found.items() for start, end in pieces]


def _document_and_tile_rows(source: DataFrame, change: Callable | None) -> DataFrame:
    """Per document a row with the number of its words and either their digest or, if a tile of it is to be solved,
    the words; and a row for each such tile. ``source`` has the columns ``__row, __id, __text``.

    A document without a tile has no run, so its words are not needed again.
    """

    def documents(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, ids = part.column(0).to_pylist(), part.column(1).to_pylist()
        texts = [(t or b"").split() for t in part.column(2).cast(pa.binary()).to_pylist()]
        if change is not None:
            texts = [change(i, words) for i, words in zip(ids, texts)]
        numbers: dict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        sizes = np.array([len(words) for words in texts], np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        every = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int32, int(sizes.sum()))
        out, size, sent = [], 0, set()
        for octave, docs, cuts in cuts_to_solve(every, starts, ends):
            step = octave_step(octave)
            for d, cut, last_cut in strips(octave, docs, cuts):
                first, last = max(0, cut - step), min(int(sizes[d]), last_cut + 3 * step)
                tile = every[starts[d] + first : starts[d] + last].tobytes()
                out.append((rows[d], None, len(texts[d]), None, None, octave, cut, last_cut, tile))
                sent.add(d)
                size += last - first
                if size >= BATCH_WORDS:
                    yield batch_of(out, part)
                    out, size = [], 0
        for d, words in enumerate(texts):
            joined = b" ".join(words)
            plain, again = (None, joined) if d in sent else (hashlib.sha256(joined).hexdigest(), None)
            out.append((rows[d], ids[d], len(words), plain, again, None, None, None, None))
        yield batch_of(out, part)

    def batch_of(out: list[tuple], part: pa.RecordBatch) -> pa.RecordBatch:
        types = [pa.int64(), part.schema.field(1).type] + [t for _, t, _ in _FIELDS]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    def run(batches):
        for batch in batches:
            for part in parts(batch, 2):
                yield from documents(part)

    names = ["__row", "__id"] + [name for name, _, _ in _FIELDS]
    id_type = source.schema["__id"].dataType.simpleString()
    schema = ", ".join([f"__row long, __id {id_type}"] + [f"{name} {kind}" for name, _, kind in _FIELDS])
    return source.mapInArrow(run, schema)


def _solve(batches):
    """The fragments of the runs in each tile, by itself."""
    names = ["__row", "period", "start", "end"]
    for batch in batches:
        found = []
        for row, n, octave, cut, last_cut, tile in zip(*(c.to_pylist() for c in batch.columns)):
            words, first = np.frombuffer(tile, np.int32), max(0, cut - octave_step(octave))
            found += [(row, *f) for f in solve_strip(words, first, (cut, last_cut), octave, n)]
        columns = zip(*found) if found else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def stitch(fragments: DataFrame) -> DataFrame:
    """Runs ``__row, start, length, period`` from their fragments ``__row, period, start, end``."""
    of_period = Window.partitionBy("__row", "period").orderBy("start", "end")
    so_far = F.max("end").over(of_period.rowsBetween(Window.unboundedPreceding, -1))
    # Fragments of one run overlap by a period or more, different runs of one period by less.
    new = F.coalesce(so_far - F.col("start") < F.col("period"), F.lit(True)).cast("int")
    number = F.sum("new").over(of_period.rowsBetween(Window.unboundedPreceding, 0))
    pieces = fragments.withColumn("new", new).withColumn("run", number)
    stretches = pieces.groupBy("__row", "period", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start")
    long = length >= F.greatest(F.lit(LEAST_WORDS), LEAST_PERIODS * F.col("period"))
    return stretches.where(long).groupBy("__row", "start", length.alias("length")).agg(F.min("period").alias("period"))


def _collapse(batches):
    """Rows ``__id, n_words, words, runs`` with the words left and their digest in place of the words."""
    names = ["__id", "n_words", "runs", "collapsed", "collapsed_sha256"]
    for batch in batches:
        for part in parts(batch, 2):
            texts, digests = [], []
            for text, runs in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                words = text.split()
                left = np.ones(len(words), bool)
                for run in runs:
                    left[run["start"] + run["period"] : run["start"] + run["length"]] = False
                kept = b" ".join(words[i] for i in np.flatnonzero(left).tolist())
                texts.append(kept if runs else None)
                digests.append(hashlib.sha256(kept).hexdigest())
            collapsed = pa.array(texts, pa.binary()).cast(pa.string())
            columns = [part.column(0), part.column(1), part.column(3), collapsed, pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)


def find(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", change: Callable | None = None
) -> DataFrame:
    """One row per row of ``documents``: ``id_col, n_words, runs, collapsed, collapsed_sha256``.

    ``runs`` are ``start, length, period`` in words, sorted so; ``collapsed`` is the text, its words joined by one space, without
    what follows a run's first period (null if there is no run), and ``collapsed_sha256`` the digest of the words left, with or without
    a run. ``change``, if given, is called in the tasks with a document's id and list of words (bytes) and returns the
    words to look at.

    Null, empty and blank texts have no word and no run; repeated rows are each answered; other columns
    may have any name. No text is too long: the strips of a long one are solved on many tasks.
    """
    source = documents.select(
        F.monotonically_increasing_id().alias("__row"),
        F.col(id_col).alias("__id"),
        F.col(text_col).cast("string").alias("__text"),
    )
    rows = stage(_document_and_tile_rows(source, change))
    tiles = rows.where(F.col("octave").isNotNull()).select("__row", "n_words", "octave", "cut", "last_cut", "tile")
    spread = tiles.repartition(F.col("__row"), F.col("octave"), F.col("cut"))
    fragments = spread.mapInArrow(_solve, "__row long, period long, start long, end long")
    run = F.struct("start", "length", "period")
    runs = stage(stitch(fragments).groupBy("__row").agg(F.array_sort(F.collect_list(run)).alias("runs")))
    no_runs = F.array().cast(runs.schema["runs"].dataType)
    whole = rows.where(F.col("octave").isNull())
    looked_at = whole.where(F.col("words").isNotNull()).select("__row", "__id", "n_words", "words")
    with_runs = looked_at.join(runs, "__row", "left").withColumn("runs", F.coalesce("runs", no_runs))
    id_type = source.schema["__id"].dataType.simpleString()
    columns = f"__id {id_type}, n_words long, runs {runs.schema['runs'].dataType.simpleString()}"
    collapsed = with_runs.drop("__row").mapInArrow(_collapse, f"{columns}, collapsed string, collapsed_sha256 string")
    without = whole.where(F.col("words").isNull()).select(
        "__id",
        "n_words",
        no_runs.alias("runs"),
        F.lit(None).cast("string").alias("collapsed"),
        F.col("plain").alias("collapsed_sha256"),
    )
    return collapsed.unionByName(without).withColumnRenamed("__id", id_col)
