"""Benchmark decontamination with one Aho-Corasick automaton over word windows.

The patterns are word numbers of all test questions and answers: anchors of five words, one in six words, of which each
window of ten holds one whole. A text is scanned once, what is met is compared with the item to both sides, and hits are
mapped back to offsets in the original text. Only the benchmark's words have numbers, and no pattern holds any other word,
so only the runs of numbered words reach the automaton.
"""

from __future__ import annotations

import re
import uuid
from array import array
from functools import reduce
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import change_rows, per_text, plain_words
from orebed.session import stage

WINDOW = 10

#: Bytes of item text in one automaton. A larger benchmark is cut into several, and texts are
#: scanned with each in turn.
SHARD_BYTES = 8_000_000

#: Places of the items at which an anchor may be and still be compared there.
HOT = 8

#: Windows of an item that are kept together when a large benchmark is cut.
PIECE_WINDOWS = 10_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


#: The automaton that this Python worker used last, kept from task to task.
_BUILT: dict[str, Automaton] = {}


def _letters(numbers: np.ndarray) -> tuple[int, ...]:
    """Word numbers as two letters each, of different alphabets: a node's branches are looked through one by one."""
    pairs = np.stack([(numbers >> 8) + 256, numbers & 255], axis=1)
    return tuple(pairs.ravel().tolist())


class Automaton:
    """Finds the windows of items ``(id, text bytes)`` in texts.

    The patterns are anchors: of each item the words at every ``stride``-th position, ``size`` of them, so placed that each
    window holds one whole. Where an anchor is met, text and item are compared to both sides of it, and what agrees is hit
    if it is a window or more. Anchors at more than ``HOT`` places of the items would mean as many comparisons at each
    meeting; there the windows are patterns themselves, as are whole items of less than a window.
    """

    def __init__(self, items, window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        self.window = window
        self.size = size = (window + 1) // 2
        self.stride = stride = window - size + 1
        self.owners: list[set] = []
        self.words, self.owner_at = array("i", [0]), array("i", [0])
        # Items of the same words are one, with all their ids.
        known: dict[bytes, set] = {}
        for item, text in items:
            words = plain_words(text)
            if words:
                known.setdefault(b" ".join(words), set()).add(item)
        anchors: dict[tuple, list[int]] = {}
        whole: dict[tuple, set[int]] = {}
        for owner, (text, ids) in enumerate(known.items()):
            self.owners.append(ids)
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in text.split()]
            if len(words) < window:
                whole.setdefault(tuple(words), set()).add(owner)
                continue
            start = len(self.words)
            self.words.extend([*words, 0])
            self.owner_at.extend([owner] * (len(words) + 1))
            for at in range(0, len(words) - size + 1, stride):
                anchors.setdefault(tuple(words[at : at + size]), []).append(start + at)
        self.shortest = min([window, *map(len, whole)])
        for key in [k for k, found in anchors.items() if len(found) > HOT]:
            for at in anchors.pop(key):
                self._windows(at, whole)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        # A short item or, with a small window, a window may be an anchor too.
        for key in anchors.keys() | whole.keys():
            values = len(key), tuple(anchors.get(key, ())), tuple(whole.get(key, ()))
            self.automaton.add_word(_letters(np.array(key)), values)
        self.empty = not anchors and not whole
        if not self.empty:
            self.automaton.make_automaton()

    def _windows(self, at: int, whole: dict[tuple, set[int]]) -> None:
        """Make patterns of the windows whose first anchor is at ``at``."""
        for start in range(max(at - self.stride + 1, 1), at + 1):
            key = tuple(self.words[start : start + self.window])
            if len(key) == self.window and 0 not in key:
                whole.setdefault(key, set()).add(self.owner_at[at])

    def _around(self, numbers: list[int], at: int, place: int) -> tuple[int, int]:
        """The stretch of the text that agrees with the item, given that the anchors at ``at`` and ``place`` do."""
        words, low, high = self.words, at, at + self.size
        here = place - 1
        while low and words[here] == numbers[low - 1]:
            low, here = low - 1, here - 1
        here = place + self.size
        while high < len(numbers) and words[here] == numbers[high]:
            high, here = high + 1, here + 1
        return low, high

    def scan(self, text: bytes | None) -> tuple[int, np.ndarray, set]:
        """The number of words, the hit words' positions, and the items found."""
        words = plain_words(text)
        if self.empty or len(words) < self.shortest:
            return len(words), np.zeros(0, np.int64), set()
        numbers = np.fromiter(map(self.numbers.get, words, repeat(0)), np.int64, len(words))
        known = np.r_[0, (numbers > 0).astype(np.int8), 0]
        turns = np.flatnonzero(np.diff(known))
        starts, ends = turns[::2], turns[1::2]
        change, owners = np.zeros(len(words) + 1, np.int64), set()
        for a, b in zip(starts.tolist(), ends.tolist()):
            if b - a < self.shortest:
                continue
            run = numbers[a:b].tolist()
            # What was compared on a diagonal, by place in the items less place in the run: its end.
            compared: dict[int, int] = {}
            for last, (size, places, found) in self.automaton.iter(_letters(numbers[a:b])):
                end = last // 2
                at = end - size + 1
                if found:
                    change[a + at] += 1
                    change[a + end + 1] -= 1
                    owners.update(found)
                for place in places:
                    if compared.get(place - at, 0) > end:
                        continue
                    low, high = self._around(run, at, place)
                    compared[place - at] = high
                    if high - low >= self.window:
                        change[a + low] += 1
                        change[a + high] -= 1
                        owners.add(self.owner_at[place])
        hits = np.flatnonzero(np.cumsum(change[:-1])) if owners else np.zeros(0, np.int64)
        return len(words), hits, set().union(*(self.owners[i] for i in owners))


def places(text: bytes, hits: np.ndarray) -> list[dict]:
    """Position, start and end of each hit word, in code points of the original text."""
    at = [m.span() for m in _WORD.finditer(text.decode(errors="replace"))]
    return [{"word": i, "start": at[i][0], "end": at[i][1]} for i in hits.tolist()]


def _cut(window: int, windows: int):
    """A function that cuts long items, ``item, text``, so that each window is whole in one piece."""

    def run(batches):
        for batch in batches:
            items, texts = [], []
            for item, text in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                words = plain_words(text)
                last = len(words) - window + 1  # windows in all
                if last <= windows:
                    items.append(item)
                    texts.append(text)
                    continue
                for start in range(0, last, windows):
                    items.append(item)
                    texts.append(b" ".join(words[start : min(start + windows, last) + window - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(texts, pa.binary())], ["item", "text"])

    return run


def _shards(
    benchmark: DataFrame, item_col: str, text_col: str, shard_bytes: int, window: int = WINDOW, windows: int = PIECE_WINDOWS
) -> list[DataFrame]:
    """The benchmark in tables of about ``shard_bytes`` of text each; items of more ``windows`` are cut."""
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text")
    ).where(F.col("text").isNotNull())
    # Copies hash alike, so they would all be in one shard.
    items = items.distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // shard_bytes) or 1
    if n == 1:
        return [items]
    items = items.mapInArrow(_cut(window, windows), "item string, text binary").distinct()
    items = stage(items.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(n))))
    return [items.where(F.col("shard") == i).select("item", "text") for i in range(n)]


def _automaton(shard: DataFrame, window: int):
    """A function that gives the automaton in a task; the items are broadcast, their size is bounded."""
    items = shard.sparkSession.sparkContext.broadcast([(i, bytes(t)) for i, t in shard.collect()])
    name = uuid.uuid4().hex

    def get() -> Automaton:
        if name not in _BUILT:
            _BUILT.clear()
            _BUILT[name] = Automaton(items.value, window)
        return _BUILT[name]

    return get


def find(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per row of ``documents``: ``id_col, n_words, items, hits``.

    ``items`` are the ids, as text and sorted, of the items of which a window occurs; ``hits``
    the words inside an occurrence, with their ``start, end`` in code points of the original text.
    Null or empty texts have no word and no hit; items without a word are not looked for; the words of
    items with a null id are hit, but add no item; repeated rows and items are each handled. A benchmark too large for one
    automaton is searched for in parts, whose hits are united by row; only hits are shuffled then.
    """
    shards = _shards(benchmark, item_col, item_text, shard_bytes, window)
    if len(shards) == 1:
        return _scan(documents, [id_col], text_col, shards[0], window)
    rows = stage(documents.select(id_col, text_col, F.monotonically_increasing_id().alias("__row")))
    found = _scan(rows, [id_col, "__row"], text_col, shards[0], window)
    for shard in shards[1:]:
        found = found.union(_scan(rows, [id_col, "__row"], text_col, shard, window))
    unite = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    united = found.groupBy("__row", id_col).agg(F.max("n_words").alias("n_words"), unite("items"), unite("hits"))
    return united.drop("__row")


def _scan(df: DataFrame, keep: list[str], text_col: str, shard: DataFrame, window: int) -> DataFrame:
    get = _automaton(shard, window)

    def make():
        automaton = get()

        def score(texts):
            found = [automaton.scan(t) for t in texts]
            hits = [places(t, h) if len(h) else [] for t, (_, h, _) in zip(texts, found)]
            return [n for n, _, _ in found], [sorted(x - {None}) for _, _, x in found], hits

        return score

    columns = ["n_words long", "items array<string>", "hits array<struct<word:bigint,start:bigint,end:bigint>>"]
    return per_text(df, keep, text_col, columns, make)


def drop_contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The rows of ``documents``, all their columns, in which no window of the benchmark occurs.

    Of a benchmark too large for one automaton each part is searched for on its own, in tasks with one automaton each; the
    numbers of rows with a hit are united and taken out.
    """
    shards = _shards(benchmark, "item_id", "text", shard_bytes, window)
    if len(shards) == 1:
        get = _automaton(shards[0], window)

        def make():
            automaton = get()
            return lambda texts: ([not automaton.scan(t)[2] for t in texts], None)

        return change_rows(documents, text_col, make)
    row = f"__row_{uuid.uuid4().hex}"
    rows = stage(documents.withColumn(row, F.monotonically_increasing_id()))
    hit = reduce(DataFrame.unionByName, [_hit(rows, row, text_col, shard, window) for shard in shards])
    return rows.join(hit.distinct(), row, "left_anti").drop(row)


def _hit(rows: DataFrame, row: str, text_col: str, shard: DataFrame, window: int) -> DataFrame:
    """The numbers of rows in which a window of the shard occurs."""
    get = _automaton(shard, window)

    def make():
        automaton = get()
        return lambda texts: [[bool(automaton.scan(t)[2]) for t in texts]]

    return per_text(rows, [row], text_col, ["hit boolean"], make).where("hit").select(row)
