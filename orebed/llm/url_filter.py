"""URL filters by a Bloom filter cascade.

A rule is a host and the start of a path. A URL's keys are its host and parent domains
with the starts of its path; the longest key that is listed is its rule. Whether a key is listed is
asked of a cascade of Bloom filters: the first level holds the listed keys, the second the unlisted
keys of the corpus that pass the first, the third the listed keys that pass the second, and so on until
a level lets nothing wrong pass. Over the corpus's complete key universe the answer is
exact, and pages meet no join. The false positives of a level are found where the keys are; what
the driver holds is the listed keys and the filters.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import per_text
from orebed.session import stage

#: Most bytes of filters that are broadcast; beyond, keys are looked up by a join.
FILTER_BYTES = 64_000_000

_LEVELS = 64


class Rule(NamedTuple):
    """``verdict`` for urls on ``host`` or a subdomain whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


def split_url(url: bytes | None) -> tuple[bytes, bytes]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    at = (url or b"").find(b"://")
    if at < 0:
        return b"", b""
    rest = re.split(rb"[?#]", url[at + 3 :], maxsplit=1)[0]
    host, slash, path = rest.partition(b"/")
    return host.lower(), slash + path  # of bytes: A-Z alone


class Lengths(NamedTuple):
    """The lengths in bytes that hosts and paths of rules have; no other key can be listed."""

    hosts: Sequence[int]
    paths: Sequence[int]


def lengths_of(rules: Sequence[Rule]) -> Lengths:
    return Lengths(sorted({len(r.host.encode()) for r in rules}), sorted({len(r.path.encode()) for r in rules}))


def keys(host: bytes, path: bytes, lengths: Lengths) -> list[tuple[bytes, bytes]]:
    """The host and its parent domains with the starts of the path, of the rules' lengths, longest
    first, of equal length the longest host."""
    starts = [path[:n] for n in lengths.paths if n <= len(path)]
    hosts = [host[len(host) - n :] for n in lengths.hosts if n == len(host) or n < len(host) and host[-n - 1] == 46]
    return sorted(((h, p) for h in hosts for p in starts), key=lambda k: (-len(k[0]) - len(k[1]), -len(k[0])))


class Bloom:
    """A Bloom filter of a level: bits as bytes, positions from a hash seeded by the level."""

    def __init__(self, level: int, n: int, rate: float):
        self.level = level
        self.k = max(1, round(math.log2(1 / rate)))
        self.m = max(64, int(1.4427 * n * math.log2(1 / rate)) + 1)
        self.bits = np.zeros(-(-self.m // 8), dtype=np.uint8)

    def _places(self, key: bytes) -> list[int]:
        h = xxhash.xxh3_128_intdigest(key, self.level)
        a, b = h & (2**64 - 1), (h >> 64) | 1
        return [(a + i * b) % self.m for i in range(self.k)]

    def add(self, key: bytes) -> None:
        for p in self._places(key):
            self.bits[p >> 3] |= 1 << (p & 7)

    def has(self, key: bytes) -> bool:
        return all(self.bits[p >> 3] >> (p & 7) & 1 for p in self._places(key))


def passes(levels: Sequence[Bloom], key: bytes) -> bool:
    """Whether the cascade takes the key for a listed one: the first level that refuses it decides."""
    for i, level in enumerate(levels):
        if not level.has(key):
            return i % 2 == 1
    return len(levels) % 2 == 1


def cascade(listed: Sequence[bytes], universe: DataFrame, most_bytes: int = FILTER_BYTES) -> list[Bloom] | None:
    """Filters that are exact for every key of ``universe`` (a binary column ``key``) and the
    listed keys; None if they would need more than ``most_bytes``.

    The first level's rate is set so that false positives over the universe are about as many as
    listed keys; the later levels halve what is left. The false positives are counted before they
    are fetched, so the driver never gets more keys than are in proportion to the listed ones.
    """
    listed = sorted(set(listed))
    if not listed:
        return []
    first = Bloom(0, len(listed), min(0.5, len(listed) / max(1, universe.count())))
    if len(first.bits) > most_bytes:
        return None
    for key in listed:
        first.add(key)
    found = stage(_unlisted_passing(universe, first, listed))
    if found.count() > 1_000 + 64 * len(listed):
        return None
    levels = [first, *_cascade_of([bytes(r[0]) for r in found.collect()], listed, 1)]
    return levels if sum(len(x.bits) for x in levels) <= most_bytes else None


def _unlisted_passing(universe: DataFrame, level: Bloom, listed: Sequence[bytes]) -> DataFrame:
    """Keys of the universe that pass the first level without being listed."""
    shared = universe.sparkSession.sparkContext.broadcast((level, frozenset(listed)))

    def run(batches):
        bloom, known = shared.value
        for batch in batches:
            found = [k for k in batch.column(0).to_pylist() if bloom.has(k) and k not in known]
            yield pa.RecordBatch.from_arrays([pa.array(found, type=pa.binary())], ["key"])

    return universe.mapInArrow(run, "key binary")


def key_universe(pages: DataFrame, url_col: str, lengths: Lengths) -> DataFrame:
    """Every key of every url that has a rule's lengths, once: a binary column ``key``. Repeated keys of a batch go before the shuffle."""

    def run(batches):
        for batch in batches:
            found = set()
            for url in batch.column(0).cast(pa.binary()).to_pylist():
                found.update(h + b"\0" + p for h, p in keys(*split_url(url), lengths))
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), type=pa.binary())], ["key"])

    return pages.select(F.col(url_col).cast("string")).mapInArrow(run, "key binary").distinct()


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    most_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """One row per row of ``pages``: ``id_col, host, path, rule, verdict``.

    ``rule`` is the longest listed key that fits (of equal length, the longest host), null if
    none does, and then ``verdict`` is ``default``. A null url or one without ``://`` has an empty host
    and path and no rule. Repeated rows and urls each get their row; an empty table gives none.

    Of rules with one host and path the last counts. Rules whose filters would pass ``most_bytes`` are joined
    to the keys instead, with the same result.
    """
    rules = list({(r.host, r.path): r for r in rules}.values())
    known = {r.host.encode() + b"\0" + r.path.encode(): r.verdict for r in rules}
    lengths = lengths_of(rules)
    universe = stage(key_universe(pages, url_col, lengths))
    listed = cascade(list(known), universe, most_bytes)
    if listed is None:
        return _joined(pages, rules, lengths, id_col, url_col, default)
    # Among listed keys the universe is the list itself, so the second cascade needs no search.
    block = [k for k, v in known.items() if v == "block"]
    blocked = _cascade_of(block, [k for k, v in known.items() if v != "block"], _LEVELS + 1)
    shared = pages.sparkSession.sparkContext.broadcast((listed, blocked))

    def make():
        levels, blocking = shared.value

        def score(urls):
            rows = []
            for url in urls:
                host, path = split_url(url)
                rule = next((k for k in keys(host, path, lengths) if passes(levels, k[0] + b"\0" + k[1])), None)
                verdict = default if rule is None else "block" if passes(blocking, rule[0] + b"\0" + rule[1]) else "allow"
                text = lambda b: b.decode(errors="replace")
                rows.append((text(host), text(path), None if rule is None else text(rule[0] + rule[1]), verdict))
            return list(zip(*rows))

        return score

    return per_text(pages, [id_col], url_col, ["host string", "path string", "rule string", "verdict string"], make)


def _cascade_of(inside: list[bytes], outside: list[bytes], number: int) -> list[Bloom]:
    """Levels, numbered from ``number``, that tell two lists of keys apart: each holds what the level
    before passed wrongly."""
    levels: list[Bloom] = []
    while inside:
        if len(levels) == _LEVELS:
            raise RuntimeError("keys that no level tells apart")
        level = Bloom(number + len(levels), len(inside), 0.5)
        for key in inside:
            level.add(key)
        levels.append(level)
        inside, outside = [k for k in outside if level.has(k)], inside
    return levels


def _joined(pages: DataFrame, rules, lengths, id_col: str, url_col: str, default: str) -> DataFrame:
    """The same verdicts from a join of the keys with the table of rules."""
    rows = stage(pages.select(id_col, url_col, F.monotonically_increasing_id().alias("__row")))
    table = rows.sparkSession.createDataFrame(
        [(r.host.encode() + b"\0" + r.path.encode(), r.key, r.verdict) for r in rules], "key binary, rule string, verdict string"
    )

    def make():
        def score(urls):
            found = [split_url(u) for u in urls]
            text = lambda b: b.decode(errors="replace")
            every = [[(h + b"\0" + p) for h, p in keys(*f, lengths)] for f in found]
            return [text(h) for h, _ in found], [text(p) for _, p in found], every

        return score

    split = per_text(rows, [id_col, "__row"], url_col, ["host string", "path string", "keys array<binary>"], make)
    each = split.select("__row", F.posexplode("keys").alias("at", "key"))
    best = each.join(table, "key").groupBy("__row").agg(F.min(F.struct("at", "rule", "verdict")).alias("best"))
    out = split.join(best, "__row", "left")
    verdict = F.coalesce("best.verdict", F.lit(default))
    return out.select(id_col, "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))
