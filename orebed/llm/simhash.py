"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints at 3 or fewer differing bits have a value in the middle: at most
two flips from one and one flip from the other. Every fingerprint emits such values
(variants), the variants are shuffled, and fingerprints that meet at one are linked.

Which variants are needed follows from the parity of the number of set bits. Fingerprints
at distance 1 or 3 differ in parity, at 2 they agree:

* distance 0: one row after grouping equal fingerprints;
* distance 1: the odd one's flip is the even one itself;
* distance 2: they meet at one flip of each;
* distance 3: two of the three bits lie in the same half of the word, so the even one's
  two flips within a half meet a single flip of the odd one.

So an odd fingerprint has 1 + 64 variants, an even one 1 + 64 + 2 * C(32, 2). All members of a
meeting point are linked through one of at most one flip, which is within 3 bits of each; members
of two flips alone (up to 4 bits apart) are not linked there. Each such link is
checked by counting bits. Links are thus a spanning set, linear in the variants, never all pairs
of a dense group; components are the same.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import per_text
from orebed.llm.components import components
from orebed.session import stage

SHINGLE = 3
BITS = 3
SEED = 42

#: Variants in one bucket of the shuffle, about.
BUCKET = 2_000_000

#: Shingles whose bits are counted at once.
_BLOCK = 100_000

_EVEN = np.array(
    [0]
    + [1 << i for i in range(64)]
    + [(1 << i) | (1 << j) for half in (0, 32) for i in range(half, half + 32) for j in range(half, i)],
    dtype=np.uint64,
)
_FLIPS = {0: _EVEN, 1: _EVEN[:65]}


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The unsigned SimHash of a text: words are runs of non-white-space with A-Z
    lower-cased; no word gives 0, fewer words than a shingle one shingle of them all."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    starts = np.cumsum([0, *map(len, words)]) + np.arange(len(words) + 1)
    ends = (starts[shingle:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends)], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), _BLOCK):
        block = hashes[i : i + _BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id_col, fp`` for every row: the fingerprint's 64 bits as a signed long."""
    return _prints(documents, [id_col], text_col, shingle)


def _prints(documents: DataFrame, keep: list[str], text_col: str, shingle: int) -> DataFrame:
    def make():
        return lambda texts: [[_signed(fingerprint(t, shingle)) for t in texts]]

    return per_text(documents, keep, text_col, ["fp long"], make)


def _hash_rows(bits: int) -> np.ndarray:
    """For each of the 64 bits, its share in a linear hash of ``bits`` bits: the hash of a
    value is the XOR of the shares of its set bits.

    Several bits of a half have the same share, so that the variants of a fingerprint fall into tens of
    buckets, not hundreds, and it is sent to as many. All bits count, so near copies spread.
    """
    if not bits:
        return np.zeros(64, dtype=np.int64)
    shares = max(8, bits // 2 + 1)
    drawn = np.random.default_rng(7).integers(1, 1 << bits, size=(2, shares), dtype=np.int64)
    return drawn[:, np.arange(32) % shares].ravel()


def _linear_hash(values: np.ndarray, shares: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), dtype=np.int64)
    for i, share in enumerate(shares.tolist()):
        out ^= np.where((values >> np.uint64(i)) & np.uint64(1), share, 0)
    return out


def _by_hash(bits: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For even and odd fingerprints: their flips ordered by hash, and where each hash starts."""
    shares, out = _hash_rows(bits), {}
    for parity, flips in _FLIPS.items():
        hashes = _linear_hash(flips, shares)
        order = np.argsort(hashes, kind="stable")
        starts = np.searchsorted(hashes[order], np.arange((1 << bits) + 1))
        out[parity] = flips[order], starts
    return out


def _to_buckets(bits: int):
    """For a batch of fingerprints: a row for each bucket that some of their variants fall in,
    with those fingerprints. The receiver makes the variants again, so that one
    number is shuffled for all variants of a fingerprint in the bucket."""
    shares = _hash_rows(bits)

    def run(batches):
        tables = _by_hash(bits)
        hit = {p: np.flatnonzero(np.diff(starts)) for p, (_, starts) in tables.items()}
        for frame in batches:
            values = frame["fp"].to_numpy(np.int64).view(np.uint64)
            own, odd = _linear_hash(values, shares), np.bitwise_count(values) & 1
            pairs = []
            for parity in (0, 1):
                at = np.flatnonzero(odd == parity)
                buckets = (own[at][:, None] ^ hit[parity][None, :]).ravel()
                pairs.append((buckets, np.repeat(at, len(hit[parity]))))
            buckets, rows = (np.concatenate(x) for x in zip(*pairs))
            order = np.argsort(buckets, kind="stable")
            buckets, rows = buckets[order], rows[order]
            cuts = np.flatnonzero(np.diff(buckets)) + 1
            blobs = [values[x].tobytes() for x in np.split(rows, cuts)] if len(rows) else []
            yield pd.DataFrame({"bucket": buckets[np.r_[0, cuts]] if len(rows) else [], "fps": blobs})

    return run


def _expand(values: np.ndarray, bucket: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The variants of ``values`` that fall in the bucket, their origins and numbers of flips."""
    shares, tables = _hash_rows(bits), _by_hash(bits)
    own, odd = _linear_hash(values, shares), np.bitwise_count(values) & 1
    variants, origins = [], []
    for parity, (flips, starts) in tables.items():
        mine = values[odd == parity]
        want = own[odd == parity] ^ bucket
        first, n = starts[want], starts[want + 1] - starts[want]
        at = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        origin = np.repeat(mine, n)
        variants.append(origin ^ flips[at])
        origins.append(origin)
    variants, origins = np.concatenate(variants), np.concatenate(origins)
    return variants, origins, np.bitwise_count(variants ^ origins)


def links_in_bucket(values: np.ndarray, bucket: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints that meet at a variant in the bucket, as links to one of at most one flip."""
    variants, origins, flips = _expand(values, bucket, bits)
    # Fewest flips first within a variant: the order of a stable sort of presorted rows.
    order = np.argsort(flips, kind="stable")
    order = order[np.argsort(variants[order], kind="stable")]
    variants, origins, flips = variants[order], origins[order], flips[order]
    first = np.r_[True, variants[1:] != variants[:-1]] if len(variants) else np.zeros(0, bool)
    group = np.cumsum(first) - 1
    centre = np.flatnonzero(first)[group] if len(variants) else group
    linked = ~first & (flips[centre] <= 1)
    a, b = origins[linked], origins[centre[linked]]
    near = np.bitwise_count(a ^ b) <= BITS
    pairs = np.unique(np.stack([a[near], b[near]]), axis=1)
    return pairs[0], pairs[1]


def near_links(distinct: DataFrame) -> DataFrame:
    """Links ``a, b`` between fingerprints (column ``fp``, each once) that join all
    pairs at 3 or fewer differing bits."""
    n = distinct.count()
    average = (len(_FLIPS[0]) + len(_FLIPS[1])) / 2
    bits = max(0, math.ceil(math.log2(max(1.0, n * average / BUCKET))))

    def meet(table: pa.Table) -> pa.Table:
        values = np.frombuffer(b"".join(table.column("fps").to_pylist()), dtype=np.uint64)
        a, b = links_in_bucket(values, table.column("bucket")[0].as_py(), bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    sent = distinct.select("fp").mapInPandas(_to_buckets(bits), "bucket long, fps binary")
    return sent.groupBy("bucket").applyInArrow(meet, "a long, b long")


def groups(prints: DataFrame) -> DataFrame:
    """``fp, root`` for the fingerprints (column ``fp``, repeats allowed) that are linked with
    another one."""
    distinct = stage(prints.select("fp").distinct())
    return components(near_links(distinct))


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``documents``: ``id_col, fp, fingerprint, component_id``.

    ``component_id`` is the smallest id reachable over fingerprints that differ in 3 or
    fewer bits. Texts that are null, empty or without a word have fingerprint zero, which
    links like any other. Repeated rows and ids each get their row; a null id is never the
    smallest, and a group of null ids only has a null component. An empty table gives none.

    Equal fingerprints are one row before variants are made, so copies cost one count
    each; the smallest id of a group combines before its shuffle.
    """
    prints = stage(fingerprints(documents, id_col, text_col, shingle))
    least = prints.groupBy("fp").agg(F.min(id_col).alias("__least"))
    rooted = least.join(groups(prints).withColumnRenamed("node", "fp"), "fp", "left")
    rooted = stage(rooted.withColumn("root", F.coalesce("root", "fp")))
    smallest = rooted.groupBy("root").agg(F.min("__least").alias("component_id"))
    by_print = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        id_col, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``documents``, all their columns, that stay: of each group of near
    duplicates the row with the smallest id (of repeated ids one row, a null id last).

    The rows are written once with a number of their own, so that repeated ids stay apart; only
    numbers and fingerprints are grouped, and the texts are joined to the kept numbers.
    """
    row = "__row"
    while row in map(str.lower, documents.columns):
        row += "_"
    staged = stage(documents.select("*", F.monotonically_increasing_id().alias(row)))
    prints = stage(_prints(staged, [row, id_col], text_col, shingle))
    order = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col(row).alias("r"))
    least = prints.groupBy("fp").agg(F.min(order).alias("first"))
    rooted = least.join(groups(prints).withColumnRenamed("node", "fp"), "fp", "left")
    kept = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.r").alias(row))
    # Always by a shuffle: the kept numbers grow with the documents.
    return staged.join(kept.hint("merge"), row, "left_semi").drop(row)
