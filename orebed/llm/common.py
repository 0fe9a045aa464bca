"""Shared by the text operators: Arrow passes over whole texts, word splitting,
shards and bounded samples for training, and broadcast models."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.session import stage, staging

#: Bytes of text that one call of a scoring function gets; a longer text comes alone.
CHUNK_BYTES = 4_000_000

_PLACES = pa.list_(pa.struct([("word", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))

#: Arrow types of the result columns, by their Spark names.
ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<binary>": pa.list_(pa.binary()),
    "array<string>": pa.list_(pa.string()),
    "array<struct<word:bigint,start:bigint,end:bigint>>": _PLACES,
}

_KEEP = set(b"abcdefghijklmnopqrstuvwxyz0123456789") | set(range(128, 256))
_SPACED = bytes(b if b in _KEEP else 32 for b in bytes(range(256)).lower())


def plain_words(text: bytes | None) -> list[bytes]:
    """The runs of ASCII letters, digits and non-ASCII characters, A-Z
    lower-cased. Bytes of non-ASCII characters are all above 127."""
    return text.translate(_SPACED).split() if text else []


def parts(batch: pa.RecordBatch, text_at: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text, one row at least."""
    lengths = pc.binary_length(batch.column(text_at).cast(pa.binary()))
    start = size = 0
    for i, n in enumerate(lengths.to_pylist()):
        if i > start and size + (n or 0) > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def per_text(
    df: DataFrame,
    keep: Sequence[str],
    text_col: str,
    columns: Sequence[str],
    make: Callable[[], Callable[[list[bytes | None]], Sequence]],
) -> DataFrame:
    """``keep`` columns of ``df`` and new ``columns`` ("name type") computed from each whole text.

    ``make`` is called once in each task; what it returns takes the UTF-8 texts of
    some rows and gives one list per new column. Only the kept columns and the
    text leave the JVM, so other columns may have any name.
    """
    names = [c.split()[0] for c in columns]
    types = [ARROW[c.split()[1]] for c in columns]
    source = df.select(*keep, F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]] + list(columns))

    def run(batches):
        score = make()
        for batch in batches:
            at = batch.num_columns - 1
            for part in parts(batch, at):
                found = score(part.column(at).cast(pa.binary()).to_pylist())
                arrays = [pa.array(v, type=t) for v, t in zip(found, types)]
                yield pa.RecordBatch.from_arrays([*part.columns[:at], *arrays], [*keep, *names])

    return source.mapInArrow(run, schema)


def change_rows(
    df: DataFrame,
    text_col: str,
    make: Callable[[], Callable[[list[bytes | None]], tuple[list[bool], list[bytes | None] | None]]],
    length_col: str | None = None,
) -> DataFrame:
    """The rows of ``df`` with all their columns, some left out or with another text.

    What ``make`` returns takes the UTF-8 texts of some rows and gives, for
    each, whether to keep the row, and the texts to put in place (None: all as they
    were). ``length_col``, if there, gets the code points of a text that changed.
    """
    schema, at = df.schema, df.columns.index(text_col)
    length_at = df.columns.index(length_col) if length_col in df.columns else None

    def run(batches):
        change = make()
        for batch in batches:
            for part in parts(batch, at):
                old = part.column(at).cast(pa.binary()).to_pylist()
                keep, new = change(old)
                arrays = list(part.columns)
                if new is not None:
                    arrays[at] = pa.array(new, type=pa.binary()).cast(arrays[at].type)
                    if length_at is not None:
                        lengths = arrays[length_at].to_pylist()
                        for i, (a, b) in enumerate(zip(old, new)):
                            if a != b:
                                lengths[i] = len(b.decode(errors="replace"))
                        arrays[length_at] = pa.array(lengths, type=arrays[length_at].type)
                out = pa.RecordBatch.from_arrays(arrays, schema=part.schema)
                yield out.filter(pa.array(keep, type=pa.bool_()))

    return df.mapInArrow(run, schema)


def remainder(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(of))


def sample_by_class(rows: DataFrame, class_col: str, id_col: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each class, chosen by a hash of the id, and at
    most twice as many rows in all as were asked for.

    Only the number of rows of each class passes through the driver.
    """
    counts = rows.groupBy(class_col).count().collect()
    hashed = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 30))
    chosen = F.lit(False)
    for value, n in counts:
        chosen = chosen | ((F.col(class_col) == value) & (hashed < int(min(1.0, per_class / n) * (1 << 30)) + 1))
    return rows.where(chosen).limit(2 * per_class * max(1, len(counts)))


def allowed_labels(labels: DataFrame, label: str, of: int, held_out: int) -> DataFrame:
    """Labels with an id whose crc32 modulo ``of`` is not ``held_out``: ``doc_id, __label``."""
    allowed = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    return allowed.where(remainder("doc_id", of) != held_out).select("doc_id", F.col(label).alias("__label"))


def label_counts(labels: DataFrame, label: str, of: int, held_out: int) -> dict[int, int]:
    """How many rows of a whole table of 0 and 1 labels have each, held-out rows left out."""
    allowed = allowed_labels(labels, label, of, held_out)
    return dict(allowed.groupBy(F.col("__label").cast("int")).count().collect())


@contextmanager
def labelled_shards(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    of: int,
    held_out: int,
    per_shard: int,
    max_bytes: int,
    lang: bool = False,
) -> Iterator[DataFrame]:
    """``__words, __label, __lang, __shard`` of all labelled documents, written until the end, the rows of a shard one after the other.
    ``__words`` are the plain words of a text with spaces between.

    Rows whose crc32(doc_id) modulo ``of`` is ``held_out`` are never read. Documents are dealt by id to as many
    shards as ``per_shard`` documents and ``max_bytes`` of text on average need, and ordered there by the id's hash, so that
    neither depends on the partitioning. Only ids and lengths, then the words, are shuffled, once each.
    """
    allowed = allowed_labels(labels, label, of, held_out).withColumn("__label", F.col("__label").cast("int")).distinct()
    language = F.col("lang") if lang and "lang" in documents.columns else F.lit(None).cast("string")
    there = F.col("doc_id").isNotNull() & F.col("text").isNotNull() & (remainder("doc_id", of) != held_out)
    texts = documents.where(there).select("doc_id", language.alias("__lang"), F.col("text"))
    sizes = texts.select("doc_id", F.length(F.col("text").cast("binary")).alias("__size")).join(allowed, "doc_id")
    n, size = sizes.agg(F.count(F.lit(1)), F.sum("__size")).first()
    shards = max(1, math.ceil(max(n / per_shard, (size or 0) / max_bytes)))
    words = per_text(texts, ["doc_id", "__lang"], "text", ["__words binary"], lambda: lambda t: [[b" ".join(plain_words(x)) for x in t]])
    # Stacked, texts and labels meet after one shuffle by shard, which a join need not keep to.
    stacked = words.withColumn("__label", F.lit(None).cast("int")).unionByName(allowed, allowMissingColumns=True)
    found = F.collect_set("__label").over(Window.partitionBy("doc_id"))
    rows = stacked.repartition(shards, "doc_id").withColumn("__found", found).where(F.col("__words").isNotNull())
    rows = rows.withColumn("__label", F.explode("__found"))
    rows = rows.sortWithinPartitions(F.xxhash64("doc_id"), "__words", "__label", F.col("__lang").asc_nulls_last())
    with staging(documents.sparkSession):
        yield stage(rows.select("__words", "__label", "__lang", F.spark_partition_id().alias("__shard")), compression="zstd")


def labelled_texts(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    of: int,
    held_out: int,
    per_class: int,
    max_bytes: int,
    lang: bool = False,
) -> list[tuple]:
    """``(text bytes, label, lang)`` of a bounded sample of labelled documents.

    Rows whose crc32(doc_id) modulo ``of`` is ``held_out`` are never read. About
    ``per_class`` documents of each label, and not more than ``max_bytes`` of text; the
    sample's ids are a table of a bounded size, so the texts are not shuffled.
    """
    allowed = allowed_labels(labels, label, of, held_out)
    chosen = sample_by_class(allowed.distinct(), "__label", "doc_id", per_class)
    language = F.col("lang") if lang and "lang" in documents.columns else F.lit(None).cast("string")
    texts = documents.select("doc_id", language.alias("__lang"), F.col("text").cast("binary").alias("__text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").where(F.col("__text").isNotNull())
    rows = rows.limit(4 * per_class).select("doc_id", "__text", "__label", "__lang")
    return bounded(rows, max_bytes)


def bounded(rows: DataFrame, max_bytes: int) -> list[tuple]:
    """Collect rows ``id, text, ...`` up to ``max_bytes`` of text, in order of the id's
    hash so that the sample does not depend on the partitioning; drops the id.

    ``rows`` are of a bounded number. Ids and lengths alone decide which are taken, before any text is fetched; a text longer
    than ``max_bytes`` is taken only if it is the first.
    """
    key, text = rows.columns[:2]
    hashed = F.xxhash64(key).alias("__hash")
    size = F.sum(F.length(text)).alias("__size")
    chosen, total = [], 0
    for place, n in rows.groupBy(hashed).agg(size).orderBy("__hash").collect():
        total += n
        if chosen and total > max_bytes:
            break
        chosen.append((place,))
    few = F.broadcast(rows.sparkSession.createDataFrame(chosen, "__hash long"))
    taken = rows.withColumn("__hash", F.xxhash64(key)).join(few, "__hash", "left_semi").select(*rows.columns, "__hash")
    found = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in row) for row in taken.collect()]
    return [row[1:-1] for row in sorted(found, key=lambda row: (row[-1], repr(row[1:-1])))]
