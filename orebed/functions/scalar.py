"""Scalar and array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The timestamp format of the review files.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

_BLANKS = " \t\r\n\f\x0b"


def parse_timestamp(text: Column, strict: bool = True) -> Column:
    """Text to timestamp; bad text raises, or gives NULL when not strict."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return parse(text, F.lit(TIMESTAMP_FORMAT) if not strict else TIMESTAMP_FORMAT)


def strip(text: Column) -> Column:
    """Drop blanks, tabs and line ends on both sides."""
    return F.btrim(text, F.lit(_BLANKS))


def split_fields(line: Column, drop_quotes: bool) -> Column:
    """The comma-separated fields of a line; quotes do not protect commas."""
    line = strip(line)
    if drop_quotes:
        line = F.replace(line, F.lit('"'), F.lit(""))
    return F.split(line, ",", -1)


def basket_key(date: Column, customer: Column) -> Column:
    """First five and last two characters of the date text, dash, customer."""
    date = date.cast("string")
    return F.concat(F.substring(date, 1, 5), F.right(date, F.lit(2)), F.lit("-"), customer)


def words(text: Column) -> Column:
    """Lower-case words of a text, in order."""
    return F.split(F.lower(text), "\\s+")


def jaccard(shared: Column, size_a: Column, size_b: Column) -> Column:
    """Jaccard similarity from the overlap and the two set sizes."""
    return shared / F.nullif(size_a + size_b - shared, F.lit(0))


def array_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two array columns; NULL for two empty ones."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0))


def is_subset(part: Column, whole: Column) -> Column:
    """Whether every element of one array column occurs in another."""
    return F.size(F.array_except(part, whole)) == 0


def row_text(*columns: Column) -> Column:
    """Comma-joined text form of a row; NULL stays visible as empty text."""
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
