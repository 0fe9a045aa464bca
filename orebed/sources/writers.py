"""Sinks. All write a folder of part files from the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "error") -> None:
    """Header and comma-separated rows; a value holding a comma is quoted."""
    df.write.mode(mode).option("header", header).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON object per row; a one-row table makes one document."""
    df.write.mode(mode).json(path)


def itemset_text(itemset) -> F.Column:
    """``('a')`` for a single item, ``('a', 'b')`` for more."""
    quoted = F.transform(
        itemset, lambda x: F.concat(F.lit("'"), x.cast("string"), F.lit("'"))
    )
    return F.concat(F.lit("("), F.array_join(quoted, ", "), F.lit(")"))


def itemset_report(*sections: tuple[str, DataFrame]) -> DataFrame:
    """The lines of a report on itemsets: ``section, size, kind, itemset, line``.

    Each section is a title and a table with an ``itemset`` column. ``kind``
    is 0 for the title, 1 for an itemset, 2 for the blank line closing a size.
    """
    report = None
    for number, (title, sets) in enumerate(sections):
        sized = sets.select(
            F.lit(number).alias("section"),
            F.size("itemset").alias("size"),
            F.lit(1).alias("kind"),
            "itemset",
            itemset_text(F.col("itemset")).alias("line"),
        )
        nothing = F.lit(None).cast(sets.schema["itemset"].dataType).alias("itemset")
        head = sets.sparkSession.range(1).select(
            F.lit(number).alias("section"),
            F.lit(0).alias("size"),
            F.lit(0).alias("kind"),
            nothing,
            F.lit(title).alias("line"),
        )
        gaps = (
            sized.groupBy("section", "size")
            .agg(F.lit(2).alias("kind"))
            .select("section", "size", "kind", nothing, F.lit("").alias("line"))
        )
        part = head.unionByName(sized).unionByName(gaps)
        report = part if report is None else report.unionByName(part)
    return report


def write_itemset_report(report: DataFrame, path: str, mode: str = "error") -> None:
    """Lines in the order section, size, itemset; one itemset a line."""
    ordered = report.orderBy("section", "size", "kind", "itemset")
    ordered.select("line").write.mode(mode).text(path)
