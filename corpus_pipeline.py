"""A training-data pipeline: toxic documents go, of each group of near duplicates one document
stays, documents with benchmark passages go, secrets are masked, and what is left is packed.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows it gets and returns a DataFrame, which is
written and read again for the next. All but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orebed.llm import decontaminate, secret_scan, simhash, toxicity
from orebed.llm.queries import pack, table
from orebed.session import stage, staging


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classifier = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, classifier)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.mask_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: The first stage scores with a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; only the last one's rows stay there."""
    docs = table(spark, sf_dir, "documents")
    with staging(spark):
        for name, function in STAGES:
            docs = stage(function(spark, docs, sf_dir), keep=name == STAGES[-1][0])
    return docs
