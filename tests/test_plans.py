"""What the plans of the jobs may not hold, intermediate tables included."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from pyspark.sql import functions as F

from orebed import session
from orebed.functions import skew
from orebed.operators import layout
from orebed.plans import jobs

SF = "/root/testdata/sf0.001"
NAMES = [
    "frequent_itemsets",
    "son_candidates",
    "minhash_pairs",
    "jaccard_pairs_exact",
    "cf_predictions",
    "label_encode",
    "rating_features",
    "review_summary",
    "clustered_top_businesses",
]
BANNED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


@pytest.mark.parametrize("name", NAMES)
def test_plans(spark, monkeypatch, name):
    plans = []
    write = session.stage

    def stage(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    for module in [m for n, m in sys.modules.items() if n.startswith("orebed.")]:
        if hasattr(module, "stage"):
            monkeypatch.setattr(module, "stage", stage)
    result = contract.queries()[name](spark, SF)
    plans.append(result._jdf.queryExecution().executedPlan().toString())
    for plan in plans:
        for banned in BANNED:
            assert banned not in plan, plan


def test_stage_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = spark.conf

    monkeypatch.setattr(session, "CHECKPOINT_DIR", "spark.checkpoint.dir.unset")
    with pytest.raises(RuntimeError, match="shared"):
        session.shared_folder(Session())


def test_stage_gives_the_same_rows(spark):
    df = spark.range(5).selectExpr("id", "array(id) AS a")
    staged = session.stage(df)
    assert sorted(staged.collect()) == df.collect() and staged.dtypes == df.dtypes


def test_heavy_keys_and_split_join(spark):
    rows = [("hot", i) for i in range(300)] + [(f"k{i % 50}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, i int")
    heavy = skew.heavy_keys(df, ["k"], parts=10, min_rows=1)
    assert [(r.k, r.n_rows, r.splits) for r in heavy.collect()] == [("hot", 300, 6)]
    by_pairs = skew.heavy_keys(df, ["k"], parts=10, min_rows=1, pairs=True).collect()
    assert [(r.k, r.splits) for r in by_pairs] == [("hot", 10)]
    ordered = F.col("a.i") < F.col("b.i")
    plain = df.alias("a").join(df.alias("b"), (F.col("a.k") == F.col("b.k")) & ordered)
    expected = plain.groupBy("a.k").count().collect()
    for joined in (
        skew.join_within(df, df, ["k"], ["i"], ordered, heavy=heavy),
        skew.join_within(df, df, ["k"], ["i"], ordered, splits=F.lit(3)),
        skew.join_within(df, df, ["k"], ["i"], ordered),
    ):
        assert sorted(joined.groupBy("a.k").count().collect()) == sorted(expected)


def test_staged_tables_are_freed(spark, tmp_path):
    folder = Path(session.shared_folder(spark))
    before = set(folder.iterdir())
    with session.staging(spark):
        outer = session.stage(spark.range(3).toDF("id"))
        with session.staging(spark):
            session.stage(spark.range(4).toDF("id"))
        assert len(set(folder.iterdir()) - before) == 1
        outer.write.parquet(str(tmp_path / "out"))
    assert set(folder.iterdir()) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_jobs_free_what_they_staged(spark, tmp_path):
    folder = Path(session.shared_folder(spark))
    lines = [f'"1/{d}/2000","c{d % 3}","","","","p{d % 4}"' for d in range(60)]
    (tmp_path / "tx.csv").write_text("\n".join(["DATE,CUSTOMER,X,Y,Z,PRODUCT", *lines]))
    before = set(folder.iterdir())
    candidates, frequent = jobs.itemset_job(spark, 0, 2, str(tmp_path / "tx.csv"), str(tmp_path / "out"))
    # Only what the job returns is left, and can be read.
    assert len(set(folder.iterdir()) - before) == 2
    assert candidates.count() >= frequent.count() > 0


def test_bucketed_tables_need_no_exchange(spark):
    reviews = spark.range(5000).selectExpr("id % 300 AS k", "id AS v")
    one, two = layout.bucketed(reviews, ["k"], 4), layout.bucketed(reviews.distinct(), ["k"], 4)
    grouped = one.groupBy("k").agg(F.sum("v").alias("v"))
    joined = one.hint("merge").join(two.groupBy("k").count(), "k").groupBy("k").agg(F.max("count").alias("c"))
    for df in (grouped, joined):
        assert df.count() == 300
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
