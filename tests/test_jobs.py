from __future__ import annotations

import json

import pytest

from orebed.fixtures import view
from orebed.functions.scalar import TIMESTAMP_FORMAT
from orebed.operators import features
from orebed.plans import jobs
from orebed.sources import readers, schemas
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The input files of the jobs, written from the driver tables."""
    root = tmp_path_factory.mktemp("files")
    reviews = view(spark, SF, "reviews")
    text = reviews.withColumn("date", F.date_format("date", TIMESTAMP_FORMAT))
    text.write.json(str(root / "reviews.json"))
    view(spark, SF, "business").write.json(str(root / "business.json"))
    view(spark, SF, "tips").write.json(str(root / "tips.json"))
    view(spark, SF, "photos").write.json(str(root / "photos.json"))
    ratings = view(spark, SF, "ratings")
    for part in ("train", "val"):
        table = ratings.where(F.col("split") == part).drop("split")
        table.write.option("header", True).csv(str(root / f"{part}.csv"))
    return root


def lines(path):
    return [x for p in sorted(path.glob("part-*")) for x in p.read_text().splitlines()]


def test_review_summary(spark, folder, tmp_path):
    jobs.review_summary_job(spark, str(folder / "reviews.json"), str(tmp_path / "o"), 1998)
    (document,) = [json.loads(x) for x in lines(tmp_path / "o")]
    assert document["n_review"] == view(spark, SF, "reviews").count()
    assert len(document["top_user"]) == 10 and document["n_user"] > 0


def test_layout(spark, folder, tmp_path):
    rows = jobs.layout_job(spark, str(folder / "reviews.json"), str(tmp_path / "o")).collect()
    by_name = {r.layout: r for r in rows}
    assert by_name["customized"].n_partition == 10
    assert by_name["default"].top == by_name["customized"].top
    assert sum(by_name["default"].n_items) == sum(by_name["customized"].n_items)


def test_cities(spark, folder, tmp_path):
    means, top = jobs.city_job(
        spark, str(folder / "business.json"), str(folder / "reviews.json"),
        str(tmp_path / "a"), str(tmp_path / "b"),
    )
    assert lines(tmp_path / "a")[0] == "city,stars"
    assert [r.city for r in means.limit(10).collect()] == [r.city for r in top.collect()]


def test_itemsets(spark, tmp_path):
    rows = ['"date","customer","a","b","c","product"']
    for day in range(1, 5):
        for customer in range(3):
            for product in ("p", "q", "r")[: day]:
                rows.append(f'"11/{day}/2000","{customer}","","","","{product}"')
    (tmp_path / "t.csv").write_text("\n".join(rows) + "\n")
    jobs.itemset_job(
        spark, 1, 6, str(tmp_path / "t.csv"), str(tmp_path / "o"), 2, str(tmp_path / "b")
    )
    assert lines(tmp_path / "b")[0] == "DATE-CUSTOMER_ID,PRODUCT_ID"
    text = lines(tmp_path / "o")
    frequent = text[text.index("Frequent Itemsets:") :]
    assert frequent == [
        "Frequent Itemsets:", "('p')", "('q')", "('r')", "",
        "('p', 'q')", "('p', 'r')", "('q', 'r')", "", "('p', 'q', 'r')", "",
    ]


def test_similarity(spark, tmp_path):
    rows = [("u1", "a"), ("u2", "a"), ("u1", "b"), ("u2", "b"), ("u3", "b"), ("u9", "c")]
    text = "user_id,business_id,stars\n" + "".join(f"{u},{b},1.0\n" for u, b in rows)
    (tmp_path / "r.csv").write_text(text)
    jobs.similarity_job(spark, str(tmp_path / "r.csv"), str(tmp_path / "o"))
    assert lines(tmp_path / "o") == [
        "business_id_1,business_id_2,similarity", "a,b,0.6666666666666666",
    ]
    rows = [(u, b) for b in "abc" for u in ("u1", "u2")]
    text = "user_id,business_id,stars\n" + "".join(f"{u},{b},1.0\n" for u, b in rows)
    (tmp_path / "s.csv").write_text(text)
    outputs = [str(tmp_path / name) for name in ("p", "q")]
    source = str(tmp_path / "s.csv")
    assert jobs.similarity_job(spark, source, outputs[0]).count() == 3
    assert jobs.similarity_job(spark, source, outputs[1], copies_path=str(tmp_path / "c")).count() == 0
    assert sorted(lines(tmp_path / "c"))[:3] == ["a,a", "b,a", "c,a"]


def test_cf(spark, folder, tmp_path):
    weights, predictions = jobs.cf_job(
        spark, str(folder / "train.csv"), str(folder / "val.csv"), str(tmp_path / "o")
    )
    assert weights.count() > 0
    assert predictions.where("prediction IS NULL").count() == 0
    assert "user_id,business_id,prediction" in lines(tmp_path / "o")


def test_ratings(spark, folder, tmp_path):
    names = ("train.csv", "val.csv", "business.json", "reviews.json", "tips.json", "photos.json")
    inputs = [str(folder / name) for name in names]
    outputs = [str(tmp_path / name) for name in ("o", "m", "c")]
    errors = jobs.rating_job(spark, *inputs, *outputs, maxIter=3, maxDepth=3)
    assert {r.part for r in errors.collect()} == {"train", "val"}
    assert lines(tmp_path / "o")[0] == "user_id,business_id,prediction"
    assert spark.read.parquet(str(tmp_path / "c" / "user_id")).count() > 0


def test_of_repeated_business_lines_the_last_counts(spark, tmp_path):
    path = tmp_path / "business.json"
    line = '{"business_id": "b", "city": "c", "stars": %s, "review_count": %d, "is_open": 1}\n'
    path.write_text(line % (5.0, 9) + line % (4.0, 8) + line % (1.0, 1))
    rows = readers.read_json_lines(spark, str(path), schemas.BUSINESS, ("business_id",)).withColumn("order", readers.place())
    (found,) = features.business_attrs(rows, "order").collect()
    assert (found.biz_stars, found.biz_review_count) == (1.0, 1)
