from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from orebed.functions import scalar
from orebed.sources import readers, schemas, writers


def test_json_lines(spark, tmp_path):
    path = tmp_path / "b.json"
    path.write_text('{"business_id": "b1", "city": "x"}\n{"business_id": "b2"}\n')
    df = readers.read_json_lines(spark, str(path), schemas.BUSINESS, ("business_id",))
    assert [(r.business_id, r.city) for r in df.collect()] == [("b1", "x"), ("b2", None)]
    with pytest.raises(Exception, match="city is missing"):
        readers.read_json_lines(spark, str(path), schemas.BUSINESS, ("city",)).collect()


def test_malformed_json_fails(spark, tmp_path):
    path = tmp_path / "b.json"
    path.write_text('{"business_id": "b1"}\n{"business_id": \n')
    with pytest.raises(Exception):
        readers.read_json_lines(spark, str(path), schemas.BUSINESS).collect()


def test_split_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('"a","b"\n  "1","x, y" \n"a","b"\n"2",\n3\n')
    rows = readers.read_split_csv(spark, str(path), ["a", None, "c"], header=True, drop_quotes=True)
    got = [tuple(r) for r in rows.collect()]
    # every repeat of the header goes; a quoted comma still splits
    assert got == [("1", " y"), ("2", None), ("3", None)]
    quoted = readers.read_split_csv(spark, str(path), ["a", "b"])
    assert quoted.first().a == '"a"' and quoted.count() == 5


def test_ratings(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('user_id,business_id,stars\nu,"b, c",4.0\n')
    assert tuple(readers.read_ratings(spark, str(path)).first()) == ("u", "b, c", 4.0)
    path = tmp_path / "v.csv"
    path.write_text("user_id,business_id\nu,b\n")
    assert tuple(readers.read_ratings(spark, str(path), labelled=False).first()) == ("u", "b")
    path = tmp_path / "w.csv"
    path.write_text("user_id,business_id,stars\nu,b,4.0\n")
    whole = readers.read_ratings(spark, str(path), labelled=False)
    assert whole.columns == ["user_id", "business_id", "stars"] and whole.count() == 1
    path = tmp_path / "bad.csv"
    path.write_text("user_id,business_id,stars\nu,b,many\n")
    with pytest.raises(Exception):
        readers.read_ratings(spark, str(path)).collect()


def test_csv_and_json_sinks(spark, tmp_path):
    df = spark.createDataFrame([("x, y", 1.5)], "city string, stars double").coalesce(1)
    writers.write_csv(df, str(tmp_path / "c"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "c").glob("part-*")))
    assert text == 'city,stars\n"x, y",1.5\n'
    writers.write_json(df.select(F.array("city").alias("top")), str(tmp_path / "j"))
    line = "".join(p.read_text() for p in (tmp_path / "j").glob("part-*"))
    assert json.loads(line) == {"top": ["x, y"]}


def test_scalars(spark):
    df = spark.createDataFrame(
        [("2013-05-07 04:34:36", [1, 2, 3], [2, 3, 4], "\t a ")],
        "t string, a array<int>, b array<int>, s string",
    )
    row = df.select(
        F.year(scalar.parse_timestamp(F.col("t"))),
        scalar.parse_timestamp(F.lit("bad"), strict=False),
        scalar.array_jaccard(F.col("a"), F.col("b")),
        scalar.is_subset(F.array(F.lit(1), F.lit(3)), F.col("a")),
        scalar.is_subset(F.col("b"), F.col("a")),
        scalar.strip(F.col("s")),
        scalar.row_text(F.col("s"), F.lit(1.5), F.lit(None)),
    ).first()
    assert tuple(row) == (2013, None, 0.5, True, False, "a", "\t a ,1.5,")
    with pytest.raises(Exception):
        df.select(scalar.parse_timestamp(F.lit("bad"))).collect()


def test_required_field_is_checked_whatever_is_selected(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('{"user_id": "u", "business_id": "b"}\n{"business_id": "c"}\n')
    df = readers.read_json_lines(
        spark, str(path), "user_id string, business_id string", ("user_id", "business_id")
    )
    for use in (df.select("business_id"), df.groupBy("business_id").count()):
        with pytest.raises(Exception, match="required field user_id"):
            use.collect()
    with pytest.raises(Exception, match="required field user_id"):
        df.count()


def test_header_of_the_first_file_by_name(spark, tmp_path):
    (tmp_path / "part-0").write_text("a,b\n1,2\n")
    (tmp_path / "part-1").write_text("3,4\n" * 500)
    rows = readers.read_split_csv(spark, str(tmp_path), ["a", "b"], header=True)
    assert rows.count() == 501 and rows.where("a = 'a'").count() == 0
