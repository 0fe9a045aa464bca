"""The pipeline's stages on the small tables and on odd rows."""

from __future__ import annotations

import pytest

import corpus_pipeline
from orebed.llm import decontaminate, queries, secret_scan, simhash, toxicity
from orebed.session import stage

SF = "/root/testdata/sf0.001"


def test_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    classifier = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    functions = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    kept = stage(functions["toxicity"](spark, docs, SF))
    toxic = {r["doc_id"] for r in toxicity.score(docs, classifier).where("score >= 0.5").collect()}
    assert kept.columns == columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - toxic

    one = stage(functions["simhash"](spark, kept, SF))
    least = {r["component_id"] for r in simhash.near_duplicates(kept).collect()}
    assert one.columns == columns and {r["doc_id"] for r in one.collect()} == least

    clean = stage(functions["decontamination"](spark, one, SF))
    hit = {r["doc_id"] for r in decontaminate.find(one, benchmark).collect() if r["hits"]}
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == least - hit

    masked = stage(functions["secrets"](spark, clean, SF))
    before, after = ({r["doc_id"]: r for r in x.collect()} for x in (clean, masked))
    assert masked.columns == columns and before.keys() == after.keys()
    with_spans = {r["doc_id"] for r in secret_scan.scan(clean).where("spans <> ''").collect()}
    assert {d for d in before if before[d] != after[d]} == with_spans
    assert all(after[d]["n_chars"] == len(after[d]["text"]) for d in with_spans)
    assert secret_scan.scan(masked).where("spans <> ''").count() == 0

    packed = functions["packing"](spark, masked, SF).collect()
    assert {r["doc_id"] for r in packed} == set(after)


ODD = [
    (1, None, None, None, None), (None, "words of a text", "en", "s", 4), (2, "", "en", None, 0), (2, "", "en", None, 0),
    (3, "words of a text", None, "s", None), (4, "long " * 50_000, "en", "s", 1), (5, "token = abcdefghijkl", "de", "s", None),
]


@pytest.mark.parametrize("odd", [ODD, []])
def test_odd_rows_pass(spark, odd):
    docs = spark.createDataFrame(
        [(*r, 1, 2.0) for r in odd], "doc_id long, text string, lang string, source string, n_chars long, score int, fp double"
    )
    for name, function in corpus_pipeline.STAGES:
        out = stage(function(spark, docs, SF))
        if name != "packing":
            assert out.columns == docs.columns
        docs = out
    assert docs.select("doc_id").distinct().count() == (4 if odd else 0)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    bins: dict[int, list] = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_queries_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
