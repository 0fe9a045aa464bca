"""Held-out accuracy and edge rows of the trained operators."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from orebed.llm import common, langid, quality, queries, toxicity

SF = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.001"


def auc(scores, labels) -> float:
    values, at = np.unique(scores, return_inverse=True)
    counts = np.bincount(at)
    ranks = (np.cumsum(counts) - (counts - 1) / 2)[at]
    n = labels.sum()
    return float((ranks[labels == 1].sum() - n * (n + 1) / 2) / (n * (len(labels) - n)))


def held_out(spark, query, label, of, rest):
    scored = query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    for r in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % of == rest)
    return [r for r in scored if r["held_out"] and r[label] is not None]


def test_toxicity_on_held_out_rows(spark):
    rows = held_out(spark, queries.op4_toxicity, "toxic", 5, 0)
    y = np.array([r["toxic"] for r in rows])
    # About one in fifteen texts that this table calls toxic is junk without any word of abuse.
    assert auc(np.array([r["score"] for r in rows]), y) > 0.93
    wrong = np.array([r["predicted"] for r in rows]) != y
    assert wrong.mean() < 0.03


def test_quality_on_held_out_rows(spark):
    rows = held_out(spark, queries.op9_quality, "quality", 4, 2)
    y = np.array([r["quality"] for r in rows])
    assert auc(np.array([r["score"] for r in rows]), y) > 0.97
    assert (np.array([r["predicted"] for r in rows]) != y).mean() < 0.03


def test_language_on_held_out_rows(spark):
    found = queries.op6_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = [r for r in found.collect() if r["held_out"] and r["lang"] is not None]
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


ODD = [(1, "plain words here"), (2, None), (3, ""), (3, ""), (4, "12 34 !!"), (None, "words"), (5, "long words " * 200_000), (6, "\n"), (7, "x")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 0.5, "en") for r in ODD], "doc_id long, text string, score double, lang_pred string")


def test_odd_rows_have_scores(spark, odd):
    documents, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    tox, good = toxicity.fit(documents, labels), quality.fit(documents, labels)
    for found in (toxicity.score(odd, tox), quality.score(odd, good)):
        assert found.columns == ["doc_id", "score"]
        assert sorted(map(repr, (r["doc_id"] for r in found.collect()))) == sorted(repr(r[0]) for r in ODD)
        assert all(0 <= r["score"] <= 1 for r in found.collect())
        assert found.limit(0).count() == 0
    assert toxicity.score(odd.limit(0), tox).count() == 0
    kept = toxicity.drop_toxic(odd, tox)
    assert kept.columns == odd.columns and kept.count() >= len(ODD) - 1


def test_languages_of_odd_rows(spark, odd):
    network = langid.fit(spark.read.parquet(f"{SMALL}/documents.parquet"))
    found = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(odd, network).collect()]
    assert len(found) == len(ODD)
    assert {d for d, lang, _ in found if lang == "und"} == {2, 3, 4, 6}
    assert all(0 <= s <= 1 for _, _, s in found)
    assert langid.identify(odd.limit(0), network).count() == 0


def test_nothing_to_learn_from(spark, odd):
    documents = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, None, None)], "doc_id long, toxic int, quality int")
    assert {r["score"] for r in toxicity.score(odd, toxicity.fit(documents, labels)).collect()} == {0.0}
    assert {r["score"] for r in quality.score(odd, quality.fit(documents, labels)).collect()} == {0.0}
    assert {r["lang_pred"] for r in langid.identify(odd, langid.fit(documents)).collect()} == {"und"}


def test_one_label_only():
    sample = [(b"some words", 1, "en"), (b"others", 1, None)]
    assert toxicity.learn(sample, {1: 2}).score([[b"x"], []]).tolist() == [1.0, 1.0]
    assert quality.learn(sample, {1: 2}).score(np.zeros((2, len(quality.FEATURES)))).tolist() == [1.0, 1.0]


def test_table_scoring_is_the_network():
    rng = np.random.default_rng(0)
    net = langid.Network(["a", "b", "c"]).ready()
    x = rng.integers(1, 256, (5, langid.WINDOW), dtype=np.uint8)
    e = net.embed[x]
    hidden = []
    for f, b in zip(net.filters, net.bias):
        size = langid.WINDOW - len(f) + 1
        conv = sum(e[:, k : k + size] @ f[k] for k in range(len(f)))
        hidden.append(np.maximum(conv.max(axis=1) + b, 0))
    assert np.allclose(net.logits(x), np.concatenate(hidden, axis=1) @ net.out + net.out_bias, atol=1e-4)


def test_gradients_of_the_language_network():
    rng = np.random.default_rng(4)
    net = langid.Network(["a", "b"])
    x, y, w = rng.integers(1, 256, (6, langid.WINDOW), dtype=np.uint8), np.array([0, 1, 1, 0, 1, 0]), np.ones(6, np.float32)

    def loss():
        z = net.ready().logits(x).astype(np.float64)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(6), y]))

    gradient = net._gradients(x, y, w)
    for array, g in ((net.filters[1], gradient[2]), (net.out, gradient[-2]), (net.embed, gradient[0])):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = array[at], np.float32(1e-2)
        array[at] = old + step
        up = loss()
        array[at] = old - step
        down = loss()
        array[at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 1e-3


def test_toxicity_reads_the_whole_text():
    rng = np.random.default_rng(6)
    clean = [" ".join(rng.choice(["the", "of", "and", "house", "tree", "sea", "river"], 60)) for _ in range(400)]
    bad = [t + " scoundrel" + str(rng.integers(5)) for t in clean[:200]]
    sample = [(t.encode(), 0, "en") for t in clean] + [(t.encode(), 1, "en") for t in bad]
    sample = [sample[i] for i in rng.permutation(len(sample))]
    model = toxicity.learn(sample, {0: 400, 1: 200})
    words = toxicity.plain_words(b"the house and the sea " * 20_000)
    scores = model.score([words, [*words, b"scoundrel7"], [b"scoundrel1"], []])
    assert scores[0] < 0.5 <= scores[1] and scores[2] >= 0.5 > scores[3]


def test_features():
    assert quality.features(None) == quality.features(b"") == [0.0] * len(quality.FEATURES)
    for text in (b" ", b"\n", b"a", "é".encode(), b"A B! " * 100_000, b"a" * 500_000):
        x = quality.features(text)
        assert len(x) == len(quality.FEATURES) and np.isfinite(x).all()


def test_interactions_are_learned():
    rng = np.random.default_rng(8)
    x = rng.random((3_000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(int)
    model = quality.Model().fit(x, y, np.ones(len(y)))
    assert (0, 2) in model.pairs
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


@pytest.mark.parametrize("module,label,of,rest", [(toxicity, "toxic", 5, 0), (quality, "quality", 4, 2)])
def test_held_out_labels_are_not_learned_from(spark, module, label, of, rest):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(1500).cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet").join(docs.select("doc_id"), "doc_id", "left_semi").cache()
    held = common.remainder("doc_id", of) == rest
    other = labels.withColumn(label, F.when(held, 1 - F.col(label)).otherwise(F.col(label)))
    found = [
        sorted(map(tuple, module.score(docs, module.fit(docs, given, of=of, held_out=rest)).collect()))
        for given in (labels, other, labels.where(~held))
    ]
    assert found[0] == found[1] == found[2] and len({s for _, s in found[0]}) > 100


def test_sample_is_bounded_before_texts_are_fetched(spark):
    rows = spark.range(40).select("id", F.repeat(F.lit("x"), F.lit(300_000)).cast("binary").alias("text"))
    sample = common.bounded(rows, 1_000_000)
    assert len(sample) == 3 and all(len(t) == 300_000 for (t,) in sample)
    assert len(common.bounded(rows, 10)) == 1 and common.bounded(rows.limit(0), 10) == []


def labelled(spark, n, word_of):
    rng = np.random.default_rng(n)
    rows = [(i, " ".join(rng.choice(["the", "of", "and", "house", "tree", "sea"], 30)), int(rng.random() < 0.4), "en") for i in range(n)]
    rows = [(i, f"{t} {word_of(i)}" if y else t, lang, y) for i, t, y, lang in rows]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int"), rows


def test_toxicity_learns_from_all_labelled_texts(spark):
    """Every word of abuse is in a few texts only, over many shards."""
    docs, labels, rows = labelled(spark, 3_000, lambda i: f"{chr(97 + i % 20) * 3}{chr(97 + i // 20 % 10) * 3}")
    model = toxicity.fit(docs, labels, per_class=100)
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 != 0]
    scores = model.score([toxicity.plain_words(r[1].encode()) for r in learned])
    assert ((scores >= 0.5) == np.array([r[3] for r in learned])).mean() > 0.99


def test_one_shard_is_the_plain_classifier(spark):
    docs, labels, _ = labelled(spark, 300, lambda i: f"scoundrel{i % 9}")
    sample = common.labelled_texts(docs, labels, "toxic", 5, 0, 4_000, 40_000_000, lang=True)
    plain, found = toxicity.learn(sample, common.label_counts(labels, "toxic", 5, 0)), toxicity.fit(docs, labels)
    # Products of small matrices are rounded otherwise where numpy has other threads.
    assert np.abs(plain.state() - found.state()).max() < 1e-4 and np.array_equal(plain.lang_table, found.lang_table)
    assert np.allclose(plain.thresholds, found.thresholds, atol=1e-3)


def test_cuts_over_partitions_are_the_plain_ones(spark):
    rng = np.random.default_rng(5)
    for top in (0, 3, 1000):
        lang, z, y = rng.integers(0, 3, 600), rng.integers(0, top + 1, 600) / 4, rng.integers(0, 2, 600)
        y = np.where(z > top / 6, y, 0) if top else y
        rows = spark.createDataFrame(list(zip(lang.tolist(), z.tolist(), y.tolist())), "lang int, z double, y int")
        counted = rows.groupBy("lang", "z").agg(F.sum(1 - F.col("y")).alias("n0"), F.sum("y").alias("n1"))
        cuts = toxicity.best_cuts(counted.repartitionByRange(7, "lang", "z").sortWithinPartitions("lang", "z"), [1.0, 2.0])
        for i in range(3):
            mine = lang == i
            assert cuts[i] == (toxicity._threshold(z[mine], y[mine], 1.0 + y[mine]), min(y[mine].sum(), (1 - y[mine]).sum()))


def test_toxicity_knows_languages_of_few_texts(spark):
    docs, labels, _ = labelled(spark, 300, lambda i: "scoundrel")
    docs = docs.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id") % 60))
    # A language may have all its texts in the quarter for the thresholds.
    assert len(toxicity.fit(docs, labels, per_class=5).langs) > 50
