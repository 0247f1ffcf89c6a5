import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattline.llm import toxicity
from wattline.llm.common import table


def brute(emit, start, trans):
    p, edges, starts = np.zeros(len(emit)), np.zeros((2, 2)), np.zeros(2)
    heads = [*np.flatnonzero(start), len(emit)]
    for a, b in zip(heads, heads[1:]):
        z, pp, e, s = 0.0, np.zeros(b - a), np.zeros((2, 2)), np.zeros(2)
        for y in itertools.product((0, 1), repeat=int(b - a)):
            w = np.exp(trans[2, y[0]] + sum(trans[i, j] for i, j in zip(y, y[1:])) + sum(emit[a + k] for k, v in enumerate(y) if v))
            z, pp = z + w, pp + w * np.array(y)
            s[y[0]] += w
            for i, j in zip(y, y[1:]):
                e[i, j] += w
        p[a:b], edges, starts = pp / z, edges + e / z, starts + s / z
    return p, edges, starts


@pytest.mark.parametrize("n", [0, 1, 2, 9, 40])
def test_forward_backward(n):
    rng = np.random.default_rng(n)
    emit, start, trans = rng.normal(size=n) * 3, rng.random(n) < 0.3, rng.normal(size=(3, 2))
    start[:1] = True
    for got, want in zip(toxicity.scan(emit, start, trans), brute(emit, start, trans)):
        assert np.allclose(got, want)


def test_held_out_accuracy(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    crf = toxicity.fit(docs, labels)
    rows = toxicity.score(docs.select("doc_id", "text"), crf).withColumn("h", toxicity.held_out("doc_id")).join(labels, "doc_id").collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["h"]]
    toxic = [r for r in held if r["toxic"] == 1]
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic)
    assert sum(r["predicted"] for r in held if r["toxic"] == 0) <= 0.01 * len(held)


@pytest.fixture(scope="module")
def small(spark):
    words = [f"w{i}" for i in range(50)]
    rows, labels = [], []
    for i in range(200):
        text = " ".join(words[(i * 7 + j * 3) % 50] for j in range(30))
        toxic = i % 4 == 0
        rows.append((i, text + (" you utter scoundrel" if toxic else ""), "en"))
        labels.append((i, int(toxic)))
    schema = "doc_id long, text string, score string"
    docs = spark.createDataFrame(rows, schema).select("doc_id", "text")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_spans_and_rows_of_all_kinds(spark, small):
    crf = toxicity.fit(*small)
    text = "w1 w2 w3, Scoundrel! w4 w5"
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "w1 " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("xx"))
    got = toxicity.score(docs, crf).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    for r in got:
        if r["text"] == text:
            assert [text[s["start"]:s["end"]] for s in r["spans"]] == ["Scoundrel"]
        else:
            assert r["spans"] == [] and r["predicted"] == 0
    assert toxicity.score(docs.limit(0), crf).count() == 0


def test_labels_of_held_out_rows_change_nothing(spark, small):
    docs, labels = small
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert a.weights == b.weights and (a.document == b.document).all()


def test_nothing_to_learn(spark, small):
    docs, labels = small
    for some in (labels.limit(0), labels.where("toxic = 0"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        crf = toxicity.fit(docs, some)
        assert {r["predicted"] for r in toxicity.score(docs, crf).collect()} == {0}


@pytest.mark.parametrize("toxic", [0, 1])
def test_labels_without_documents_change_nothing(spark, small, toxic):
    docs, labels = small
    stray = spark.range(1_000_000, 1_020_000).select(F.col("id").alias("doc_id"), F.lit(toxic).alias("toxic"))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, labels.unionByName(stray))
    assert a.weights == b.weights and a.weights and a.bias == b.bias
    assert (a.trans == b.trans).all() and (a.document == b.document).all()
    assert toxicity.score(docs, b).where("predicted = 1").count() == docs.where("doc_id % 4 = 0").count()


def test_only_stray_labels_of_a_class(spark, small):
    docs, labels = small
    stray = spark.createDataFrame([(1_000_000, 1)], "doc_id long, toxic int")
    crf = toxicity.fit(docs, labels.where("toxic = 0").unionByName(stray))
    assert crf.weights == {} and toxicity.score(docs, crf).where("predicted = 1").count() == 0


def test_one_key_with_several_texts(spark, small):
    docs, labels = small
    more = docs.unionByName(docs.withColumn("text", F.lit(None).cast("string"))).unionByName(docs)
    crf = toxicity.fit(more, labels)
    assert toxicity.score(docs, crf).where("predicted = 1").count() == docs.where("doc_id % 4 = 0").count()


def test_longer_documents_of_the_labelled_do_not_take_the_sample(spark, small):
    docs, labels = small
    long = spark.range(5_000, 5_200).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("w1 "), 400), F.lit("scoundrel")).alias("text"))
    more = labels.unionByName(long.select("doc_id", F.lit(1).alias("toxic")))
    crf = toxicity.fit(docs.unionByName(long), more, sample=20, sample_chars=1_000)
    assert crf.weights and toxicity.score(docs, crf).where("predicted = 1").count() == docs.where("doc_id % 4 = 0").count()


def test_what_the_driver_has_is_sent_as_arrow(spark, monkeypatch):
    """Rows of Python objects would start Python workers of their own on the executors."""
    docs = spark.createDataFrame([(i, ("foul" if i % 2 else "fine") + f" text number {i}") for i in range(200)], "doc_id int, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id int, toxic int")
    sent, make = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **b: sent.append(type(data)) or make(self, data, *a, **b))
    crf = toxicity.fit(docs, labels)
    assert set(sent) == {pa.Table} and crf.weights["foul"] > 0
