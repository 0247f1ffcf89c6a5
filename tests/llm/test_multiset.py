import hashlib

import pytest
from pyspark.sql import functions as F

from wattline.llm import multiset
from wattline.llm.common import table


def expected(rows):
    """(key, n_chars, sha of the edited text) by a plain loop; rows sorted as the operator orders them."""
    out = []
    for i, (k, t) in enumerate(rows):
        n, q = len(t), len(t) // 4
        out.append((k, n, hashlib.sha256((t[:n - q] + rows[(i + 1) % len(rows)][1][:q]).encode()).hexdigest()))
    return out


def test_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    got = multiset.edited_likeness(docs).collect()
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == expected(rows)
    by = {r["doc_id"]: r for r in got}
    fp = {}
    for k, t in rows:
        fp.setdefault(t, set()).add(by[k]["fingerprint"])
    assert all(len(f) == 1 for f in fp.values()) and len({next(iter(f)) for f in fp.values()}) == len(fp)
    assert sum(r["near_edited"] > r["near_next"] for r in got) >= 0.95 * len(got)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))


def vectors(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in multiset.fingerprints(docs).collect()}


def test_order_and_insertion(spark):
    v = vectors(spark, ["a b c\nd e\na b c", "a b c\na b c\nd e", "a b c\na b c", "d e", "a b c\nd e"])
    assert v[0]["fingerprint"] == v[1]["fingerprint"] and v[0]["fingerprint"] != v[4]["fingerprint"]
    for part in ("equal", "lanes"):
        whole, rest, piece = v[0][part], v[2][part], v[3][part]
        frame = spark.createDataFrame([(whole, rest, piece)], "w array<long>, r array<long>, p array<long>")
        row = frame.select(multiset.plus(F.col("r"), F.col("p")).alias("plus"), multiset.minus(F.col("w"), F.col("p")).alias("minus")).first()
        assert row["plus"] == whole and row["minus"] == rest


def test_lanes_against_plain_python(spark):
    xxhash = pytest.importorskip("xxhash")
    text = "the one the two\nthe one"
    v = vectors(spark, [text])[0]
    lanes, equal = [0] * 64, [0] * 8
    for p in text.split("\n"):
        sha = hashlib.sha256(p.encode()).hexdigest()
        equal = [(e + int(sha[8 * i:8 * i + 8], 16)) % 2**32 for i, e in enumerate(equal)]
        w = p.split(" ")
        for a, b in zip(w, [*w[1:], None]):
            h = xxhash.xxh64_intdigest(a.encode(), 42)
            if b is not None:
                h = xxhash.xxh64_intdigest(b.encode(), h)
            lanes = [x + (1 if h >> j & 1 else -1) for j, x in enumerate(lanes)]
    assert v["equal"] == equal and v["lanes"] == [x % 2**32 for x in lanes]


def test_rows_of_all_kinds(spark):
    rows = [(5, "abcd efgh"), (5, "abcd efgh"), (5, "abcd efgh"), (1, None), (2, ""), (None, "né" * 4000), (3, "x")]
    docs = spark.createDataFrame([(k, t, "z") for k, t in rows], "doc_id long, text string, fingerprint string")
    got = multiset.edited_likeness(docs).collect()
    order = [(1, ""), (2, ""), (3, "x"), (5, "abcd efgh"), (5, "abcd efgh"), (5, "abcd efgh"), (None, "né" * 4000)]
    assert sorted(map(str, expected(order))) == sorted(str((r["doc_id"], r["n_chars"], r["edited_sha256"])) for r in got)
    assert [r["near_next"] for r in got if r["doc_id"] == 1] == [1.0]
    assert sorted(r["near_next"] for r in got if r["doc_id"] == 5)[1:] == [1.0, 1.0]
    assert multiset.edited_likeness(docs.limit(0)).count() == 0
    assert [r["near_edited"] for r in multiset.edited_likeness(docs.where("doc_id = 2")).collect()] == [1.0]
