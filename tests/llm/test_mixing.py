import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from wattline.llm import mixing
from wattline.llm.queries import ORACLES, op12_mix
from wattline.testing import compare, duckdb_connection

SCHEMA = "doc_id long, text string, source string, extra string"


def filled(sizes, weights=(3, 1, 2), budget=Fraction(3, 2), most=2):
    """Targets by sharing again and again; sizes by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = budget * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in stopped)
        rest = [s for s in order if s not in stopped]
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        new = {s for s in rest if share[s] > most * sizes[s]}
        if not new:
            return {s: float(most * sizes[s]) for s in stopped} | {s: float(x) for s, x in share.items()}
        stopped |= new


@pytest.fixture()
def rows():
    out = [(i, " ".join(["w"] * (i % 13)), ["b", "a", None, "\U0001F600", "￿", "B", "", "z"][min(i % 11, 7)], "x") for i in range(4000)]
    return out + [(1, None, "a", "x"), (None, "a b", "none", "x"), (None, "a b c", "none", "x"), (7, "", "empty", "x"), (8, None, "empty", "x")]


def test_targets_and_draws(spark, rows):
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = filled(sizes)
    taken = {s: 0 for s in sizes}
    by_id = {i: s for i, _, s, _ in rows if i is not None and i > 8}
    for r in got:
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert math.floor(rate) <= r["copies"] <= math.ceil(rate) and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        if r["doc_id"] in by_id:
            s = by_id[r["doc_id"]]
            assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s], rel=1e-12)
            taken[s] += r["taken"]
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s, t in want.items():
        if sizes[s] > 1000:
            assert abs(taken[s] - t) < 4 * math.sqrt(sum(len((x or "").split()) ** 2 for _, x, y, _ in rows if y == s) / 4) + 20


def test_reruns_and_order_of_rows(spark, rows):
    rank = lambda df: sorted(map(tuple, df.collect()), key=repr)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert rank(mixing.mix(docs)) == rank(mixing.mix(docs.repartition(7).orderBy(F.desc("text"))))
    assert rank(mixing.mix(docs)) != rank(mixing.mix(docs, seed=1))


def test_emitted_rows_are_the_copies(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("copy", "draw", "rate", "copies", "size")})
    out = mixing.emit(docs)
    assert out.columns == [c for c in docs.columns if c != "copy"] + ["copy"]
    assert out.where("rate <> 'rate' OR draw <> 'draw' OR copies <> 'copies' OR size <> 'size'").count() == 0
    said = mixing.mix(docs).agg(F.sum("copies"), F.sum("taken")).first()
    assert out.count() == said[0] and out.agg(F.sum(mixing.words())).first()[0] == said[1]


def test_more_sources_than_are_broadcast(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, mixing.mix(docs).collect()), key=repr)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 2)
    out = mixing.mix(docs)
    assert "Salt" in out._jdf.queryExecution().toString() or "_salt" in out._jdf.queryExecution().toString()
    assert sorted(map(tuple, out.collect()), key=repr) == want


def test_empty_and_wordless(spark):
    docs = spark.createDataFrame([(1, None, None, "x"), (2, " \t", "a", "x")], SCHEMA)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.emit(docs.limit(0)).count() == 0
    assert all(r["target"] == 0 and r["taken"] == 0 for r in mixing.mix(docs).collect())
    one = mixing.mix(spark.createDataFrame([(1, "a b", None, "x")] * 3, SCHEMA)).collect()     # rows that repeat are drawn alike
    assert len({r["taken"] for r in one}) == 1 and one[0]["target"] == 9.0


def test_no_python_on_the_main_path(spark, rows):
    plan = mixing.mix(spark.createDataFrame(rows, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    ok, why = compare(op12_mix(spark, sf), duckdb_connection(sf), ORACLES["op12_mix"])
    assert ok, why
