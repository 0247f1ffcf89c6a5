import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm import topk
from wattline.llm.queries import ORACLES, op10_topk
from wattline.testing import compare, duckdb_connection


def brute(rows, k, every):
    out = set()
    good = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, v in good:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), d) for d, w in good if d != q)[:k]
            out |= {(q, r + 1, d, -s) for r, (s, d) in enumerate(best)}
    return out


@pytest.mark.parametrize("scale", [0.2, 5.0, 2000.0])
def test_against_brute_force(spark, scale):
    rng = np.random.default_rng(int(scale * 10))
    rows = [(int(i), rng.normal(scale=scale, size=12).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]                      # a hot vector: ties go to the smaller id
    rows += [(2000, None), (2010, [1.0, None]), (2020, [float("nan")]), (2030, [float("inf")]), (None, [1.0]), (2040, []), (2050, [1.0, 2.0])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    for held in (16, 40, 1000):                                                # one chunk a task, several, all
        got = topk.top_k(docs, F.col("vec_id") % 10 == 0, k=7, block=100, chunk=16, run_blocks=3, task_queries=held)
        assert {tuple(r) for r in got.collect()} == brute(rows, 7, 10)


def test_fewer_rows_than_k_and_none(spark):
    rows = [(0, [0.0, 0.0]), (1, [-1.0, 0.5]), (10, [1.0, 1.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {tuple(r) for r in topk.top_k(docs, F.col("vec_id") % 10 == 0, k=20).collect()} == brute(rows, 20, 10)
    assert topk.top_k(docs.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_components_out_of_range_raise(spark):
    for x in (1e30, -1e12, 2.0 ** 26):
        docs = spark.createDataFrame([(0, [1.0, x]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
        with pytest.raises(OverflowError):
            topk.top_k(docs, F.col("vec_id") % 10 == 0)
    rows = [(0, [2.0 ** 24, 1.0]), (1, [2.0 ** 24, 0.5]), (2, [2.0 ** 24, -0.5])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.top_k(docs, F.col("vec_id") % 10 == 0).collect()} == brute(rows, 20, 10)


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    ok, why = compare(op10_topk(spark, sf), duckdb_connection(sf), ORACLES["op10_topk"])
    assert ok, why
