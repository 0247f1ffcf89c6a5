import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm import centroids
from wattline.llm.queries import ORACLES, op11_centroids
from wattline.testing import compare, duckdb_connection


def lloyd(rows, k, rounds, dims, scale):
    """Clusters and final centroids by whole vectors."""
    kept = [(i, [int(np.floor(float(np.float32(x)) * scale)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    c = [v for _, v in first]
    for turn in range(rounds + 1):
        far = [[sum((a - b) ** 2 for a, b in zip(v, m)) for m in c] for _, v in kept]
        label = [d.index(min(d)) for d in far]
        if turn < rounds:
            for j in range(len(c)):
                mine = [v for (_, v), x in zip(kept, label) if x == j]
                c[j] = [sum(col) // len(mine) for col in zip(*mine)] if mine else c[j]
    return [(i, x, d[x]) for (i, _), x, d in zip(kept, label, far)], c


@pytest.mark.parametrize("n, k, width, chunk", [(200, 12, 4, 16), (5, 9, 8, 1024), (60, 3, 1, 7)])
def test_against_whole_vectors(spark, n, k, width, chunk):
    rng = np.random.default_rng(n)
    rows = [(i % 50, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(n)]
    rows += [(rows[0][0], rows[0][1])] * 20 + [(900 + i, [0.25] * 8) for i in range(20)]                       # repeats and ties
    rows += [(1, None), (2, [0.5] * 7), (3, [0.5] * 7 + [None]), (4, [0.5] * 7 + [float("nan")]), (5, [float("-inf")] * 8), (6, []), (None, [0.1] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("x")).repartition(3)
    found, cells = centroids.cluster(df, k=k, rounds=4, dims=8, scale=32, chunk=chunk, width=width)
    want, c = lloyd(rows, k, 4, 8, 32)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))
    got = {}
    for r in cells.collect():
        got.setdefault(r["cluster"], {})[r["dim"]] = r["value"]
    assert [[got[j][d] for d in range(8)] for j in range(len(c))] == c


def test_empty_and_large(spark):
    df = spark.createDataFrame([(1, [1e30] * 8)], "vec_id long, embedding array<float>")
    empty = centroids.described(*centroids.cluster(df.limit(0), dims=8, width=4))
    assert empty.count() == 0 and "centroid_sha256" in empty.columns
    with pytest.raises(Exception, match="may not fit a long"):
        centroids.cluster(df, dims=8, width=4)
    with pytest.raises(ValueError, match="divide"):
        centroids.cluster(df, dims=8, width=3)


def test_inertia(spark):
    df = spark.createDataFrame([(i, [float(i % 3), 0.0]) for i in range(30)], "vec_id long, embedding array<double>")
    found, cells = centroids.cluster(df, k=2, dims=2, width=1, scale=4)
    rows = centroids.described(found, cells).collect()
    by = {}
    for r in rows:
        by[r["cluster"]] = by.get(r["cluster"], 0) + r["distance"]
    assert len(rows) == 30 and all(r["cluster_inertia"] == by[r["cluster"]] and r["inertia"] == sum(by.values()) for r in rows)


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    ok, why = compare(op11_centroids(spark, sf), duckdb_connection(sf), ORACLES["op11_centroids"])
    assert ok, why
