import random

import numpy as np
import pytest
import xxhash

from wattline.llm import simhash
from wattline.llm.common import table
from wattline.llm.graph import components

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text, k=4):
    words = text.encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    v = sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))
    return v - (1 << 64) if v >> 63 else v


def linked(values, radius=4):
    v = np.array(values, dtype=np.int64).view(np.uint64)
    apart = np.bitwise_count(v[:, None] ^ v[None, :])
    return [(i, j) for i, j in zip(*np.nonzero(apart <= radius)) if i < j]


@pytest.mark.parametrize("text", ["", "  \n", "One", "one two THREE", "a b c d", "Ä ä b c d e f", "x y z " * 70])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def near(rng, x, n):
    for bit in rng.sample(range(64), n):
        x ^= 1 << bit
    return x


@pytest.mark.parametrize("shard", [4096, 7])
def test_links_reach_what_all_pairs_reach(spark, classes, shard):
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(150)]
    for base in values[:20]:
        values += [near(rng, base, rng.randint(1, 6)) for _ in range(6)]
    values += [near(rng, values[0], rng.randint(1, 3)) for _ in range(200)]        # a dense group, split into trees
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    want = classes(len(values), linked(values))
    frame = spark.createDataFrame([(v,) for v in values], "f long")
    got = {r["node"]: r["component"] for r in components(simhash.links(frame, shard=shard)).collect()}
    assert [got.get(v, v) for v in values] == [values[i] for i in want]


def test_near_duplicates_equal_brute_force(spark, classes):
    docs = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    f = [brute_fingerprint(t or "") for _, t in rows]
    groups = classes(len(rows), linked(f))
    least = {}
    for (d, _), g in zip(rows, groups):
        least[g] = min(d, least.get(g, d))
    want = {(d, format(x % (1 << 64), "016x"), least[g]) for (d, _), x, g in zip(rows, f, groups)}
    assert set(map(tuple, simhash.near_duplicates(docs).collect())) == want


def test_rows_of_all_kinds(spark):
    same = "w1 w2 w3 w4 w5 w6 w7 w8 " * 20
    rows = [(7, same, "x"), (3, same, None), (3, same, "x"), (None, same, "x"), (9, None, "x"), (8, "", "x"), (5, " \n", "x"), (4, "other words here now", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, f string")
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    assert sorted((d, c) for d, f, c in got if f == "0" * 16) == [(5, 5), (8, 5), (9, 5)]
    assert [c for d, f, c in got if d in (7, 3, None)] == [3] * 4
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5]
    empty = docs.limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, j) for j in range(200, 260)] + [(1, 1)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 100 for i in range(100, 141)) and all(got[j] == 5 for j in range(200, 260)) and 1 not in got
