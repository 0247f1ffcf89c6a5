import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from wattline.llm import manifest
from wattline.llm.queries import ORACLES, op13_manifest
from wattline.testing import compare, duckdb_connection

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(leaves, fanout):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def whole_tree(rows, fanout=2):
    """Every column of every row from whole trees in memory."""
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, t, l, s, n: h("".join(map(said, (d, s, l, n, t))))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
    trees = [levels_of([leaf(*r) for r in groups[g]], fanout) for g in order]
    top, out = levels_of([t[-1][0] for t in trees], fanout), []
    for k, g in enumerate(order):
        for i, (d, t, l, s, n) in enumerate(groups[g]):
            hit = d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0
            claim, told = leaf(d, t, l, s, n + 1 if hit else n), ""
            for levels, at in ((trees[k], i), (top, k)):
                for nodes in levels[:-1]:
                    run = nodes[at // fanout * fanout:][:fanout]
                    left, right = "".join(run[:at % fanout]), "".join(run[at % fanout + 1:])
                    claim, told, at = h(left + claim + right), told + left + right, at // fanout
            out.append((d, leaf(d, t, l, s, n), trees[k][-1][0], top[-1][0], h(told), claim, claim == top[-1][0]))
    return sorted(out, key=repr)


def rows_of_all_kinds():
    langs = [None, "", "a", "b", "é", "\U0001F600", "￿"]
    rows = [(i % 60 if i % 7 else None, "t" * (i % 3) if i % 4 else None, langs[i % 7] if i < 150 else f"one{i}", None if i % 9 == 0 else "s",
             i if i % 6 else None) for i in range(163)]
    return rows + [(3, "x", "a", "s", 1)] * 40 + [(5, "é" * 5000, "a", "s", 2 ** 63 - 1)]


@pytest.mark.parametrize("fanout, levels", [(2, 2), (2, 8), (3, 1), (4, 2)])
def test_against_whole_trees(spark, fanout, levels):
    rows = rows_of_all_kinds()
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("tree", "rank", "n", "leaf", "key", "claim", "_row")}).repartition(5)
    got = manifest.manifest(docs, claimed=manifest.tampered(docs), fanout=fanout, levels=levels).select(*COLUMNS).collect()
    want = whole_tree(rows, fanout)
    assert sorted(map(tuple, got), key=repr) == want and {r[-1] for r in want} == {True, False}


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], SCHEMA)
    r = manifest.manifest(docs).first()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] and r["proof_sha256"] == h("") and r["verified"]
    assert manifest.manifest(docs.limit(0)).count() == 0


def test_equal_segments_are_stored_once(spark):
    docs = spark.createDataFrame([(1, "a", lang, "s", 1) for lang in ("en", "de") for _ in range(64)], SCHEMA)
    nodes = docs.select((F.col("lang") == "en").cast("long").alias("tree"), F.lit("x").alias("digest"))
    nodes = nodes.withColumn("n", F.lit(64).cast("long")).withColumn("rank", F.expr("row_number() over (partition by tree order by digest) - 1").cast("long"))
    store, roots = manifest.build(nodes, levels=3)
    assert [s.count() for s in store] == [16, 2] and [s.dropDuplicates(["digest"]).count() for s in store] == [1, 1]
    assert len({r["digest"] for r in roots.collect()}) == 1
    assert all(r["verified"] for r in manifest.manifest(docs, levels=3).collect())


def test_a_few_requests_read_their_segments_only(spark):
    leaves = [h(str(i)) for i in range(100)]
    nodes = spark.createDataFrame([(0, i, 100, x) for i, x in enumerate(leaves)], "tree long, rank long, n long, digest string")
    store, roots = manifest.build(nodes, levels=2)
    starts = roots.withColumn("path", F.array().cast("array<string>"))
    asked = nodes.where("rank in (0, 42, 99)").select("tree", "rank", "n", F.struct("rank").alias("payload"))
    got = {r["payload"]["rank"]: r for r in manifest.descend(store, starts, asked, levels=2).collect()}
    root = roots.first()["digest"]
    assert set(got) == {0, 42, 99} and root == levels_of(leaves, 2)[-1][0]
    for rank, r in got.items():
        assert r["rank"] == rank and r["digest"] == leaves[rank] and manifest.folded(leaves[rank], r["path"][::-1]) == root
        assert manifest.folded(leaves[1], r["path"][::-1]) != root


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    ok, why = compare(op13_manifest(spark, sf), duckdb_connection(sf), ORACLES["op13_manifest"])
    assert ok, why
