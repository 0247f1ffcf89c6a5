import zlib
from collections import Counter, defaultdict

from wattline.llm import sharding
from wattline.llm.common import table


def check(rows, shards=8):
    """The law of rows, and gapless slots; returns the shards of each text's checksum."""
    counts = Counter(r["shard"] for r in rows)
    full = [counts.get(s, 0) for s in range(shards)]
    assert sum(full) == len(rows) and max(full) - min(full) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    groups = defaultdict(set)
    for r in rows:
        groups[r["text_crc32"]].add(r["shard"])
    return groups


def test_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    rows = sharding.balanced_shards(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    assert all((r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 1, zlib.crc32(texts[r["doc_id"]])) for r in rows)
    assert all(len(s) == 1 for s in check(rows).values())       # every group of copies fits and lies together


def test_group_of_a_third_is_divided_as_little_as_needed(spark):
    texts = ["hot"] * 400 + [f"pair {i // 2}" for i in range(200)] + [f"single {i}" for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = check(sharding.balanced_shards(docs).collect())
    assert len(groups[zlib.crc32(b"hot")]) <= 4                 # 400 rows, shards of 150
    assert sum(len(groups[zlib.crc32(f"pair {i}".encode())]) > 1 for i in range(100)) <= 5


def test_rows_of_all_kinds(spark):
    rows = [(1, None, "s"), (1, None, "s"), (None, "", "s"), (2, "x" * 100_000, None), (2, "x" * 100_000, None), (3, "é", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    got = sharding.balanced_shards(docs, shards=2).collect()
    groups = check(got, 2)
    assert sorted(r["size"] for r in got) == [1, 1, 1, 3, 100_001, 100_001]
    assert len(groups[0]) == 1 and len(groups[zlib.crc32(b"x" * 100_000)]) == 1
    assert sharding.balanced_shards(docs.limit(0)).count() == 0
    assert len(check(sharding.balanced_shards(docs.limit(3)).collect())[0]) == 3   # fewer rows than shards
