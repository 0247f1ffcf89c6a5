import hashlib
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattline.llm import bpe, packing
from wattline.llm.common import table

ODD = ["", "a<|endoftext|>b  <|endoftext|>", "aaaaaaaaa aaaa \x1c x aaaaaaa", "É̀́ ́x ΑΣ ΑΣ b", "  \n\n  ", "日本語 テスト 🎉🎉",
       "x" * 3000, "İstanbul I'll've 's 'S <|startoftext|>hi", "ẛ̣ ﬁ \x85 \x1f", "ŉ Ÿ ÀÉ é Ñ ſ ĸ ª º µ ÿ ß ² ¼", "ǅ Ǆ", "abab" * 50, "  　x"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(ODD)] + [(20_000, None), (10_000, ""), (None, "null key")]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, length string")


def test_encode_decode(texts):
    rows, docs = texts
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = bpe.decode(bpe.encode(docs, block_bytes=50_000)).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == tok.decode(ids, skip_special_tokens=False) and r["length"] == "x"
    want = sorted((str(d), len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
                  for d, t in rows for i in [tok.encode(t or "", add_special_tokens=False).ids])
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(docs).collect()) == want
    assert bpe.encode(docs.limit(0)).count() == 0 and bpe.digests(docs.limit(0)).count() == 0


def test_vocabulary_out_of_order_is_refused(tmp_path):
    import json

    letters = bpe.byte_letters()
    vocab = {c: i for i, c in enumerate(letters)} | {"ab": 256, "abc": 257}
    path = tmp_path / "v.json"
    path.write_text(json.dumps({"model": {"vocab": vocab, "merges": [["ab", "c"], ["a", "b"]]}}))
    with pytest.raises(ValueError):
        bpe.PairIndexBpe(str(path))


def test_pack(texts):
    rows, docs = texts
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.pack(docs, size=256, block_bytes=50_000).collect()
    assert len({r["sequence_id"] for r in got}) == len(got)
    pieces = {}
    for r in got:
        assert r["length"] == 1 << r["bucket"] == len(r["ids"]) <= 256 and r["offset"] == 0
        assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r["ids"]))
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["ids"]))
    single = [(d, t) for d, t in rows if d != 10_000]                   # that key is repeated
    for d, t in single:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        parts = sorted(pieces[d, len(ids)])
        assert [i for _, p in parts for i in p] == ids and [s for s, _ in parts] == [sum(len(p) for _, p in parts[:i]) for i in range(len(parts))]
    assert packing.pack(docs.where(F.col("doc_id").isNull())).count() >= 1
    assert packing.pack(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, size=100)


@pytest.mark.parametrize("n, want", [(1, [1]), (2048, [2048]), (2047, [1 << k for k in range(10, -1, -1)]), (5000, [2048, 2048, 512, 256, 128, 8])])
def test_piece_lengths(n, want):
    assert packing.piece_lengths(n, 2048) == want


def test_buckets(spark, texts, tmp_dir):
    packing.write_buckets(packing.pack(texts[1], size=64), tmp_dir)
    back = spark.read.parquet(tmp_dir)
    assert back.where(F.size("ids") != F.pow(F.lit(2), F.col("bucket"))).count() == 0 and back.count() > 0
