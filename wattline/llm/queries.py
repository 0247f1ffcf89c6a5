"""The thin ``opN_<name>`` queries over the given tables, and SQL for those that it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, chat, manifest, mixing, multiset, packing, sharding, simhash, substring, topk, toxicity, urls
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a field trained on the labels that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    crf = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), crf)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted", "spans")


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 40 words or more that a document shares with a smaller one."""
    return substring.passages(table(spark, sf_dir, "documents"))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut into power-of-two sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), size=2048, end_id=1).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that imitates another template's marks, rendered and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    odd = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, "assistant", says)],
                                "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(rows.unionByName(odd)))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their fingerprint and the smallest doc_id they reach."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


URL_RULES = [urls.Rule("block", "net", "/"), urls.Rule("allow", "example.net", "/en/"),
             urls.Rule("block", "example.com", "/de/"), urls.Rule("allow", "org", "/fr/")]


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages judged by the rules, or else by their path's template."""
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def op7_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, their edited texts and their successors by fingerprint."""
    return multiset.edited_likeness(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again, as counts and digests."""
    return bpe.digests(table(spark, sf_dir, "documents"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of equal row counts, equal texts together where they fit."""
    return sharding.balanced_shards(table(spark, sf_dir, "documents"), shards=8)


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for each vector whose id is divisible by 20."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors by the nearest of 40 centroids after five rounds."""
    return centroids.described(*centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2, dims=64, scale=256)).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with what the mix takes of them: weights 3, 1, 2, 150 % of all words, each source twice at most."""
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), budget=(3, 2), most=2)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as leaves of the manifest, every seventh verified after tampering."""
    docs = table(spark, sf_dir, "documents")
    return manifest.manifest(docs, claimed=manifest.tampered(docs)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_substring, op3_pack, op4_chat, op5_simhash, op6_urls, op7_multiset, op8_bpe, op9_shards, op10_topk,
                                   op11_centroids, op12_mix, op13_manifest)}

_ESCAPE = r"""regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"""
_NEEDS = r"""regexp_matches({0}, '<\\*\|')"""
_SAID = "CASE WHEN " + _NEEDS.format("role") + " OR " + _NEEDS.format("text") + " THEN length(" + _ESCAPE.format("role") \
    + ") + length(" + _ESCAPE.format("text") + ") ELSE length(role) + length(text) END"


def _lloyd(rounds: int) -> str:
    """Lloyd's rounds over (vector, dimension) rows, one pair of tables a round."""
    parts = ["""v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             "x AS MATERIALIZED (SELECT r, generate_subscripts(v, 1) AS dim, unnest(v) AS val FROM v)",
             """c0 AS MATERIALIZED (SELECT cluster, generate_subscripts(v, 1) AS dim, unnest(v) AS val FROM (
  SELECT v, row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS cluster FROM v WHERE vec_id IS NOT NULL) WHERE cluster < 40)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, cluster, d FROM (
  SELECT r, cluster, d, row_number() OVER (PARTITION BY r ORDER BY d, cluster) AS best FROM (
    SELECT x.r, c.cluster, sum((x.val - c.val) * (x.val - c.val)) AS d FROM x JOIN c{i} c ON x.dim = c.dim GROUP BY x.r, c.cluster)) WHERE best = 1)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.cluster, c.dim, coalesce(m.val, c.val) AS val FROM c{i} c LEFT JOIN (
  SELECT cluster, dim, ((s - ((s % n) + n) % n) // n)::BIGINT AS val FROM (
    SELECT a.cluster, x.dim, sum(x.val)::BIGINT AS s, count(*) AS n FROM a{i} a JOIN x ON a.r = x.r GROUP BY a.cluster, x.dim)) m
  ON c.cluster = m.cluster AND c.dim = m.dim)""")
    return "WITH " + ",\n".join(parts) + f""",
told AS (SELECT cluster, sha256(string_agg(val::VARCHAR, ',' ORDER BY dim)) AS h FROM c{rounds} GROUP BY cluster)
SELECT v.vec_id, a.cluster::INTEGER AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, told.h AS centroid_sha256
FROM a{rounds} a JOIN v ON a.r = v.r JOIN told ON told.cluster = a.cluster"""


def _field(x: str) -> str:
    return f"coalesce(strlen(({x})::VARCHAR) || ':' || ({x})::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


#: CRC-32 of the decimal doc_id, byte by byte and bit by bit (there is no such function).
_CRC32 = """xor(4294967295, list_reduce(
  list_concat([4294967295::BIGINT], list_transform(range(1, len(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT)),
  lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                             lambda x, zero: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


ORACLES = {
    "op4_chat": f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(25 + {_SAID})::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id""",
    "op10_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20""",
    "op11_centroids": _lloyd(5),
    "op12_mix": """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '-') || ':' || md5(coalesce(text, ''))), 1, 12))::UBIGINT / (1::BIGINT << 48)::DOUBLE AS draw
  FROM documents),
sources AS (
  SELECT source, s, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS w
  FROM (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source)),
-- from the source that is first to be above: what the stopped ones before leave, and the weights from it on
filled AS (
  SELECT *, 3 * sum(s) OVER () - 2 * coalesce(sum(2 * s) OVER before, 0) AS share, 2 * sum(w) OVER onward AS parts FROM sources
  WINDOW before AS (ORDER BY s / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         onward AS (ORDER BY s / w::DOUBLE, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
stopped AS (SELECT *, bool_and(2 * s * parts < w * share) OVER (ORDER BY s / w::DOUBLE, source NULLS LAST) AS above FROM filled),
last AS (SELECT (3 * sum(s) - 2 * coalesce(sum(2 * s) FILTER (above), 0))::BIGINT AS share, (2 * sum(w) FILTER (NOT above))::DOUBLE AS parts FROM stopped),
rates AS (SELECT source, s, CASE WHEN above THEN (2 * s)::DOUBLE ELSE (w * last.share)::DOUBLE / last.parts END AS target FROM stopped, last),
rated AS (SELECT *, CASE WHEN s > 0 THEN target / s ELSE 0 END AS rate FROM rates)
SELECT doc_id, size, s AS source_size, target, (size * (floor(rate)::BIGINT + (draw < rate - floor(rate))::BIGINT))::BIGINT AS taken,
       (floor(rate)::BIGINT + (draw < rate - floor(rate))::BIGINT)::BIGINT AS copies
FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source""",
    "op13_manifest": f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, row_number() OVER () AS r FROM (
    SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
           CASE WHEN coalesce(({_CRC32}) % 7 = 0, false) THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS claim FROM documents)),
low AS (
  SELECT lang, 0 AS level, rank AS i, count(*) OVER (PARTITION BY lang) AS n, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY lang, level, i // 2),
subroots AS MATERIALIZED (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, place AS i, count(*) OVER () AS n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY level, i // 2),
nodes AS MATERIALIZED (SELECT place, 0 AS part, level, i, n, low.h FROM low JOIN subroots ON low.lang IS NOT DISTINCT FROM subroots.lang
  UNION ALL SELECT -1, 1, level, i, n, h FROM high),
steps AS MATERIALIZED (
  SELECT r, way.part, way.level, row_number() OVER (PARTITION BY r ORDER BY way.part, way.level) AS step, pos % 2 = 1 AS odd, coalesce(s.h, '') AS other FROM (
    SELECT r, 0 AS part, nodes.level, nodes.place, rank >> nodes.level AS pos FROM leaves
    JOIN subroots ON leaves.lang IS NOT DISTINCT FROM subroots.lang
    JOIN nodes ON nodes.place = subroots.place AND part = 0 AND n > 1 AND nodes.i = rank >> nodes.level
    UNION ALL
    SELECT r, 1, nodes.level, -1, subroots.place >> nodes.level AS pos FROM leaves
    JOIN subroots ON leaves.lang IS NOT DISTINCT FROM subroots.lang
    JOIN nodes ON part = 1 AND n > 1 AND nodes.i = subroots.place >> nodes.level) way
  LEFT JOIN nodes s ON s.place = way.place AND s.part = way.part AND s.level = way.level AND s.i = xor(pos, 1)),
fold AS (
  SELECT r, 0::BIGINT AS step, claim AS h FROM leaves
  UNION ALL
  SELECT fold.r, steps.step, sha256(CASE WHEN odd THEN other || h ELSE h || other END) FROM fold JOIN steps ON steps.r = fold.r AND steps.step = fold.step + 1),
ends AS (SELECT r, arg_max(h, step) AS folded_root FROM fold GROUP BY r),
proofs AS (SELECT leaves.r, sha256(coalesce(string_agg(other, '' ORDER BY step), '')) AS proof_sha256 FROM leaves LEFT JOIN steps ON steps.r = leaves.r GROUP BY leaves.r),
root AS (SELECT h AS root FROM high WHERE n = 1)
SELECT doc_id, leaf, subroots.h AS subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots ON leaves.lang IS NOT DISTINCT FROM subroots.lang JOIN ends ON ends.r = leaves.r JOIN proofs ON proofs.r = leaves.r, root""",
}
