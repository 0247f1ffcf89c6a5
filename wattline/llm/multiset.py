r"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A text is the multiset of its paragraphs (the pieces between newlines). Each
paragraph is hashed to a wide vector, and a document's vector is the sum of its
paragraphs' vectors, lane by lane, modulo 2^32. The sum doesn't depend on the
order, and paragraphs can be inserted (``plus``) or deleted (``minus``) without
the rest of the text. The vector has two parts:

* 8 lanes of the paragraph's SHA-256, which decide equality;
* 64 lanes that sum, over each word of the paragraph and its successor in it, +1 or
  -1 by the bits of their XXH64. Paragraphs that share words in sequence have
  like vectors there, so the cosine of the signed lanes is a likeness (0 to 1).

All of it is DataFrame work: the lanes are 32 integer sums of two counters each.

Rows: a null text counts as empty (one empty paragraph); two empty texts have
likeness 1; texts of any length are hashed whole; extra columns are ignored; an
empty table gives an empty table. Ties and repeated rows: see ``edited_likeness``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, next_rows

LANES, EQUAL_LANES = 64, 8
POWER = 1 << 32
#: Adds bit j and bit j + 32 of a hash into the two halves of one sum.
TWO_COUNTERS = (1 << 32) + 1


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n")


def equality(text: Column) -> Column:
    """The equality lanes of a text: SHA-256 words of its paragraphs, summed modulo 2^32."""
    words = F.transform(paragraphs(text), lambda p: F.sha2(p, 256))
    zero = F.array(*[F.lit(0).cast("long")] * EQUAL_LANES)
    def add(acc: Column, sha: Column) -> Column:
        return F.array(*[F.pmod(acc[i] + F.conv(F.substring(sha, 8 * i + 1, 8), 16, 10).cast("long"), F.lit(POWER))
                         for i in range(EQUAL_LANES)])
    return F.aggregate(words, zero, add)


def features(text: Column) -> Column:
    """XXH64 of each word with its successor in the paragraph (the last word alone)."""
    words = F.transform(paragraphs(text), lambda p: F.split(p, " "))
    return F.flatten(F.transform(words, lambda w: F.zip_with(w, F.slice(w, 2, F.size(w)), lambda a, b: F.xxhash64(a, b))))


def lanes_of(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` with ``equal`` and ``lanes``: the two parts of each text's vector, for rows that ``keys`` tell apart.

    The lanes stay with their keys: if ``texts`` is already dealt by some of
    ``keys``, nothing is shuffled. All buffers are integers, so that the sums
    run in a hash aggregation.
    """
    spread = (texts.select(*keys, equality(F.col(text)).alias("equal"), features(F.col(text)).alias("_f"))
              .select(*keys, "equal", F.explode_outer("_f").alias("_word")))
    sums = [F.sum(F.shiftrightunsigned("_word", j).bitwiseAND(F.lit(TWO_COUNTERS))).alias(f"_s{j}") for j in range(32)]
    counted = spread.groupBy(*keys, "equal").agg(F.count("_word").alias("_words"), *sums)
    def lane(j: int) -> Column:
        pair = F.coalesce(F.col(f"_s{j % 32}"), F.lit(0).cast("long"))
        ones = F.shiftrightunsigned(pair, 32) if j >= 32 else pair.bitwiseAND(F.lit(POWER - 1))
        return F.pmod(2 * ones - F.col("_words"), F.lit(POWER))
    return counted.select(*keys, "equal", F.array(*[lane(j) for j in range(LANES)]).alias("lanes"))


def plus(a: Column, b: Column) -> Column:
    """The vector of both multisets together."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + y, F.lit(POWER)))


def minus(a: Column, b: Column) -> Column:
    """The vector of what is left when ``b`` is deleted from ``a``."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x - y, F.lit(POWER)))


def as_text(equal: Column, lanes: Column) -> Column:
    """Both parts as hexadecimal digits."""
    return F.concat_ws("", F.transform(F.concat(equal, lanes), lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))))


def likeness(a_equal: Column, a: Column, b_equal: Column, b: Column) -> Column:
    """Cosine of the signed lanes, 0 to 1; 1 for equal fingerprints, 0 beside a vector of zeros."""
    signed = lambda v: F.transform(v, lambda x: (F.when(x >= POWER // 2, x - POWER).otherwise(x)).cast("double"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    x, y = signed(a), signed(b)
    norms = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    cosine = F.when(norms > 0, dot(x, y) / norms).otherwise(F.lit(0.0))
    return F.when((a_equal == b_equal) & (a == b), F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, equal, lanes, fingerprint) of each row's text; equal rows of one key share one result row."""
    keyed = docs.select(F.col(key).alias("_k"), F.coalesce(text, F.lit("")).alias("_t")).distinct()
    found = lanes_of(keyed.withColumn("_x", F.xxhash64("_t")), ["_k", "_x"], "_t")
    return found.select(F.col("_k").alias(key), "equal", "lanes", as_text(F.col("equal"), F.col("lanes")).alias("fingerprint"))


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of an edited text and of the next document.

    The edited text has its last quarter of code points replaced by the first
    as many (or all) of the next document, in order of the key (null keys last;
    rows of equal key by the hash of their text; the last is followed by the
    first). Rows of equal key and text follow each other: all but one are
    followed by their own copy. One row per row of ``docs``.

    The texts are shuffled once, by key and hash. What the next document gives
    (a quarter of the text at most) is sent to its predecessor; the order
    itself is found on keys and lengths alone.
    """
    k = ["_n", "_d", "_h"]
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).isNull().alias("_n"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("_d"),
                       F.xxhash64(t).alias("_h"), t.alias("_t"))
    seen = rows.select(*k, F.char_length("_t").cast("long").alias("_len")).groupBy(*k, "_len").agg(F.count("*").alias("_m"))
    order = materialise(next_rows(seen, k, k), "order")
    quarter = F.floor(F.col("_len") / 4).cast("int")
    first = F.lag(F.lit(1)).over(W.partitionBy(*k).orderBy("_n")).isNull()
    texts = rows.withColumn("_first", first).where("_first").drop("_first")          # one of each repeated row
    asked = order.select(*[F.col(f"next_{c}").alias(c) for c in k], *[F.col(c).alias(f"to{c}") for c in k], "_len", "_m",
                         quarter.alias("_q"))
    given = texts.join(asked, k).select(*[F.col(f"to{c}").alias(c) for c in k], "_len", "_m", "_q",
                                        F.expr("substring(_t, 1, _q)").alias("_head"))
    kept = F.expr("substring(_t, 1, cast(_len - _q as int))")
    both = texts.join(given, k).select(*k, "_len", "_m", "_t", F.concat(kept, F.col("_head")).alias("_e"),
                                       F.when(F.col("_m") > 1, F.concat(kept, F.expr("substring(_t, 1, _q)"))).alias("_c"))
    version = lambda w, c: F.struct(F.lit(w).alias("w"), F.col(c).alias("t"))
    which = (both.select(*k, "_len", "_m", F.explode(F.array(version(0, "_t"), version(1, "_e"), version(2, "_c"))).alias("_x"))
             .where("_x.t is not null")
             .select(*k, "_len", "_m", F.col("_x.w").alias("_w"), F.unhex(F.sha2("_x.t", 256)).alias("_sha"), F.col("_x.t").alias("_t")))
    found = lanes_of(which, [*k, "_len", "_m", "_w", "_sha"], "_t")
    part = lambda w: F.get(F.filter("_all", lambda x: x["_w"] == w), F.lit(0))
    wide = materialise(found.groupBy(*k, "_len", "_m").agg(F.collect_list(F.struct("_w", "_sha", "equal", "lanes")).alias("_all"))
                       .select(*k, "_len", "_m", part(0).alias("own"), part(1).alias("edited"), part(2).alias("copied")), "lanes")
    after = (order.select(*k, *[F.col(f"next_{c}").alias(f"to{c}") for c in k])
             .join(wide.select(*[F.col(c).alias(f"to{c}") for c in k], F.col("own.equal").alias("next_equal"),
                               F.col("own.lanes").alias("next_lanes")), [f"to{c}" for c in k])
             .select(*k, "next_equal", "next_lanes"))
    line = wide.join(after, k)
    col = F.col
    near_next = likeness(col("own.equal"), col("own.lanes"), col("next_equal"), col("next_lanes"))
    variant = lambda x, n, near: F.struct(
        F.lower(F.hex(col(f"{x}._sha"))).alias("sha"), as_text(col(f"{x}.equal"), col(f"{x}.lanes")).alias("f"),
        likeness(col("own.equal"), col("own.lanes"), col(f"{x}.equal"), col(f"{x}.lanes")).alias("near"), near.alias("next"), n.alias("n"))
    return (line.select("*", F.explode(F.when(col("_m") > 1, F.array(
        variant("edited", F.lit(1).cast("long"), near_next), variant("copied", col("_m") - 1, F.lit(1.0))))
        .otherwise(F.array(variant("edited", F.lit(1).cast("long"), near_next)))).alias("v"))
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), col("v.n"))).alias("_i"))
        .select(F.when(~col("_n"), col("_d")).alias(key), col("_len").alias("n_chars"), col("v.sha").alias("edited_sha256"),
                as_text(col("own.equal"), col("own.lanes")).alias("fingerprint"), col("v.f").alias("edited_fingerprint"),
                col("v.near").alias("near_edited"), col("v.next").alias("near_next")))
