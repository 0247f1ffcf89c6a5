"""Mixing sources to target weights by repetition rates.

Words are runs of characters other than ASCII white space. Words are added up
per source; the sources, in order of their code points (a null source
last), get ``weights`` in turn and share ``budget`` times all words by them. No source
gets more than ``most`` times its own words: what such a source leaves is
shared again among the others by weight, until none is above. Target over words
is the source's rate; each document is emitted floor(rate) times, and once more if a
number in [0, 1) drawn from its hash is less than the rate's fraction.

The draws are independent of each other, so a source's words differ from its target by
about sqrt(f (1 - f) sum of squared sizes), f the fraction: 1 % for 19,000
documents, a tenth for 50. Nothing depends on the order or place of rows: reruns agree.

One row a source is all that is ever gathered by source, and words are added up before
the shuffle; sources are numbered by contiguous runs, not in one task, and the
driver gets two sums a round. The rates are broadcast if they are at most
``BROADCAST_SOURCES``; else the join is salted, so that a large source is ``SALT`` keys.

Rows: a null text has no words; a null source is a source; a source without
words has target and rate zero; a null key is drawn by its text, rows that
repeat key and text are drawn alike; extra columns pass through ``emit``,
whose ``copy`` numbers copies from 1 (a clashing column is replaced); an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Sources whose rates (some 100 bytes each) are broadcast, at most; beyond that a source is so many keys of a join.
BROADCAST_SOURCES, SALT = 50_000, 64


def words(text: str = "text") -> Column:
    """Number of words."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: str = "doc_id", text: str = "text", seed: int = 0) -> Column:
    """A number in [0, 1) from the hash of seed, key and text."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("-")), F.lit(":"),
                    F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(said.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size) with ``place``, from 0 in order of code points, null last."""
    order = [F.col("source").isNull(), F.col("source")]
    runs = materialise(sources.repartitionByRange(*order).withColumn("run", F.spark_partition_id()), "sources")
    counts = runs.groupBy("run").agg(F.count("*").alias("n")).withColumn("one", F.lit(1))
    before = W.partitionBy("one").orderBy("run").rowsBetween(W.unboundedPreceding, -1)      # one row a run
    starts = counts.select("run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(W.partitionBy("run").orderBy(*order))
    return runs.join(starts, "run").select("source", "source_size", (F.col("start") + inside - 1).alias("place"))


def targets(sized: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """(source, source_size, target, rate) of ``sized`` (source, size). ``budget`` is a fraction of all words.

    A source is above its target while ``most`` times its words are less than
    its share: compared as integers, so no rounding decides. Rounds end when no further source is.
    """
    whole = lambda c: c.cast("decimal(38,0)")
    sources = numbered(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = materialise(sources.select("source", "source_size", weight.cast("long").alias("weight")), "weights")
    limit = F.col("source_size") * most
    up, down = budget
    total = int(sources.agg(F.sum("source_size")).first()[0] or 0)
    share, parts, above = 0, 1, F.lit(False)                # a source's share: weight * share / parts
    left = None
    while True:
        held = sources.select(F.sum(F.when(above, limit).otherwise(0)).alias("stopped"),
                              F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("open")).first()
        now = (int(held["stopped"] or 0), int(held["open"] or 0))
        if now == left or not now[1]:
            break
        left = now
        share, parts = up * total - down * now[0], down * now[1]
        above = whole(limit) * F.lit(parts).cast("decimal(38,0)") < whole(F.col("weight")) * F.lit(share).cast("decimal(38,0)")
    fair = whole(F.col("weight") * F.lit(share)).cast("double") / F.lit(float(parts))
    target = F.when(above, limit.cast("double")).otherwise(fair)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return materialise(sources.select("source", "source_size", target.alias("target"), rate.alias("rate")), "rates")


def copies(sized: DataFrame, rates: DataFrame) -> DataFrame:
    """``sized`` (source, draw, …) with source_size, target and ``copies``: floor(rate), and one more where draw < fraction."""
    side = rates.select(F.col("source").alias("_source"), "source_size", "target", "rate")
    same = F.col("source").eqNullSafe(F.col("_source"))
    if rates.count() <= BROADCAST_SOURCES:
        joined = sized.join(F.broadcast(side), same)
    else:
        side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        salted = sized.withColumn("_grain", (F.col("draw") * SALT).cast("int"))
        joined = salted.join(side.hint("merge"), same & (F.col("_grain") == F.col("_salt"))).drop("_grain", "_salt")
    extra = (F.col("draw") < F.col("rate") - F.floor("rate")).cast("long")
    return joined.withColumn("copies", F.floor("rate") + extra).drop("_source", "rate")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0,
        weights: Sequence[int] = (3, 1, 2), budget: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """(key, size, source_size, target, taken, copies) of each document."""
    sized = materialise(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), words(text).alias("size"),
                                    draw(key, text, seed).alias("draw")), "sized")
    rates = targets(sized, weights, budget, most)
    return copies(sized, rates).select(F.col("key").alias(key), "size", "source_size", "target",
                                       (F.col("size") * F.col("copies")).alias("taken"), "copies")


def emit(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0,
         weights: Sequence[int] = (3, 1, 2), budget: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """The mixed corpus: each document's row, all columns, as often as the mix takes it, with ``copy`` from 1."""
    docs = docs.drop("copy")
    rates = targets(docs.select(F.col(source).alias("source"), words(text).alias("size")), weights, budget, most)
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(source).alias("source"), draw(key, text, seed).alias("draw"))
    taken = copies(packed, rates).where("copies > 0")
    return taken.select("row.*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
