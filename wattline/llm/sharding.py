"""Sharding by balanced label propagation.

Documents of equal text are linked. Every document begins in a shard that its
row's hash names. In each round a group's documents look at where their
neighbours are (one count per group and shard, aggregated before the
shuffle) and ask to move to the fullest shard of their group that is still
open. A shard takes at most what its quota leaves free: if more ask, a
hash draws, by group, so that small groups move as a whole, and by row for a
group that is large beside a shard. Documents without neighbours cost no cut
edge wherever they are, so they make room: the quota counts linked documents,
and at the end each shard's surplus, documents without neighbours first and then
those of groups that are divided anyway, fills the shards that lack rows. Row counts then differ by one at most.

A group larger than a shard fills one, then the next. What the driver gathers is
one number per shard. All of it is DataFrame joins and aggregations.

Rows: a null text is no bytes and is linked to other null and empty texts; keys may be
null or repeated, as rows are numbered when they are first written; repeated
rows are linked and are placed each by itself; extra columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

ROUNDS = 12
#: Rows of one numbering bucket, about.
BUCKET_ROWS = 5_000
#: A shard with less than this part of its quota free is closed.
FULL = 0.1
#: A group larger than this part of a shard may be divided.
DIVIDED = 64


def draw(*cols) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 20)) / F.lit(float(1 << 20))


def accepted(free: float, asked: float) -> float:
    """The part of those who ask that may move: two standard deviations less than would fill the shard on average."""
    if asked <= free:
        return 1.0
    return max(0.0, free - 2 * (free * (1 - free / asked)) ** 0.5) / asked if free > 4 else 1.0 / asked


def by_shard(values: dict[int, float], shard: Column, kind: str) -> Column:
    """A number for each shard, as a literal map."""
    return F.element_at(F.create_map(*[F.lit(x) for s, v in values.items() for x in (int(s), v)]), shard).cast(kind)


def propagate(state: DataFrame, quota: dict[int, int], rounds: int) -> DataFrame:
    """Move the linked rows of ``state`` (row, gid, large, shard) between shards, never filling one beyond its quota by intent."""
    for turn in range(rounds):
        load = {s: 0 for s in quota} | {r["shard"]: r["count"] for r in state.groupBy("shard").count().collect()}
        free = {s: float(quota[s] - load[s]) for s in quota}
        free = {s: x if x > FULL * quota[s] else 0.0 for s, x in free.items()}
        if not any(free.values()):
            break
        open_to = F.col("shard").isin([s for s in free if free[s] > 0])
        pieces = (state.groupBy("gid", "shard").agg(F.count("*").alias("here"))          # ties: by a hash, closed shards last
                  .withColumn("pull", F.col("here") * (1 << 20) + F.when(open_to, F.pmod(F.xxhash64("gid", "shard"), F.lit(1 << 20)))
                              .otherwise(-1)))
        best = pieces.groupBy(F.col("gid").alias("g")).agg(
            F.max_by(F.when(open_to, F.col("shard")), F.when(open_to, F.col("pull"))).alias("to"),
            F.max(F.when(open_to, F.col("pull"))).alias("top"))
        moves = materialise(pieces.join(best, F.col("gid") == F.col("g")).where("top > pull")
                            .select("gid", F.col("shard").alias("from"), "to", "here"), "moves")
        asked = {r["to"]: r["n"] for r in moves.groupBy("to").agg(F.sum("here").alias("n")).collect()}
        if not asked:
            break
        chance = {s: accepted(free[s], asked.get(s, 0)) for s in quota}
        drawn = F.when(F.col("large"), draw("row", F.lit(turn))).otherwise(draw("gid", F.lit(turn)))
        asks = moves.select(F.col("gid").alias("g"), F.col("from"), "to")
        state = materialise(
            state.join(asks, (F.col("gid") == F.col("g")) & (F.col("shard") == F.col("from")), "left")
            .select("row", "gid", "large", F.when(F.col("to").isNotNull() & (drawn < by_shard(chance, F.col("to"), "double")), F.col("to"))
                    .otherwise(F.col("shard")).alias("shard")), "state")
    return state


def balanced_shards(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) by the law of ``rows``."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = materialise(docs.select(F.col(key).alias("key"), (F.octet_length(t) + 1).cast("long").alias("size"),
                                   F.crc32(t.cast("binary")).alias("text_crc32"), F.xxhash64(t).alias("gid"),
                                   F.monotonically_increasing_id().alias("row")), "rows")
    n = rows.count()
    quota = {s: n // shards + (s < n % shards) for s in range(shards)}
    start = F.pmod(F.xxhash64("row", F.lit(shards)), F.lit(shards)).cast("int").alias("shard")
    groups = rows.groupBy("gid").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("gid").alias("g"), (F.col("n") > max(1, n // shards // DIVIDED)).alias("large"))
    linked = materialise(rows.select("row", "gid").join(groups, F.col("gid") == F.col("g")).select("row", "gid", "large", start), "state")
    placed = propagate(linked, quota, rounds).select("row", F.col("shard").alias("at"), F.col("large").cast("int").alias("tier"))

    buckets = max(1, n // (shards * BUCKET_ROWS))
    where = materialise(rows.join(placed, "row", "left").select(
        "key", "size", "text_crc32", "row", F.coalesce("tier", F.lit(2)).alias("tier"), F.coalesce("at", start).alias("shard"),
        F.pmod(F.xxhash64("row", F.lit(-1)), F.lit(buckets)).alias("bucket")), "placed")
    parts = ["shard", "tier", "bucket"]
    before = W.partitionBy("shard").orderBy("tier", "bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = where.groupBy(*parts).agg(F.count("*").alias("n"))
    offsets = counts.select(*parts, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = where.join(offsets, parts).withColumn(
        "slot", F.col("offset") + F.row_number().over(W.partitionBy(*parts).orderBy("row")) - 1)

    load = {s: 0 for s in quota} | {r["shard"]: r["n"] for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    surplus, lacking, given, taken = {}, [], 0, 0
    for s in quota:
        surplus[s] = given - quota[s]                       # a surplus row's number is its slot plus this
        given += max(0, load[s] - quota[s])
        if load[s] < quota[s]:
            lacking.append((taken, s, load[s]))
            taken += quota[s] - load[s]
    over = F.col("slot") >= by_shard(quota, F.col("shard"), "long")
    number = F.col("slot") + by_shard(surplus, F.col("shard"), "long")
    shard, slot = F.col("shard"), F.col("slot")
    for first, s, held in lacking:                          # the last that begins at or before the number holds
        shard = F.when(over & (number >= first), F.lit(s)).otherwise(shard)
        slot = F.when(over & (number >= first), number - first + held).otherwise(slot)
    return numbered.select(F.col("key").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
                           slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
