"""Exact top-k search over an impact-ordered index, a score at a time.

Integer vectors lie in blocks. Within a block the postings (dimension, vector,
impact) are put into segments by quantised impact: the bit length of the
absolute value. Segments are processed from the highest impact down: one pass
adds a segment's postings to the accumulators of all queries of a chunk (a
product of two matrices). What is left of a vector after a segment is bounded
by Cauchy-Schwarz, norm of the query times norm of the vector's remaining
postings, and a query's k-th best lower bound, carried on from block to block,
proves which vectors can't be members any more. A block is left as soon as few
can; the rest is left only on that proof, and possible members are rescored
exactly in integers.

Rows: vectors that are null or hold a null or non-finite component take no
part; a shorter vector counts as filled with zeros; equal scores go to the
smaller id, also among repeated vectors; repeated ids are candidates each by
itself, except that a query never meets a row of its own id; a null id takes no part;
a vector whose squared length could carry a score out of a long raises ``OverflowError``;
extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bound_arrow, materialise

#: Vectors of one block and queries of one chunk: 8 MB of accumulators.
BLOCK, CHUNK = 4096, 256
#: Blocks that one task takes in turn, the k-th best scores carried on.
RUN = 16
#: Queries that one task holds at most, and the bytes of their vectors (integers and doubles) at most.
TASK_QUERIES, TASK_BYTES = 16_384, 64 << 20
#: Squared length of an integer vector, from which on a score needn't fit into a long (Cauchy-Schwarz).
FARTHEST = 2.0 ** 62


def integer_vectors(vectors: DataFrame, key: str, vector: str, scale: float = 64.0) -> DataFrame:
    """(id, v): floor(scale * component) of each vector that takes part."""
    v = F.col(vector)
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return (vectors.where(F.col(key).isNotNull() & v.isNotNull()).where(ok)
            .select(F.col(key).cast("long").alias("id"),
                    F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("v")))


def packed(rows: DataFrame, name: str, size: int, dims: int, kind: str) -> DataFrame:
    """(name, rows, ids, vals): the rows (group, row, id, v) of a group as byte strings, about ``size`` rows a group."""
    schema = f"{name} long, rows binary, ids binary, vals binary"

    def run(batches):
        held: dict[int, list] = {}
        count = 0

        def out():
            joined = [[np.concatenate(x).tobytes() for x in zip(*h)] for h in held.values()]
            return pa.table({name: pa.array(list(held), pa.int64())} | {
                c: pa.array([x[i] for x in joined], pa.binary()) for i, c in enumerate(("rows", "ids", "vals"))}).to_batches()

        for b in batches:
            group, row, ids = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            v = b.column(3)
            lengths = v.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            dense = np.zeros((len(ids), dims), dtype=kind)
            dense[np.repeat(np.arange(len(ids)), lengths),
                  np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = v.flatten().to_numpy(zero_copy_only=False)
            for g in np.unique(group).tolist():
                at = np.flatnonzero(group == g)
                held.setdefault(g, []).append((row[at], ids[at], dense[at]))
            count += len(ids)
            if count >= size:
                yield from out()
                held, count = {}, 0
        if held:
            yield from out()

    return rows.mapInArrow(run, schema)


def segments(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """A block's segments: (impact of each posting, norms of the vectors, (impact, norms of what remains after it) by falling impact)."""
    level = np.where(v == 0, 0, 1 + np.floor(np.log2(np.maximum(np.abs(v), 1).astype(np.float64)))).astype(np.int8)
    square = v.astype(np.float64) ** 2
    left, after = square.sum(1), []
    whole = np.sqrt(left)
    for top in np.unique(level)[::-1].tolist():
        if top:
            left = left - np.where(level == top, square, 0).sum(1)
            after.append((top, np.sqrt(np.maximum(left, 0)) * (1 + 1e-9)))
    return level, whole, after


class ChunkSearch:
    """The best k of one chunk of queries, over the blocks that come."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, q: np.ndarray, k: int):
        self.row, self.ids, self.q, self.k = rows, ids, q.astype(np.int64), k
        self.qf = self.q.astype(np.float64)
        self.norm = np.sqrt((self.qf ** 2).sum(1))
        self.floor = np.full(len(ids), -np.inf)            # k-th best exact score so far
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]

    def block(self, ids: np.ndarray, v: np.ndarray, level: np.ndarray, whole: np.ndarray, after: list) -> None:
        own = self.ids[:, None] == ids[None, :]
        acc = np.zeros((len(self.ids), len(ids)))
        exact = self.norm[:, None] * (1e-12 * whole)[None, :] + 0.25      # more than rounding can make
        possible = ~own
        for top, left in after:
            acc += self.qf @ np.where(level == top, v, 0).astype(np.float64).T
            if np.median(left) > 0.6 * np.median(whole):
                continue                                    # too early for any proof
            slack = self.norm[:, None] * left[None, :] + exact
            bound = self.floor
            if len(ids) > self.k and not np.isfinite(bound).all():   # no full list yet: take this block's lower bounds
                bound = np.maximum(bound, np.partition(np.where(own, -np.inf, acc - slack), -self.k, axis=1)[:, -self.k])
            possible = (acc + slack >= bound[:, None]) & ~own
            if possible.sum() <= 4 * self.k * len(self.ids):
                break                                       # proved: nothing else can be a member
        for i in np.flatnonzero(possible.any(1)).tolist():
            at = np.flatnonzero(possible[i])
            score = v[at].astype(np.int64) @ self.q[i]                       # exact: integers
            s, d = np.concatenate((self.best[i][0], score)), np.concatenate((self.best[i][1], ids[at]))
            order = np.lexsort((d, -s))[:self.k]
            self.best[i] = s[order], d[order]
            if len(order) == self.k:
                self.floor[i] = s[order[-1]]

    def rows(self):
        n = [len(s) for s, _ in self.best]
        return (np.repeat(self.row, n), np.repeat(self.ids, n), np.concatenate([d for _, d in self.best] or [np.empty(0, np.int64)]),
                np.concatenate([s for s, _ in self.best] or [np.empty(0, np.int64)]))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
          scale: float = 64.0, block: int = BLOCK, chunk: int = CHUNK, run_blocks: int = RUN,
          task_queries: int = TASK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows by integer inner product for each row where ``is_query``.

    Queries meet all rows in blocks: groups of queries x runs of blocks, dealt
    over the cluster by (group, run) with an equality join. Each task keeps
    one group of queries (``task_queries``, less for wide vectors) and one block; the runs' winners
    (k a query and run) are merged by a window. Runs are shorter where there would be fewer than two for each core.
    What is shipped is vectors x groups + queries x runs; for up to ``task_queries`` queries the vectors go once.
    """
    spark = vectors.sparkSession
    bound_arrow(spark)
    v = materialise(integer_vectors(vectors, key, vector, scale), "vectors")
    asked = materialise(integer_vectors(vectors.where(is_query), key, vector, scale)
                        .withColumn("row", F.monotonically_increasing_id()), "queries")
    shape = v.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d"),
                  F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))).alias("high"),
                  F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("far")).first()
    if (shape["far"] or 0.0) >= FARTHEST:
        raise OverflowError(f"the longest vector's square is {shape['far']:.3g}: a score needn't fit into a long")
    n_queries, n, dims = asked.count(), shape["n"], max(1, shape["d"] or 0)
    kind = "<i2" if (shape["high"] or 0) < 1 << 15 else "<i8"
    held_queries = max(chunk, min(task_queries, TASK_BYTES // (16 * dims)))
    n_blocks, n_chunks = max(1, -(-n // block)), max(1, -(-n_queries // held_queries))
    wanted = -(-2 * spark.sparkContext.defaultParallelism // n_chunks)
    n_runs = min(n_blocks, max(-(-n_blocks // run_blocks), wanted))
    group = lambda parts: F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).alias("g")
    held = packed(v.select(group(n_blocks), F.lit(0).cast("long").alias("row"), "id", "v").repartition(n_blocks, "g"),
                  "block", block, dims, kind)
    chunks = packed(asked.select(group(n_chunks), "row", "id", "v").repartition(n_chunks, "g"),
                    "chunk", held_queries, dims, kind)
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>"))
    left = held.select((F.col("block") % n_runs).alias("run"), F.col("ids").alias("b_ids"), F.col("vals").alias("b_vals"),
                       every(n_chunks).alias("chunk"))
    right = chunks.select("chunk", F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"), F.col("vals").alias("q_vals"),
                          every(n_runs).alias("run"))
    pairs = left.join(right, ["chunk", "run"]).sortWithinPartitions("chunk", "run", "q_rows")

    def search(batches):
        now, state = None, None

        def out():
            for part in state:
                row, q, d, s = part.rows()
                yield from pa.table({"row": row, "query_id": q, "vec_id": d, "score": s}).to_batches()

        for b in batches:
            cols = [b.column(x).to_pylist() for x in ("chunk", "run", "b_ids", "b_vals", "q_rows", "q_ids", "q_vals")]
            for c, r, b_ids, b_vals, q_rows, q_ids, q_vals in zip(*cols):
                if (c, r, q_rows) != now:
                    if state is not None:
                        yield from out()
                    now = (c, r, q_rows)
                    row, q_id, q = np.frombuffer(q_rows, np.int64), np.frombuffer(q_ids, np.int64), np.frombuffer(q_vals, kind).reshape(-1, dims)
                    state = [ChunkSearch(row[i:i + chunk], q_id[i:i + chunk], q[i:i + chunk], k) for i in range(0, len(row), chunk)]
                ids, vals = np.frombuffer(b_ids, np.int64), np.frombuffer(b_vals, kind).reshape(-1, dims)
                for i in range(0, len(ids), block):
                    parts = segments(vals[i:i + block])
                    for part in state:
                        part.block(ids[i:i + block], vals[i:i + block], *parts)
        if state is not None:
            yield from out()

    found = pairs.mapInArrow(search, "row long, query_id long, vec_id long, score long")
    best = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
