"""Clustering of vectors by Lloyd's rounds, sharded by dimension.

Vectors become integers and are cut into blocks: ``CHUNK`` vectors by ``WIDTH``
columns. A shard is a block of columns; it holds its slice of each centroid. A round:

1. Each block's task computes the exact squared distances of its vectors to all
   centroids in its columns, from its shard's slice alone.
2. The partial distances of a chunk's blocks are added up by chunk, and each
   vector takes the nearest centroid (ties: the smaller number).
3. The labels go back to the blocks. Each shard adds its columns up per cluster (partial
   sums before the shuffle) and replaces its slice by floor(sum / count); a
   cluster without vectors keeps its centroid.

No task sees whole vectors or whole centroids. A slice is ``k * WIDTH`` integers, a bound of parameters, and is
broadcast; nothing passes through the driver.

Rows: vectors that are null, of another length, or with null or non-finite components
take no part; rows that repeat id or vector are vectors each; a vector without id is
clustered but is no start; fewer vectors than ``k`` give fewer centroids; extra columns
are ignored; an empty table gives an empty table. A distance must fit a long: components
beyond ``LARGEST`` raise ``OverflowError``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_arrow, materialise

#: Vectors and columns of a block.
CHUNK, WIDTH = 1024, 16
#: Absolute value of an integer component, at most.
LARGEST = 1 << 26


def whole(vector: Column, dims: int) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dims) & ~bad, F.lit(False))


def blocks_of(rows: DataFrame, dims: int, scale: int, chunk: int, width: int) -> DataFrame:
    """(chunk, shard, ids, n, block): ``rows`` (id, vector) cut into blocks; the chunk's ids are with shard 0."""
    bound_arrow(rows.sparkSession, chunk)
    kinds = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("ids", pa.list_(pa.int64())), ("n", pa.int32()), ("block", pa.binary())])

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        for b in batches:
            if not b.num_rows:
                continue
            values = np.floor(b.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).reshape(-1, dims)
            if np.abs(values).max() > LARGEST:
                raise OverflowError(f"a component times {scale} is beyond {LARGEST}: distances may not fit a long")
            values, ids = values.astype(np.int32), b.column("id").to_pylist()
            rows_ = [{"chunk": (task << 32) + number, "shard": s, "ids": None if s else ids, "n": len(ids),
                      "block": values[:, at:at + width].tobytes()} for s, at in enumerate(range(0, dims, width))]
            number += 1
            yield pa.RecordBatch.from_pylist(rows_, kinds)

    return rows.mapInArrow(run, "chunk long, shard int, ids array<long>, n int, block binary")


def starts(rows: DataFrame, k: int, seed: int, dims: int, scale: int, width: int) -> DataFrame:
    """(shard, slice): the ``k`` vectors of the smallest digests of ``seed:id``, in that order, cut into slices."""
    told = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    whole_ = F.transform("vector", lambda x: F.floor(x.cast("double") * scale))
    first = materialise(rows.where("id IS NOT NULL").select(told.alias("told"), whole_.alias("vector")).orderBy("told", "vector").limit(k), "starts")
    order = first.agg(F.array_sort(F.collect_list(F.struct("told", "vector"))).alias("all"))             # k rows
    cells = order.select(F.posexplode("all").alias("cluster", "v")).select("cluster", F.posexplode("v.vector").alias("dim", "value"))
    return sliced(cells, width)


def sliced(cells: DataFrame, width: int) -> DataFrame:
    """(shard, slice): cells (cluster, dim, value) as one array a shard, cluster by cluster."""
    rows = cells.groupBy(F.expr(f"cast(dim div {width} as int)").alias("shard")).agg(
        F.array_sort(F.collect_list(F.struct("cluster", "dim", "value"))).alias("cells"))
    return rows.select("shard", F.col("cells.value").alias("slice"))


def partial_distances(blocks: DataFrame, slices: DataFrame) -> DataFrame:
    """(chunk, n, parts): the squared distances of each block's vectors to all centroids in the block's columns."""
    rows = blocks.select("chunk", "shard", "n", "block").join(F.broadcast(slices), "shard").drop("shard")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                n = b.column("n")[i].as_py()
                x = np.frombuffer(b.column("block")[i].as_buffer(), dtype=np.int32).reshape(n, -1).astype(np.int64)
                c = b.column("slice")[i].values.to_numpy().reshape(-1, x.shape[1])
                parts = np.stack([((x - row) ** 2).sum(1) for row in c], axis=1)
                yield pa.RecordBatch.from_pydict({"chunk": [b.column("chunk")[i].as_py()], "n": pa.array([n], pa.int32()), "parts": [parts.tobytes()]})

    return rows.mapInArrow(run, "chunk long, n int, parts binary")


def nearest(parts: DataFrame) -> DataFrame:
    """(chunk, labels, distances): the partial distances of each chunk added up, and who is nearest."""
    rows = parts.repartition("chunk").sortWithinPartitions("chunk")
    kinds = pa.schema([("chunk", pa.int64()), ("labels", pa.list_(pa.int32())), ("distances", pa.list_(pa.int64()))])

    def run(batches):
        now, total = None, None

        def closed():
            label = total.argmin(1)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([label.astype(np.int32)], kinds.field(1).type),
                                               pa.array([total[np.arange(len(label)), label]], kinds.field(2).type)], schema=kinds)

        for b in batches:
            for i in range(b.num_rows):
                chunk, n = b.column("chunk")[i].as_py(), b.column("n")[i].as_py()
                part = np.frombuffer(b.column("parts")[i].as_buffer(), dtype=np.int64).reshape(n, -1)
                if chunk != now:
                    if now is not None:
                        yield closed()
                    now, total = chunk, part.copy()
                else:
                    total += part
        if now is not None:
            yield closed()

    return rows.mapInArrow(run, "chunk long, labels array<int>, distances array<long>")


def updated(blocks: DataFrame, labels: DataFrame, slices: DataFrame, width: int) -> DataFrame:
    """Each shard's new slice: floors of its clusters' means, the old values where a cluster is empty."""
    rows = blocks.select("chunk", "shard", "n", "block").join(labels.select("chunk", "labels"), "chunk")

    def run(batches):
        sums, counts = {}, {}
        for b in batches:
            for i in range(b.num_rows):
                shard, n = b.column("shard")[i].as_py(), b.column("n")[i].as_py()
                x = np.frombuffer(b.column("block")[i].as_buffer(), dtype=np.int32).reshape(n, -1).astype(np.int64)
                label = b.column("labels")[i].values.to_numpy()
                for c in np.unique(label).tolist():
                    mine = x[label == c]
                    sums[shard, c] = sums.get((shard, c), 0) + mine.sum(0)
                    counts[shard, c] = counts.get((shard, c), 0) + len(mine)
        keys = list(sums)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([s for s, _ in keys], pa.int32()), "cluster": pa.array([c for _, c in keys], pa.int32()),
                                          "n": pa.array([counts[x] for x in keys], pa.int64()),
                                          "sums": pa.array([sums[x] for x in keys], pa.list_(pa.int64()))})

    told = rows.mapInArrow(run, "shard int, cluster int, n long, sums array<long>")
    cell = (told.select("shard", "cluster", "n", F.posexplode("sums").alias("col", "part"))
            .groupBy("shard", "cluster", "col").agg(F.sum("part").alias("s"), F.sum("n").alias("n"))
            .select("cluster", (F.col("shard") * width + F.col("col")).alias("dim"), F.expr("(s - pmod(s, n)) div n").alias("value")))
    old = slices.select("shard", F.posexplode("slice").alias("at", "old"))
    old = old.select(F.expr(f"cast(at div {width} as int)").alias("cluster"), (F.col("shard") * width + F.col("at") % width).alias("dim"), "old")
    both = old.join(cell, ["cluster", "dim"], "left").select("cluster", "dim", F.coalesce("value", "old").alias("value"))
    return sliced(both, width)


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 40, rounds: int = 5, seed: int = 2,
            dims: int = 64, scale: int = 256, chunk: int = CHUNK, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(key, cluster, distance) of each vector after ``rounds`` rounds, and (cluster, dim, value), the final centroids.

    ``width`` must divide ``dims``.
    """
    if dims % width:
        raise ValueError(f"blocks of {width} columns don't divide {dims} dimensions")
    rows = vectors.where(whole(F.col(vector), dims)).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"))
    blocks = materialise(blocks_of(rows, dims, scale, chunk, width), "blocks")
    slices = materialise(starts(rows, k, seed, dims, scale, width), "slices")
    bound_arrow(vectors.sparkSession, 16)                   # rows are blocks now
    for turn in range(rounds + 1):
        labels = materialise(nearest(partial_distances(blocks, slices)), "labels")
        if turn < rounds:
            slices = materialise(updated(blocks, labels, slices, width), "slices")
    bound_arrow(vectors.sparkSession)
    ids = blocks.where("shard = 0").select("chunk", "ids")
    out = ids.join(labels, "chunk").select(F.explode(F.arrays_zip("ids", "labels", "distances")).alias("x")).select(
        F.col("x.ids").alias(key), F.col("x.labels").alias("cluster"), F.col("x.distances").alias("distance"))
    cells = slices.select("shard", F.posexplode("slice").alias("at", "value")).select(
        F.expr(f"cast(at div {width} as int)").alias("cluster"), (F.col("shard") * width + F.col("at") % width).alias("dim"), "value")
    return out, cells


def described(found: DataFrame, cells: DataFrame) -> DataFrame:
    """``found`` (key, cluster, distance) with its cluster's inertia, that of all, and its centroid's digest."""
    text = F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))), lambda c: c["value"].cast("string")))
    told = cells.groupBy("cluster").agg(F.sha2(text.cast("binary"), 256).alias("centroid_sha256"))
    per = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    one = F.lit(1).alias("one")
    total = per.agg(F.sum("cluster_inertia").alias("inertia")).select(one, "inertia")
    clusters = per.join(told, "cluster").select("*", one).join(F.broadcast(total), "one").drop("one")
    return found.join(F.broadcast(clusters), "cluster")     # at most k rows
