"""Merkle manifest of a dataset as a content-addressed DAG.

A row's leaf is H (lowercase hex SHA-256 of concatenated text) of its fields,
each ``-`` if null, else its length in UTF-8 bytes, ``:`` and its value. Leaves of
one group ascend by key; while several nodes remain, every ``FANOUT`` consecutive
ones (of the last run those that are left, even one) become their H. The groups'
roots, in order of group (null first, then by bytes), give the dataset's root likewise.

Building. Leaves are numbered in contiguous runs (``repartitionByRange``), so no
task holds a group. Every ``FANOUT ** LEVELS`` consecutive nodes are one segment: a task builds the
levels above them and stores the segment's digest with the record digest → children of each of its inner
nodes; the segments' digests are the nodes of the next round. Equal segments are
stored once, as their digest is their key.

Descending. Requests are (group, rank); those of one segment are one row. From the root
down, a join on the digest fetches each requested segment; in it the rank's
digits select a child at a time, and the children that aren't selected make a step,
``left siblings.right siblings``, of the path. The segment that a path ends in starts the
next round's join with that path. Reversed, the steps of all segments lead from the leaf to the root.

The driver gets the number of groups and whether a round is the last. Rows: a null key is text ``-`` and comes
first; rows that repeat a key are ordered by their leaf, and repeated rows are
leaves each; null and empty fields differ (``-`` and ``0:``); a group of one row has
that row's leaf as root; extra columns are ignored; an empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bound_arrow, materialise

#: Children of a node, at most; levels of a segment, whose nodes (256 leaves' worth) one task holds.
FANOUT, LEVELS = 2, 8
#: Groups whose roots (some 150 bytes each) are broadcast, at most.
BROADCAST_GROUPS = 50_000

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def said(value: Column) -> Column:
    """A field as it enters a leaf."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(said, fields)).cast("binary"), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ranked(rows: DataFrame, group: list[Column], order: list[str]) -> DataFrame:
    """``rows`` with ``tree`` (the group's number in order, null first), ``rank`` in its group from 0 and ``n``, the group's rows.

    ``rows`` must be a written, narrow table. A run is a contiguous part of all rows; what
    meets in one place is one row a run, and one a group and run for each group.
    """
    by = [*group, *order]
    runs = materialise(rows.repartitionByRange(*by, "_row").withColumn("_run", F.spark_partition_id())
                       .withColumn("_group", F.struct(*group)), "leaf_runs")
    parts = runs.groupBy("_group", "_run").agg(F.count("*").alias("_here"))
    whole = W.partitionBy("_group")
    before = whole.orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("_group", "_run", F.coalesce(F.sum("_here").over(before), F.lit(0)).alias("_start"), F.sum("_here").over(whole).alias("n"))
    # a group begins in the run where it has its first row; groups are numbered run by run
    heads = materialise(parts.where("_start = 0"), "groups")
    begun = heads.groupBy("_run").agg(F.count("*").alias("_k")).withColumn("_one", F.lit(1))
    earlier = W.partitionBy("_one").orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    begun = begun.select("_run", F.coalesce(F.sum("_k").over(earlier), F.lit(0)).alias("_first"))
    trees = heads.join(begun, "_run").select(
        "_group", (F.col("_first") + F.row_number().over(W.partitionBy("_run").orderBy("_group")) - 1).alias("tree"))
    inside = F.row_number().over(W.partitionBy("_run", "_group").orderBy(*order, "_row"))
    parts = materialise(parts.join(trees, "_group"), "places")
    return (runs.withColumn("_at", inside).join(parts.withColumnRenamed("_run", "_r").withColumnRenamed("_group", "_g"),
                                                (F.col("_run") == F.col("_r")) & (F.col("_group") == F.col("_g")))
            .withColumn("rank", F.col("_start") + F.col("_at") - 1).drop("_run", "_r", "_g", "_group", "_at", "_start", "_row"))


def grown(nodes: list[str], levels: int, fanout: int) -> tuple[str, list[dict]]:
    """The digest ``levels`` above ``nodes``, and the record of each inner node."""
    records = []
    for _ in range(levels):
        up = []
        for i in range(0, len(nodes), fanout):
            children = nodes[i:i + fanout]
            up.append(digest("".join(children)))
            records.append({"digest": up[-1], "children": children})
        nodes = up
    return nodes[0], records


def height(n: int, fanout: int) -> int:
    """Levels above ``n`` nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


RECORDS = "array<struct<digest: string, children: array<string>>>"


def segments(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(tree, rank, n, digest, levels, records): each segment of ``nodes`` (tree, rank, n, digest), as a node of the next round."""
    size = fanout ** levels
    rows = (nodes.select("tree", F.expr(f"rank div {size}").alias("block"), "rank", "n", "digest")
            .repartition("tree", "block").sortWithinPartitions("tree", "block", "rank"))
    kinds = pa.schema([("tree", pa.int64()), ("rank", pa.int64()), ("n", pa.int64()), ("digest", pa.string()), ("levels", pa.int32()),
                       ("records", pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))])))])

    def run(batches):
        now, held = None, []

        def closed():
            tree, block, n = now
            up = min(levels, height(n, fanout))
            top, records = grown(held, up, fanout)
            return {"tree": tree, "rank": block, "n": -(-n // fanout ** up), "digest": top, "levels": up, "records": records}

        for b in batches:
            out = []
            for tree, block, n, node in zip(*(b.column(c).to_pylist() for c in ("tree", "block", "n", "digest"))):
                if (tree, block, n) != now:
                    if now:
                        out.append(closed())
                    now, held = (tree, block, n), []
                held.append(node)
            yield pa.RecordBatch.from_pylist(out, kinds)
        if now:
            yield pa.RecordBatch.from_pylist([closed()], kinds)

    return rows.mapInArrow(run, f"tree long, rank long, n long, digest string, levels int, records {RECORDS}")


def build(nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """The store, one table of segments a round from the leaves up, and (tree, digest, rounds): each tree's root and how many rounds it took.

    ``nodes``: (tree, rank, n, digest).
    """
    bound_arrow(nodes.sparkSession)
    store, roots = [], []
    while True:
        roots.append(nodes.where("n = 1").select("tree", "digest", F.lit(len(store)).alias("rounds")))
        nodes = nodes.where("n > 1")
        if nodes.isEmpty():
            return store, reduce(DataFrame.unionByName, roots)
        store.append(materialise(segments(nodes, fanout, levels), "segments"))
        nodes = store[-1].select("tree", "rank", "n", "digest")


def step_down(at: DataFrame, segment: DataFrame, wanted: DataFrame, fanout: int, levels: int, payload: str) -> DataFrame:
    """(tree, rank, digest, path, payload) of the wanted nodes of the segments that ``at`` (tree, rank, digest, path) is at.

    ``wanted``: (tree, rank, asked): ranks within the segment and what comes with each.
    """
    records = segment.dropDuplicates(["digest"]).select(F.col("digest").alias("held"), "levels", "records")
    rows = at.join(wanted, ["tree", "rank"]).join(records, F.col("digest") == F.col("held")).select(
        "tree", "rank", "digest", "path", "asked", "levels", "records")
    size = fanout ** levels
    schema = f"tree long, rank long, digest string, path array<string>, payload {payload}"

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                tree, rank, top, path, up = (b.column(c)[i].as_py() for c in ("tree", "rank", "digest", "path", "levels"))
                children = {r["digest"]: r["children"] for r in b.column("records")[i].as_py()}
                asked = b.column("asked")[i].values
                ranks, ends, paths = [], [], []
                for place in asked.field("place").to_pylist():
                    node, steps = top, list(path)
                    for level in reversed(range(up)):
                        mine = place // fanout ** level % fanout
                        run_ = children[node]
                        steps.append("".join(run_[:mine]) + "." + "".join(run_[mine + 1:]))
                        node = run_[mine]
                    ranks.append(rank * size + place)
                    ends.append(node)
                    paths.append(steps)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * len(ranks), pa.int64()), pa.array(ranks, pa.int64()), pa.array(ends, pa.string()),
                     pa.array(paths, pa.list_(pa.string())), asked.field("payload")], names=["tree", "rank", "digest", "path", "payload"])

    return rows.mapInArrow(run, schema)


def descend(store: list[DataFrame], starts: DataFrame, requests: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """(tree, rank, digest, path, payload): each request's node and its path, from the root down.

    ``starts``: (tree, digest, rounds, path), each tree's root and the steps that led there; ``requests``: (tree, rank, n, payload), each
    once, ``n`` being the tree's leaves.
    """
    size, payload = fanout ** levels, requests.schema["payload"].dataType.simpleString()
    nothing = F.lit(True)
    asked = [requests.groupBy("tree", F.expr(f"rank div {size}").alias("block")).agg(
        F.collect_list(F.struct(F.expr(f"cast(rank % {size} as int)").alias("place"), "payload")).alias("asked")).withColumnRenamed("block", "rank")]
    for _ in store[1:]:
        up = asked[-1].groupBy("tree", F.expr(f"rank div {size}").alias("block")).agg(
            F.collect_list(F.struct(F.expr(f"cast(rank % {size} as int)").alias("place"), nothing.alias("payload"))).alias("asked"))
        asked.append(materialise(up.withColumnRenamed("block", "rank"), "asked"))
    lone = starts.where("rounds = 0").join(requests.where("n = 1"), "tree").select("tree", "rank", "digest", "path", "payload")
    at = None
    for k in reversed(range(len(store))):
        here = starts.where(F.col("rounds") == k + 1).select("tree", F.lit(0).cast("long").alias("rank"), "digest", "path")
        at = here if at is None else at.unionByName(here)
        at = step_down(at, store[k], asked[k], fanout, levels, payload if k == 0 else "boolean")
        if k:
            at = materialise(at.drop("payload"), "descent")
    return lone if at is None else at.unionByName(lone)


def folded(claim: str, path: list[str]) -> str:
    """The root that a leaf's digest leads to by the steps of its path, from the leaf up."""
    for step in path:
        left, right = step.split(".")
        claim = digest(left + claim + right)
    return claim


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS,
             claimed: Sequence[Column] | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """(key, leaf, subroot, root, path, claim, folded_root, proof_sha256, verified) of each row.

    ``path``: steps from the leaf to the root. ``claimed``: the fields of the row that is to be verified (default: the row's own);
    ``folded_root`` is what its leaf, ``claim``, gives along the path.
    """
    own = [F.col(f) for f in fields]
    rows = materialise(docs.select(F.col(key).alias("key"), F.col(group).alias("group"), leaf(own).alias("leaf"),
                                   (leaf(claimed) if claimed is not None else leaf(own)).alias("claim"),
                                   F.monotonically_increasing_id().alias("_row")), "leaves")
    nodes = materialise(ranked(rows, [F.col("group")], ["key", "leaf"]).withColumnRenamed("leaf", "digest"), "ranked")
    store, subroots = build(nodes.select("tree", "rank", "n", "digest"), fanout, levels)
    subroots = materialise(subroots, "subroots")
    n = subroots.count()
    groups = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.lit(n).cast("long").alias("n"), "digest", "rounds")
    above, roots = build(groups.drop("rounds"), fanout, levels)
    roots = materialise(roots, "root")                                                        # one row
    first = roots.withColumn("path", F.array().cast("array<string>"))
    starts = descend(above, first, groups.select("tree", "rank", "n", F.struct("rounds").alias("payload")), fanout, levels)
    starts = materialise(starts.join(F.broadcast(roots.select("tree", F.col("digest").alias("root"))), "tree").select(
        F.col("rank").alias("tree"), "digest", F.col("payload.rounds").alias("rounds"), "path", "root"), "starts")
    leaves = descend(store, starts.drop("root"), nodes.select("tree", "rank", "n", F.struct("key", "claim").alias("payload")), fanout, levels)
    tops = starts.select("tree", F.col("digest").alias("subroot"), "root")
    joined = leaves.join(F.broadcast(tops) if n <= BROADCAST_GROUPS else tops.hint("merge"), "tree").select(
        F.col("payload.key").alias("key"), F.col("payload.claim").alias("claim"), F.col("digest").alias("leaf"), "subroot", "root",
        F.reverse("path").alias("path"))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            paths = b.column("path").to_pylist()
            ends = [folded(c, p) for c, p in zip(b.column("claim").to_pylist(), paths)]
            proofs = [digest("".join(s.replace(".", "") for s in p)) for p in paths]
            good = [e == r for e, r in zip(ends, b.column("root").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(ends, pa.string()), pa.array(proofs, pa.string()), pa.array(good, pa.bool_())],
                names=[*b.schema.names, "folded_root", "proof_sha256", "verified"])

    out = joined.mapInArrow(run, f"key {kind}, claim string, leaf string, subroot string, root string, path array<string>, "
                                 "folded_root string, proof_sha256 string, verified boolean")
    return out.withColumnRenamed("key", key)


def tampered(docs: DataFrame, key: str = "doc_id", count: str = "n_chars", every: int = 7) -> list[Column]:
    """The fields of each row after one was added to ``count`` where ``every`` divides the key's CRC-32."""
    hit = F.crc32(F.col(key).cast("string").cast("binary")) % every == 0
    more = F.when(hit, (F.col(count).cast("decimal(38,0)") + 1).cast("string")).otherwise(F.col(count).cast("string"))
    return [more if f == count else F.col(f) for f in FIELDS]
