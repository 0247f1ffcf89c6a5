"""SimHash near-duplicates with BK-trees.

Words are runs of bytes other than ASCII white space, A-Z lower-cased; a
document's fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of
all its shingles of four words. Fingerprints at most four bits apart are linked.

Searching one tree over everything would compare nearly every pair (64-bit
fingerprints lie about 32 bits apart, where a radius of four prunes little).
So the fingerprint space is cut into shards first: the 64 bits are six blocks,
and two fingerprints at most four bits apart agree in at least two whole blocks;
each of the fifteen pairs of blocks sends a fingerprint to the shard that
its bits there name. Every shard has a BK-tree whose children are keyed by the
integer Hamming distance to their parent, and a search follows only the edges
within the radius. Different fingerprints only are searched, so groups of
copies cost nothing. A shard of more than ``SHARD`` fingerprints is split into
trees of bounded size, and its fingerprints are sent to each of them, as a
broadcast would, but without a whole tree on every machine. A tree emits
at most one link for each fingerprint that came to it (a spanning forest), never all pairs.

Rows: null and empty texts, and texts of white space only, have fingerprint
zero and are linked like any other; fewer than four words make one shingle;
repeated rows have equal fingerprints; a null key gets its component as any
row, and the smallest key ignores nulls; extra columns are ignored; an empty
table gives an empty table. Texts of any length are hashed whole.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, bound_arrow, materialise
from .graph import components

#: Bits (low, width) of the blocks; two fingerprints within RADIUS bits agree in two of them.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
RADIUS = 4
#: Fingerprints of one tree.
SHARD = 4096
#: Shingles whose bits are counted at once.
COUNTED = 1 << 16


def fingerprint(text: str, shingle: int = 4) -> int:
    """The 64-bit fingerprint of a whole text, as a signed integer."""
    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, 42)], dtype=np.uint64)
    else:
        ends = list(accumulate(map(len, words)))
        ends = [e + i for i, e in enumerate(ends)]
        starts = [0, *[e + 1 for e in ends]]
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(line[a:b], 42) for a, b in zip(starts, ends[shingle - 1:])], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), COUNTED):
        part = hashes[i:i + COUNTED].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = 4) -> DataFrame:
    """``docs`` with a long column of fingerprints."""
    bound_arrow(docs.sparkSession)
    schema = docs.withColumn(name, F.lit(0).cast("long")).schema

    def run(batches):
        for t in blocks(batches, text, 4 << 20):
            out = pa.array([fingerprint(x or "", shingle) for x in t.column(text).to_pylist()], pa.int64())
            yield from t.append_column(name, out).to_batches()

    return docs.mapInArrow(run, schema)


class BkTree:
    """Fingerprints as nodes; the children of a node are keyed by their Hamming distance to it."""

    def __init__(self):
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, x: int) -> int:
        at = len(self.value)
        self.value.append(x)
        self.children.append({})
        if at:
            node = 0
            while True:
                d = (self.value[node] ^ x).bit_count()
                if (down := self.children[node].get(d)) is None:
                    self.children[node][d] = at
                    break
                node = down
        return at

    def near(self, x: int, radius: int) -> list[int]:
        """Numbers of all nodes within the radius."""
        if not self.value:
            return []
        found, look = [], [0]
        while look:
            node = look.pop()
            d = (self.value[node] ^ x).bit_count()
            if d <= radius:
                found.append(node)
            kids = self.children[node]
            if len(kids) > 2 * radius + 1:
                look += [kids[e] for e in range(d - radius, d + radius + 1) if e in kids]
            else:
                look += [n for e, n in kids.items() if -radius <= e - d <= radius]
        return found


def shard_links(tree: list[int], probes: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``tree``, and between ``probes`` and ``tree``."""
    bk, root = BkTree(), list(range(len(tree)))
    links = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(x: int, found: list[int], at: int | None) -> None:
        tops = {find(i) for i in found}
        if at is not None:
            tops.add(at)
        if tops and (len(tops) > 1 or at is None):
            top = min(tops)
            for i in tops:
                root[i] = top
                if i != top and i != at:
                    links.append((tree[i], tree[top]))
            if at is None or top != at:
                links.append((x, tree[top]))

    for i, x in enumerate(tree):
        found = bk.near(x, radius)
        bk.add(x)
        join(x, found, i)
    for x in probes:
        join(x, bk.near(x, radius), None)
    return links


def shards_of(value: Column) -> Column:
    """The fifteen shards of a fingerprint: number of the pair of blocks, and the bits of both."""
    def bits(low: int, width: int) -> Column:
        return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
    return F.array(*[F.lit(n << 32).cast("long") + F.shiftleft(bits(*a), 16) + bits(*b)
                     for n, (a, b) in enumerate(combinations(BLOCKS, 2))])


def links(values: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that connect the different fingerprints ``values`` (f) as all links within the radius would."""
    if radius > RADIUS:
        raise ValueError(f"the blocks prove links up to {RADIUS} bits")
    at = values.select(F.explode(shards_of(F.col("f"))).alias("shard"), "f")
    large = (at.groupBy("shard").count().where(F.col("count") > shard)
             .select(F.col("shard").alias("large"), F.ceil(F.col("count") / shard).cast("int").alias("trees")))
    own = F.pmod(F.xxhash64("f", F.lit(3)), F.coalesce("trees", F.lit(1))).cast("int")
    dealt = (at.join(large, F.col("shard") == F.col("large"), "left").withColumn("own", own)
             .select("shard", "f", "own", F.explode(F.when(F.col("trees").isNull(), F.array(F.lit(0)))
                                                    .otherwise(F.sequence(F.col("own"), F.col("trees") - 1))).alias("tree")))
    rows = (dealt.select("shard", "tree", (F.col("own") != F.col("tree")).cast("int").alias("probe"), "f")
            .repartition("shard", "tree").sortWithinPartitions("shard", "tree", "probe", "f"))
    bound_arrow(values.sparkSession, 20_000)

    def run(batches):
        now, tree, probes, out = None, [], [], []

        def found(x):                                       # trees hold unsigned numbers, whose xor has a popcount
            pairs = np.array(x, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]}).to_batches()

        for b in batches:
            s, t, p, f = (b.column(i).to_numpy() for i in range(4))
            f = f.view(np.uint64)
            cut = np.flatnonzero((s[1:] != s[:-1]) | (t[1:] != t[:-1])) + 1
            for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(s)]):
                if i == j:
                    continue
                key = (int(s[i]), int(t[i]))
                if key != now:
                    if len(tree) + len(probes) > 1:
                        out += shard_links(tree, probes, radius)
                    now, tree, probes = key, [], []
                mid = i + int(np.searchsorted(p[i:j], 1))
                tree += f[i:mid].tolist()
                probes += f[mid:j].tolist()
                if len(probes) > 4 * shard:                 # many probes: a part of the links now, the tree stays
                    out += shard_links(tree, probes, radius)
                    probes = []
            if len(out) > 10_000:
                yield from found(out)
                out = []
        if len(tree) + len(probes) > 1:
            out += shard_links(tree, probes, radius)
        yield from found(out)

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = RADIUS) -> DataFrame:
    """(key, fingerprint, component_id): the smallest key that each document reaches over links."""
    marked = materialise(with_fingerprints(docs.select(key, text), text, "_f", shingle).select(key, F.col("_f").alias("f")), "fingerprints")
    return marked.join(classes(marked, key, radius), "f").select(
        key, F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id"))


def classes(marked: DataFrame, key: str, radius: int = RADIUS) -> DataFrame:
    """(f, least): each different fingerprint of ``marked`` with the smallest ``key`` of its component."""
    first = materialise(marked.groupBy("f").agg(F.min(key).alias("first")), "classes")
    reached = components(links(first.select("f"), radius)).select(F.col("node").alias("f"), "component")
    least = first.join(reached, "f", "left").select("f", "first", F.coalesce("component", "f").alias("component"))
    return least.join(least.groupBy("component").agg(F.min("first").alias("least")), "component").select("f", "least")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest key (nulls last), the first of them if rows repeat.

    Rows are numbered once and written with their fingerprints, so that
    repeated rows can be told apart; columns stay as they are.
    """
    marked = materialise(with_fingerprints(docs, text, "_simhash", shingle)
                         .withColumn("_simhash_row", F.monotonically_increasing_id()), "fingerprints")
    order = F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.col("_simhash_row").alias("r"))
    rank = marked.select(F.col("_simhash").alias("f"), order.alias("o"))
    keep = classes(rank, "o", radius).select(F.col("least.r").alias("_simhash_row")).distinct()
    return marked.join(keep, "_simhash_row", "left_semi").select(*docs.columns)
