"""URL filter by path-template trees.

Per host, the paths form a tree of segments. It is built level by level over
aggregated counts, so that a host of any size is a few rows:

1. Digits and long hexadecimal runs of a segment become ``{n}`` and ``{h}``.
2. At each node, children that hold less than a sixteenth of its urls are a
   variable segment: they become the wildcard ``{*}``, but for those of ``RARE`` urls or
   more whose labelled share or purity differs significantly from the other ones'
   (corrected for the number of tests). These and the rest keep their names.
3. Siblings in order of their labelled share and of their purity are merged
   where neighbours don't differ significantly in either (two-proportion z-tests):
   ``{a|b}``.

A template's purity is its share of bad labels, smoothed towards ``PRIOR``
by ``WEIGHT`` labels; templates of ``REJECT`` or more are blocked. Labels are
what the rules say of the urls they fit, unless a column of labels is given.
Rules come first for the urls they fit; the longest fitting rule wins. Trees grow to
level ``DEPTH``, and on to the paths' real depth at nodes of ``RARE`` urls or more that
hold a bad label, unless all their urls do: without one nothing deeper is blocked.

Rows: a null url, or one without ``://``, has empty host and path, and is
judged by the template of the empty path; repeated urls count each; a path that goes on
where its tree ends has the wildcard ``{**}`` for all further segments; urls of any length are
read whole; extra columns pass through unless a result column has their name; an empty table gives an
empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

#: Levels of every tree, a child below this part of its node's urls may be variable, and urls too few to be tested.
DEPTH, CONSTANTS, RARE = 6, 16, 16
#: Significance of the tests between siblings.
Z = 2.0
#: Smoothing: the purity of a template without labels, how many labels that weighs, and the purity that is rejected.
PRIOR, WEIGHT, REJECT = 0.25, 4.0, 0.5


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end; A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host, up to a question mark, a hash or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def first_fit(rules: list[Rule], host: Column, path: Column, value) -> Column:
    """``value`` of the longest rule that fits, else null. Rules are configuration: a short list."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        out = F.when(r.fits(host, path), F.lit(value(r))).otherwise(out)
    return out


def segments(path: Column) -> Column:
    """Generalised segments."""
    parts = F.slice(F.split(path, "/"), 2, 1 << 30)
    one = lambda s: F.regexp_replace(F.regexp_replace(s, r"(?i)\b(?=[0-9a-f]*[0-9])[0-9a-f]{8,}\b", "{h}"), "[0-9]+", "{n}")
    return F.transform(parts, one)


def differ(a: Column, m: Column, b: Column, n: Column, z: Column | float = Z) -> Column:
    """Do a of m and b of n differ significantly (pooled two-proportion test)? Nothing to compare: no."""
    m1, n1 = (F.greatest(x, F.lit(1)) for x in (m, n))
    share = (a + b) / (m1 + n1)
    spread = F.sqrt(F.greatest(share * (1 - share), F.lit(0.0)) * (1 / m1 + 1 / n1))
    return F.when((m > 0) & (n > 0) & (spread > 0), F.abs(a / m1 - b / n1) > z * spread).otherwise(F.lit(False))


def grow(front: DataFrame, level: int) -> DataFrame:
    """One level of all trees: each row (host, shape, segs, template, n, labelled, bad) with its template one segment longer."""
    node = ["host", "template"]
    here = front.where(F.size("segs") >= level).withColumn("seg", F.element_at("segs", level))
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
    child = here.groupBy(*node, "seg").agg(*sums)
    total = child.groupBy(*node).agg(F.sum("n").alias("all"))
    sized = child.join(total, node).withColumn("small", F.col("n") * CONSTANTS < F.col("all"))
    pool = sized.where("small").groupBy(*node).agg(F.count("*").alias("tests"), *[F.sum(c).alias(f"pool_{c}") for c in ("n", "labelled", "bad")])
    n, labelled, bad = (F.col(f"pool_{c}") - F.col(c) for c in ("n", "labelled", "bad"))
    z = Z + F.sqrt(2 * F.log("tests"))                                     # so many tests exceed Z by chance
    apart = (F.col("n") >= RARE) & (differ(F.col("labelled"), F.col("n"), labelled, n, z)
                                    | ((F.col("labelled") >= RARE) & differ(F.col("bad"), F.col("labelled"), bad, labelled, z)))
    named = sized.join(pool, node, "left").withColumn("name", F.when(F.col("small") & ~apart, F.lit("{*}")).otherwise(F.col("seg")))
    branch = named.groupBy(*node, "name").agg(*sums)
    order = W.partitionBy(*node).orderBy(F.col("labelled") / F.col("n"), F.col("bad") / F.greatest("labelled", F.lit(1)), "name")
    before = lambda c: F.lag(c).over(order)
    new = (before("n").isNull() | differ(F.col("labelled"), F.col("n"), before("labelled"), before("n"))
           | differ(F.col("bad"), F.col("labelled"), before("bad"), before("labelled")))
    grouped = branch.withColumn("new", new.cast("int")).withColumn("group", F.sum("new").over(order))
    merged = grouped.groupBy(*node, "group").agg(F.array_sort(F.collect_list("name")).alias("names"))
    label = F.when(F.size("names") == 1, F.element_at("names", 1)).otherwise(F.concat(F.lit("{"), F.concat_ws("|", "names"), F.lit("}")))
    to = merged.select(*node, F.explode("names").alias("name"), label.alias("label"))
    found = named.select(*node, "seg", "name").join(to, [*node, "name"]).select(*node, "seg", "label")
    grown = (here.join(found, [*node, "seg"])
             .withColumn("template", F.concat_ws("/", "template", "label")).select(*front.columns))
    return materialise(grown.unionByName(front.where(F.size("segs") < level)), "templates")


def closed(front: DataFrame, level: int) -> DataFrame:
    """``front`` with those rows ended in ``{**}`` whose node has nothing to tell apart below."""
    node = ["host", "template"]
    goes_on = F.size("segs") >= level
    open_ = (front.where(goes_on).groupBy(*node).agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "bad")])
             .where((F.col("n") >= RARE) & (F.col("bad") > 0) & (F.col("bad") < F.col("n"))).select(*node, F.lit(True).alias("open")))
    ends = goes_on & F.col("open").isNull()
    return (front.join(open_, node, "left")
            .withColumns({"segs": F.when(ends, F.slice("segs", 1, level - 1)).otherwise(F.col("segs")),
                          "template": F.when(ends, F.concat("template", F.lit("/{**}"))).otherwise(F.col("template"))}).select(*front.columns))


def shape_of(segs: Column) -> Column:
    """The segments as one text that tells their number, too: no segment and one empty segment differ."""
    return F.concat(F.size(segs).cast("string"), F.lit(":"), F.concat_ws("/", segs))


def templates(urls: DataFrame) -> DataFrame:
    """(host, shape, template, purity) of ``urls`` (host, path, bad: 1, 0 or null): one row a different generalised path."""
    segs = segments(F.col("path"))
    front = materialise(urls.select("host", segs.alias("segs"), "bad").withColumn("shape", shape_of(F.col("segs")))
                        .groupBy("host", "shape", "segs").agg(F.count("*").alias("n"), F.count("bad").alias("labelled"),
                                                              F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
                        .withColumn("template", F.lit("")), "shapes")
    level, deep = 1, front.agg(F.max(F.size("segs"))).first()[0] or 0
    while level <= deep:
        front = grow(front, level)
        level += 1
        if DEPTH < level <= deep:
            front = materialise(closed(front, level), "closed")
            deep = front.agg(F.max(F.size("segs"))).first()[0] or 0
    purity = (F.sum("bad") + PRIOR * WEIGHT) / (F.sum("labelled") + WEIGHT)
    judged = front.groupBy("host", "template").agg(purity.alias("purity"))
    return front.select("host", "shape", "template").join(judged, ["host", "template"])


def judge(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", label: Column | None = None) -> DataFrame:
    """(key, host, path, rule, verdict, template, purity), one row a page. ``label`` is 1 for bad, 0 for good, else null."""
    u = F.col(url)
    parsed = pages.select(F.col(key), host_of(u).alias("host"), path_of(u).alias("path"),
                          (F.lit(None).cast("int") if label is None else label.cast("int")).alias("given"))
    host, path = F.col("host"), F.col("path")
    said = first_fit(rules, host, path, lambda r: r.verdict)
    ruled = parsed.select(key, "host", "path", first_fit(rules, host, path, lambda r: r.name).alias("rule"), said.alias("said"),
                          F.coalesce("given", F.when(said.isNotNull(), (said == "block").cast("int"))).alias("bad"))
    tree = materialise(templates(ruled), "tree")
    return (ruled.withColumn("shape", shape_of(segments(path))).join(tree, ["host", "shape"])
            .select(key, "host", "path", "rule",
                    F.coalesce("said", F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                    "template", "purity"))
