"""Landed API pages (JSON): one object per page with a ``results`` array.

Pages are read from files, never fetched here. Files may hold one page per
line (splittable) or one pretty-printed page each (``multi_line=True``).
The page number comes from the ``page=N`` folder the page was landed in, so
"first seen" keeps the order the API returned. The ``next`` links must make one chain (see ``chained``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.codes import product_code
from ..functions.money import strict_double
from ..functions.time import iso_z, month_start, parse_instant, to_uk_wall_clock
from ..operators.dedupe import first_per_key
from ..operators.series import join_null_safe
from ..schemas import PAGE_SIZE, RATE_PAGE, USAGE_PAGE
from ..session import materialise


def _read(spark: SparkSession, path: str, schema, multi_line: bool) -> DataFrame:
    # FAILFAST: a malformed page fails the load instead of turning into NULLs.
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


class PageChainError(ValueError):
    """The landed pages aren't one whole chain: a page is missing, there twice, branches off or closes a circle."""


def _numbered(pages: DataFrame) -> DataFrame:
    """``pages`` with ``page``: the ``page=N`` folder, or the last number of the file's name."""
    if "page" not in pages.columns:
        number = F.regexp_extract("_metadata.file_name", r"(\d+)\D*$", 1).try_cast("long")
        pages = pages.withColumn("page", F.when(number.isNotNull(), number).otherwise(F.raise_error(
            F.concat(F.lit("no page number in the file name "), F.col("_metadata.file_name")))))
    # Lines of one file come in the order of its splits, and within a split in order.
    return pages.withColumns({"__file": F.col("_metadata.file_path"), "__line": F.struct(
        F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("line"))})


def chained(pages: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``pages`` with ``place``, their place from 0 in the chain of their ``next`` links; ``PageChainError`` if they aren't one chain.

    A page is called by its ``page`` number; of several pages in one file the first has it, and each
    further one is the page that the one before it links to. Pointer doubling counts the pages to the end: each
    round joins every page with the one its link points at and doubles how far it points, so n pages take log2(n) rounds of
    joins over (group, page, next) alone. Pages of which none links on keep the order of their numbers and lines.
    """
    group = list(group)
    pages = materialise(_numbered(pages), "pages")          # parsed once; the rounds read three of its columns
    inside = Window.partitionBy(*group, "__file").orderBy("__line")
    target = F.regexp_extract("next", r"[?&]page=(\d+)", 1).try_cast("long")
    odd = F.col("next").isNotNull() & target.isNull()
    links = pages.select(*group, "page", "__file", "__line", F.when(odd, F.raise_error(
        F.concat(F.lit("a link without a page number: "), F.col("next")))).otherwise(target).alias("to"))
    before = F.lag("to").over(inside)
    first = F.row_number().over(inside) == 1
    links = materialise(links.select("*", F.when(first, F.col("page")).otherwise(before).alias("id"),
                                     (~first & before.isNull()).alias("stray")), "links")
    linked = links.groupBy(*group).agg(F.max("to").isNotNull().alias("__linked"))
    if group:
        links = join_null_safe(links, linked, group, "inner")
    else:
        links = links.withColumn("__linked", F.lit(bool(linked.first()[0])))
    named = lambda r: ", ".join(f"{g}={r[g]}" for g in group)
    chain = materialise(links.where("__linked"), "chain")

    def refuse(found: DataFrame, what: str, column: str) -> None:
        if row := found.orderBy(*group, column).head(1):
            where = f" ({named(row[0])})" if group else ""
            raise PageChainError(f"{what} {row[0][column]}{where}")

    refuse(chain.where("stray"), "a page follows the last one in the file of page", "page")
    refuse(chain.groupBy(*group, "id").count().where("count > 1"), "there twice: page", "id")
    refuse(chain.where("to IS NOT NULL").groupBy(*group, "to").count().where("count > 1"), "several pages link to page", "to")
    known = chain.select(*group, F.col("id").alias("to"))
    refuse(chain.where("to IS NOT NULL").join(known, [*group, "to"], "left_anti"), "missing: page", "to")
    heads = chain.select(*group, "id").join(chain.where("to IS NOT NULL").select(*group, F.col("to").alias("id")), [*group, "id"], "left_anti")
    refuse(heads.groupBy(*group).agg(F.count("*").alias("n"), F.max("id").alias("id")).where("n > 1"), "no page links to page", "id")

    hops = chain.select(*group, "id", "to", F.when(F.col("to").isNull(), 0).otherwise(1).cast("long").alias("left"))
    pages_left, limit = chain.count(), 1
    while limit <= 2 * max(pages_left, 1):                   # after k rounds a page points 2^k pages on
        hops = materialise(hops, "hops")
        if hops.where("to IS NOT NULL").isEmpty():
            break
        far = hops.select(*group, F.col("id").alias("to"), F.col("to").alias("__on"), F.col("left").alias("__more"))
        hops = hops.join(far, [*group, "to"], "left").select(
            *group, "id", F.when(F.col("to").isNotNull(), F.col("__on")).alias("to"),
            (F.col("left") + F.coalesce("__more", F.lit(0))).alias("left"))
        limit *= 2
    refuse(hops.where("to IS NOT NULL"), "the links close a circle at page", "id")
    longest = hops.groupBy(*group).agg(F.max("left").alias("__all"))
    hops = hops.join(longest, group) if group else hops.withColumn("__all", F.lit(longest.first()[0]))
    order = Window.partitionBy(*group, "page").orderBy("__file", "__line")
    placed = chain.select(*group, "__file", "__line", "id").join(hops, [*group, "id"]).select(
        "__file", "__line", F.struct((F.col("__all") - F.col("left")).alias("n"), F.lit(0).alias("k")).alias("place"))
    loose = links.where(~F.col("__linked")).select("__file", "__line", F.struct(
        F.col("page").cast("long").alias("n"), (F.row_number().over(order) - 1).cast("int").alias("k")).alias("place"))
    return pages.join(placed.unionByName(loose), ["__file", "__line"]).drop("__file", "__line")


def _rows(pages: DataFrame, extra: list[str], group: Sequence[str] = ()) -> DataFrame:
    """Explode ``results`` with (page, pos) as the arrival order: the page's place in its chain, the row's in the page."""
    placed = chained(pages, group)
    return placed.select(*[F.col("place").alias("page") if c == "page" else c for c in extra], F.posexplode("results").alias("pos", "r"))


def usage_rows(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Half-hour readings: timestamp from ``interval_start`` else ``consumption_start``."""
    pages = _read(spark, path, USAGE_PAGE, multi_line)
    rows = _rows(pages, ["page"])
    start = F.coalesce(F.col("r.interval_start"), F.col("r.consumption_start"))
    utc = parse_instant(start)
    return rows.select("page", "pos",
                       utc.alias("interval_start_utc"),
                       to_uk_wall_clock(utc).alias("interval_start_uk"),
                       strict_double("r.consumption").alias("kwh"))


def usage_batch(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Readings ready to load: first reading per UTC slot in page order."""
    rows = usage_rows(spark, path, multi_line)
    return (first_per_key(rows, ["interval_start_utc"], ["page", "pos"])
            .select("interval_start_utc", "interval_start_uk", "kwh"))


def rate_rows(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Unit rates landed under ``tariff_code=<code>/page=<n>/``; first per (code, valid_from)."""
    pages = _read(spark, path, RATE_PAGE, multi_line)
    rows = _rows(pages, ["tariff_code", "page"], ["tariff_code"])
    frm = parse_instant("r.valid_from")
    to = parse_instant("r.valid_to")
    out = rows.select("tariff_code", "page", "pos",
                      product_code("tariff_code").alias("product_code"),
                      frm.alias("valid_from_utc"), to.alias("valid_to_utc"),
                      to_uk_wall_clock(frm).alias("valid_from_uk"),
                      to_uk_wall_clock(to).alias("valid_to_uk"),
                      strict_double("r.value_inc_vat").alias("unit_rate"))
    return (first_per_key(out, ["tariff_code", "valid_from_utc"], ["page", "pos"])
            .drop("page", "pos"))


def month_rows(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Monthly totals: renamed columns, offsets dropped at UTC, month as a date."""
    pages = _read(spark, path, USAGE_PAGE, multi_line)
    rows = _rows(pages, ["page"]).select("page", "pos", "r.*")
    rows = rows.withColumnsRenamed({"interval_start": "month_start", "interval_end": "month_end",
                                    "consumption": "kwh"})
    rows = rows.select("page", "pos",
                       parse_instant("month_start").alias("month_start"),
                       parse_instant("month_end").alias("month_end"),
                       strict_double("kwh").alias("kwh"))
    return (first_per_key(rows.withColumn("month", month_start("month_start")), ["month"], ["page", "pos"])
            .select("month", "kwh"))


# ---------------------------------------------------------------------------
# Landing pages from tables (tests and the registered page queries).
# ---------------------------------------------------------------------------

def _land(df: DataFrame, order: str, path: str, partition_by: list[str], page_size: int,
          number: Callable[[Column], Column] = lambda page: page) -> str:
    """Group rows into pages of ``page_size`` by a dense order number; one line per page. ``number`` renames the pages.

    A page is bounded by ``page_size`` rows, so no group grows with the data.
    """
    keys = [c for c in partition_by if c != "page"]
    out = (df.groupBy(*keys, "page")
           .agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("__o"), "entry"))).alias("e"))
           .select(*keys, "page", F.transform("e", lambda x: x["entry"]).alias("results")))
    if keys:
        out = out.join(df.groupBy(*keys).agg(F.max("page").alias("__last")), on=keys, how="left")
    else:
        out = out.withColumn("__last", df.agg(F.max("page")).scalar())
    out = out.withColumn("next", F.when(F.col("page") < F.col("__last"),
                                        F.concat(F.lit("?page="), number(F.col("page") + 1).cast("string"))))
    out = out.withColumn("page", number(F.col("page")))
    out.drop("__last").write.mode("overwrite").partitionBy(*keys, "page").json(path)
    return path


def land_usage_pages(events: DataFrame, path: str, page_size: int = PAGE_SIZE,
                     number: Callable[[Column], Column] = lambda page: page) -> str:
    """Readings as the API would send them: mixed offsets, two names for the start."""
    slot_utc = F.timestamp_add("MINUTE", -(F.minute("ts") % 30), F.date_trunc("MINUTE", "ts").cast("timestamp_ntz"))
    plus_one = F.concat(F.date_format(F.timestamp_add("HOUR", F.lit(1), slot_utc), "yyyy-MM-dd'T'HH:mm:ss"),
                        F.lit("+01:00"))
    text = F.when(F.col("event_id") % 2 == 0, iso_z(slot_utc)).otherwise(plus_one)
    fallback = F.col("event_type") == "view"
    entry = F.struct(F.when(~fallback, text).alias("interval_start"),
                     F.when(fallback, text).alias("consumption_start"),
                     iso_z(F.timestamp_add("MINUTE", F.lit(30), slot_utc)).alias("interval_end"),
                     F.col("value").alias("consumption"))
    rows = events.select("event_id", (F.col("event_id") / page_size).cast("bigint").alias("page"),
                         entry.alias("entry"))
    return _land(rows, "event_id", path, ["page"], page_size, number)


def land_rate_pages(tariffs: DataFrame, path: str, page_size: int = PAGE_SIZE) -> str:
    """Rates per tariff code folder, ``valid_to`` NULL for the open end."""
    entry = F.struct(iso_z("valid_from_utc").alias("valid_from"), iso_z("valid_to_utc").alias("valid_to"),
                     F.col("unit_rate").alias("value_inc_vat"))
    # A page covers ``page_size`` half hours; a code has at most one rate per
    # half hour, so a page holds at most ``page_size`` rates. No window needed.
    secs = F.unix_seconds(F.col("valid_from_utc").cast("timestamp"))
    rows = tariffs.select("tariff_code", secs.alias("__pos"),
                          F.floor(secs / (page_size * 1800)).alias("page"), entry.alias("entry"))
    return _land(rows, "__pos", path, ["tariff_code", "page"], page_size)


def land_month_pages(monthly: DataFrame, path: str, page_size: int = PAGE_SIZE) -> str:
    """Monthly totals with UTC ``Z`` month bounds."""
    start = F.col("month").cast("timestamp_ntz")
    entry = F.struct(iso_z(start).alias("interval_start"), F.lit(None).cast("string").alias("consumption_start"),
                     iso_z(F.timestamp_add("MONTH", F.lit(1), start)).alias("interval_end"),
                     F.col("kwh").alias("consumption"))
    order = F.year("month") * 12 + F.month("month")
    rows = monthly.select(order.alias("__o2"), (order / page_size).cast("bigint").alias("page"),
                          entry.alias("entry"))
    return _land(rows, "__o2", path, ["page"], page_size)
