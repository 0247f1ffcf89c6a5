"""Driver tables and the domain tables derived from them.

The reference ships no data, so the bronze tables are built from the given
TPC-H-style tables (recipes in FIXTURES.md); every builder reads whole tables
and prunes to the columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.codes import product_code
from ..functions.time import floor_half_hour, to_uk_wall_clock
from ..operators.series import next_in_order

NATION_COUNT = 25  # TPC-H nation table: keys 0..24


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as it stands now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tariff_code_of(nation_name: str = "n_name") -> F.Column:
    return F.concat(F.lit("E-1R-"), F.replace(F.col(nation_name), F.lit(" "), F.lit("-")),
                    F.lit("-24-01-01-A"))


def consumption_raw(spark: SparkSession, sf_dir: str, with_meter: bool = False) -> DataFrame:
    """Bronze readings from ``events``: one row per event, several per slot.

    ``ingestion_ts`` is the event time and ``version`` (event_id) breaks ties,
    so "newest version" is well defined.
    """
    ev = read_table(spark, sf_dir, "events")
    slot = floor_half_hour("ts")
    cols = [F.col("user_id").alias("meter_id")] if with_meter else []
    return ev.select(*cols,
                     slot.alias("interval_start_utc"),
                     to_uk_wall_clock(slot).alias("interval_start_uk"),
                     F.col("value").alias("kwh"),
                     F.col("ts").alias("ingestion_ts"),
                     F.col("event_id").alias("version"))


def agreements_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One agreement per nation, a day each from 2024-01-02; the last is open-ended."""
    n = read_table(spark, sf_dir, "nation")
    start = F.timestamp_add("DAY", F.col("n_nationkey"), F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
    end = F.when(F.col("n_nationkey") != NATION_COUNT - 1,
                 F.timestamp_add("DAY", F.col("n_nationkey") + 1,
                                F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")))
    return n.select(tariff_code_of().alias("tariff_code"),
                    start.alias("valid_from_utc"),
                    end.alias("valid_to_utc"),
                    to_uk_wall_clock(start).alias("valid_from_uk"),
                    to_uk_wall_clock(end).alias("valid_to_uk"),
                    F.lit(None).cast("timestamp_ntz").alias("ingestion_ts"))


def tariffs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-hour rates per tariff code from ``part`` × ``nation``; the last is open-ended."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    start = F.timestamp_add("HOUR", (F.col("p_partkey") / NATION_COUNT).cast("bigint") * 6,
                           F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    rates = (part.join(nation, F.col("p_partkey") % NATION_COUNT == F.col("n_nationkey"))
             .select(tariff_code_of().alias("tariff_code"),
                     start.alias("valid_from_utc"),
                     (F.col("p_retailprice") / 100).alias("unit_rate")))
    rates = next_in_order(rates, ["tariff_code"], ["valid_from_utc"], ["valid_from_utc"],
                          bucket=F.date_trunc("MONTH", "valid_from_utc"))
    return rates.select(
        "tariff_code",
        product_code("tariff_code").alias("product_code"),
        "valid_from_utc",
        F.col("next_valid_from_utc").alias("valid_to_utc"),
        to_uk_wall_clock("valid_from_utc").alias("valid_from_uk"),
        to_uk_wall_clock("next_valid_from_utc").alias("valid_to_uk"),
        "unit_rate",
        F.lit(None).cast("timestamp_ntz").alias("ingestion_ts"))


def order_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer, order k is valid from its date until the next order's date."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    w = next_in_order(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderdate"],
                      bucket=F.date_trunc("MONTH", "o_orderdate"))
    return w.select("o_custkey",
                    F.col("o_orderdate").alias("valid_from"),
                    F.col("next_o_orderdate").alias("valid_to"),
                    F.col("o_orderkey").alias("window_orderkey"))


def distinct_order_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One window per (customer, order date): the highest order key of that date."""
    o = (read_table(spark, sf_dir, "orders")
         .groupBy("o_custkey", "o_orderdate")
         .agg(F.max("o_orderkey").alias("o_orderkey")))
    w = next_in_order(o, ["o_custkey"], ["o_orderdate"], ["o_orderdate"],
                      bucket=F.date_trunc("MONTH", "o_orderdate"))
    return w.select("o_custkey",
                    F.col("o_orderdate").alias("valid_from"),
                    F.col("next_o_orderdate").alias("valid_to"),
                    F.col("o_orderkey").alias("window_orderkey"))


def shipment_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order's customer: the points of the keyed range join."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select("l_orderkey", "l_linenumber", "o_custkey", "l_shipdate"))
