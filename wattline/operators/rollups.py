"""Roll-ups of the gold fact (daily table and dashboard tiles).

Sums are plain double sums of the stored values; every group-by is a partial + final hash aggregate, so no key is sent whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.money import mean, total
from ..functions.time import month_start


def daily_energy(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """agg_daily_energy: per (keys and) usage_date total kWh, total cost, plain mean rate."""
    return fact.groupBy(*keys, "usage_date").agg(
        total("kwh").alias("total_kwh"),
        total("cost").alias("total_cost"),
        mean("unit_rate").alias("avg_rate"))


def scorecard(fact: DataFrame) -> DataFrame:
    return fact.agg(
        total("kwh").alias("total_kwh"),
        mean("unit_rate").alias("avg_rate"),
        total("cost").alias("total_cost"))


def hourly_profile(fact: DataFrame) -> DataFrame:
    return fact.groupBy("hour_of_day").agg(
        total("kwh").alias("total_kwh"),
        mean("kwh").alias("avg_kwh"),
        F.count(F.lit(1)).alias("intervals"))


def cost_over_time(daily: DataFrame) -> DataFrame:
    return daily.select("usage_date", "total_cost")


def daily_kwh(daily: DataFrame) -> DataFrame:
    return daily.select("usage_date", "total_kwh")


def rate_over_time(daily: DataFrame) -> DataFrame:
    return daily.select("usage_date", "avg_rate")


def band_split(fact: DataFrame) -> DataFrame:
    return fact.groupBy("time_band").agg(
        total("kwh").alias("total_kwh"),
        total("cost").alias("total_cost"),
        F.count(F.lit(1)).alias("intervals"))


def cost_by_tariff_band(fact: DataFrame) -> DataFrame:
    return fact.groupBy("tariff_code", "time_band").agg(
        total("kwh").alias("total_kwh"),
        total("cost").alias("total_cost"))


def monthly_usage(consumption: DataFrame, ts: str = "interval_start_uk") -> DataFrame:
    """Monthly kWh on the UK wall clock (a UTC month would move summer midnights)."""
    return (consumption.groupBy(month_start(ts).alias("month"))
            .agg(total("kwh").alias("kwh")))
