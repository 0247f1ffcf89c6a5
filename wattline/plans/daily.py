"""The daily table and the slot masks, kept up by touched days.

Both are partitioned by day. A refresh reads the fact's partitions around the
touched days (literals, so the others aren't opened), aggregates those days whole and
overwrites their partitions: the table equals the roll-up of the whole fact.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import quality, rollups
from ..operators.upsert import table_exists

DAY = "day"


def _write(df: DataFrame, path: str, mode: str) -> None:
    (df.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(DAY).parquet(path))


def _around(days: Iterable[dt.date], reach: int) -> list[dt.date]:
    return sorted({d + dt.timedelta(days=k) for d in days for k in range(-reach, reach + 1)})


def touched_rollup(spark: SparkSession, fact_path: str, days: Iterable[dt.date], keys: Sequence[str] = ()) -> DataFrame:
    """The daily rows of every usage date that the fact's partitions ``days`` (UTC) have rows of.

    A usage date is on a wall clock within a day of UTC: its rows lie in the partitions of the day before, its own and the next.
    """
    days = list(days)
    fact = spark.read.parquet(fact_path)
    near = fact.where(F.col(DAY).isin(_around(days, 2)))
    date = F.to_date("usage_date")
    dates = near.where(F.col(DAY).isin(days)).select(date.alias("__date")).distinct()
    concerned = near.join(F.broadcast(dates), date == F.col("__date"), "left_semi")     # at most three dates a touched day
    return rollups.daily_energy(concerned, keys).withColumn(DAY, date)


def refresh(spark: SparkSession, fact_path: str, daily_path: str, days: Iterable[dt.date] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Bring the daily table (keys, usage_date) up to the fact; ``days``: the fact's partitions that changed (None: all)."""
    if days is None or not table_exists(spark, daily_path):
        _write(rollups.daily_energy(spark.read.parquet(fact_path), keys).withColumn(DAY, F.to_date("usage_date")), daily_path, "static")
    elif days := list(days):
        _write(touched_rollup(spark, fact_path, days, keys), daily_path, "dynamic")
    return read(spark, daily_path)


def read(spark: SparkSession, daily_path: str) -> DataFrame:
    return spark.read.parquet(daily_path).drop(DAY)


def refresh_masks(spark: SparkSession, fact_path: str, masks_path: str, days: Iterable[dt.date] | None = None,
                  keys: Sequence[str] = ()) -> DataFrame:
    """The slot masks of each (keys, UTC day), from which missing half hours are told without reading the fact again."""
    fact = spark.read.parquet(fact_path)
    whole = days is None or not table_exists(spark, masks_path)
    if not whole:
        days = list(days)
        fact = fact.where(F.col(DAY).isin(days))
    if whole or days:
        masks = quality.slot_masks(fact, keys=keys).withColumn(DAY, F.to_date(F.timestamp_micros("__day").cast("timestamp_ntz")))
        _write(masks, masks_path, "static" if whole else "dynamic")
    return spark.read.parquet(masks_path).drop(DAY)
