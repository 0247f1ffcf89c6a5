"""Silver layer: bronze tables cleaned into the shapes the gold models read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.time import fill_open_end
from .dedupe import latest_per_key


def stg_consumption(raw: DataFrame, keys: Sequence[str] = ("interval_start_utc",),
                    tie_break: Sequence[str] = (), cluster_by_time: bool = False) -> DataFrame:
    """Newest version of each reading (by ``ingestion_ts``).

    ``cluster_by_time`` range-partitions the readings on time (then the other
    keys) instead of hashing them: the dedupe window is satisfied by it, the
    broadcast validity joins keep it, and every task then holds a contiguous
    stretch of time, so a day-partitioned write needs no second shuffle. Use
    it for full builds of the fact; it costs one sampling pass.
    """
    keys = list(keys)
    extra = [k for k in keys if k != "interval_start_utc"]
    if cluster_by_time:
        raw = raw.repartitionByRange("interval_start_utc", *extra)
    latest = latest_per_key(raw, keys, ["ingestion_ts"], tie_break)
    return latest.select(*extra, "interval_start_utc", "interval_start_uk", "kwh")


def fill_open_ends(df: DataFrame, cols: Sequence[str] = ("valid_to_utc", "valid_to_uk")) -> DataFrame:
    return df.withColumns({c: fill_open_end(c) for c in cols})


def stg_agreements(raw: DataFrame) -> DataFrame:
    return fill_open_ends(raw.select(
        "tariff_code",
        F.col("valid_from_utc").cast("timestamp_ntz").alias("valid_from_utc"),
        F.col("valid_to_utc").cast("timestamp_ntz").alias("valid_to_utc"),
        F.col("valid_from_uk").cast("timestamp_ntz").alias("valid_from_uk"),
        F.col("valid_to_uk").cast("timestamp_ntz").alias("valid_to_uk")))


def stg_tariffs(raw: DataFrame) -> DataFrame:
    return fill_open_ends(raw.select(
        "tariff_code",
        F.col("valid_from_utc").cast("timestamp_ntz").alias("valid_from_utc"),
        F.col("valid_to_utc").cast("timestamp_ntz").alias("valid_to_utc"),
        F.col("valid_from_uk").cast("timestamp_ntz").alias("valid_from_uk"),
        F.col("valid_to_uk").cast("timestamp_ntz").alias("valid_to_uk"),
        "unit_rate"))
