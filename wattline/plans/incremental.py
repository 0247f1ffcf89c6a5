"""Incremental gold fact with a lookback (the model's ``is_incremental`` branch)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.pricing import price_intervals
from ..operators.upsert import UpsertResult, table_exists, upsert
from ..schemas import LOOKBACK_DAYS
from ..session import materialise

FACT_PARTITION = "day"


def high_water_mark(spark: SparkSession, path: str, ts: str = "interval_start_utc") -> dt.datetime | None:
    """Largest stored instant; None when the table is missing or empty."""
    if not table_exists(spark, path):
        return None
    return spark.read.parquet(path).agg(F.max(ts)).first()[0]


def lookback_filter(consumption: DataFrame, hwm: dt.datetime | None, days: int = LOOKBACK_DAYS,
                    ts: str = "interval_start_utc", day_col: str | None = None) -> DataFrame:
    """Rows at or after ``hwm - days``; everything when there is no mark yet.

    An empty target therefore means a full load, not "nothing for ever".
    The bound is a literal, so it reaches the Parquet scan as a pushed filter;
    with ``day_col`` (the table's UTC-day partition) it also prunes partitions.
    """
    if hwm is None:
        return consumption
    lo = hwm - dt.timedelta(days=days)
    cond = F.col(ts) >= F.lit(lo)
    if day_col:
        cond = cond & (F.col(day_col) >= F.lit(lo.date()))
    return consumption.filter(cond)


def high_water_marks(spark: SparkSession, path: str, meter_keys: Sequence[str], ts: str = "interval_start_utc") -> DataFrame | None:
    """(meter keys, mark): each meter's largest stored instant; None when the table is missing."""
    if not table_exists(spark, path):
        return None
    return spark.read.parquet(path).groupBy(*meter_keys).agg(F.max(ts).alias("__mark"))


def lookback_by_meter(consumption: DataFrame, marks: DataFrame, meter_keys: Sequence[str], days: int = LOOKBACK_DAYS,
                      ts: str = "interval_start_utc") -> DataFrame:
    """Rows at or after their own meter's mark less ``days``; all rows of a meter without a mark.

    A meter that lags behind the others has a mark of its own, so none of its readings is passed over.
    """
    on = [consumption[k].eqNullSafe(marks[k]) for k in meter_keys]
    late = F.timestamp_add("DAY", F.lit(-days), F.col("__mark"))
    return (consumption.join(marks, on, "left").where(F.col("__mark").isNull() | (consumption[ts] >= late))
            .select(*[consumption[c] for c in consumption.columns]))


def write_fact(spark: SparkSession, path: str, fact: DataFrame, full_refresh: bool = False,
               time_clustered: bool = False, meter_keys: Sequence[str] = ()) -> UpsertResult:
    """Write the fact by UTC day. A full refresh rewrites everything; otherwise keyed upsert.

    ``time_clustered`` says the rows already arrive grouped by time (see
    ``staging.stg_consumption(cluster_by_time=True)``), so no rebalance shuffle
    is needed to keep files per day few.
    """
    day = F.to_date("interval_start_utc")
    if full_refresh:
        out = fact.withColumn(FACT_PARTITION, day)
        if not time_clustered:
            out = out.hint("rebalance", FACT_PARTITION)
        (out.write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy(FACT_PARTITION).parquet(path))
        n = spark.read.parquet(path).count()
        return UpsertResult(path, n, n, -1)
    return upsert(spark, path, fact, keys=[*meter_keys, "interval_start_utc"], partition_col=FACT_PARTITION,
                  partition_expr=day, keep_duplicates=True)   # overlapping windows fan out; the unique test reports it


_UNSET = object()


def incremental_fact(spark: SparkSession, path: str, consumption: DataFrame, agreements: DataFrame,
                     tariffs: DataFrame, lookback_days: int = LOOKBACK_DAYS,
                     full_refresh: bool = False, hwm=_UNSET, time_clustered: bool = False,
                     meter_keys: Sequence[str] = ()) -> UpsertResult:
    """Reprice the last ``lookback_days`` (or everything) and replace those keys.

    With ``meter_keys`` each meter's lookback starts from its own newest stored instant.
    Rows older than the lookback are kept as stored, so a late correction older
    than the lookback, or a changed rate, needs ``full_refresh=True``. Pass
    ``hwm`` when the caller already read it (to prune the bronze scan).
    """
    if hwm is _UNSET:
        hwm = None if full_refresh else high_water_mark(spark, path)
    if hwm is not None and meter_keys:
        # One row a meter: written, as the fact that it is read from is about to change.
        marks = materialise(high_water_marks(spark, path, meter_keys), "marks")
        batch = lookback_by_meter(consumption, marks, meter_keys, lookback_days)
    else:
        batch = lookback_filter(consumption, hwm, lookback_days)
    if hwm is not None and not meter_keys:
        # Windows that end before the lookback cannot match a repriced point;
        # dropping them keeps a daily run from rewriting years of rates.
        lo = F.lit(hwm - dt.timedelta(days=lookback_days))
        agreements = agreements.filter(F.col("valid_to_utc") > lo)
        tariffs = tariffs.filter(F.col("valid_to_utc") > lo)
    fact = price_intervals(batch, agreements, tariffs, meter_keys=meter_keys)
    return write_fact(spark, path, fact, full_refresh=full_refresh or hwm is None,
                      time_clustered=time_clustered, meter_keys=meter_keys)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(FACT_PARTITION)
