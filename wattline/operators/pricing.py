"""Price every interval: validity joins, cost, calendar columns, time band."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.time import day_start, hour_of_day
from ..schemas import NIGHT_HOURS, PEAK_HOURS
from .dedupe import latest_per_key
from .validity import DEFAULT_BROADCAST_ROWS, join_prepared, prepare_windows, range_join


def time_band(hour: Column | str) -> Column:
    """night for hours 0-6, peak for 16-19 (both ends in), day otherwise and for NULL."""
    h = F.col(hour) if isinstance(hour, str) else hour
    return (F.when(h.between(*NIGHT_HOURS), F.lit("night"))
             .when(h.between(*PEAK_HOURS), F.lit("peak"))
             .otherwise(F.lit("day")))


def _price(with_code: DataFrame, tariffs: DataFrame, meter_keys: Sequence[str],
           broadcast_rows: int | None, rate_unit: str) -> DataFrame:
    """J2 (rate by code and window), then cost, calendar columns and band."""
    priced = range_join(with_code,
                        tariffs.select("tariff_code", "valid_from_utc", "valid_to_utc", "unit_rate"),
                        at="interval_start_utc", valid_from="valid_from_utc",
                        valid_to="valid_to_utc", on=["tariff_code"], unit=rate_unit,
                        broadcast_rows=broadcast_rows)
    hour = hour_of_day("interval_start_uk")
    return priced.select(
        *meter_keys,
        "interval_start_utc", "interval_start_uk", "kwh", "tariff_code", "unit_rate",
        (F.col("kwh") * F.col("unit_rate")).alias("cost"),
        day_start("interval_start_uk").alias("usage_date"),
        hour.alias("hour_of_day"),
        time_band(hour).alias("time_band"),
    )


def price_intervals(consumption: DataFrame, agreements: DataFrame, tariffs: DataFrame,
                    meter_keys: Sequence[str] = (), agreement_keys: Sequence[str] | None = None,
                    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                    rate_unit: str = "auto") -> DataFrame:
    """Gold fact: each interval ⟕ its agreement ⟕ the rate valid then.

    Unmatched intervals are kept with NULL tariff, rate and cost; overlapping
    windows fan out (the unique check reports them). ``agreement_keys`` are the
    columns agreements share with consumption (e.g. a meter id); by default
    agreements apply to every meter.
    """
    akeys = list(agreement_keys or ())
    base = consumption.select(*meter_keys, "interval_start_utc", "interval_start_uk", "kwh")
    with_code = range_join(base,
                           agreements.select(*akeys, "tariff_code", "valid_from_utc", "valid_to_utc"),
                           at="interval_start_utc", valid_from="valid_from_utc",
                           valid_to="valid_to_utc", on=akeys, broadcast_rows=broadcast_rows)
    return _price(with_code, tariffs, meter_keys, broadcast_rows, rate_unit)


def windows_within(windows: DataFrame, low: dt.datetime | None, high: dt.datetime | None) -> DataFrame:
    """The windows that an interval from ``low`` to ``high`` (both in) can fall into; no other one can price it.

    Decades of rates beside a month of readings are left out before they are written, cut into buckets and shuffled.
    """
    if low is None:
        return windows
    low, high = (F.lit(str(x)).cast("timestamp_ntz") for x in (low, high))
    return windows.where((F.col("valid_from_utc") <= high) & (F.col("valid_to_utc") > low))


def price_readings(raw: DataFrame, agreements: DataFrame, tariffs: DataFrame,
                   meter_keys: Sequence[str] = (), agreement_keys: Sequence[str] | None = None,
                   tie_break: Sequence[str] = (), broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                   rate_unit: str = "auto") -> DataFrame:
    """Newest version of every raw reading, priced: ``price_intervals(stg_consumption(raw))``.

    When agreements are keyed by meter and too many to broadcast, the readings
    are hash-partitioned once on (meter keys, agreement bucket). The dedupe
    window (whose keys include that bucket, a function of the timestamp, so
    the result is unchanged) and the agreement join both use that partitioning:
    one exchange of the large side instead of two.
    """
    akeys = list(agreement_keys or ())
    keys = [*meter_keys, "interval_start_utc"]
    prepared = prepare_windows(agreements.select(*akeys, "tariff_code", "valid_from_utc", "valid_to_utc"),
                               "valid_from_utc", "valid_to_utc", on=akeys, broadcast_rows=broadcast_rows)
    if prepared.broadcast or not akeys or not set(akeys) <= set(meter_keys):
        latest = latest_per_key(raw, keys, ["ingestion_ts"], tie_break)
        base = latest.select(*meter_keys, "interval_start_utc", "interval_start_uk", "kwh")
        with_code = join_prepared(base, prepared, "interval_start_utc")
    else:
        bucket = "__agreement_bucket"
        staged = (raw.withColumn(bucket, prepared.point_bucket("interval_start_utc"))
                  .repartition(*akeys, bucket))
        latest = latest_per_key(staged, [*meter_keys, bucket, "interval_start_utc"], ["ingestion_ts"], tie_break)
        base = latest.select(*meter_keys, bucket, "interval_start_utc", "interval_start_uk", "kwh")
        with_code = join_prepared(base, prepared, "interval_start_utc", bucket_col=bucket).drop(bucket)
    return _price(with_code, tariffs, meter_keys, broadcast_rows, rate_unit)
