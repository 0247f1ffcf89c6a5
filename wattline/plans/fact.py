"""The model chain: bronze → silver → gold fact → daily table.

The reading side stays lazy: Catalyst sees dedupe, joins and projections as
one plan, so column pruning and filters reach the Parquet scans of the bronze
tables. Only the small window sides are written once (and measured) before
the join is planned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators import pricing, rollups, staging
from ..operators.validity import DEFAULT_BROADCAST_ROWS
from ..sources import tables


def silver(spark: SparkSession, sf_dir: str,
           cluster_by_time: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    consumption = staging.stg_consumption(tables.consumption_raw(spark, sf_dir), tie_break=["version"],
                                          cluster_by_time=cluster_by_time)
    agreements = staging.stg_agreements(tables.agreements_raw(spark, sf_dir))
    tariffs = staging.stg_tariffs(tables.tariffs_raw(spark, sf_dir))
    return consumption, agreements, tariffs


def fct_energy_cost(consumption: DataFrame, agreements: DataFrame, tariffs: DataFrame,
                    meter_keys: Sequence[str] = (),
                    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    return pricing.price_intervals(consumption, agreements, tariffs, meter_keys=meter_keys,
                                   broadcast_rows=broadcast_rows)


def fact_from_tables(spark: SparkSession, sf_dir: str, cluster_by_time: bool = False) -> DataFrame:
    return fct_energy_cost(*silver(spark, sf_dir, cluster_by_time=cluster_by_time))


def daily_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.daily_energy(fact_from_tables(spark, sf_dir))
