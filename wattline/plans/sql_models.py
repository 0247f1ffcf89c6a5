"""The model chain as Spark SQL over temp views.

For users who keep their models as SQL: silver views, the gold fact and the
daily table are SQL text run by ``spark.sql`` over registered views. The range
joins are written in the bucketed form (explode each window into the days it
covers, equi-join on the day, keep the range as a residual), so Catalyst plans
hash joins, not nested loops. The broadcast hint is added only after the same
bounded row count the DataFrame path uses.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.sql import register_sql_functions
from ..operators.validity import DEFAULT_BROADCAST_ROWS, bounded
from ..session import materialise

STG_CONSUMPTION = """
SELECT {keys}interval_start_utc, interval_start_uk, kwh FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys}interval_start_utc
                                 ORDER BY ingestion_ts DESC, {tie_break} DESC) AS rn
    FROM {raw_consumption}) WHERE rn = 1
"""

STG_WINDOWS = """
SELECT tariff_code, valid_from_utc,
       coalesce(valid_to_utc, far_future_timestamp()) AS valid_to_utc,
       valid_from_uk,
       coalesce(valid_to_uk, far_future_timestamp()) AS valid_to_uk{extra}
FROM {raw}
"""

# Days covered by each window; open ends stop at the largest finite instant.
WINDOW_DAYS = """
SELECT w.*, explode(sequence(
           CAST(date_trunc('DAY', valid_from_utc) AS TIMESTAMP_NTZ),
           CAST(date_trunc('DAY', greatest(valid_from_utc,
                least(valid_to_utc - INTERVAL 1 MICROSECOND, {horizon}))) AS TIMESTAMP_NTZ),
           INTERVAL 1 DAY)) AS bucket
FROM {windows} w
WHERE valid_from_utc < valid_to_utc
"""

HORIZON = """
SELECT max(greatest(valid_from_utc,
       CASE WHEN valid_to_utc < far_future_timestamp() THEN valid_to_utc END)) AS h
FROM {windows}
"""

FACT = """
SELECT *, CASE WHEN hour_of_day BETWEEN 0 AND 6 THEN 'night'
               WHEN hour_of_day BETWEEN 16 AND 19 THEN 'peak'
               ELSE 'day' END AS time_band
FROM (
    SELECT /*+ {hints} */
           {keys}c.interval_start_utc, c.interval_start_uk, c.kwh, a.tariff_code, t.unit_rate,
           c.kwh * t.unit_rate AS cost,
           CAST(date_trunc('DAY', c.interval_start_uk) AS TIMESTAMP_NTZ) AS usage_date,
           CAST(hour(c.interval_start_uk) AS BIGINT) AS hour_of_day
    FROM (SELECT *, least(CAST(date_trunc('DAY', interval_start_utc) AS TIMESTAMP_NTZ),
                          CAST(date_trunc('DAY', {agreement_horizon}) AS TIMESTAMP_NTZ)) AS a_bucket,
                    least(CAST(date_trunc('DAY', interval_start_utc) AS TIMESTAMP_NTZ),
                          CAST(date_trunc('DAY', {rate_horizon}) AS TIMESTAMP_NTZ)) AS t_bucket
          FROM {consumption}) c
    LEFT JOIN {agreement_days} a
           ON c.a_bucket = a.bucket
          AND c.interval_start_utc >= a.valid_from_utc AND c.interval_start_utc < a.valid_to_utc
    LEFT JOIN {rate_days} t
           ON a.tariff_code = t.tariff_code AND c.t_bucket = t.bucket
          AND c.interval_start_utc >= t.valid_from_utc AND c.interval_start_utc < t.valid_to_utc
) priced
"""

DAILY = """
SELECT usage_date,
       sum(kwh) AS total_kwh,
       sum(cost) AS total_cost,
       avg(unit_rate) AS avg_rate
FROM {fact} GROUP BY usage_date
"""


def _ts_literal(spark: SparkSession, sql: str) -> str:
    value = spark.sql(sql).first()[0]
    return "CAST(NULL AS TIMESTAMP_NTZ)" if value is None else f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'"


def build(spark: SparkSession, raw_consumption: DataFrame, raw_agreements: DataFrame,
          raw_tariffs: DataFrame, tie_break: str = "ingestion_ts", meter_keys: Sequence[str] = (),
          broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> dict[str, DataFrame]:
    """Register the bronze frames as views and run the models; returns every model by name.

    ``meter_keys`` are the readings' key columns besides the half hour.
    """
    register_sql_functions(spark)
    tag = uuid.uuid4().hex[:8]
    name = {m: f"{m}_{tag}" for m in ("raw_consumption", "raw_agreements", "raw_tariffs",
                                      "stg_consumption", "stg_agreements", "stg_tariffs",
                                      "agreement_days", "rate_days", "fct_energy_cost")}
    raw_consumption.createOrReplaceTempView(name["raw_consumption"])
    raw_agreements.createOrReplaceTempView(name["raw_agreements"])
    raw_tariffs.createOrReplaceTempView(name["raw_tariffs"])
    out: dict[str, DataFrame] = {}
    out["stg_consumption"] = spark.sql(STG_CONSUMPTION.format(
        keys="".join(f"{k}, " for k in meter_keys), tie_break=tie_break, raw_consumption=name["raw_consumption"]))
    # Window sides are small and read several times: write them once.
    out["stg_agreements"] = materialise(spark.sql(STG_WINDOWS.format(extra="", raw=name["raw_agreements"])),
                                        "sql-agreements")
    out["stg_tariffs"] = materialise(spark.sql(STG_WINDOWS.format(extra=", unit_rate", raw=name["raw_tariffs"])),
                                     "sql-tariffs")
    for m in ("stg_consumption", "stg_agreements", "stg_tariffs"):
        out[m].createOrReplaceTempView(name[m])
    horizons = {}
    hints = {}
    for side, src in (("agreement", "stg_agreements"), ("rate", "stg_tariffs")):
        horizons[side] = _ts_literal(spark, HORIZON.format(windows=name[src]))
        days = spark.sql(WINDOW_DAYS.format(windows=name[src], horizon=horizons[side]))
        view = name["agreement_days" if side == "agreement" else "rate_days"]
        days.createOrReplaceTempView(view)
        proven = broadcast_rows is not None and bounded(days, broadcast_rows)
        alias = {"agreement": "a", "rate": "t"}[side]   # the aliases used in FACT
        hints[side] = f"BROADCAST({alias})" if proven else f"MERGE({alias})"
    out["fct_energy_cost"] = spark.sql(FACT.format(
        keys="".join(f"c.{k}, " for k in meter_keys),
        hints=", ".join(hints.values()),
        agreement_horizon=horizons["agreement"], rate_horizon=horizons["rate"],
        consumption=name["stg_consumption"], agreement_days=name["agreement_days"],
        rate_days=name["rate_days"]))
    out["fct_energy_cost"].createOrReplaceTempView(name["fct_energy_cost"])
    out["agg_daily_energy"] = spark.sql(DAILY.format(fact=name["fct_energy_cost"]))
    return out
