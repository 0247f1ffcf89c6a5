"""The whole run: audited bronze loads, then silver → gold → tests.

Order follows the reference's runner: agreements, tariffs, usage, export;
the first failure stops the run (its audit row says FAILED).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.money import strict_double
from ..operators import quality, staging
from ..operators.filters import period
from ..operators.pricing import price_intervals, windows_within
from ..operators.upsert import table_exists, upsert
from ..schemas import FIRST_LOAD_START, LOOKBACK_DAYS
from ..session import materialise
from . import audit, changes, daily, incremental, lake


@dataclass(frozen=True)
class Lake:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def consumption(self) -> str:
        return self.path("bronze/raw_consumption")

    @property
    def agreements(self) -> str:
        return self.path("bronze/raw_agreements")

    @property
    def tariffs(self) -> str:
        return self.path("bronze/raw_tariffs")

    @property
    def audit(self) -> str:
        return self.path("ingestion_audit")

    @property
    def fact(self) -> str:
        return self.path("gold/fct_energy_cost")

    @property
    def changes(self) -> str:
        return self.path("ingestion_changes")

    @property
    def builds(self) -> str:
        return self.path("gold/builds")

    @property
    def masks(self) -> str:
        return self.path("gold/slot_masks")

    @property
    def stream_batches(self) -> str:
        return self.path("gold/stream_batches")

    def priced_with(self, name: str) -> str:
        """Copy of the windows that the last build priced with."""
        return self.path(f"gold/priced_with/{name}")

    @property
    def daily(self) -> str:
        return self.path("gold/agg_daily_energy")


def _stamp(df: DataFrame, now: dt.datetime | None) -> DataFrame:
    ts = F.lit(now).cast("timestamp_ntz") if now else F.current_timestamp().cast("timestamp_ntz")
    return df.withColumn("ingestion_ts", ts)


def load_usage(spark: SparkSession, lk: Lake, batch: DataFrame, arrival=(), now=None,
               source: str = "usage_api", meter_keys: Sequence[str] = ()) -> dict:
    """Upsert readings by (meter keys, ``interval_start_utc``) into day partitions, audited.

    Of several readings of one key the first in ``arrival`` order is kept; without an
    order they fail the load. The days it touches are logged before they change, for the next build.
    """
    keys = [*meter_keys, "interval_start_utc"]
    run_id, now = str(uuid.uuid4()), now or audit._now()

    def run():
        b = _stamp(batch.select(*keys, "interval_start_uk", strict_double("kwh").alias("kwh"), *arrival), now)
        res = upsert(spark, lk.consumption, b, keys, "day", F.to_date("interval_start_utc"), arrival=list(arrival),
                     range_cols=("interval_start_utc", "interval_start_utc"), allow_empty=False,
                     before_write=lambda days: changes.log_days(spark, lk.changes, run_id, now, days))
        changes.log_done(spark, lk.changes, run_id, now)
        return res.rows_in_batch, res.rows_inserted, res.range_min, res.range_max
    return audit.audited_load(spark, lk.audit, source, run, run_id)


def new_usage(spark: SparkSession, lk: Lake, landed: DataFrame, meter_keys: Sequence[str] = (),
              lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """The readings the next load asks for: from ``lookback_days`` before the newest stored half hour on.

    Each meter by its own newest half hour, so one that lags isn't skipped; with nothing
    stored, from the first load's start. Without meters the bound is a literal that reaches the scan.
    """
    ts, keys = "interval_start_utc", list(meter_keys)
    if not keys or not table_exists(spark, lk.consumption):
        newest = incremental.high_water_mark(spark, lk.consumption)
        first = newest - dt.timedelta(days=lookback_days) if newest else dt.datetime.fromisoformat(FIRST_LOAD_START)
        return period(landed, ts, f"{first.isoformat()}Z")
    stored = spark.read.parquet(lk.consumption).groupBy(*keys).agg(F.max(ts).alias("__newest"))
    first = F.coalesce(F.timestamp_add("DAY", F.lit(-lookback_days), F.col("__newest")),
                       F.lit(FIRST_LOAD_START).cast("timestamp_ntz"))
    return landed.join(stored, keys, "left").where(F.col(ts) >= first).select(*landed.columns)


class NoAgreements(RuntimeError):
    """Rates were asked for before any agreement was loaded."""


def agreement_codes(spark: SparkSession, lk: Lake) -> DataFrame:
    """The tariff codes of the stored agreements, each once."""
    if not table_exists(spark, lk.agreements):
        raise NoAgreements(f"no agreements at {lk.agreements}: load them before the rates")
    return spark.read.parquet(lk.agreements).select("tariff_code").distinct()


def rates_for_agreements(spark: SparkSession, lk: Lake, rates: DataFrame) -> DataFrame:
    """The rates of codes that some stored agreement has; ``NoAgreements`` where there is none."""
    codes = agreement_codes(spark, lk)
    if codes.isEmpty():
        raise NoAgreements(f"{lk.agreements} is empty: load agreements before the rates")
    return rates.join(codes, "tariff_code", "left_semi")


#: Folders of a window table. Codes are hashed into them, so their number doesn't grow with the codes.
WINDOW_BUCKETS = 64


def load_windows(spark: SparkSession, lk: Lake, path: str, batch: DataFrame, source: str, now=None, arrival=()) -> dict:
    """Upsert agreements or rates by (tariff_code, valid_from_utc), audited; duplicates as in ``load_usage``."""
    def run():
        b = _stamp(batch, now)
        res = upsert(spark, path, b, ["tariff_code", "valid_from_utc"], "bucket",
                     F.pmod(F.xxhash64("tariff_code"), F.lit(WINDOW_BUCKETS)).cast("int"), arrival=list(arrival),
                     range_cols=("valid_from_utc", "valid_to_utc"), allow_empty=False)
        return res.rows_in_batch, res.rows_inserted, res.range_min, res.range_max
    return audit.audited_load(spark, lk.audit, source, run)


class TestsFailed(RuntimeError):
    """A test of severity "error" found failing rows; what depends on its table isn't built."""

    __test__ = False


def not_null(df: DataFrame, columns: Sequence[str], prefix: str = "") -> dict[str, DataFrame]:
    return {f"{prefix}{c} not null": df.where(F.col(c).isNull()) for c in columns}


def silver_tests(consumption: DataFrame, agreements: DataFrame, tariffs: DataFrame,
                 meter_keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Failing rows of the cleaned tables: five columns not null, one key unique."""
    return (not_null(consumption, ["interval_start_utc", "kwh"], "consumption ")
            | not_null(agreements, ["tariff_code"], "agreements ") | not_null(tariffs, ["tariff_code", "unit_rate"], "tariffs ")
            | {"consumption unique": quality.unique_check(consumption, [*meter_keys, "interval_start_utc"])})


def fact_tests(fact: DataFrame, meter_keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Failing rows of (days of) the fact: three columns not null, the key unique."""
    keys = list(meter_keys)
    return {"not_null": quality.null_check(fact, ["interval_start_utc", "kwh", "cost"], [*keys, "interval_start_utc"]),
            "unique": quality.unique_check(fact, [*keys, "interval_start_utc"])}


def count_failures(tests: Mapping[str, DataFrame]) -> dict[str, int]:
    return {name: failing.count() for name, failing in tests.items()}


def gate(tests: Mapping[str, DataFrame], severity: str | Mapping[str, str] = "error") -> dict[str, int]:
    """Evaluate the tests. Failing rows of a test of severity "error" stop the build; "warn" only counts them."""
    found = count_failures(tests)
    of = (lambda name: severity) if isinstance(severity, str) else (lambda name: severity.get(name, "error"))
    if stop := {name: n for name, n in found.items() if n and of(name) == "error"}:
        raise TestsFailed(", ".join(f"{name}: {n} failing rows" for name, n in stop.items()))
    return found


WINDOW_COLUMNS = {"agreements": ("tariff_code", "valid_from_utc", "valid_to_utc"),
                  "tariffs": ("tariff_code", "valid_from_utc", "valid_to_utc", "unit_rate")}


def build_models(spark: SparkSession, lk: Lake, full_refresh: bool = False, meter_keys: Sequence[str] = (),
                 severity: str | Mapping[str, str] = "error", found: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Silver views over bronze, their tests, the fact, its tests, the daily table.

    The first build (or ``full_refresh``) prices everything. A later one prices what has changed (see
    ``changes``): readings of loads that no build has taken, however far behind the newest they are, and readings in
    the time of windows that differ. Only days touched so are read, tested for nulls and doubles,
    and rolled up again; holes are told by the masks of all days. A failing test (see ``gate``) stops what
    depends on its table, and the next build takes the same changes again. ``found`` receives the counts.
    """
    found = {} if found is None else found
    keys = [*meter_keys, "interval_start_utc"]
    loads = changes.pending(spark, lk.changes, lk.builds)
    bronze = spark.read.parquet(lk.consumption)
    windows = {"agreements": staging.stg_agreements(spark.read.parquet(lk.agreements).drop("bucket")),
               "tariffs": staging.stg_tariffs(spark.read.parquet(lk.tariffs).drop("bucket"))}
    full = full_refresh or not table_exists(spark, lk.fact)
    if full:
        rows, concerned = bronze, None
    else:
        before = {n: spark.read.parquet(lk.priced_with(n)) if table_exists(spark, lk.priced_with(n)) else None for n in windows}
        differ = [materialise(changes.changed_windows(w, before[n], WINDOW_COLUMNS[n]), "changed-windows") for n, w in windows.items()]
        rows, concerned = changes.readings_to_price(bronze, keys, loads, [d for d in differ if not d.isEmpty()])
        concerned = materialise(concerned, "concerned")
    # The tests and the fact read the cleaned readings several times: they are cleaned once.
    consumption = materialise(staging.stg_consumption(rows.drop("day"), keys=keys), "stg-consumption")
    found |= gate(silver_tests(consumption, *windows.values(), meter_keys), severity)
    batch = consumption if full else consumption.join(concerned, keys, "left_semi")
    low, high = consumption.agg(F.min("interval_start_utc"), F.max("interval_start_utc")).first()
    priced = price_intervals(batch, *[windows_within(w, low, high) for w in windows.values()], meter_keys=meter_keys)
    days = incremental.write_fact(spark, lk.fact, priced, full_refresh=full, meter_keys=meter_keys).touched
    days = None if full else days
    fact = spark.read.parquet(lk.fact)
    tested = (fact if full else fact.where(F.col("day").isin(list(days)))).drop("day")
    masks = daily.refresh_masks(spark, lk.fact, lk.masks, days, meter_keys)
    found |= gate(fact_tests(tested, meter_keys) | {"no_missing_intervals": quality.holes_of(masks, keys=list(meter_keys))}, severity)
    out = daily.refresh(spark, lk.fact, lk.daily, days, meter_keys)
    for name, w in windows.items():
        w.select(*WINDOW_COLUMNS[name]).write.mode("overwrite").parquet(lk.priced_with(name))
    changes.take(spark, lk.builds, loads)
    return fact.drop("day"), out


def run(spark: SparkSession, lk: Lake, agreements: DataFrame, tariffs: DataFrame, usage: DataFrame,
        export_root: str | None = None, usage_arrival=(), now=None, meter_keys: Sequence[str] = (),
        severity: str | Mapping[str, str] = "error", agreements_arrival=(), tariffs_arrival=(),
        usage_lookback: int | None = None) -> dict:
    """Agreements → their tariffs → usage → (export) → silver → tests → fact → tests → daily; stops at the first failure.

    Of repeated keys the first in the given arrival order is kept. With ``usage_lookback`` only readings from that many days before
    each meter's newest stored one on are taken, as a load that asks a service would; without, all that landed.
    """
    out = {"audit": [], "tests": {}}
    out["audit"].append(load_windows(spark, lk, lk.agreements, agreements, "agreements_feed", now, agreements_arrival))
    out["audit"].append(load_windows(spark, lk, lk.tariffs, rates_for_agreements(spark, lk, tariffs), "rates_feed", now, tariffs_arrival))
    if usage_lookback is not None:
        usage = new_usage(spark, lk, usage, meter_keys, usage_lookback)
    out["audit"].append(load_usage(spark, lk, usage, usage_arrival, now, meter_keys=meter_keys))
    if export_root:
        bronze = {"raw_consumption": spark.read.parquet(lk.consumption).drop("day"),
                  "raw_agreements": spark.read.parquet(lk.agreements).drop("bucket"),
                  "raw_tariffs": spark.read.parquet(lk.tariffs).drop("bucket")}
        out["exports"] = lake.export_tables(bronze, list(bronze), export_root)
    out["fact"], out["daily"] = build_models(spark, lk, meter_keys=meter_keys, severity=severity, found=out["tests"])
    return out


def materialize_model(spark: SparkSession, df: DataFrame, name: str, how: str = "view",
                      path: str | None = None, unique_key: list[str] | None = None,
                      partition_col: str | None = None, partition_expr=None) -> DataFrame:
    """A model as a temp view, an overwritten table, or an incremental (keyed upsert) table.

    Whatever the form, the model is registered as a temp view ``name`` so SQL
    can refer to it, and the DataFrame that reads it is returned.
    """
    if how == "view":
        out = df
    elif how == "table":
        if not path:
            raise ValueError("a table model needs a path")
        df.write.mode("overwrite").parquet(path)
        out = spark.read.parquet(path)
    elif how == "incremental":
        if not (path and unique_key and partition_col is not None and partition_expr is not None):
            raise ValueError("an incremental model needs path, unique_key and a key-derived partition")
        upsert(spark, path, df, unique_key, partition_col, partition_expr)
        out = spark.read.parquet(path).drop(partition_col)
    else:
        raise ValueError(f"unknown materialisation {how!r}: view, table or incremental")
    out.createOrReplaceTempView(name)
    return out
