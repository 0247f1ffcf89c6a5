"""Nothing is lost: digits, rows, days, meters, audit rows."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from wattline.operators import quality, rollups, validity
from wattline.operators.upsert import BadKeys, table_exists, upsert
from wattline.plans import audit, incremental, lake, pipeline
from wattline.schemas import AGREEMENTS, TARIFFS
from wattline.session import run_scratch


def readings(spark, rows):
    """(meter, slot, kwh, version)"""
    return (spark.createDataFrame(rows, "meter_id long, s string, kwh double, version long")
            .withColumn("interval_start_utc", F.col("s").cast("timestamp_ntz")).drop("s")
            .withColumn("interval_start_uk", F.col("interval_start_utc")))


def test_small_and_large_values_are_summed(spark):
    day = F.lit("2024-01-01").cast("timestamp_ntz").alias("usage_date")
    small = spark.range(1000).select(day, F.lit(4e-7).alias("kwh"), F.lit(4e-7).alias("cost"), F.lit(1.0).alias("unit_rate"))
    assert rollups.daily_energy(small).first()["total_kwh"] == pytest.approx(0.0004)
    large = spark.createDataFrame([(1e13,), (1.0,)], "kwh double").select(day, "kwh", F.col("kwh").alias("cost"), F.lit(1.0).alias("unit_rate"))
    assert rollups.daily_energy(large).first()["total_kwh"] == 1e13 + 1


def test_two_meters_at_one_slot_stay_two(spark, tmp_dir):
    lk = pipeline.Lake(tmp_dir)
    batch = readings(spark, [(1, "2024-01-01 00:00:00", 1.0, 2), (2, "2024-01-01 00:00:00", 2.0, 1), (1, "2024-01-01 00:00:00", 9.0, 3)])
    row = pipeline.load_usage(spark, lk, batch, arrival=["version"], meter_keys=["meter_id"])
    assert row["records_inserted"] == 2
    assert sorted((r.meter_id, r.kwh) for r in spark.read.parquet(lk.consumption).collect()) == [(1, 1.0), (2, 2.0)]


def test_duplicates_without_an_order_fail(spark, tmp_dir):
    batch = readings(spark, [(1, "2024-01-01 00:00:00", 1.0, 2), (1, "2024-01-01 00:00:00", 9.0, 3)])
    lk = pipeline.Lake(tmp_dir)
    with pytest.raises(BadKeys):
        pipeline.load_usage(spark, lk, batch)
    assert [r.status for r in spark.read.parquet(lk.audit).collect()] == ["FAILED"]
    assert not table_exists(spark, lk.consumption)


def test_null_keys_are_refused(spark, tmp_dir):
    batch = readings(spark, [(1, None, 1.0, 2), (1, "2024-01-01 00:00:00", 9.0, 3)])
    with pytest.raises(BadKeys):
        upsert(spark, tmp_dir, batch, ["interval_start_utc"], "day", F.to_date("interval_start_utc"), arrival=["version"])
    assert not table_exists(spark, tmp_dir)


def test_unreadable_file_isn_t_an_empty_table(spark):
    path = tempfile.mkdtemp(prefix="wattline-test-")
    spark.range(2).withColumn("day", F.lit(1)).write.mode("overwrite").partitionBy("day").parquet(path)
    for name in os.listdir(f"{path}/day=1"):
        if name.endswith(".parquet"):
            with open(f"{path}/day=1/{name}", "wb") as f:
                f.write(b"no parquet at all")
    with pytest.raises(Exception):
        table_exists(spark, path)
    with pytest.raises(Exception):
        incremental.high_water_mark(spark, path, "id")
    assert not table_exists(spark, f"{path}/nowhere")


def test_truncate_withdraws_days(spark, tmp_dir):
    rows = readings(spark, [(1, "2024-01-01 00:00:00", 1.0, 1), (1, "2024-01-02 00:00:00", 2.0, 2)]).withColumn("ingestion_ts", F.col("interval_start_utc"))
    for part in (rows, rows.where("version = 2")):
        out = lake.export_tables({"raw_consumption": part}, ["raw_consumption"], tmp_dir)
    assert [r.kwh for r in spark.read.parquet(out["raw_consumption"]).collect()] == [2.0]


def test_audit_keeps_large_counts_and_whole_messages(spark, tmp_dir):
    audit.audited_load(spark, tmp_dir, "big", lambda: (3_000_000_000, 3_000_000_000, None, None))

    def fail():
        raise RuntimeError("x" * 10_000)
    with pytest.raises(RuntimeError):
        audit.audited_load(spark, tmp_dir, "bad", fail)
    rows = {r.source: r for r in spark.read.parquet(tmp_dir).collect()}
    assert rows["big"].records_fetched == 3_000_000_000 and len(rows["bad"].error_message) == 10_000


def test_flat_pages_in_number_order(spark):
    from wattline.sources import pages
    path = tempfile.mkdtemp(prefix="wattline-pages-")
    for page, kwh in ((10, 10.0), (2, 2.0)):
        with open(f"{path}/page-{page}.json", "w") as f:
            f.write(json.dumps({"results": [{"interval_start": "2024-01-01T00:00:00Z", "consumption": kwh}]}) + "\n")
    assert [r.kwh for r in pages.usage_batch(spark, path).collect()] == [2.0]


def test_failing_tests_stop_the_build(spark, tmp_dir):
    lk = pipeline.Lake(tmp_dir)
    at = dt.datetime(2024, 1, 1)
    agreements = spark.createDataFrame([("E-1R-A", at, None, at, None, at)], AGREEMENTS).drop("ingestion_ts")
    tariffs = spark.createDataFrame([("E-1R-A", "A", at, None, at, None, 0.2, at)], TARIFFS).drop("ingestion_ts")
    gap = readings(spark, [(1, "2024-01-01 00:00:00", 1.0, 1), (1, "2024-01-01 02:00:00", 2.0, 2)]).drop("meter_id")
    with pytest.raises(pipeline.TestsFailed, match="no_missing_intervals: 3"):
        pipeline.run(spark, lk, agreements, tariffs, gap, usage_arrival=["version"])
    assert table_exists(spark, lk.fact) and not table_exists(spark, lk.daily)
    out = pipeline.run(spark, lk, agreements, tariffs, gap, usage_arrival=["version"], severity={"no_missing_intervals": "warn"})
    assert out["tests"]["no_missing_intervals"] == 3 and out["daily"].count() == 1


def test_flagship_shuffles_only_what_the_dedupe_leaves(spark):
    from wattline.plans import fact as fact_plan
    plan = fact_plan.fact_from_tables(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    above, _, below = plan.partition("Exchange hashpartitioning")
    assert "WindowGroupLimit" in below and "rangepartitioning" not in plan


def test_period_in_order(spark):
    from wattline.operators import filters
    rows = readings(spark, [(1, f"2024-01-0{d} 00:00:00", float(d), d) for d in (5, 1, 4, 2, 3)]).repartition(3)
    got = filters.period(rows, "interval_start_utc", "2024-01-02T00:00:00Z", "2024-01-05T00:00:00Z", ordered=True)
    assert [r.version for r in got.collect()] == [2, 3, 4]


def test_null_meter_is_a_meter(spark):
    rows = readings(spark, [(None, "2024-01-01 00:00:00", 1.0, 1), (None, "2024-01-01 03:00:00", 1.0, 2),
                            (None, "2024-01-02 00:00:00", 1.0, 3), (7, "2024-01-01 00:00:00", 1.0, 4)])
    forms = [f(rows, keys=["meter_id"]) for f in (quality.missing_intervals, quality.missing_by_gap, quality.missing_by_mask)]
    found = [sorted(r.interval_start_utc for r in f.collect()) for f in forms]
    assert len(found[0]) == 49 - 3 and found[0] == found[1] == found[2]
    spans = rows.select("meter_id", F.col("interval_start_utc").alias("a"), F.lit("2024-01-05").cast("timestamp_ntz").alias("b"))
    assert quality.overlapping_windows(spans, ["meter_id"], "a", "b").count() == 2


def windows_and_points(spark, ends):
    """Per key half-hour windows, then one that is open or ends as ``ends`` says; points before, in and years after them."""
    start = dt.datetime(2024, 1, 31, 12)
    at = [start + dt.timedelta(minutes=30 * i) for i in range(60)]
    rows = [(k, a, a + dt.timedelta(minutes=30), i) for k in (1, 2) for i, a in enumerate(at)]
    rows += [(k, at[-1] + dt.timedelta(minutes=30), e, 99) for k, e in zip((1, 2), ends)]
    windows = spark.createDataFrame(rows, "k long, f timestamp_ntz, t timestamp_ntz, w long")
    points = [(k, start + dt.timedelta(minutes=m)) for k in (1, 2, 3) for m in (-60, 0, 29, 30, 31, 1799, 1800, 1900, 5000, 10 ** 5, 10 ** 6, 2 * 10 ** 6)]
    return windows, spark.createDataFrame(points, "k long, at timestamp_ntz")


@pytest.mark.parametrize("ends", [(dt.datetime(9999, 12, 31), dt.datetime(9999, 12, 31)), (dt.datetime(2999, 1, 1), dt.datetime(2024, 2, 20)),
                                  (dt.datetime(2024, 2, 4), None)])
@pytest.mark.parametrize("unit", ["auto", "HOUR", "MONTH"])
def test_points_after_the_last_start(spark, ends, unit):
    windows, points = windows_and_points(spark, ends)
    windows.createOrReplaceTempView("w_brute")
    points.createOrReplaceTempView("p_brute")
    want = sorted(map(tuple, spark.sql("SELECT p.k, p.at, w.w FROM p_brute p LEFT JOIN w_brute w"
                                       " ON p.k = w.k AND p.at >= w.f AND p.at < w.t").collect()), key=str)
    for how in (validity.range_join(points, windows, "at", "f", "t", on=["k"], unit=unit),
                validity.range_join(points, windows, "at", "f", "t", on=["k"], unit=unit, broadcast_rows=None),
                validity.asof_join(points, windows, "at", "f", "t", on=["k"], unit=unit)):
        assert sorted(map(tuple, how.collect()), key=str) == want


def test_few_long_windows_don_t_explode_nor_hide_the_size(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(minutes=30 * i), start + dt.timedelta(minutes=30 * i + 30), "x" * 100) for i in range(20_000)]
    rows += [(start, dt.datetime(2999, 1, 1), "x" * 100)] * 6
    windows = spark.createDataFrame(rows, "f timestamp_ntz, t timestamp_ntz, note string")
    stats = validity.measure_windows(windows, "f", "t", "auto")
    made = validity.explode_windows(windows, "f", "t", stats.unit, stats.horizon).count()
    assert made <= stats.exploded_rows and made < 3 * len(rows) and stats.exploded_bytes > 100 * made
    wide = validity.prepare_windows(windows, "f", "t", broadcast_bytes=1 << 20)
    assert not wide.broadcast and validity.prepare_windows(windows, "f", "t").broadcast


def test_usage_is_asked_from_the_lookback_on(spark, tmp_dir):
    lk = pipeline.Lake(tmp_dir)
    before = readings(spark, [(1, "2023-12-31 23:30:00", 1.0, 1), (1, "2024-01-01 00:00:00", 1.0, 2)])
    assert [r.version for r in pipeline.new_usage(spark, lk, before, ["meter_id"]).collect()] == [2]
    pipeline.load_usage(spark, lk, readings(spark, [(1, "2024-03-10 00:00:00", 1.0, 1), (2, "2024-02-10 00:00:00", 1.0, 2)]),
                        arrival=["version"], meter_keys=["meter_id"])
    landed = readings(spark, [(1, "2024-03-08 23:30:00", 1.0, 1), (1, "2024-03-09 00:00:00", 1.0, 2), (2, "2024-02-09 00:00:00", 1.0, 3),
                              (2, "2024-02-08 23:30:00", 1.0, 4), (3, "2024-01-01 00:00:00", 1.0, 5), (3, "2023-12-31 00:00:00", 1.0, 6)])
    assert sorted(r.version for r in pipeline.new_usage(spark, lk, landed, ["meter_id"]).collect()) == [2, 3, 5]
    assert sorted(r.version for r in pipeline.new_usage(spark, lk, landed).collect()) == [2]


def test_rates_need_agreements(spark, tmp_dir):
    lk = pipeline.Lake(tmp_dir)
    at = dt.datetime(2024, 1, 1)
    rates = spark.createDataFrame([(c, c, at, None, at, None, 0.2, at) for c in ("E-1R-A", "E-1R-B")], TARIFFS)
    with pytest.raises(pipeline.NoAgreements):
        pipeline.rates_for_agreements(spark, lk, rates)
    known = spark.createDataFrame([("E-1R-B", at, None, at, None, at)], AGREEMENTS).drop("ingestion_ts")
    pipeline.load_windows(spark, lk, lk.agreements, known, "agreements_feed")
    assert [r.tariff_code for r in pipeline.rates_for_agreements(spark, lk, rates).collect()] == ["E-1R-B"]


def test_a_load_leaves_no_scratch(spark, tmp_dir):
    def scratch():
        root = run_scratch(spark).removeprefix("file:")
        return {n for n in (os.listdir(root) if os.path.isdir(root) else ()) if n.startswith("upsert-")}
    lk = pipeline.Lake(tmp_dir)
    batch = readings(spark, [(1, "2024-01-01 00:00:00", 1.0, 1)])
    before = scratch()
    for _ in range(2):
        pipeline.load_usage(spark, lk, batch, arrival=["version"])
    assert scratch() == before


def test_sql_models_by_meter(spark):
    from wattline.registry import QUERIES
    sf = "/root/testdata/sf0.001"
    a, b = (sorted(map(str, QUERIES[q](spark, sf).collect())) for q in ("fct_cost_per_meter", "fct_cost_sql_per_meter"))
    assert a == b and a
