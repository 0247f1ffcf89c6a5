"""Hand-written cases (FIXTURES.md) and brute-force equivalence on small inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions import (day_start, hour_of_day, parse_instant, product_code,
                                to_uk_wall_clock)
from wattline.operators import dedupe, filters, pricing, quality, staging, validity
from wattline.operators.series import next_in_order
from wattline.plans import audit, incremental, lake
from wattline.schemas import FACT
from wattline.sources import catalog

NTZ = T.TimestampNTZType()


def ts(s):
    return dt.datetime.fromisoformat(s)


def half_hours(spark, start, n):
    return spark.range(n).select(
        F.timestamp_add("MINUTE", F.col("id") * 30, F.lit(start).cast("timestamp_ntz")).alias("utc"))


def test_uk_days_have_46_and_50_half_hours(spark):
    for start, day, expected in (("2024-03-30 00:00:00", "2024-03-31", 46),
                                 ("2024-10-26 00:00:00", "2024-10-27", 50)):
        df = half_hours(spark, start, 48 * 3).select(day_start(to_uk_wall_clock("utc")).alias("d"))
        counts = {r["d"].date().isoformat(): r["count"] for r in df.groupBy("d").count().collect()}
        assert counts[day] == expected


def test_repeated_wall_clock_keeps_two_rows(spark):
    df = spark.createDataFrame([(ts("2024-10-27 00:30:00"),), (ts("2024-10-27 01:30:00"),)],
                               T.StructType([T.StructField("utc", NTZ)]))
    out = df.select(to_uk_wall_clock("utc").alias("uk")).collect()
    assert [r.uk for r in out] == [ts("2024-10-27 01:30:00")] * 2


def test_literal_agreements_mixed_offsets(spark):
    # The three literal agreements of the reference's first load.
    rows = [("E-1R-VAR-21-05-19-A", "2021-06-29T00:00:00+01:00", "2022-12-05T00:00:00Z"),
            ("E-1R-INTELLI-VAR-22-10-14-A", "2022-12-05T00:00:00Z", "2025-07-01T00:00:00+01:00"),
            ("E-1R-INTELLI-VAR-24-10-29-A", "2025-07-01T00:00:00+01:00", None)]
    df = spark.createDataFrame(rows, "tariff_code string, valid_from string, valid_to string")
    out = df.select("tariff_code", parse_instant("valid_from").alias("f"), parse_instant("valid_to").alias("t"),
                    to_uk_wall_clock(parse_instant("valid_from")).alias("f_uk"),
                    product_code("tariff_code").alias("p")).orderBy("f").collect()
    assert out[0].f == ts("2021-06-28 23:00:00") and out[0].f_uk == ts("2021-06-29 00:00:00")
    assert out[1].t == ts("2025-06-30 23:00:00")
    assert out[2].t is None
    assert [r.p for r in out] == ["VAR-21-05-19", "INTELLI-VAR-22-10-14", "INTELLI-VAR-24-10-29"]


def test_short_codes_give_empty_product(spark):
    df = spark.createDataFrame([("E-1R-A",), ("A",), ("E-1R",), (None,), ("E-1R-X-A",)], "c string")
    out = [r.p for r in df.select(product_code("c").alias("p")).collect()]
    assert out == ["", "", "", None, "X"]


def test_time_band_hours(spark):
    df = spark.createDataFrame([(h,) for h in (6, 7, 15, 16, 19, 20, None)], "h bigint")
    out = [r.b for r in df.select(pricing.time_band("h").alias("b")).collect()]
    assert out == ["night", "day", "day", "peak", "peak", "day", "day"]


def _windows(spark, rows):
    return spark.createDataFrame(
        [(c, ts(f), ts(t) if t else None) for c, f, t in rows],
        T.StructType([T.StructField("tariff_code", T.StringType()), T.StructField("valid_from_utc", NTZ),
                      T.StructField("valid_to_utc", NTZ)]))


def _points(spark, stamps):
    return spark.createDataFrame([(ts(s), 1.0) for s in stamps],
                                 T.StructType([T.StructField("interval_start_utc", NTZ),
                                               T.StructField("kwh", T.DoubleType())]))


@pytest.mark.parametrize("broadcast_rows", [None, 1000])
def test_window_bounds_in_and_out(spark, broadcast_rows):
    w = staging.fill_open_ends(_windows(spark, [("A", "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
                                                ("B", "2024-01-02 00:00:00", None)]), ["valid_to_utc"])
    p = _points(spark, ["2024-01-01 00:00:00", "2024-01-01 23:30:00", "2024-01-02 00:00:00",
                        "2030-05-05 10:00:00", "2023-12-31 23:30:00"])
    out = validity.range_join(p, w, "interval_start_utc", "valid_from_utc", "valid_to_utc",
                              broadcast_rows=broadcast_rows)
    got = {r.interval_start_utc.isoformat(): r.tariff_code for r in out.collect()}
    assert got == {"2024-01-01T00:00:00": "A", "2024-01-01T23:30:00": "A", "2024-01-02T00:00:00": "B",
                   "2030-05-05T10:00:00": "B", "2023-12-31T23:30:00": None}


def test_overlap_fans_out_and_is_reported(spark):
    agreements = staging.fill_open_ends(_windows(spark, [("A", "2024-01-01 00:00:00", "2024-01-03 00:00:00"),
                                                         ("B", "2024-01-02 00:00:00", None)]),
                                        ["valid_to_utc"])
    rates = staging.fill_open_ends(_windows(spark, [("A", "2024-01-01 00:00:00", None)]),
                                   ["valid_to_utc"]).withColumn("unit_rate", F.lit(10.0))
    consumption = _points(spark, ["2024-01-01 12:00:00", "2024-01-02 12:00:00"]).withColumn(
        "interval_start_uk", to_uk_wall_clock("interval_start_utc"))
    fact = pricing.price_intervals(consumption, agreements, rates)
    assert fact.count() == 3
    dup = quality.unique_check(fact, ["interval_start_utc"]).collect()
    assert [(r.interval_start_utc, r.n_rows) for r in dup] == [(ts("2024-01-02 12:00:00"), 2)]
    ov = quality.overlapping_windows(agreements, [], "valid_from_utc", "valid_to_utc").collect()
    assert [r.tariff_code for r in ov] == ["B"]
    unpriced = {r.tariff_code: r.reason for r in quality.unpriced(fact).collect()}
    assert unpriced == {"B": "no_rate"}


def test_no_agreement_keeps_row_with_null_cost(spark):
    agreements = staging.fill_open_ends(_windows(spark, [("A", "2024-01-02 00:00:00", None)]), ["valid_to_utc"])
    rates = agreements.withColumn("unit_rate", F.lit(1.0))
    consumption = _points(spark, ["2024-01-01 12:00:00"]).withColumn("interval_start_uk",
                                                                     F.col("interval_start_utc"))
    r = pricing.price_intervals(consumption, agreements, rates).collect()
    assert len(r) == 1 and r[0].tariff_code is None and r[0].cost is None and r[0].kwh == 1.0
    assert quality.unpriced(pricing.price_intervals(consumption, agreements, rates)).first().reason == \
        "no_agreement"


def test_equal_ingestion_ts_breaks_ties_by_arrival(spark):
    t0 = ts("2024-01-01 00:00:00")
    raw = spark.createDataFrame([(t0, t0, 1.0, t0, 1), (t0, t0, 2.0, t0, 2), (t0, t0, 3.0, t0, 0)],
                                "interval_start_utc timestamp_ntz, interval_start_uk timestamp_ntz, kwh double,"
                                " ingestion_ts timestamp_ntz, version int")
    assert staging.stg_consumption(raw, tie_break=["version"]).first().kwh == 2.0
    assert dedupe.first_per_key(raw, ["interval_start_utc"], ["version"]).first().kwh == 3.0


def test_empty_fact_means_full_load_and_no_gaps(spark, tmp_dir):
    spark.createDataFrame([], FACT).withColumn("day", F.to_date("interval_start_utc")) \
        .write.partitionBy("day").parquet(tmp_dir)
    assert incremental.high_water_mark(spark, tmp_dir) is None
    assert quality.missing_intervals(spark.createDataFrame([], FACT)).count() == 0
    consumption = _points(spark, ["2024-01-01 00:00:00", "2024-01-01 00:30:00"]).withColumn(
        "interval_start_uk", F.col("interval_start_utc"))
    agreements = staging.fill_open_ends(_windows(spark, [("A", "2024-01-01 00:00:00", None)]), ["valid_to_utc"])
    rates = agreements.withColumn("unit_rate", F.lit(2.0))
    incremental.incremental_fact(spark, tmp_dir, consumption, agreements, rates)
    assert incremental.read_fact(spark, tmp_dir).count() == 2


def test_bad_number_fails_and_is_audited(spark, tmp_dir):
    def load():
        bad = spark.createDataFrame([("x1",)], "kwh string").select(F.col("kwh").cast("double"))
        bad.collect()
        return 1, 1, None, None
    with pytest.raises(Exception):
        audit.audited_load(spark, f"{tmp_dir}/audit", "usage_api", load)
    row = spark.read.parquet(f"{tmp_dir}/audit").first()
    assert row.status == "FAILED" and row.records_fetched == 0 and row.error_message


def test_identifier_columns_are_refused(spark):
    df = spark.createDataFrame([(1, 2.0)], "meter_id int, kwh double")
    with pytest.raises(ValueError):
        filters.allow_list(df, ["meter_id", "kwh"], lake.IDENTIFIERS)
    with pytest.raises(ValueError, match="defined are"):
        lake.export_tables({}, ["no_such_table"], "/nonexistent")
    for spec in lake.EXPORTS.values():
        assert not set(spec.columns) & set(lake.IDENTIFIERS)


def test_table_checks(spark, tmp_dir):
    from wattline.schemas import MONTHLY
    catalog.drop_table(spark, "wl_monthly")
    with pytest.raises(ValueError):
        catalog.require_table(spark, "wl_monthly")
    catalog.create_table_if_absent(spark, "wl_monthly", MONTHLY, tmp_dir)
    catalog.create_table_if_absent(spark, "wl_monthly", MONTHLY, tmp_dir)  # idempotent
    catalog.require_table(spark, "wl_monthly")
    cols = [r.col_name for r in catalog.describe(spark, "wl_monthly").collect()]
    assert cols[:2] == ["month", "kwh"]
    catalog.drop_table(spark, "wl_monthly", if_exists=False)
    assert not spark.catalog.tableExists("wl_monthly")


def test_period_filter_reaches_the_scan(spark, tmp_dir):
    _points(spark, ["2024-01-01 00:00:00", "2024-01-05 00:00:00"]).write.parquet(tmp_dir)
    df = filters.period(spark.read.parquet(tmp_dir), "interval_start_utc", "2024-01-02T00:00:00+01:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(interval_start_utc), GreaterThanOrEqual(interval_start_utc" in plan
    assert df.count() == 1


# ---------------------------------------------------------------------------
# Brute force on random small inputs
# ---------------------------------------------------------------------------

def _random_windows(spark, n_keys=4, n=40, seed=1, overlap=True):
    rnd = random.Random(seed)
    rows = []
    base = ts("2024-01-01 00:00:00")
    for k in range(n_keys):
        t = base
        for _ in range(n):
            start = t + dt.timedelta(hours=rnd.randint(0 if overlap else 1, 30))
            end = start + dt.timedelta(hours=rnd.randint(1, 60)) if rnd.random() > 0.05 else None
            if not overlap and end is not None:
                t = end
            else:
                t = start
            rows.append((k, start, end, len(rows)))
            if end is None and not overlap:
                break
    return spark.createDataFrame(rows, "k int, valid_from timestamp_ntz, valid_to timestamp_ntz, wid int")


def _random_points(spark, n=400, seed=2):
    rnd = random.Random(seed)
    base = ts("2023-12-31 00:00:00")
    rows = [(i, rnd.randint(0, 4), base + dt.timedelta(minutes=30 * rnd.randint(0, 48 * 80))) for i in range(n)]
    return spark.createDataFrame(rows, "pid int, k int, at timestamp_ntz")


def _brute(spark, points, windows):
    points.createOrReplaceTempView("bp")
    windows.createOrReplaceTempView("bw")
    return spark.sql("SELECT p.pid, w.wid FROM bp p LEFT JOIN bw w ON p.k = w.k"
                     " AND p.at >= w.valid_from AND p.at < w.valid_to")


def _pairs(df):
    return sorted((r.pid, -1 if r.wid is None else r.wid) for r in df.select("pid", "wid").collect())


@pytest.mark.parametrize("unit,broadcast_rows", [("DAY", None), ("HOUR", 10_000), ("MONTH", None)])
def test_range_join_equals_brute_force(spark, unit, broadcast_rows):
    windows = staging.fill_open_ends(_random_windows(spark), ["valid_to"])
    points = _random_points(spark)
    got = validity.range_join(points, windows, "at", "valid_from", "valid_to", on=["k"], unit=unit,
                              broadcast_rows=broadcast_rows)
    assert _pairs(got) == _pairs(_brute(spark, points, windows))


def test_asof_equals_range_on_disjoint_windows(spark):
    windows = staging.fill_open_ends(_random_windows(spark, overlap=False, seed=5), ["valid_to"])
    assert quality.overlapping_windows(windows, ["k"], "valid_from", "valid_to").count() == 0
    points = _random_points(spark, seed=7)
    got = validity.asof_join(points, windows, "at", "valid_from", "valid_to", on=["k"])
    assert _pairs(got) == _pairs(_brute(spark, points, windows))


def test_overlap_check_equals_window_form(spark):
    windows = _random_windows(spark, seed=3)
    got = quality.overlapping_windows(windows, ["k"], "valid_from", "valid_to", tie_break=["wid"])
    windows.createOrReplaceTempView("ow")
    want = spark.sql("SELECT wid FROM (SELECT *, max(valid_to) OVER (PARTITION BY k ORDER BY valid_from, wid"
                     " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM ow) WHERE m > valid_from")
    assert sorted(r.wid for r in got.collect()) == sorted(r.wid for r in want.collect())


def test_next_in_order_equals_lead(spark):
    pts = _random_points(spark, n=300, seed=11).dropDuplicates(["k", "at"])
    got = next_in_order(pts, ["k"], ["at"], ["at"], bucket=F.date_trunc("DAY", "at"))
    pts.createOrReplaceTempView("np")
    want = spark.sql("SELECT k, at, lead(at) OVER (PARTITION BY k ORDER BY at) AS next_at FROM np")
    assert sorted(got.select("k", "at", "next_at").collect()) == sorted(want.collect())


def test_gap_forms_agree(spark):
    pts = _random_points(spark, n=500, seed=13).select("k", F.col("at").alias("interval_start_utc"))
    a = quality.missing_intervals(pts, keys=["k"])
    b = quality.missing_by_gap(pts, keys=["k"])
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.count() > 0


def test_hour_of_day_is_bigint(spark):
    df = _points(spark, ["2024-06-01 10:00:00"]).select(hour_of_day(to_uk_wall_clock("interval_start_utc")).alias("h"))
    assert df.schema["h"].dataType == T.LongType() and df.first().h == 11


def test_mask_form_equals_series_off_grid(spark):
    rnd = random.Random(17)
    base = ts("2024-03-30 00:00:00")
    rows = []
    for k in range(3):
        for _ in range(150):
            minutes = 30 * rnd.randint(0, 48 * 6) + (rnd.choice([0, 0, 0, 7]) if k == 2 else 0)
            rows.append((k, base + dt.timedelta(minutes=minutes + 13 * k)))
    rows.append((0, rows[0][1]))  # a duplicate
    pts = spark.createDataFrame(rows, "k int, interval_start_utc timestamp_ntz")
    want = sorted(quality.missing_intervals(pts, keys=["k"]).collect())
    assert sorted(quality.missing_by_mask(pts, keys=["k"]).collect()) == want
    one = pts.filter("k = 1").drop("k")
    assert sorted(quality.missing_by_mask(one).collect()) == sorted(quality.missing_intervals(one).collect())


def test_auto_unit_follows_window_length():
    def spread(hours):
        return {u: 100 * (hours * 3600 // length + 1) for u, (_, length) in validity.UNITS.items()}
    assert validity.pick_unit("auto", 100, spread(6)) == "DAY"
    assert validity.pick_unit("auto", 100, spread(24 * 40)) == "MONTH"
    assert validity.pick_unit("auto", 100, spread(24 * 800)) == "YEAR"
    assert validity.pick_unit("auto", 100, spread(24 * 9000)) == "YEAR"
    assert validity.pick_unit("HOUR", 100, spread(24 * 9000)) == "HOUR"


def test_range_join_auto_equals_brute_force(spark):
    windows = staging.fill_open_ends(_random_windows(spark, seed=21), ["valid_to"])
    points = _random_points(spark, seed=22)
    got = validity.range_join(points, windows, "at", "valid_from", "valid_to", on=["k"], broadcast_rows=None)
    assert _pairs(got) == _pairs(_brute(spark, points, windows))


def test_incremental_run_prunes_bronze_partitions(spark, tmp_dir):
    pts = _points(spark, ["2024-01-01 00:00:00", "2024-01-05 00:00:00", "2024-01-09 00:00:00"])
    pts.withColumn("day", F.to_date("interval_start_utc")).write.partitionBy("day").parquet(tmp_dir)
    df = incremental.lookback_filter(spark.read.parquet(tmp_dir), ts("2024-01-09 00:00:00"), 1, day_col="day")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and ">= 2024-01-08" in plan
    assert df.count() == 1


def test_pipeline_stops_at_first_failure(spark, tmp_dir):
    from wattline.operators.upsert import EmptyBatch
    from wattline.plans import pipeline
    from wattline.schemas import AGREEMENTS, TARIFFS
    lk = pipeline.Lake(tmp_dir)
    empty_agreements = spark.createDataFrame([], AGREEMENTS).drop("ingestion_ts")
    tariffs = spark.createDataFrame([], TARIFFS).drop("ingestion_ts")
    usage = _points(spark, ["2024-01-01 00:00:00"]).withColumn("interval_start_uk", F.col("interval_start_utc"))
    with pytest.raises(EmptyBatch):
        pipeline.run(spark, lk, empty_agreements, tariffs, usage)
    rows = spark.read.parquet(lk.audit).collect()
    assert [(r.source, r.status) for r in rows] == [("agreements_feed", "FAILED")]
    assert not incremental.high_water_mark(spark, lk.consumption)


def test_materialize_model_forms(spark, tmp_dir):
    from wattline.plans import pipeline
    df = _points(spark, ["2024-01-01 00:00:00", "2024-01-01 00:30:00"])
    assert pipeline.materialize_model(spark, df, "wl_view").count() == 2
    assert spark.sql("SELECT count(*) AS n FROM wl_view").first().n == 2
    assert pipeline.materialize_model(spark, df, "wl_table", "table", path=f"{tmp_dir}/t").count() == 2
    inc = pipeline.materialize_model(spark, df, "wl_inc", "incremental", path=f"{tmp_dir}/i",
                                     unique_key=["interval_start_utc"], partition_col="day",
                                     partition_expr=F.to_date("interval_start_utc"))
    assert inc.count() == 2
    again = pipeline.materialize_model(spark, df, "wl_inc", "incremental", path=f"{tmp_dir}/i",
                                       unique_key=["interval_start_utc"], partition_col="day",
                                       partition_expr=F.to_date("interval_start_utc"))
    assert again.count() == 2
    with pytest.raises(ValueError):
        pipeline.materialize_model(spark, df, "x", "ephemeral")


def test_sql_functions(spark):
    from wattline.functions.sql import register_sql_functions
    register_sql_functions(spark)
    r = spark.sql("SELECT far_future_timestamp() AS f, product_code('E-1R-INTELLI-VAR-22-10-14-A') AS p,"
                  " product_code('E-1R-A') AS q").first()
    assert r.f == ts("9999-12-31 00:00:00") and r.p == "INTELLI-VAR-22-10-14" and r.q == ""


def test_monthly_usage_uses_the_uk_month(spark):
    from wattline.operators import rollups
    df = _points(spark, ["2024-06-30 23:30:00", "2024-06-30 22:30:00"]).withColumn(
        "interval_start_uk", to_uk_wall_clock("interval_start_utc"))
    got = {r.month.isoformat(): r.kwh for r in rollups.monthly_usage(df).collect()}
    assert got == {"2024-07-01": 1.0, "2024-06-01": 1.0}


def test_hot_key_series_work_is_split_by_bucket(spark):
    # One key holds every row: the lead must still be partitioned by (key, bucket).
    pts = spark.range(2000).select((F.col("id") % 1 + 7).alias("k"),
                                   F.timestamp_add("MINUTE", F.col("id") * 30,
                                                   F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("at"))
    out = next_in_order(pts, ["k"], ["at"], ["at"], bucket=F.date_trunc("DAY", "at"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__nio_key#" in plan      # one struct of key and bucket
    inner = [line for line in plan.splitlines() if "Window [lead" in line and "], [at#" in line]
    assert inner and all("[__nio_key#" in line for line in inner)                          # rows: inside (key, bucket)
    assert "HashAggregate" in plan                                                          # keys: over the summary
    rows = out.orderBy("at").collect()
    assert rows[0].next_at == ts("2024-01-01 00:30:00") and rows[-1].next_at is None
    assert sum(1 for r in rows if r.next_at is not None
               and (r.next_at - r.at) != dt.timedelta(minutes=30)) == 0


def test_salted_asof_equals_range(spark):
    windows = staging.fill_open_ends(_random_windows(spark, overlap=False, seed=31), ["valid_to"])
    points = _random_points(spark, seed=32)
    got = validity.asof_join(points, windows, "at", "valid_from", "valid_to", on=["k"], salt=7)
    assert _pairs(got) == _pairs(_brute(spark, points, windows))


def test_size_shuffles(spark):
    from wattline.session import size_shuffles
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 100 * 1024 ** 4) == 204_800
        assert size_shuffles(spark, 1024) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stream_keeps_newest_version_out_of_order(spark, tmp_dir):
    from wattline.streaming.stream import stream_upsert
    schema = T.StructType([T.StructField("interval_start_utc", NTZ), T.StructField("kwh", T.DoubleType()),
                           T.StructField("ingestion_ts", NTZ)])
    t0 = ts("2024-01-01 00:00:00")
    newer = spark.createDataFrame([(t0, 2.0, ts("2024-01-02 00:00:00"))], schema)
    older = spark.createDataFrame([(t0, 1.0, ts("2024-01-01 12:00:00")),
                                   (ts("2024-01-01 00:30:00"), 5.0, ts("2024-01-01 12:00:00"))], schema)
    newer.coalesce(1).write.parquet(f"{tmp_dir}/landed/a")   # arrives first
    older.coalesce(1).write.parquet(f"{tmp_dir}/landed/b")   # older versions arrive later
    src = f"{tmp_dir}/landed/*"
    for attempt in ("x", "y"):
        stream_upsert(spark, src, schema, f"{tmp_dir}/table", f"{tmp_dir}/ckpt-{attempt}",
                      keys=["interval_start_utc"], version=["ingestion_ts"], partition_col="day",
                      partition_expr=F.to_date("interval_start_utc"), max_files_per_trigger=1)
    got = {r.interval_start_utc: r.kwh for r in spark.read.parquet(f"{tmp_dir}/table").collect()}
    assert got == {t0: 2.0, ts("2024-01-01 00:30:00"): 5.0}


def test_stream_processing_time_mode(spark, tmp_dir):
    from wattline.streaming.stream import stream_upsert
    schema = T.StructType([T.StructField("interval_start_utc", NTZ), T.StructField("kwh", T.DoubleType()),
                           T.StructField("ingestion_ts", NTZ)])
    spark.createDataFrame([(ts("2024-01-01 00:00:00"), 3.0, ts("2024-01-02 00:00:00"))], schema) \
        .write.parquet(f"{tmp_dir}/landed/a")
    q = stream_upsert(spark, f"{tmp_dir}/landed/*", schema, f"{tmp_dir}/table", f"{tmp_dir}/ckpt",
                      keys=["interval_start_utc"], version=["ingestion_ts"], partition_col="day",
                      partition_expr=F.to_date("interval_start_utc"), processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(f"{tmp_dir}/table").first().kwh == 3.0


def test_per_meter_agreements_equal_brute_force(spark):
    rnd = random.Random(41)
    base = ts("2024-01-01 00:00:00")
    agreements, t = [], {}
    for m in range(5):
        start = base - dt.timedelta(days=rnd.randint(0, 3))
        for j in range(4):
            end = start + dt.timedelta(hours=rnd.randint(6, 60))
            agreements.append((m, f"CODE-{(m + j) % 3}", start, None if j == 3 else end))
            start = end
    a = staging.fill_open_ends(spark.createDataFrame(
        agreements, "meter_id int, tariff_code string, valid_from_utc timestamp_ntz, valid_to_utc timestamp_ntz"),
        ["valid_to_utc"])
    rates = [(f"CODE-{c}", base - dt.timedelta(days=5) + dt.timedelta(hours=8 * k),
              base - dt.timedelta(days=5) + dt.timedelta(hours=8 * (k + 1)), float(c + k)) for c in range(3)
             for k in range(40)]
    r = spark.createDataFrame(rates, "tariff_code string, valid_from_utc timestamp_ntz, "
                                     "valid_to_utc timestamp_ntz, unit_rate double")
    readings = [(m, base + dt.timedelta(minutes=30 * rnd.randint(-60, 48 * 6)), 1.0 + m) for m in range(5)
                for _ in range(60)]
    c = (spark.createDataFrame(readings, "meter_id int, interval_start_utc timestamp_ntz, kwh double")
         .dropDuplicates(["meter_id", "interval_start_utc"])
         .withColumn("interval_start_uk", to_uk_wall_clock("interval_start_utc")))
    for rows in (None, 10_000):
        got = pricing.price_intervals(c, a, r, meter_keys=["meter_id"], agreement_keys=["meter_id"],
                                      broadcast_rows=rows)
        c.createOrReplaceTempView("pm_c")
        a.createOrReplaceTempView("pm_a")
        r.createOrReplaceTempView("pm_r")
        want = spark.sql(
            "SELECT c.meter_id, c.interval_start_utc, a.tariff_code, t.unit_rate FROM pm_c c"
            " LEFT JOIN pm_a a ON c.meter_id = a.meter_id AND c.interval_start_utc >= a.valid_from_utc"
            " AND c.interval_start_utc < a.valid_to_utc"
            " LEFT JOIN pm_r t ON a.tariff_code = t.tariff_code AND c.interval_start_utc >= t.valid_from_utc"
            " AND c.interval_start_utc < t.valid_to_utc")
        key = lambda df: sorted(tuple(x) for x in df.select("meter_id", "interval_start_utc", "tariff_code",
                                                             "unit_rate").collect())
        assert key(got) == key(want)


def test_upsert_numeric_looking_partition_values(spark, tmp_dir):
    from wattline.operators.upsert import upsert
    df = spark.createDataFrame([("007", 1.0), ("12", 2.0)], "code string, v double")
    upsert(spark, tmp_dir, df, ["code"], "p", F.col("code"))
    upsert(spark, tmp_dir, spark.createDataFrame([("007", 5.0)], "code string, v double"), ["code"], "p",
           F.col("code"))
    got = {r.code: r.v for r in spark.read.parquet(tmp_dir).select("code", "v").collect()}
    assert got == {"007": 5.0, "12": 2.0}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_casts_fail_whatever_ansi(spark, ansi):
    from wattline.functions import strict_double
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = spark.createDataFrame([("1.5",), (None,)], "v string")
        assert [r.d for r in good.select(strict_double("v").alias("d")).collect()] == [1.5, None]
        df = spark.createDataFrame([("1.5",), (None,), ("x1",)], "v string")
        with pytest.raises(Exception, match="not a number"):
            df.select(strict_double("v")).collect()
        with pytest.raises(Exception, match="ISO-8601"):
            df.select(parse_instant("v")).collect()
        ok = spark.createDataFrame([("2024-01-01T00:00:00+01:00",), (None,)], "v string")
        assert [r.t for r in ok.select(parse_instant("v").alias("t")).collect()] == [ts("2023-12-31 23:00:00"), None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_export_truncate_then_append(spark, tmp_dir):
    cons = _points(spark, ["2024-01-01 00:00:00", "2024-01-02 00:30:00"]).select(
        "interval_start_utc", F.col("interval_start_utc").alias("interval_start_uk"), "kwh",
        F.col("interval_start_utc").alias("ingestion_ts"), F.lit(9).alias("meter_id"))
    agr = staging.fill_open_ends(_windows(spark, [("A", "2024-01-01 00:00:00", None)]), ["valid_to_utc"]).select(
        "tariff_code", "valid_from_utc", "valid_to_utc", F.col("valid_from_utc").alias("valid_from_uk"),
        F.col("valid_to_utc").alias("valid_to_uk"), F.col("valid_from_utc").alias("ingestion_ts"))
    tables_ = {"raw_consumption": cons, "raw_agreements": agr}
    out = lake.export_tables(tables_, list(tables_), tmp_dir)
    c = spark.read.parquet(out["raw_consumption"])
    assert "meter_id" not in c.columns and sorted(r.day.isoformat() for r in c.select("day").collect()) == [
        "2024-01-01", "2024-01-02"]
    lake.export_tables(tables_, ["raw_agreements"], tmp_dir, mode="append")
    assert spark.read.parquet(out["raw_agreements"]).count() == 2
    lake.export_tables(tables_, ["raw_agreements"], tmp_dir, mode="overwrite")
    assert spark.read.parquet(out["raw_agreements"]).count() == 1
    with pytest.raises(ValueError):
        lake.export_tables(tables_, ["raw_agreements"], tmp_dir, mode="merge")


def _per_meter_fixture(spark):
    rnd = random.Random(51)
    base = ts("2024-01-01 00:00:00")
    agreements = []
    for m in range(6):
        start = base - dt.timedelta(days=rnd.randint(0, 3))
        for j in range(4):
            end = start + dt.timedelta(hours=rnd.randint(6, 60))
            agreements.append((m, f"CODE-{(m + j) % 3}", start, None if j == 3 else end))
            start = end
    a = staging.fill_open_ends(spark.createDataFrame(
        agreements, "meter_id int, tariff_code string, valid_from_utc timestamp_ntz, valid_to_utc timestamp_ntz"),
        ["valid_to_utc"])
    r = staging.fill_open_ends(spark.createDataFrame(
        [(f"CODE-{c}", base - dt.timedelta(days=5) + dt.timedelta(hours=8 * k), None if k == 39 else
          base - dt.timedelta(days=5) + dt.timedelta(hours=8 * (k + 1)), float(c + k)) for c in range(3)
         for k in range(40)],
        "tariff_code string, valid_from_utc timestamp_ntz, valid_to_utc timestamp_ntz, unit_rate double"),
        ["valid_to_utc"])
    raw = spark.createDataFrame(
        [(m, base + dt.timedelta(minutes=30 * rnd.randint(-60, 48 * 6)), float(rnd.randint(1, 9)),
          base + dt.timedelta(seconds=rnd.randint(0, 10 ** 6)), i) for i, m in
         enumerate(rnd.randint(0, 5) for _ in range(700))],
        "meter_id int, interval_start_utc timestamp_ntz, kwh double, ingestion_ts timestamp_ntz, version int"
    ).withColumn("interval_start_uk", to_uk_wall_clock("interval_start_utc"))
    return raw, a, r


@pytest.mark.parametrize("broadcast_rows", [None, 100_000])
def test_price_readings_equals_two_step(spark, broadcast_rows):
    raw, a, r = _per_meter_fixture(spark)
    got = pricing.price_readings(raw, a, r, meter_keys=["meter_id"], agreement_keys=["meter_id"],
                                 tie_break=["version"], broadcast_rows=broadcast_rows)
    cons = staging.stg_consumption(raw, keys=["meter_id", "interval_start_utc"], tie_break=["version"])
    want = pricing.price_intervals(cons, a, r, meter_keys=["meter_id"], agreement_keys=["meter_id"])
    assert sorted(got.collect()) == sorted(want.collect())
    if broadcast_rows is None:
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        # the readings are exchanged once, on (meter_id, bucket), for both the dedupe and the join
        readings = [line for line in plan.splitlines() if "Exchange hashpartitioning(meter_id" in line]
        assert len(readings) == 1 and "__agreement_bucket" in readings[0]


def test_load_stamps_ingestion_time_and_run_id(spark, tmp_dir):
    import uuid as _uuid
    from wattline.plans import pipeline
    lk = pipeline.Lake(tmp_dir)
    usage = _points(spark, ["2024-01-01 00:00:00", "2024-01-01 00:30:00"]).withColumn(
        "interval_start_uk", F.col("interval_start_utc"))
    row = pipeline.load_usage(spark, lk, usage)
    assert str(_uuid.UUID(row["run_id"])) == row["run_id"]
    assert row["status"] == "SUCCESS" and row["records_fetched"] == 2 and row["records_inserted"] == 2
    assert row["start_time"] <= row["end_time"]
    assert row["min_interval"] == ts("2024-01-01 00:00:00") and row["max_interval"] == ts("2024-01-01 00:30:00")
    stamps = {r.ingestion_ts for r in spark.read.parquet(lk.consumption).collect()}
    assert len(stamps) == 1 and None not in stamps          # one load, one stamp
    again = pipeline.load_usage(spark, lk, usage)
    assert again["records_inserted"] == 0                    # replaced rows count 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_flagship_plan_shape(spark):
    from wattline.plans import fact as fact_plan
    plan = _plan(fact_plan.fact_from_tables(spark, "/root/testdata/sf0.001"))
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line
                or "Exchange rangepartitioning" in line]
    assert len(shuffles) == 1                                   # the dedupe, nothing else
    assert plan.count("BroadcastHashJoin") == 2 and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan
    clustered = _plan(fact_plan.fact_from_tables(spark, "/root/testdata/sf0.001", cluster_by_time=True))
    assert "Exchange rangepartitioning(interval_start_utc" in clustered
    assert "Exchange hashpartitioning" not in clustered


def test_unproven_window_side_is_not_broadcast(spark):
    windows = staging.fill_open_ends(_random_windows(spark, seed=61), ["valid_to"])
    points = _random_points(spark, seed=62)
    small_bound = validity.range_join(points, windows, "at", "valid_from", "valid_to", on=["k"],
                                      broadcast_rows=10)          # fails the bounded count
    plan = _plan(small_bound)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    proven = validity.range_join(points, windows, "at", "valid_from", "valid_to", on=["k"],
                                 broadcast_rows=100_000)
    assert "BroadcastHashJoin" in _plan(proven)


def test_pretty_printed_pages_read_multiline(spark):
    import json
    import os
    import tempfile
    from wattline.sources import pages
    root = tempfile.mkdtemp(prefix="wl-pages-")   # a local test fixture, written by the test
    page = {"next": None, "results": [
        {"interval_start": "2024-06-01T00:00:00+01:00", "interval_end": "2024-06-01T00:30:00+01:00",
         "consumption": 0.25},
        {"consumption_start": "2024-06-01T00:00:00Z", "consumption": "0.5"},
        {"interval_start": "2024-05-31T23:00:00Z", "consumption": 9.0}]}
    os.makedirs(f"{root}/page=0")
    with open(f"{root}/page=0/page.json", "w") as fh:
        json.dump(page, fh, indent=2)
    got = sorted((r.interval_start_utc, r.interval_start_uk, r.kwh)
                 for r in pages.usage_batch(spark, root, multi_line=True).collect())
    # 00:00+01:00 and 23:00Z are the same instant: first in page order wins.
    assert got == [(ts("2024-05-31 23:00:00"), ts("2024-06-01 00:00:00"), 0.25),
                   (ts("2024-06-01 00:00:00"), ts("2024-06-01 01:00:00"), 0.5)]


def test_bad_number_in_a_page_fails(spark):
    import json
    import os
    import tempfile
    from wattline.sources import pages
    root = tempfile.mkdtemp(prefix="wl-pages-")
    os.makedirs(f"{root}/page=0")
    with open(f"{root}/page=0/page.json", "w") as fh:
        json.dump({"next": None, "results": [{"interval_start": "2024-06-01T00:00:00Z", "consumption": "x1"}]}, fh)
    with pytest.raises(Exception, match="not a number"):
        pages.usage_batch(spark, root, multi_line=True).collect()


def test_flat_page_files_keep_file_order(spark):
    import json
    import tempfile
    from wattline.sources import pages
    root = tempfile.mkdtemp(prefix="wl-flat-")
    for n, kwh in ((1, "1.0"), (2, "2.0")):
        with open(f"{root}/page-{n:04d}.json", "w") as fh:
            json.dump({"next": None, "results": [{"interval_start": "2024-01-01T00:00:00Z", "consumption": kwh}]}, fh)
    got = pages.usage_batch(spark, root, multi_line=True).collect()
    assert [(r.interval_start_utc, r.kwh) for r in got] == [(ts("2024-01-01 00:00:00"), 1.0)]


def test_sql_models_plan_shape(spark):
    from wattline.registry import QUERIES
    plan = _plan(QUERIES["fct_cost_sql"](spark, "/root/testdata/sf0.001"))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan and "NestedLoop" not in plan
