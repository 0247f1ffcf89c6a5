"""Builds price what has changed: by load, by window, by touched day."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattline.operators import quality, rollups
from wattline.plans import changes, daily, incremental, pipeline
from wattline.schemas import AGREEMENTS, TARIFFS

AT = dt.datetime(2024, 1, 1)


def readings(spark, rows):
    """(meter, slot, kwh)"""
    return (spark.createDataFrame(rows, "meter_id long, s string, kwh double")
            .withColumn("interval_start_utc", F.col("s").cast("timestamp_ntz")).drop("s")
            .withColumn("interval_start_uk", F.col("interval_start_utc")))


def agreements(spark, *rows):
    return spark.createDataFrame([(c, f, t, f, t, AT) for c, f, t in rows or [("E-1R-A", AT, None)]], AGREEMENTS).drop("ingestion_ts")


def rates(spark, *rows):
    return spark.createDataFrame([(c, "A", f, t, f, t, r, AT) for c, f, t, r in rows or [("E-1R-A", AT, None, 0.5)]], TARIFFS).drop("ingestion_ts")


def run(spark, lk, rows, a=None, r=None, **kw):
    return pipeline.run(spark, lk, a or agreements(spark), r or rates(spark), readings(spark, rows), severity="warn", meter_keys=["meter_id"], **kw)


def fact_rows(spark, lk):
    return sorted((r.meter_id, r.interval_start_utc, r.cost) for r in incremental.read_fact(spark, lk.fact).collect())


def test_a_meter_that_lags_is_priced(spark, tmp_dir):
    lk = pipeline.Lake(tmp_dir)
    run(spark, lk, [(1, "2024-01-10 00:00:00", 1.0), (2, "2024-01-02 00:00:00", 1.0)])
    out = run(spark, lk, [(2, "2024-01-03 00:00:00", 3.0)])
    assert (2, dt.datetime(2024, 1, 3), 1.5) in fact_rows(spark, lk) and len(fact_rows(spark, lk)) == 3
    assert sorted((r.meter_id, r.usage_date.day, r.total_cost) for r in out["daily"].collect()) == [(1, 10, 0.5), (2, 2, 0.5), (2, 3, 1.5)]


def test_marks_by_meter(spark, tmp_dir):
    a, r = agreements(spark), rates(spark)
    for rows in ([(1, "2024-01-10 00:00:00", 1.0), (2, "2024-01-02 00:00:00", 1.0)],
                 [(1, "2024-01-08 00:00:00", 9.0), (2, "2024-01-01 12:00:00", 2.0), (2, "2023-12-31 00:00:00", 9.0), (3, "2024-01-01 00:00:00", 4.0)]):
        incremental.incremental_fact(spark, tmp_dir, readings(spark, rows), a, r, meter_keys=["meter_id"])
    got = sorted((x.meter_id, x.interval_start_utc.day, x.kwh) for x in incremental.read_fact(spark, tmp_dir).collect())
    assert got == [(1, 10, 1.0), (2, 1, 2.0), (2, 2, 1.0), (3, 1, 4.0)]


def test_changed_windows_reprice_their_time_only(spark, tmp_dir):
    lk, day = pipeline.Lake(tmp_dir), lambda n: dt.datetime(2024, 1, n)
    rows = [(1, f"2024-01-{d:02d} 00:00:00", 1.0) for d in range(1, 10)]
    first = rates(spark, ("E-1R-A", AT, day(3), 1.0), ("E-1R-A", day(3), day(5), 2.0), ("E-1R-A", day(5), None, 3.0))
    run(spark, lk, rows, r=first)
    before = {p: dt_ for p, dt_ in _files(spark, lk.fact)}
    # the rate of the 3rd ends a day early, another follows; nothing else differs
    then = rates(spark, ("E-1R-A", AT, day(3), 1.0), ("E-1R-A", day(3), day(4), 2.0), ("E-1R-A", day(4), day(5), 7.0), ("E-1R-A", day(5), None, 3.0))
    run(spark, lk, [(1, "2024-01-09 00:00:00", 1.0)], r=then)
    assert [c for _, _, c in fact_rows(spark, lk)] == [1.0, 1.0, 2.0, 7.0, 3.0, 3.0, 3.0, 3.0, 3.0]
    after = dict(_files(spark, lk.fact))
    same = {p.split("day=")[1][:10] for p in set(before) & set(after)}
    assert {"2024-01-01", "2024-01-02", "2024-01-06", "2024-01-07", "2024-01-08"} <= same and "2024-01-04" not in same


def _files(spark, path):
    return [(r.p, r.t) for r in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("p"),
                                                                F.col("_metadata.file_modification_time").alias("t")).distinct().collect()]


def test_an_agreement_that_ends_takes_its_price_along(spark, tmp_dir):
    lk = pipeline.Lake(tmp_dir)
    run(spark, lk, [(1, "2024-01-02 00:00:00", 1.0), (1, "2024-01-05 00:00:00", 1.0)])
    run(spark, lk, [(1, "2024-01-05 00:00:00", 2.0)], a=agreements(spark, ("E-1R-A", AT, dt.datetime(2024, 1, 2))))
    assert [c for _, _, c in fact_rows(spark, lk)] == [None, None]


def test_a_failed_build_s_changes_are_taken_again(spark, tmp_dir):
    lk = pipeline.Lake(tmp_dir)
    run(spark, lk, [(1, "2024-01-02 00:00:00", 1.0)])
    args = (agreements(spark), rates(spark), readings(spark, [(1, "2024-01-02 02:00:00", 4.0)]))
    with pytest.raises(pipeline.TestsFailed):
        pipeline.run(spark, lk, *args, meter_keys=["meter_id"])                     # three half hours are missing
    assert daily.read(spark, lk.daily).first().total_kwh == 1.0
    out = run(spark, lk, [(2, "2024-01-07 00:00:00", 1.0)])
    assert sorted(r.total_kwh for r in out["daily"].collect()) == [1.0, 5.0] and out["tests"]["no_missing_intervals"] == 3
    assert changes.pending(spark, lk.changes, lk.builds) == changes.Pending()


def test_a_load_that_never_ended_stays_pending(spark, tmp_dir):
    lk = pipeline.Lake(tmp_dir)
    changes.log_days(spark, lk.changes, "r1", AT, [AT.date()])
    changes.log_done(spark, lk.changes, "r2", AT)
    got = changes.pending(spark, lk.changes, lk.builds)
    changes.take(spark, lk.builds, got)
    assert got.done == ("r2",) and changes.pending(spark, lk.changes, lk.builds) == changes.Pending((), (AT,), (AT.date(),))


def test_spans_join_what_touches(spark):
    rows = [("2024-01-01", "2024-01-05"), ("2024-01-03", "2024-01-04"), ("2024-01-05", "2024-03-02"), ("2024-02-10", "2024-02-20"),
            ("2024-03-05", "9999-12-31"), ("2024-03-01", "2024-03-01"), ("2024-04-01", "2024-05-01")]
    w = spark.createDataFrame(rows, "f string, t string").select(F.col("f").cast("timestamp_ntz").alias("valid_from_utc"), F.col("t").cast("timestamp_ntz").alias("valid_to_utc"))
    got = sorted((str(r[0])[:10], str(r[1])[:10]) for r in changes.spans([w]).collect())
    assert got == [("2024-01-01", "2024-03-02"), ("2024-03-05", "9999-12-31")]


def test_touched_days_are_all_that_is_read(spark, tmp_dir):
    rows = [(m, f"2024-03-{d:02d} {h}:30:00", 1.0) for m in (1, 2) for d in range(1, 29) for h in ("00", "23")]
    fact = (readings(spark, rows).withColumn("interval_start_uk", F.timestamp_add("HOUR", F.lit(1), "interval_start_utc"))
            .withColumns({"usage_date": F.date_trunc("DAY", "interval_start_uk").cast("timestamp_ntz"), "cost": F.col("kwh"), "unit_rate": F.lit(1.0)}))
    path = f"{tmp_dir}/fact"
    incremental.write_fact(spark, path, fact, full_refresh=True)
    whole = rollups.daily_energy(fact, ["meter_id"])
    touched = daily.touched_rollup(spark, path, [dt.date(2024, 3, 10)], ["meter_id"])
    assert sorted((r.meter_id, r.usage_date.day) for r in touched.collect()) == [(m, d) for m in (1, 2) for d in (10, 11)]
    assert touched.drop("day").exceptAll(whole).count() == 0
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day" in plan and "2024-03-12" in plan and "2024-03-13" not in plan
    files = touched._jdf.queryExecution().toRdd().getNumPartitions()
    assert files >= 1
    daily.refresh(spark, path, f"{tmp_dir}/daily", None, ["meter_id"])
    got = daily.refresh(spark, path, f"{tmp_dir}/daily", [dt.date(2024, 3, 10)], ["meter_id"])
    assert got.exceptAll(whole).count() == 0 and got.count() == whole.count()


def test_masks_kept_by_day_tell_the_same_holes(spark, tmp_dir):
    rows = [(1, f"2024-03-{d:02d} 0{h}:00:00", 1.0) for d in (1, 2, 5) for h in (1, 3)] + [(2, "2024-03-02 00:00:00", 1.0)]
    path = f"{tmp_dir}/fact"
    more = [(2, "2024-03-04 00:00:00", 1.0)]
    for batch, days in ((rows, None), (more, [dt.date(2024, 3, 4)])):
        incremental.write_fact(spark, path, readings(spark, batch), full_refresh=days is None, meter_keys=["meter_id"])
        masks = daily.refresh_masks(spark, path, f"{tmp_dir}/masks", days, ["meter_id"])
    fact = incremental.read_fact(spark, path)
    got, want = (sorted(map(tuple, x.select("meter_id", "interval_start_utc").collect())) for x in (
        quality.holes_of(masks, keys=["meter_id"]), quality.missing_by_gap(fact, keys=["meter_id"])))
    assert got == want and len(got) > 100


def test_first_of_repeated_agreements_wins(spark, tmp_dir):
    lk = pipeline.Lake(tmp_dir)
    end = dt.datetime(2024, 2, 1)
    a = agreements(spark, ("E-1R-A", AT, None), ("E-1R-A", AT, end)).withColumn("place", F.when(F.col("valid_to_utc").isNull(), 2).otherwise(1))
    r = rates(spark, ("E-1R-A", AT, None, 0.5), ("E-1R-A", AT, None, 9.0)).withColumn("place", F.col("unit_rate"))
    run(spark, lk, [(1, "2024-01-02 00:00:00", 1.0)], a=a, r=r, agreements_arrival=["place"], tariffs_arrival=["place"])
    assert fact_rows(spark, lk)[0][2] == 0.5 and spark.read.parquet(lk.agreements).first().valid_to_utc == end


def test_a_run_asks_from_the_lookback_on(spark, tmp_dir):
    lk = pipeline.Lake(tmp_dir)
    run(spark, lk, [(1, "2024-01-10 00:00:00", 1.0), (2, "2024-01-03 00:00:00", 1.0)], usage_lookback=1)
    run(spark, lk, [(1, "2024-01-08 00:00:00", 1.0), (1, "2024-01-09 00:00:00", 1.0), (2, "2024-01-02 00:00:00", 1.0)], usage_lookback=1)
    assert [(m, t.day) for m, t, _ in fact_rows(spark, lk)] == [(1, 9), (1, 10), (2, 2), (2, 3)]


def test_rates_of_other_years_are_not_joined_and_readings_are_cleaned_once(spark, tmp_dir, monkeypatch):
    from wattline.operators import validity
    lk, joined, cleaned = pipeline.Lake(tmp_dir), [], []
    keep, clean = validity.write_and_read, pipeline.materialise
    monkeypatch.setattr(validity, "write_and_read", lambda df, name="x": joined.append(keep(df, name)) or joined[-1])
    monkeypatch.setattr(pipeline, "materialise", lambda df, name="x": cleaned.append(name) or clean(df, name))
    start = dt.datetime(2024, 1, 1)
    ends = [start + dt.timedelta(days=d) for d in range(-200, 201)]
    r = rates(spark, *[("E-1R-A", a, b, float(i)) for i, (a, b) in enumerate(zip(ends, ends[1:]))])
    run(spark, lk, [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-02 23:30:00", 1.0)], a=agreements(spark, ("E-1R-A", ends[0], None)), r=r)
    assert [x[2] for x in fact_rows(spark, lk)] == [200.0, 201.0]
    assert max(df.count() for df in joined if "unit_rate" in df.columns) == 2 and cleaned.count("stg-consumption") == 1


def test_changed_windows_count_repeats(spark):
    of = lambda *rows: spark.createDataFrame([(c, r) for c, r in rows], "tariff_code string, unit_rate double")
    now, before = of(("a", 1.0), ("a", 1.0), ("a", 1.0), ("b", None), ("c", 2.0)), of(("a", 1.0), ("b", None), ("b", None), ("c", 3.0))
    got = changes.changed_windows(now, before, ["tariff_code", "unit_rate"])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, now.exceptAll(before).unionByName(before.exceptAll(now)).collect()))
