"""The stream from readings to fact and daily table: late versions, replays, failing tests."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.plans import daily, incremental, pipeline
from wattline.schemas import AGREEMENTS, TARIFFS
from wattline.streaming import stream

AT = dt.datetime(2024, 1, 1)
SCHEMA = T.StructType([T.StructField("meter_id", T.LongType()), T.StructField("interval_start_utc", T.TimestampNTZType()),
                       T.StructField("interval_start_uk", T.TimestampNTZType()), T.StructField("kwh", T.DoubleType()),
                       T.StructField("ingestion_ts", T.TimestampNTZType())])


@pytest.fixture()
def lk(spark, tmp_dir):
    lk = pipeline.Lake(tmp_dir)
    a = spark.createDataFrame([("E-1R-A", AT, None, AT, None, AT)], AGREEMENTS).drop("ingestion_ts")
    r = spark.createDataFrame([("E-1R-A", "A", AT, None, AT, None, 0.5, AT)], TARIFFS).drop("ingestion_ts")
    pipeline.load_windows(spark, lk, lk.agreements, a, "a")
    pipeline.load_windows(spark, lk, lk.tariffs, r, "r")
    return lk


def land(spark, lk, rows):
    """(meter, day, kwh, version day)"""
    day = lambda n: dt.datetime(2024, 1, n)
    spark.createDataFrame([(m, day(d), day(d), k, day(v)) for m, d, k, v in rows], SCHEMA).coalesce(1).write.mode("append").parquet(lk.path("landed"))


def go(spark, lk, checkpoint="c", **kw):
    stream.stream_fact(spark, lk.path("landed"), SCHEMA, lk, lk.path(checkpoint), meter_keys=["meter_id"], **{"severity": "warn", **kw})
    fact = incremental.read_fact(spark, lk.fact)
    kept = sorted((r.meter_id, r.usage_date.day, r.total_cost) for r in daily.read(spark, lk.daily).collect())
    assert kept == sorted((r.meter_id, r.usage_date.day, r.c) for r in fact.groupBy("meter_id", "usage_date").agg(F.sum("cost").alias("c")).collect())
    return sorted((r.meter_id, r.interval_start_utc.day, r.cost) for r in fact.collect())


def test_late_versions_and_a_replay(spark, lk):
    land(spark, lk, [(1, 10, 1.0, 12), (2, 3, 2.0, 12)])
    first = [(1, 10, 0.5), (2, 3, 1.0)]
    assert go(spark, lk) == first
    land(spark, lk, [(1, 10, 9.0, 11), (1, 4, 3.0, 11)])      # an older version, and a reading that lags
    assert go(spark, lk) == sorted([*first, (1, 4, 1.5)])
    land(spark, lk, [(2, 3, 4.0, 13)])                                                # a correction
    after = [(1, 4, 1.5), (1, 10, 0.5), (2, 3, 2.0)]
    assert go(spark, lk) == after
    assert go(spark, lk, "again") == after
    assert spark.read.parquet(lk.stream_batches).count() == 6                         # a file a batch, three of each stream


def test_a_marked_batch_is_passed_over(spark, lk, monkeypatch):
    land(spark, lk, [(1, 10, 1.0, 12)])
    spark.createDataFrame([(lk.path("c"), 0)], stream.BATCHES).write.parquet(lk.stream_batches)
    monkeypatch.setattr(stream, "build_batch", lambda *a: pytest.fail("built again"))
    stream.stream_fact(spark, lk.path("landed"), SCHEMA, lk, lk.path("c"), meter_keys=["meter_id"])


def test_a_batch_cut_short_is_built_again(spark, lk, monkeypatch):
    land(spark, lk, [(1, 10, 1.0, 12)])
    go(spark, lk)
    land(spark, lk, [(1, 10, 3.0, 13), (1, 11, 1.0, 13)])
    with monkeypatch.context() as m:
        m.setattr(stream.daily, "refresh", lambda *a: 1 / 0)          # after the fact, before the daily table
        with pytest.raises(Exception):
            go(spark, lk)
    assert spark.read.parquet(lk.stream_batches).count() == 1
    assert go(spark, lk) == [(1, 10, 1.5), (1, 11, 0.5)]


def test_a_failing_test_stops_the_stream(spark, lk):
    land(spark, lk, [(1, 10, None, 12)])
    with pytest.raises(Exception, match="kwh not null"):
        go(spark, lk, severity="error")
    assert not stream.table_exists(spark, lk.stream_batches) and not stream.table_exists(spark, lk.fact)
