"""Joins to windows of any length and as-of joins of points anywhere, against brute force and by their plans."""

import random

import pytest
from pyspark.sql import functions as F

from wattline.operators import validity

NTZ = "timestamp_ntz"


def windows_of(spark, rows):
    return spark.createDataFrame(rows, "k string, f string, t string, w long").select(
        "k", F.col("f").cast(NTZ).alias("valid_from"), F.col("t").cast(NTZ).alias("valid_to"), "w")


def points_of(spark, rows):
    return spark.createDataFrame(rows, "p long, k string, a string").select("p", "k", F.col("a").cast(NTZ).alias("at"))


def brute(points, windows):
    return points.join(windows, (points.k == windows.k) & (points.at >= windows.valid_from) & (points.at < windows.valid_to), "left").select(
        points.p, points.k, points.at, windows.w)


def rows_of(df):
    return sorted(map(repr, df.select("p", "k", "at", "w").collect()))


def mixed(rng, n):
    """Windows from a second to for ever."""
    out = []
    for i in range(n):
        start = rng.randrange(1_600_000_000, 1_700_000_000)
        long = rng.choice([1, 60, 1799, 1800, 1801, 3600, 86400, 86400 * 31, 86400 * 3650, None])
        end = "9999-12-31 00:00:00" if long is None else f"{stamp(start + long)}"
        out.append((rng.choice("abc"), stamp(start), end, i))
    return [*out, ("a", "2021-01-01 00:00:00", "2021-01-01 00:00:00", -1), ("a", None, "2021-01-01 00:00:00", -2), ("a", "1969-12-31 23:59:59.5", "1970-01-01 00:00:00.000001", -3)]


def stamp(seconds):
    import datetime as dt
    return str(dt.datetime(1970, 1, 1) + dt.timedelta(seconds=seconds))


@pytest.mark.parametrize("broadcast_rows", [None, 200_000])
def test_dyadic_equals_brute_force(spark, broadcast_rows):
    rng = random.Random(31)
    w = windows_of(spark, mixed(rng, 150))
    edges = [x for r in w.collect() for x in (r.valid_from, r.valid_to) if x]
    p = [(i, rng.choice("abcd"), str(x)) for i, x in enumerate(edges)] + [(900 + i, rng.choice("abc"), stamp(rng.randrange(1_600_000_000, 1_800_000_000))) for i in range(200)]
    p = points_of(spark, [*p, (2000, None, "2021-01-01 00:00:00"), (2001, "a", None), (2001, "a", None), (2002, "a", "1969-12-31 23:59:59.7")])
    got = validity.range_join_dyadic(p, w, "at", "valid_from", "valid_to", on=["k"], broadcast_rows=broadcast_rows)
    assert rows_of(got) == rows_of(brute(p, w)) and len(rows_of(got)) > 600
    inner = validity.range_join_dyadic(p, w, "at", "valid_from", "valid_to", on=["k"], how="inner", broadcast_rows=broadcast_rows)
    assert rows_of(inner) == rows_of(brute(p, w).where("w is not null"))
    none = validity.range_join_dyadic(p, w.limit(0), "at", "valid_from", "valid_to", on=["k"])
    assert none.count() == p.count() and none.where("w is not null").count() == 0


def test_a_long_window_costs_few_rows(spark):
    halves = [("a", stamp(1_600_000_000 // 1800 * 1800 + 1800 * i), stamp(1_600_000_000 // 1800 * 1800 + 1800 * (i + 1)), i) for i in range(500)]
    thirty = [("a", "1995-03-01 10:00:00", "2025-03-01 11:30:00", -1)]
    cut = validity.dyadic_windows(windows_of(spark, halves + thirty), "valid_from", "valid_to", ["k"]).pieces
    assert cut.where("__w_w >= 0").count() == 500 and cut.where("__w_w = -1").count() < 100
    assert validity.dyadic_windows(windows_of(spark, halves), "valid_from", "valid_to", ["k"]).levels == (0,)


def test_carried_equals_brute_force(spark):
    rng = random.Random(32)
    starts = sorted(rng.sample(range(1_600_000_000, 1_700_000_000), 60))
    w = [(k, stamp(a), stamp(rng.choice([b, (a + b) // 2])), i) for k in "ab" for i, (a, b) in enumerate(zip(starts, starts[1:]))]
    w += [("c", "2020-01-01 00:00:00", "9999-12-31 00:00:00", 7), (None, "2020-01-01 00:00:00", "9999-12-31 00:00:00", 8)]
    p = [(i, rng.choice("abcd"), stamp(rng.choice([rng.choice(starts), rng.randrange(1_590_000_000, 1_720_000_000)]))) for i in range(600)]
    p = points_of(spark, [*p, (2000, "c", None), (2000, "c", None)])
    w = windows_of(spark, w)
    got = validity.asof_carried(p, w, "at", "valid_from", "valid_to", on=["k"])
    assert rows_of(got) == rows_of(brute(p, w))
    one = w.where("k = 'a'").drop("k")
    got = validity.asof_carried(p, one, "at", "valid_from", "valid_to")
    want = p.join(one, (p.at >= one.valid_from) & (p.at < one.valid_to), "left")
    assert rows_of(got) == rows_of(want)


def test_points_after_the_last_start_are_even_runs(spark):
    w = windows_of(spark, [("a", "2020-01-01 00:00:00", "2020-01-02 00:00:00", 1), ("a", "2020-01-02 00:00:00", "9999-12-31 00:00:00", 2)])
    p = spark.range(40_000).select(F.col("id").alias("p"), F.lit("a").alias("k"),
                                   F.timestamp_add("SECOND", F.col("id") % 5, F.lit("2031-01-01").cast(NTZ)).alias("at"))
    seen = []
    keep = validity.write_and_read
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # else so few rows are one run
    try:
        validity.write_and_read = lambda df, name="x": seen.append(keep(df, name)) or seen[-1]
        got = validity.asof_carried(p, w, "at", "valid_from", "valid_to", on=["k"])
    finally:
        validity.write_and_read = keep
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got.where("w = 2").count() == 40_000
    sizes = [r["count"] for r in seen[0].groupBy("__run").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 2 * 40_002 / len(sizes)           # one key, five instants: still even


def test_levels_grow_with_the_longest_window_only(spark):
    rng = random.Random(33)
    w = windows_of(spark, mixed(rng, 40))
    cut = validity.dyadic_windows(w, "valid_from", "valid_to", ["k"])
    assert max(cut.levels) < validity.DYADIC_LEVELS and cut.broadcast
    assert not validity.dyadic_windows(w, "valid_from", "valid_to", ["k"], broadcast_rows=10).broadcast


def test_a_window_is_two_rows_at_most_and_sparse_levels_are_one(spark, monkeypatch):
    rng = random.Random(34)
    w = windows_of(spark, [(f"k{i % 40}", stamp(1_600_000_000 + 4_000_000 * (i // 40)), stamp(1_600_000_000 + 4_000_000 * (i // 40) + rng.choice([86400, 900_000, 4_000_000])), i)
                           for i in range(400)] + [(f"k{i}", stamp(1_600_000_000), stamp(1_640_000_000), 1000 + i) for i in range(40)])
    cut = validity.dyadic_windows(w, "valid_from", "valid_to", ["k"])
    assert cut.pieces.count() <= 2 * 440 and len(cut.levels) == 1      # ten short windows a key and a long one: a point asks once
    p = points_of(spark, [(i, f"k{rng.randrange(45)}", stamp(rng.randrange(1_590_000_000, 1_650_000_000))) for i in range(900)])
    monkeypatch.setattr(validity, "write_and_read", lambda df, name="x": pytest.fail("pairs were written") if name == "pairs" else validity_write(df, name))
    got = validity.range_join_dyadic(p, w, "at", "valid_from", "valid_to", on=["k"], broadcast_rows=None)
    assert rows_of(got) == rows_of(brute(p, w))


validity_write = validity.write_and_read


def test_crowded_levels_stay_apart(spark):
    many = [("a", stamp(1_600_000_000 + 60 * i), stamp(1_600_000_000 + 60 * i + 1800), i) for i in range(3000)] + [
        (None, stamp(1_600_000_000), stamp(1_600_000_060), -5), ("a", "2015-01-01 00:00:00", "2025-01-01 00:00:00", -1)]
    w = windows_of(spark, many)
    cut = validity.dyadic_windows(w, "valid_from", "valid_to", ["k"])
    assert len(cut.levels) > 1 and cut.pieces.where("__w_k IS NULL").count() == 0
    p = points_of(spark, [(i, "a", stamp(1_600_000_000 + 701 * i)) for i in range(-20, 300)] + [(5000, "a", "2031-01-01 00:00:00")])
    assert rows_of(validity.range_join_dyadic(p, w, "at", "valid_from", "valid_to", on=["k"])) == rows_of(brute(p, w))
