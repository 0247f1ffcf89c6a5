"""Data-quality checks. Each returns the failing rows (empty = pass)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise
from .series import join_null_safe, next_in_order

HALF_HOUR = "INTERVAL 30 MINUTES"


def null_check(df: DataFrame, columns: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """One row per (row, column) that is NULL, in a single pass over ``df``."""
    names = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return (df.select(*ids, F.explode(F.filter(names, lambda x: x.isNotNull())).alias("failed_column")))


def unique_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row (partial + final aggregation)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def _day(col: str) -> Column:
    return F.date_trunc("DAY", F.col(col)).cast("timestamp_ntz")


def half_hour_series(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Every half hour from the first to the last ``ts`` of each key, ends included.

    Generated in two steps — days per key, then slots per day — so no single
    row holds a whole multi-year series.
    """
    keys = list(keys)
    bounds = df.groupBy(*keys).agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"))
    days = bounds.select(*keys, "__lo", "__hi",
                         F.explode(F.sequence(_day("__lo"), _day("__hi"), F.expr("INTERVAL 1 DAY")))
                         .alias("__d"))
    # Slots are anchored on the first timestamp, as a stepped series is.
    step_us = 30 * 60 * 1_000_000
    first = F.timestamp_add("MICROSECOND",
                           F.ceil((F.unix_micros(F.greatest("__d", "__lo").cast("timestamp"))
                                   - F.unix_micros(F.col("__lo").cast("timestamp"))) / step_us) * step_us,
                           F.col("__lo"))
    last = F.least(F.col("__d") + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 MICROSECOND"),
                   F.col("__hi"))
    return (days.filter(first <= last)
            .select(*keys, F.explode(F.sequence(first, last, F.expr(HALF_HOUR))).alias(ts)))


def missing_intervals(df: DataFrame, ts: str = "interval_start_utc", keys: Sequence[str] = ()) -> DataFrame:
    """Half hours between first and last with no row (series ▷ table)."""
    series = half_hour_series(df, ts, keys)
    return join_null_safe(series, df.select(*keys, ts), [*keys, ts], "left_anti")


def missing_by_gap(df: DataFrame, ts: str = "interval_start_utc", keys: Sequence[str] = ()) -> DataFrame:
    """Same answer from gaps between neighbours: only the holes are generated.

    Equal to ``missing_intervals`` when timestamps lie on the series grid (as
    floored half-hour slots do); an off-grid reading anchors its own holes.
    ``missing_by_mask`` is exact in both cases.
    """
    keys = list(keys)
    # Duplicate timestamps give a zero gap, so no distinct (and no shuffle) is needed.
    pts = df.select(*keys, ts).filter(F.col(ts).isNotNull())
    nxt = next_in_order(pts, keys, [ts], [ts], bucket=_day(ts))
    gap_start = F.col(ts) + F.expr(HALF_HOUR)
    gap_end = F.col(f"next_{ts}") - F.expr(HALF_HOUR)
    holes = nxt.filter(F.col(f"next_{ts}").isNotNull() & (gap_start <= gap_end))
    return holes.select(*keys, F.explode(F.sequence(gap_start, gap_end, F.expr(HALF_HOUR))).alias(ts))


def unpriced(fact: DataFrame, ids: Sequence[str] = ("interval_start_utc",)) -> DataFrame:
    """Rows whose cost is NULL, with the cause: no agreement, no rate, or no usage."""
    reason = (F.when(F.col("tariff_code").isNull(), F.lit("no_agreement"))
               .when(F.col("unit_rate").isNull(), F.lit("no_rate"))
               .otherwise(F.lit("no_kwh")))
    return fact.filter(F.col("cost").isNull()).select(*ids, "tariff_code", reason.alias("reason"))


def prior_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
              bucket: Column, out: str) -> DataFrame:
    """``out`` = max of ``value`` over all earlier rows of the key (by ``order``).

    Inside (key, bucket) a running window; across buckets a per-bucket max
    carried forward over a one-row-per-bucket summary.
    """
    keys, order = list(keys), list(order)
    k = "__pm_key"          # one struct: NULL keys are equal, window and join share one exchange
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)], bucket.alias("b")).alias(k)
    inner = Window.partitionBy(k).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    staged = df.select("*", key).withColumn("__pm_in", F.max(value).over(inner))
    summary = df.groupBy(key).agg(F.max(value).alias("__pm_bmax"))
    across = (Window.partitionBy(*[f"{k}.k{i}" for i in range(len(keys))]).orderBy(f"{k}.b")
              .rowsBetween(Window.unboundedPreceding, -1))
    summary = summary.select(k, F.max("__pm_bmax").over(across).alias("__pm_before"))
    joined = staged.join(summary, on=k, how="left")
    return (joined.withColumn(out, F.greatest("__pm_in", "__pm_before"))
            .drop(k, "__pm_in", "__pm_before"))


def overlapping_windows(windows: DataFrame, keys: Sequence[str], valid_from: str, valid_to: str,
                        tie_break: Sequence[str] = (), unit: str = "MONTH") -> DataFrame:
    """Windows that start before an earlier window of the same key has ended.

    ``unit`` sets the time buckets that split a key's windows across tasks. Without
    keys every window is compared; one row per bucket then meets in one task (bounded by the calendar).
    """
    pm = prior_max(windows, keys, [valid_from, *tie_break], valid_to,
                   bucket=F.date_trunc(unit, F.col(valid_from)), out="overlaps_until")
    return pm.filter(F.col("overlaps_until") > F.col(valid_from))


_SLOT_US = 30 * 60 * 1_000_000
_DAY_US = 24 * 60 * 60 * 1_000_000


def slot_masks(df: DataFrame, ts: str = "interval_start_utc", keys: Sequence[str] = ()) -> DataFrame:
    """One row per (keys, UTC day, offset within the half hour): a 48-bit mask of its filled slots, and its first and last instant."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    day_us = F.unix_micros(F.date_trunc("DAY", F.col(ts)))
    offset = F.pmod(us, F.lit(_SLOT_US))
    slot = ((us - day_us - offset) / _SLOT_US).cast("int")
    return (df.filter(F.col(ts).isNotNull())
            .groupBy(*keys, day_us.alias("__day"), offset.alias("__off"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), slot)).alias("__mask"),
                 F.min(us).alias("__lo"), F.max(us).alias("__hi")))


def missing_by_mask(df: DataFrame, ts: str = "interval_start_utc", keys: Sequence[str] = ()) -> DataFrame:
    """Same answer as ``missing_intervals`` with no row-level shuffle.

    One partial aggregate folds each (key, UTC day, offset within the half
    hour) into a 48-bit slot mask with ``bit_or``, so only one row per key-day
    leaves a map task. A row fills a slot only if it lies on the key's series
    grid (anchored at the key's first timestamp), exactly as in the series form.
    Only the holes are expanded.
    """
    # One row per key-day: small; written once so the fact is scanned once.
    return holes_of(materialise(slot_masks(df, ts, keys), "slot-masks"), ts, keys)


def holes_of(per_day: DataFrame, ts: str = "interval_start_utc", keys: Sequence[str] = ()) -> DataFrame:
    """The missing half hours that ``slot_masks`` tell. ``per_day`` is read twice: give a written table."""
    given = list(keys)
    keys = given or ["__all"]           # one series: a constant key, not a cross join
    if not given:
        per_day = per_day.withColumn("__all", F.lit(0))
    bounds = per_day.groupBy(*keys).agg(F.min("__lo").alias("__klo"), F.max("__hi").alias("__khi"))
    bounds = bounds.withColumn("__koff", F.pmod("__klo", F.lit(_SLOT_US)))
    on_grid = (join_null_safe(per_day, bounds, keys, "inner").filter(F.col("__off") == F.col("__koff"))
               .select(*keys, "__day", "__mask"))
    first_day = F.col("__klo") - F.pmod("__klo", F.lit(_DAY_US))
    last_day = F.col("__khi") - F.pmod("__khi", F.lit(_DAY_US))
    days = bounds.select(*keys, "__klo", "__khi", "__koff",
                         F.explode(F.sequence(first_day, last_day, F.lit(_DAY_US))).alias("__day"))
    cover = join_null_safe(days, on_grid, [*keys, "__day"]).fillna({"__mask": 0})
    slot_us = lambda s: F.col("__day") + F.col("__koff") + s.cast("bigint") * _SLOT_US
    # Slots first, then the test: a filter within the array would be evaluated slot by slot without generated code.
    slots = cover.select("*", F.explode(F.sequence(F.lit(0), F.lit(47))).alias("__s"))
    empty = F.call_function("shiftright", F.col("__mask"), F.col("__s")).bitwiseAND(F.lit(1)) == 0
    out = slots.where(empty & (slot_us(F.col("__s")) >= F.col("__klo")) & (slot_us(F.col("__s")) <= F.col("__khi")))
    return out.select(*given, F.timestamp_micros(slot_us(F.col("__s"))).cast("timestamp_ntz").alias(ts))
