"""Time functions over UTC ``timestamp_ntz`` columns (all JVM built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import FAR_FUTURE, HALF_HOUR_MINUTES, UK_ZONE


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_instant(col: Column | str) -> Column:
    """ISO-8601 text with any offset (``Z``, ``+01:00``) → UTC ``timestamp_ntz``.

    NULL stays NULL; malformed text fails the job whatever the ANSI setting,
    as a strict loader should. The session zone is UTC, so the NTZ cast is exact.
    """
    c = _c(col)
    parsed = c.try_cast("timestamp")
    return (F.when(c.isNotNull() & parsed.isNull(),
                   F.raise_error(F.concat(F.lit("not an ISO-8601 instant: "), c.cast("string"))))
            .otherwise(parsed).cast("timestamp_ntz"))


def to_uk_wall_clock(col: Column | str) -> Column:
    """UTC instant → naive Europe/London wall clock (repeats in autumn)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(UK_ZONE), _c(col))


def from_uk_wall_clock(col: Column | str) -> Column:
    """Naive Europe/London wall clock → UTC (ambiguous hours take the first)."""
    return F.convert_timezone(F.lit(UK_ZONE), F.lit("UTC"), _c(col))


def floor_half_hour(col: Column | str) -> Column:
    """Start of the 30-minute slot holding ``col``."""
    c = _c(col)
    minute_floor = F.date_trunc("MINUTE", c).cast("timestamp_ntz")
    return F.timestamp_add("MINUTE", -(F.minute(c) % HALF_HOUR_MINUTES), minute_floor)


def day_start(col: Column | str) -> Column:
    """Midnight of the same day, kept as ``timestamp_ntz`` (not a date)."""
    return F.date_trunc("DAY", _c(col)).cast("timestamp_ntz")


def month_start(col: Column | str) -> Column:
    """First day of the month as a ``date``."""
    return F.trunc(_c(col).cast("date"), "month")


def hour_of_day(col: Column | str) -> Column:
    return F.hour(_c(col)).cast("bigint")


def shift_days(col: Column | str, days: int) -> Column:
    return F.timestamp_add("DAY", F.lit(days), _c(col))


def iso_z(col: Column | str) -> Column:
    """UTC ``timestamp_ntz`` → ``2024-01-01T00:00:00Z`` text."""
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def far_future() -> Column:
    return F.lit(FAR_FUTURE).cast("timestamp_ntz")


def fill_open_end(col: Column | str) -> Column:
    """NULL end of a validity window → the far-future constant."""
    return F.coalesce(_c(col), far_future())
