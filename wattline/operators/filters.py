"""Request-time predicates, previews and allow-list projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.time import parse_instant


def period(df: DataFrame, ts: str, period_from: str | None = None, period_to: str | None = None,
           ordered: bool = False) -> DataFrame:
    """Rows with ``period_from <= ts < period_to`` (ISO-8601 bounds, any offset), by ``ts`` if ``ordered``.

    The bounds fold to literals, so the predicate is pushed into the Parquet
    scan (and prunes day partitions when the table is partitioned by day).
    """
    cond = F.lit(True)
    if period_from is not None:
        cond = cond & (F.col(ts) >= parse_instant(F.lit(period_from)))
    if period_to is not None:
        cond = cond & (F.col(ts) < parse_instant(F.lit(period_to)))
    rows = df.filter(cond)
    return rows.orderBy(ts) if ordered else rows


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows in ``order`` (a top-k: each task keeps only its own n)."""
    return df.orderBy(*order).limit(n)


def allow_list(df: DataFrame, allowed: Sequence[str], refused: Sequence[str] = ()) -> DataFrame:
    """Project to exactly ``allowed``; refuse if a forbidden column would leave."""
    bad = [c for c in allowed if c in set(refused)]
    if bad:
        raise ValueError(f"columns not allowed to leave the private zone: {bad}")
    missing = [c for c in allowed if c not in df.columns]
    if missing:
        raise ValueError(f"allow-listed columns missing from the table: {missing}")
    return df.select(*allowed)


def dashboard(fact: DataFrame, tariff_codes: Sequence[str] | None = None, date_from: str | None = None,
              date_to: str | None = None, day_col: str | None = None) -> DataFrame:
    """Dashboard filters on the fact: tariff codes and a usage-date range (inclusive).

    With ``day_col`` (the table's day partition) the date bounds also prune
    partitions: usage dates are UK days, so the UTC day partition is widened
    by one day on each side.
    """
    cond = F.lit(True)
    if tariff_codes is not None:
        cond = cond & F.col("tariff_code").isin(list(tariff_codes))
    if date_from is not None:
        cond = cond & (F.col("usage_date") >= F.lit(date_from).cast("timestamp_ntz"))
        if day_col:
            cond = cond & (F.col(day_col) >= F.date_sub(F.lit(date_from).cast("date"), 1))
    if date_to is not None:
        cond = cond & (F.col("usage_date") <= F.lit(date_to).cast("timestamp_ntz"))
        if day_col:
            cond = cond & (F.col(day_col) <= F.date_add(F.lit(date_to).cast("date"), 1))
    return fact.filter(cond)
