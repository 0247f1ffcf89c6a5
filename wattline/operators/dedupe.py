"""Keep one row per key: the newest version (W1) or the first seen (A9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _order(cols: Sequence[str | Column], descending: bool) -> list[Column]:
    out = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        out.append(col.desc_nulls_last() if descending else col.asc_nulls_last())
    return out


def _top_one(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    # row_number() = 1 is planned with a WindowGroupLimit before the shuffle, so
    # each map task forwards at most one row per key: a hot key costs no more
    # than #partitions rows in the exchange.
    rn = "__wl_rn"
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def latest_per_key(df: DataFrame, keys: Sequence[str], version: Sequence[str | Column],
                   tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """Newest row per key by ``version`` (e.g. ingestion time), descending.

    Equal versions are broken by ``tie_break`` (also descending, i.e. the row
    that arrived last wins), so the result is deterministic.
    """
    return _top_one(df, keys, _order([*version, *tie_break], descending=True))


def first_per_key(df: DataFrame, keys: Sequence[str], arrival: Sequence[str | Column]) -> DataFrame:
    """First row per key in arrival order (pandas ``drop_duplicates`` keep='first')."""
    return _top_one(df, keys, _order(arrival, descending=False))
