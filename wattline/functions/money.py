"""Totals, means and strict numbers.

Totals are plain sums of doubles, so no digit of an input is cut. A double
sum's last digits depend on the order rows arrive in; whoever compares results
between runs or engines rounds the total, once, with ``rounded``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def total(col: Column | str) -> Column:
    return F.sum(_c(col).cast("double"))


def mean(col: Column | str) -> Column:
    """Mean of the non-NULL values, NULL when there are none."""
    return F.avg(_c(col).cast("double"))


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """``df`` with its double columns rounded, for comparison of finished totals."""
    return df.withColumns({c: F.round(c, places) for c, t in df.dtypes if t == "double"})


def strict_double(col: Column | str) -> Column:
    """Cast to double; a non-NULL value that is not a number fails the job
    (whatever the session's ANSI setting), so a bad load is never half right."""
    c = _c(col)
    x = c.try_cast("double")
    return F.when(c.isNotNull() & x.isNull(),
                  F.raise_error(F.concat(F.lit("not a number: "), c.cast("string")))).otherwise(x)
