"""String helpers over tariff codes (JVM built-ins, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def product_code(tariff_code: Column | str) -> Column:
    """Drop the first two and the last dash-separated parts, rejoin the rest.

    ``E-1R-INTELLI-VAR-22-10-14-A`` → ``INTELLI-VAR-22-10-14``. Codes with
    fewer than four parts give ``''``; NULL stays NULL.
    """
    c = F.col(tariff_code) if isinstance(tariff_code, str) else tariff_code
    parts = F.split(c, "-", -1)
    keep = F.greatest(F.size(parts) - 3, F.lit(0))
    return F.array_join(F.slice(parts, 3, keep), "-")
