"""Ordered-series helpers that never put a whole key into one task.

``lead`` over ``partitionBy(key)`` sorts every row of a key in one task; with
one hot key (a single meter, a big customer) that is the whole table. Here the
order is cut into time buckets: the next value is found inside
(key, bucket), and only the last row of each bucket looks at a one-row-per-
(key, bucket) summary to find the first row of the next non-empty bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal ``on`` columns where NULL equals NULL, as in a GROUP BY; one copy of the columns is kept."""
    on = list(on)
    right = right.select(*[F.col(k).alias(f"__r_{k}") for k in on], *[c for c in right.columns if c not in on])
    joined = left.join(right, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in on], how)
    return joined if how == "left_anti" else joined.drop(*[f"__r_{k}" for k in on])


def next_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
                  bucket: Column, prefix: str = "next_") -> DataFrame:
    """Add ``next_<v>`` = value of the following row per key in ``order``.

    ``order`` must be a total order within a key (add a tie-break column).
    ``bucket`` must be monotone in the first order column (e.g. its day).
    Keys and bucket meet in one struct: structs compare NULL fields as equal,
    so a NULL key is a key like any other, and window and join share one exchange.
    """
    keys, order, values = list(keys), list(order), list(values)
    k = "__nio_key"
    first = "__nio_first"
    nxt = "__nio_next"
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)], bucket.alias("b")).alias(k)
    staged = df.select("*", key)
    inner = Window.partitionBy(k).orderBy(*order)
    staged = staged.withColumns({f"{prefix}{v}": F.lead(v).over(inner) for v in values})
    staged = staged.withColumn("__nio_last", F.lead(F.lit(1)).over(inner).isNull())
    if order == values and len(order) == 1:
        # First row of a bucket is just the minimum: a plain (hash) aggregate.
        first_row = F.struct(F.min(order[0]).alias("v0"))
    else:
        first_row = F.min(F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)],
                                   *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)]))
    summary = df.groupBy(key).agg(first_row.alias(first))
    across = Window.partitionBy(*[f"{k}.k{i}" for i in range(len(keys))]).orderBy(f"{k}.b")
    summary = summary.select(k, F.lead(first).over(across).alias(nxt))
    out = staged.join(summary, on=k, how="left")
    out = out.withColumns({
        f"{prefix}{v}": F.when(F.col("__nio_last"), F.col(f"{nxt}.v{i}")).otherwise(F.col(f"{prefix}{v}"))
        for i, v in enumerate(values)})
    return out.drop(k, nxt, "__nio_last")
