"""What has changed since the last build: readings by load, windows by their differences.

Every load writes, before it touches the bronze table, the days that it will
touch together with its run id and the stamp its rows carry, and once more when it
is done. A build takes the loads that no earlier build has taken, reads those
days only, and reprices the keys whose stamp is one of theirs, however old
they are and whatever the newest reading of other meters is. A load is
taken once it was done before the build began; until then every build looks at its days again.

Windows are compared with the copy that the last build priced with. A window
that came, went or changed (its old and its new form) names the time in which readings are priced anew.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from ..operators.upsert import table_exists
from ..operators.validity import range_join
from ..session import materialise

CHANGES = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("stamp", T.TimestampNTZType(), False),
    T.StructField("day", T.DateType(), True),        # NULL: the load is done
])
BUILDS = T.StructType([T.StructField("run_id", T.StringType(), False)])


def log_days(spark: SparkSession, path: str, run_id: str, stamp: dt.datetime, days: Iterable[dt.date]) -> None:
    """The days a load is about to touch; to be written before the table is."""
    spark.createDataFrame([(run_id, stamp, d) for d in sorted(days)], CHANGES).coalesce(1).write.mode("append").parquet(path)


def log_done(spark: SparkSession, path: str, run_id: str, stamp: dt.datetime) -> None:
    spark.createDataFrame([(run_id, stamp, None)], CHANGES).coalesce(1).write.mode("append").parquet(path)


@dataclass(frozen=True)
class Pending:
    """Loads that no build has taken: their stamps and days, and the run ids of those that are done."""
    done: tuple[str, ...] = ()
    stamps: tuple[dt.datetime, ...] = ()
    days: tuple[dt.date, ...] = ()


def pending(spark: SparkSession, changes: str, builds: str) -> Pending:
    """Reads the two logs: a row per load and day since the last build, bounded by the calendar."""
    if not table_exists(spark, changes):
        return Pending()
    log = spark.read.schema(CHANGES).parquet(changes)
    if table_exists(spark, builds):
        log = log.join(spark.read.schema(BUILDS).parquet(builds), "run_id", "left_anti")
    rows = log.distinct().collect()
    return Pending(tuple(sorted({r.run_id for r in rows if r.day is None})), tuple(sorted({r.stamp for r in rows})),
                   tuple(sorted({r.day for r in rows if r.day is not None})))


def take(spark: SparkSession, builds: str, loads: Pending) -> None:
    """Remember the loads that were done when the build began."""
    if loads.done:
        spark.createDataFrame([(r,) for r in loads.done], BUILDS).coalesce(1).write.mode("append").parquet(builds)


def changed_windows(now: DataFrame, before: DataFrame | None, columns: Sequence[str]) -> DataFrame:
    """Windows that differ, old forms and new ones; all of them where there is no earlier copy."""
    now = now.select(*columns)
    if before is None:
        return now
    both = now.withColumn("__n", F.lit(1)).unionByName(before.select(*columns).withColumn("__n", F.lit(-1)))
    differ = both.groupBy(*columns).agg(F.sum("__n").alias("__n")).where("__n <> 0")     # one pass: both sides are read and shuffled once
    return differ.select(*columns, F.explode(F.sequence(F.lit(1), F.abs("__n"))).alias("__i")).drop("__i")


def spans(windows: Iterable[DataFrame], valid_from: str = "valid_from_utc", valid_to: str = "valid_to_utc") -> DataFrame:
    """The time that the windows cover, each stretch once: (valid_from, valid_to).

    Only changed windows come here. They are joined up within a month first (the running end of a
    month can't be split further), so that at most a row a month and stretch meets in one task.
    """
    rows = reduce(DataFrame.unionByName, [w.select(valid_from, valid_to) for w in windows]).where(F.col(valid_from) < F.col(valid_to)).distinct()

    def joined(df: DataFrame, *part: str) -> DataFrame:
        by = Window.partitionBy(*part).orderBy(valid_from, valid_to)
        reach = F.max(valid_to).over(by.rowsBetween(Window.unboundedPreceding, -1))
        new = F.coalesce((F.col(valid_from) > reach).cast("int"), F.lit(1))
        return (df.withColumn("__new", new).withColumn("__island", F.sum("__new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
                .groupBy(*part, "__island").agg(F.min(valid_from).alias(valid_from), F.max(valid_to).alias(valid_to)).drop("__island"))

    months = joined(rows.withColumn("__month", F.date_trunc("MONTH", valid_from)), "__month").drop("__month")
    return joined(months.withColumn("__all", F.lit(1)), "__all").drop("__all")


def readings_to_price(bronze: DataFrame, keys: Sequence[str], loads: Pending, windows: Sequence[DataFrame],
                      ts: str = "interval_start_utc", stamp: str = "ingestion_ts", day: str = "day") -> tuple[DataFrame, DataFrame]:
    """(rows of ``bronze`` that may be concerned, keys among them that must be priced anew).

    Both read only the day partitions that a load touched or a changed window covers: the days
    are literals, so the scan is pruned.
    """
    keys = list(keys)
    loaded = F.col(day).isin(list(loads.days)) if loads.days else F.lit(False)
    found = bronze.where(loaded & F.col(stamp).isin(list(loads.stamps))).select(*keys) if loads.days else bronze.where(F.lit(False)).select(*keys)
    wanted = loaded
    if windows:
        time = materialise(spans(windows), "changed-spans")
        low, high = time.agg(F.min("valid_from_utc"), F.max("valid_to_utc")).first()
        if low is not None:
            near = (F.col(day) >= F.lit(low.date())) & (F.col(day) <= F.lit(high.date()))
            inside = range_join(bronze.where(near).select(*keys), time, ts, "valid_from_utc", "valid_to_utc", how="inner")
            found, wanted = found.unionByName(inside), loaded | near
    return bronze.where(wanted), found.distinct()
