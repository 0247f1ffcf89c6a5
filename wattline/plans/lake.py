"""Exports to the lake: allow-listed, sorted snapshots and day-partitioned loads."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.filters import allow_list

# Columns that identify a person or a meter never leave the private zone.
IDENTIFIERS = ("meter_id", "mpan", "serial", "account", "user_id")


@dataclass(frozen=True)
class ExportSpec:
    table: str
    columns: tuple[str, ...]
    order_by: tuple[str, ...]
    partition_field: str | None = None   # event-time column; the lake partitions by its day


EXPORTS: dict[str, ExportSpec] = {
    "raw_consumption": ExportSpec(
        "raw_consumption",
        ("interval_start_utc", "interval_start_uk", "kwh", "ingestion_ts"),
        ("interval_start_utc",), partition_field="interval_start_utc"),
    "raw_agreements": ExportSpec(
        "raw_agreements",
        ("tariff_code", "valid_from_utc", "valid_to_utc", "valid_from_uk", "valid_to_uk", "ingestion_ts"),
        ("valid_from_utc",)),
    "raw_tariffs": ExportSpec(
        "raw_tariffs",
        ("tariff_code", "product_code", "valid_from_utc", "valid_to_utc", "valid_from_uk",
         "valid_to_uk", "unit_rate", "ingestion_ts"),
        ("valid_from_utc",)),
}

DAY_COLUMN = "day"


def snapshot(df: DataFrame, spec: ExportSpec) -> DataFrame:
    """Allow-listed projection, sorted by the spec's key (tight row-group stats)."""
    return allow_list(df, spec.columns, IDENTIFIERS).orderBy(*spec.order_by)


def write_snapshot(df: DataFrame, spec: ExportSpec, root: str, mode: str = "overwrite") -> str:
    """Write one table under ``root/bronze/<table>``; ``mode`` is overwrite (truncate) or append."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' (truncate) or 'append'")
    path = f"{root.rstrip('/')}/bronze/{spec.table}"
    out = snapshot(df, spec)
    writer = out.write.mode(mode).option("partitionOverwriteMode", "static")   # truncate means all of it
    if spec.partition_field:
        out = out.withColumn(DAY_COLUMN, F.to_date(spec.partition_field))
        # Range-partitioned on (day, sort key): a day is written by few tasks, in
        # order, and a hot day is still split (equal range keys share a task).
        out = out.repartitionByRange(DAY_COLUMN, *spec.order_by).sortWithinPartitions(DAY_COLUMN, *spec.order_by)
        writer = out.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(DAY_COLUMN)
    writer.parquet(path)
    return path


def export_tables(tables: Mapping[str, DataFrame], names: Iterable[str], root: str,
                  mode: str = "overwrite") -> dict[str, str]:
    """Export several named tables; an unknown name is an error that lists valid ones."""
    names = list(names)
    if strange := set(names) - set(EXPORTS):
        raise ValueError(f"no export is defined for {sorted(strange)}; defined are {sorted(EXPORTS)}")
    return {name: write_snapshot(tables[name], EXPORTS[name], root, mode) for name in names}


def write_by_day(df: DataFrame, path: str, ts: str, mode: str = "overwrite") -> str:
    """Day time-partitioning on event time (``day=YYYY-MM-DD`` folders)."""
    (df.withColumn(DAY_COLUMN, F.to_date(ts))
     .hint("rebalance", DAY_COLUMN)
     .write.mode(mode).option("partitionOverwriteMode", "static")
     .partitionBy(DAY_COLUMN).parquet(path))
    return path


def in_order(spark: SparkSession, path: str) -> DataFrame:
    """The rows of an export with ``place``, their number from 1 in the order in which they were written.

    Days (if it is partitioned), then files by name, then rows by their number in the file; one row a file is numbered in one place.
    """
    rows = spark.read.parquet(path)
    parts = [c for c in rows.columns if c == DAY_COLUMN]
    rows = rows.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_name").alias("__name"),
                       F.col("_metadata.row_index").alias("__row"))
    files = rows.groupBy("__path", "__name", *parts).agg(F.count(F.lit(1)).alias("__n")).withColumn("__one", F.lit(1))
    before = Window.partitionBy("__one").orderBy(*parts, "__name").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(F.col("__path").alias("__file"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (rows.join(files.hint("merge"), F.col("__path") == F.col("__file"))
            .withColumn("place", F.col("__before") + F.col("__row") + 1).drop("__path", "__name", "__row", "__file", "__before"))
