"""Idempotent keyed upserts on Parquet tables without MERGE.

A target table is partitioned by a column derived from its key (the UTC day of
``interval_start_utc``, the tariff code, ...), so every key lives in exactly
one partition. An upsert reads only the partitions the batch touches, merges
there, and rewrites just those partitions with dynamic partition overwrite.
Untouched partitions are never read or written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import discard, scratch_path
from .dedupe import first_per_key, latest_per_key


@dataclass(frozen=True)
class UpsertResult:
    path: str
    rows_in_batch: int      # rows after the in-batch dedupe ("fetched")
    rows_inserted: int      # net growth of the table; replaced rows count 0
    touched_partitions: int
    range_min: object = None  # min / max of ``range_cols`` over the batch (NULLs ignored)
    range_max: object = None
    touched: tuple = ()     # the touched partitions' values, in order


class EmptyBatch(ValueError):
    pass


class BadKeys(ValueError):
    """The batch has a NULL key, or several rows of one key and no order that picks one."""


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path``: no folder, or one without data files, is none.

    Anything else that goes wrong (an unreadable file, no permission) raises:
    it mustn't be taken for an empty table that may be overwritten.
    """
    try:
        spark.read.parquet(path).schema  # noqa: B018 - forces the footer read
        return True
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def upsert(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
           partition_col: str, partition_expr: Column,
           arrival: Sequence[str | Column] = (), version: Sequence[str] = (),
           range_cols: tuple[str, str] | None = None, allow_empty: bool = True,
           keep_duplicates: bool = False, before_write: Callable[[list], None] | None = None) -> UpsertResult:
    """Insert-or-replace ``batch`` into the table at ``path`` by ``keys``.

    * in-batch duplicates: the first row in ``arrival`` order wins; without
      ``arrival`` and ``version`` they raise ``BadKeys``, unless
      ``keep_duplicates`` asks for delete + insert of all of them;
    * a NULL in a key raises ``BadKeys``, before anything is written;
    * with ``version`` empty, a batch row replaces the stored row;
      with ``version`` set, the higher version wins (stream replays are harmless).
    ``partition_expr`` must be a function of the key columns. An empty batch
    raises ``EmptyBatch`` unless ``allow_empty``. ``before_write`` is told the
    partitions that are about to change, before any does.
    """
    keys = list(keys)
    staged = batch.withColumn(partition_col, partition_expr)
    if version:
        staged = latest_per_key(staged, keys, list(version))
    elif arrival:
        staged = first_per_key(staged, keys, list(arrival))
    batch_path, merged_path = scratch_path(spark, "upsert-batch"), scratch_path(spark, "upsert-merged")
    staged.write.parquet(batch_path)                # the batch is read several times below
    staged = spark.read.parquet(batch_path)
    if not (version or arrival or keep_duplicates) and staged.groupBy(*keys).count().where("count > 1").head(1):
        raise BadKeys(f"several rows of one key {keys} and no arrival order")
    # One small job: rows and range per touched partition (bounded by the calendar / code list).
    lo_col, hi_col = range_cols or (keys[0], keys[0])
    per_part = (staged.groupBy(partition_col)
                .agg(F.count(F.lit(1)), F.min(lo_col), F.max(hi_col),
                     F.count_if(reduce(or_, [F.col(k).isNull() for k in keys]))).collect())
    if any(r[4] or r[0] is None for r in per_part):
        raise BadKeys(f"NULL in the key {keys}")
    touched = [r[0] for r in per_part]
    fetched = sum(r[1] for r in per_part)
    if fetched == 0:
        if not allow_empty:
            raise EmptyBatch("No data returned: the batch is empty")
        discard(spark, batch_path)
        return UpsertResult(path, 0, 0, 0)     # nothing to do: quit quietly
    lows = [r[2] for r in per_part if r[2] is not None]
    highs = [r[3] for r in per_part if r[3] is not None]
    cols = [c for c in staged.columns]
    if before_write:
        before_write(touched)

    if table_exists(spark, path) and touched:
        # Read with the batch's schema: partition values keep their type (a code
        # that looks numeric stays a string) and the union lines up.
        current = (spark.read.schema(staged.schema).parquet(path)
                   .filter(F.col(partition_col).isin(touched)).select(*cols))
        before = current.count()
        if version:
            merged = latest_per_key(current.unionByName(staged), keys, list(version))
        else:
            kept = current.join(staged.select(*keys), on=keys, how="left_anti")
            merged = kept.unionByName(staged)
        # Cut lineage before overwriting the partitions it was read from.
        merged.write.parquet(merged_path)
        merged = spark.read.parquet(merged_path)
    else:
        before, merged = 0, staged
    after = merged.count()   # Parquet footers only
    (merged.hint("rebalance", partition_col).write
     .mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
    discard(spark, batch_path)                  # kept only where the upsert failed
    discard(spark, merged_path)
    return UpsertResult(path, fetched, after - before, len(touched),
                        min(lows) if lows else None, max(highs) if highs else None, tuple(sorted(touched)))
