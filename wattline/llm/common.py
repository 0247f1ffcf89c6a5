"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, scratch_path

__all__ = ["blocks", "bound_arrow", "materialise", "next_rows", "scratch_path", "table", "tokenizer_path"]

#: Rows of one Arrow batch handed to Python. Texts are long; 256 of them keep a worker small.
ARROW_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by Spark's reader (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bound_arrow(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the Arrow batches that Python workers get, and let them import this package.

    Workers look for the package where the driver found it, besides their own
    path: a cluster ships it as usual (an image or ``--py-files``).
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    root = str(Path(__file__).resolve().parents[2])
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", max_bytes: int = 16 << 20) -> Iterator[pa.Table]:
    """Join Arrow batches to blocks of about ``max_bytes`` of text.

    A block holds at least one batch, and a batch is cut where its texts pass
    the bound, so one block never exceeds the bound by more than one text.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start = 0
        for i, n in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
            size += n or 0
            if size >= max_bytes:
                held.append(batch.slice(start, i + 1 - start))
                yield pa.Table.from_batches(held)
                held, size, start = [], 0, i + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def next_rows(keys: DataFrame, order: list[str], carry: list[str]) -> DataFrame:
    """Each row with the ``carry`` columns of its successor as ``next_<c>`` (the last row gets the first's).

    ``keys`` is a narrow table. It is range-partitioned on ``order`` and
    written once, so that a partition is a contiguous run; the successor of a
    run's last row is the head of the next run that has rows. Only one row a
    run meets in one place. ``order`` must be unique.
    """
    from pyspark.sql import Window as W

    runs = materialise(keys.repartitionByRange(*order).withColumn("_run", F.spark_partition_id()), "runs")
    inside = W.partitionBy("_run").orderBy(*order)
    heads = (runs.groupBy("_run").agg(F.min(F.struct(*order, *[F.col(c).alias(f"_c_{c}") for c in carry])).alias("_h"))
             .withColumn("_one", F.lit(1)))
    chain = W.partitionBy("_one").orderBy("_run")
    heads = heads.select("_run", F.coalesce(F.lead("_h").over(chain), F.first("_h").over(
        chain.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("_after"))
    here = runs.withColumn("_follow", F.lead(F.struct(*[F.col(c).alias(f"_c_{c}") for c in carry])).over(inside))
    return (here.join(heads, "_run")
            .select(*keys.columns, *[F.when(F.col("_follow").isNotNull(), F.col(f"_follow._c_{c}"))
                                     .otherwise(F.col(f"_after._c_{c}")).alias(f"next_{c}") for c in carry]))
