"""Spark session and shared-folder helpers.

Every timestamp in this library is a ``timestamp_ntz`` that holds UTC (or a
naive UK wall clock), so the session time zone is pinned to UTC: casts between
``timestamp`` and ``timestamp_ntz`` are then exact.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. Shuffle partitions are sized for the local
# test machine; on a cluster the caller's own value wins (see ``configure``).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what is measured: no static broadcast from file-size
    # estimates; AQE may still switch to a broadcast join once a side's real
    # shuffle output is known to be small. Explicit, size-checked broadcast
    # hints in the library still apply.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library needs to an existing session, once.

    What the caller sets afterwards stays. How a write treats partitions is
    an option of that write, not of the session.
    """
    if spark.conf.get("spark.wattline.configured", None):
        return spark
    spark.conf.set("spark.wattline.configured", "true")
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, app_name: str = "wattline",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return (or create) a session with the library's settings.

    ``master`` is only used when no session exists yet (tests, bench); on a
    cluster the submitting environment decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder.config("spark.ui.enabled", "false")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    return configure(spark)


def size_shuffles(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 512 << 20) -> int:
    """Size the initial shuffle so no post-shuffle partition exceeds the target.

    AQE then coalesces partitions that come out small and splits skewed
    ones, so aim high: 100 TB at 512 MB gives about 200,000 partitions.
    Scan splits stay at 128 MB (``spark.sql.files.maxPartitionBytes``).
    """
    cores = spark.sparkContext.defaultParallelism
    n = max(cores, -(-input_bytes // target_partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(target_partition_bytes, 256 << 20)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
    return n


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset (local tests) is a private
    folder created and registered, once, so ``DataFrame.checkpoint()`` and the
    library's written intermediates work everywhere. On a cluster it must be set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="wattline-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for one intermediate table.

    Everything of one application sits under
    ``<spark.checkpoint.dir>/wattline/<applicationId>/`` (see ``run_scratch``),
    so a finished run's intermediates are removed by deleting one folder, or
    by a retention rule on the shared folder.
    """
    return f"{run_scratch(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def run_scratch(spark: SparkSession) -> str:
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/wattline/{spark.sparkContext.applicationId}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete one intermediate table of this application that nothing reads any more."""
    if not path.startswith(run_scratch(spark) + "/"):
        raise ValueError(f"not an intermediate table of this run: {path}")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df, name: str = "stage"):
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage in one pass (a reliable RDD checkpoint computes its input
    twice unless cached); a lost executor then re-reads files instead of
    recomputing the plan, and later counts come from Parquet footers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
