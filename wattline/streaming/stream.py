"""The consumption load as a stream: landed files → keyed upsert per micro-batch.

Each micro-batch is merged with ``operators.upsert.upsert`` where the higher
(``ingestion_ts``, tie-break) version wins, so a replayed batch changes
nothing and the table always equals the batch "latest version" view.
``trigger(availableNow=True)`` drains what has landed and stops, which fits a
scheduled run; the checkpoint lives in the shared checkpoint folder.

``stream_fact`` goes on from there: each micro-batch's keys are priced, and the
days they lie in are rolled up again, before the batch counts as done.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import strict_double
from ..operators import staging
from ..operators.pricing import price_intervals
from ..operators.upsert import table_exists, upsert
from ..plans import daily, incremental, pipeline

#: Micro-batches that are done, by the checkpoint of the stream they belong to.
BATCHES = T.StructType([T.StructField("stream", T.StringType(), False), T.StructField("batch_id", T.LongType(), False)])


def stream_upsert(spark: SparkSession, source_path: str, schema: T.StructType, target_path: str,
                  checkpoint_location: str, keys: Sequence[str], version: Sequence[str],
                  partition_col: str, partition_expr: Column, max_files_per_trigger: int = 1,
                  processing_time: str | None = None):
    """Run the keyed-upsert stream.

    By default ``availableNow``: drain what has landed, stop, and return
    ``None`` (a scheduled run). With ``processing_time`` (e.g. ``"5 minutes"``)
    the query keeps running and its handle is returned.
    """
    def merge(batch: DataFrame, epoch_id: int) -> None:
        # An empty micro-batch is a quiet no-op inside ``upsert``.
        upsert(batch.sparkSession, target_path, batch, keys, partition_col, partition_expr,
               version=version)

    return _drain(spark, source_path, schema, merge, checkpoint_location, max_files_per_trigger, processing_time)


def _drain(spark: SparkSession, source_path: str, schema: T.StructType, each, checkpoint_location: str,
           max_files_per_trigger: int, processing_time: str | None):
    writer = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_path)
              .writeStream
              .foreachBatch(each)
              .option("checkpointLocation", checkpoint_location))
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return None


def build_batch(spark: SparkSession, lk: pipeline.Lake, batch: DataFrame, version: Sequence[str], meter_keys: Sequence[str] = (),
                severity: str = "error") -> tuple:
    """Bring bronze, fact, slot masks and daily table up to one batch of readings; returns the days it touched.

    Readings are merged by version (``ingestion_ts`` first). Every key of the batch, whether its reading won or not, is
    then priced from the stored newest version, with the agreements and rates stored now; only the
    batch's days are read and rolled up. Each step replaces whole keys or days, so a batch that was cut
    short and comes again, or comes twice, ends in the same tables. Changed windows are left to ``pipeline.build_models``.
    """
    keys = [*meter_keys, "interval_start_utc"]
    rows = batch.select(*keys, "interval_start_uk", strict_double("kwh").alias("kwh"), *version)
    touched = upsert(spark, lk.consumption, rows, keys, "day", F.to_date("interval_start_utc"), version=version).touched
    if not touched:
        return ()
    stored = spark.read.parquet(lk.consumption).where(F.col("day").isin(list(touched))).drop("day")
    concerned = stored.join(batch.select(*keys).distinct(), keys, "left_semi")
    readings = staging.stg_consumption(concerned, keys=keys, tie_break=[v for v in version if v != "ingestion_ts"])
    windows = (staging.stg_agreements(spark.read.parquet(lk.agreements).drop("bucket")),
               staging.stg_tariffs(spark.read.parquet(lk.tariffs).drop("bucket")))
    pipeline.gate(pipeline.silver_tests(readings, *windows, meter_keys), severity)
    incremental.write_fact(spark, lk.fact, price_intervals(readings, *windows, meter_keys=meter_keys), meter_keys=meter_keys)
    daily.refresh_masks(spark, lk.fact, lk.masks, touched, meter_keys)
    fact = spark.read.parquet(lk.fact).where(F.col("day").isin(list(touched))).drop("day")
    pipeline.gate(pipeline.fact_tests(fact, meter_keys), severity)
    daily.refresh(spark, lk.fact, lk.daily, touched, meter_keys)
    return touched


def stream_fact(spark: SparkSession, source_path: str, schema: T.StructType, lk: pipeline.Lake, checkpoint_location: str,
                version: Sequence[str] = ("ingestion_ts",), meter_keys: Sequence[str] = (), severity: str = "error",
                max_files_per_trigger: int = 1, processing_time: str | None = None):
    """Run the stream from landed readings to fact and daily table; triggers as in ``stream_upsert``.

    A micro-batch is marked by its id after its last table is written; one that is marked already is passed
    over, one that isn't is built again. A failing test stops the stream before the mark. ``version`` must name
    ``ingestion_ts`` first; agreements and rates must have been loaded. A bronze table is fed by streams or
    by ``pipeline.load_usage``, not by both: their columns differ.
    """
    def build(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if table_exists(session, lk.stream_batches) and not session.read.schema(BATCHES).parquet(lk.stream_batches).where(
                (F.col("stream") == checkpoint_location) & (F.col("batch_id") == batch_id)).isEmpty():
            return
        build_batch(session, lk, batch, version, meter_keys, severity)
        session.createDataFrame([(checkpoint_location, batch_id)], BATCHES).coalesce(1).write.mode("append").parquet(lk.stream_batches)

    return _drain(spark, source_path, schema, build, checkpoint_location, max_files_per_trigger, processing_time)
