"""Audited loads: one row per run in an append-only Parquet table."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from ..schemas import AUDIT


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def append_audit(spark: SparkSession, path: str, row: dict) -> None:
    spark.createDataFrame([row], AUDIT).write.mode("append").parquet(path)


def audited_load(spark: SparkSession, audit_path: str, source: str,
                 load: Callable[[], tuple[int, int, dt.datetime | None, dt.datetime | None]],
                 run_id: str | None = None) -> dict:
    """Run ``load`` and append a SUCCESS row with its counts and range.

    ``load`` returns (records_fetched, records_inserted, min_interval,
    max_interval). On error a FAILED row with zero counts and the message is
    appended and the error is raised again.
    """
    row = dict(run_id=run_id or str(uuid.uuid4()), source=source, start_time=_now(), end_time=None, status="FAILED",
               records_fetched=0, records_inserted=0, min_interval=None, max_interval=None, error_message=None)
    try:
        fetched, inserted, lo, hi = load()
        row |= dict(status="SUCCESS", records_fetched=int(fetched), records_inserted=int(inserted),
                    min_interval=lo, max_interval=hi)
    except Exception as exc:
        row["error_message"] = str(exc)
        raise
    finally:                                     # whatever happened, the run leaves its row
        row["end_time"] = _now()
        append_audit(spark, audit_path, row)
    return row
