"""SQL functions for users who write their models as SQL text.

Registered as session-scoped SQL functions: their bodies are built-in
expressions, so Catalyst inlines and constant-folds them (no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import FAR_FUTURE

SQL_FUNCTIONS = {
    # The open-ended validity fill (the reference's macro of the same name).
    "far_future_timestamp":
        f"() RETURNS TIMESTAMP_NTZ RETURN TIMESTAMP_NTZ '{FAR_FUTURE}'",
    # Tariff code → product code: drop the first two and the last dash-separated parts.
    "product_code":
        "(code STRING) RETURNS STRING RETURN "
        "array_join(slice(split(code, '-', -1), 3, greatest(size(split(code, '-', -1)) - 3, 0)), '-')",
}


def register_sql_functions(spark: SparkSession) -> None:
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
