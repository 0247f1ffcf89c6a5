"""Table management over the session catalog (Parquet tables)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _ddl(schema: T.StructType, defaults: Mapping[str, str]) -> str:
    if strange := set(defaults) - set(schema.names):
        raise ValueError(f"defaults for columns that aren't there: {sorted(strange)}")
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "") for f in schema.fields)


def create_table_if_absent(spark: SparkSession, name: str, schema: T.StructType, location: str,
                           partitioned_by: tuple[str, ...] = (), defaults: Mapping[str, str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS .. USING parquet``; keys are checked by ``quality.unique_check``.

    ``defaults``: SQL expressions of columns that an insert may leave out, such as ``localtimestamp()`` for the time a row came.
    """
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema, defaults or {})}) USING parquet{part} "
              f"LOCATION '{location}'")


def insert_rows(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Append ``rows``; columns of the table that they don't have get their defaults."""
    columns = ", ".join(f"`{c}`" for c in rows.columns)
    spark.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {{rows}}", rows=rows)


def require_table(spark: SparkSession, name: str) -> None:
    """Fail early, by name, where a later read would fail on a path."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"{name} isn't in the catalog: no load has created it")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def drop_table(spark: SparkSession, name: str, if_exists: bool = True) -> None:
    spark.sql(f"DROP TABLE {'IF EXISTS ' if if_exists else ''}{name}")
