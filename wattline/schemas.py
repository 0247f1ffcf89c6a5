"""Table schemas of the bronze, silver and gold layers (Spark types).

UTC instants and UK wall clocks are both ``timestamp_ntz``: a UK wall clock
repeats an hour every autumn, so it must never be read as an instant.
"""

from __future__ import annotations

from pyspark.sql import types as T

NTZ = T.TimestampNTZType()

# Fixed values that must equal the reference's for right results.
FAR_FUTURE = "9999-12-31 00:00:00"      # fill for an open-ended validity window
UK_ZONE = "Europe/London"
HALF_HOUR_MINUTES = 30
FIRST_LOAD_START = "2024-01-01 00:00:00"  # first incremental load starts here
LOOKBACK_DAYS = 1                         # incremental re-read / rebuild window
PAGE_SIZE = 25000                         # rows per landed page
NIGHT_HOURS = (0, 6)                      # both ends included
PEAK_HOURS = (16, 19)                     # both ends included

CONSUMPTION = T.StructType([
    T.StructField("interval_start_utc", NTZ, False),
    T.StructField("interval_start_uk", NTZ, True),
    T.StructField("kwh", T.DoubleType(), True),
    T.StructField("ingestion_ts", NTZ, True),
])

AGREEMENTS = T.StructType([
    T.StructField("tariff_code", T.StringType(), False),
    T.StructField("valid_from_utc", NTZ, False),
    T.StructField("valid_to_utc", NTZ, True),
    T.StructField("valid_from_uk", NTZ, True),
    T.StructField("valid_to_uk", NTZ, True),
    T.StructField("ingestion_ts", NTZ, True),
])

TARIFFS = T.StructType([
    T.StructField("tariff_code", T.StringType(), False),
    T.StructField("product_code", T.StringType(), True),
    T.StructField("valid_from_utc", NTZ, False),
    T.StructField("valid_to_utc", NTZ, True),
    T.StructField("valid_from_uk", NTZ, True),
    T.StructField("valid_to_uk", NTZ, True),
    T.StructField("unit_rate", T.DoubleType(), True),
    T.StructField("ingestion_ts", NTZ, True),
])

AUDIT = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("start_time", NTZ, True),
    T.StructField("end_time", NTZ, True),
    T.StructField("status", T.StringType(), False),
    T.StructField("records_fetched", T.LongType(), True),
    T.StructField("records_inserted", T.LongType(), True),
    T.StructField("min_interval", NTZ, True),
    T.StructField("max_interval", NTZ, True),
    T.StructField("error_message", T.StringType(), True),
])

MONTHLY = T.StructType([
    T.StructField("month", T.DateType(), False),
    T.StructField("kwh", T.DoubleType(), True),
])

FACT = T.StructType([
    T.StructField("interval_start_utc", NTZ, False),
    T.StructField("interval_start_uk", NTZ, True),
    T.StructField("kwh", T.DoubleType(), True),
    T.StructField("tariff_code", T.StringType(), True),
    T.StructField("unit_rate", T.DoubleType(), True),
    T.StructField("cost", T.DoubleType(), True),
    T.StructField("usage_date", NTZ, True),
    T.StructField("hour_of_day", T.LongType(), True),
    T.StructField("time_band", T.StringType(), False),
])

# Landed API pages: one JSON object per page. Numbers are read as text and
# converted strictly (a number sent as "0.5" is accepted, "x1" fails the load).
USAGE_PAGE = T.StructType([
    T.StructField("next", T.StringType(), True),
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("interval_start", T.StringType(), True),
        T.StructField("consumption_start", T.StringType(), True),
        T.StructField("interval_end", T.StringType(), True),
        T.StructField("consumption", T.StringType(), True),
    ])), True),
])

RATE_PAGE = T.StructType([
    T.StructField("next", T.StringType(), True),
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("valid_from", T.StringType(), True),
        T.StructField("valid_to", T.StringType(), True),
        T.StructField("value_inc_vat", T.StringType(), True),
    ])), True),
])
