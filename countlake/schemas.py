"""Declared schemas. File sources make every column nullable."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS = ["date_time", "agency_name", "counter_id", "visitor_count", "unit"]

DAILY_METRICS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("agency_name", T.StringType()),
        T.StructField("counter_id", T.IntegerType()),
        T.StructField("unit", T.StringType()),
        T.StructField("daily_visitor_count", T.LongType()),
        T.StructField("weekday", T.IntegerType()),
        T.StructField("avg_visits_4_weekday", T.DoubleType()),
        T.StructField("prev_avg_4_visits", T.DoubleType()),
        T.StructField("pct_change", T.DoubleType()),
    ]
)

DAILY_KEY = ["date", "agency_name", "counter_id", "unit"]

AGENCY = T.StructType(
    [
        T.StructField("agency_name", T.StringType()),
        T.StructField("agency_size", T.StringType()),
        T.StructField("location_type", T.StringType()),
        T.StructField("base_traffic", T.IntegerType()),
        T.StructField("counter_number", T.IntegerType()),
    ]
)
