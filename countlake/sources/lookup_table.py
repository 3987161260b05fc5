"""Readings stored for point lookups: by day and hash of the agency, with bloom filters.

A lookup of one agency and time opens the folder of that day and bucket alone.
In its files, small row groups sorted by agency and time are passed over by
their statistics and bloom filters, so a lookup reads a row group or two,
however many readings are stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 16
#: Bytes of a row group.
GROUP_BYTES = 1 << 20
_COLUMNS = (
    T.StructType()
    .add("date_time", "string")
    .add("agency_name", "string")
    .add("counter_id", "integer")
    .add("visitor_count", "integer")
    .add("unit", "string")
)
_STORED = T.StructType([*_COLUMNS.fields]).add("date", "date").add("bucket", "integer")


def _bucket(agency: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(agency), F.lit(buckets)).cast("int")


def _day(date_time: Column) -> Column:
    return F.to_date(F.try_to_timestamp(date_time, F.lit("yyyy-MM-dd HH:mm")))


def write_lookup(
    readings: DataFrame,
    path: str,
    mode: str = "errorifexists",
    buckets: int = BUCKETS,
    group_bytes: int = GROUP_BYTES,
) -> None:
    """Stores readings for :func:`stored_readings`; the number of buckets belongs to the table.

    Rows are dealt by the range of their day, bucket, agency and time, so a
    busy agency or day is split over tasks. A time that can't be read has no
    day and is kept in a folder of its own.
    """
    order = ["date", "bucket", "agency_name", "date_time", "counter_id"]
    placed = readings.select(
        *_COLUMNS.names,
        _day(F.col("date_time")).alias("date"),
        _bucket(F.col("agency_name"), buckets).alias("bucket"),
    )
    writer = placed.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode)
    for column in ("agency_name", "date_time"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    (
        writer.option("parquet.block.size", group_bytes)
        .option("parquet.page.size", min(group_bytes, 1 << 16))
        .partitionBy("date", "bucket")
        .parquet(path)
    )


def stored_readings(
    spark: SparkSession, path: str, date_time: str, agency: str, buckets: int = BUCKETS
) -> DataFrame:
    """The stored readings of one agency at one time, for ``serving.reading_lookup``.

    ``buckets`` are those the table was written with.
    """
    day = spark.range(1).select(_day(F.lit(date_time))).first()[0]  # a literal prunes folders
    found = spark.read.schema(_STORED).parquet(path)
    return found.filter(
        (F.col("date").isNull() if day is None else F.col("date") == F.lit(day))
        & (F.col("bucket") == _bucket(F.lit(agency), buckets))
        & (F.col("agency_name") == agency)
        & (F.col("date_time") == date_time)
    ).select(*_COLUMNS.names)
