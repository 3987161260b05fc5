"""Daily totals by event time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

_KEY = ["date", "agency_name", "counter_id"]


def daily_windows(
    readings: DataFrame, watermark: str = "1 day", reading_key: list[str] | None = None
) -> DataFrame:
    """Sum per sensor and tumbling day of ``event_ts``.

    Readings that arrive later than the watermark are dropped, which bounds
    the state to the sensors of the open days. (The batch merge differs: it
    never drops a late day that is not stored yet. ``late`` keeps them.) With
    ``reading_key``, readings that are delivered again, in the same file or
    another one, count once: keys are remembered until the watermark has passed
    them, after which a repeat is late.
    """
    day = F.window("event_ts", "1 day")
    marked = readings.withWatermark("event_ts", watermark)
    if reading_key:
        marked = marked.dropDuplicatesWithinWatermark(reading_key)
    return (
        marked.groupBy(day.alias("day"), "agency_name", "counter_id")
        .agg(F.sum("visitor_count").alias("daily_visitor_count"))
        .select(
            F.to_date("day.start").alias("date"), "agency_name", "counter_id", "daily_visitor_count"
        )
    )


def start_daily_windows(
    readings: DataFrame,
    output_path: str,
    checkpoint_path: str,
    watermark: str = "1 day",
    reading_key: list[str] | None = None,
) -> StreamingQuery:
    """Writes the totals each batch changed to that batch's own folder, by date."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        own_folder = f"{output_path}/batch_id={batch_id}"
        batch.write.mode("overwrite").partitionBy("date").parquet(own_folder)

    return (
        daily_windows(readings, watermark, reading_key)
        .writeStream.outputMode("update")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def _batches(spark: SparkSession, output_path: str) -> DataFrame:
    schema = "agency_name string, counter_id int, daily_visitor_count long, batch_id long, date date"
    return spark.read.schema(schema).parquet(output_path)


def _one_per_key(totals: DataFrame) -> DataFrame:
    return totals.groupBy(*_KEY).agg(
        F.max_by("daily_visitor_count", "batch_id").alias("daily_visitor_count")
    )


def close_days(
    spark: SparkSession,
    output_path: str,
    closed_path: str,
    before: dt.date,
    since: dt.date | None = None,
) -> None:
    """Writes the final totals of the days from ``since`` up to ``before`` to ``closed_path``.

    Only days the watermark has passed are final. Each is written by date once;
    a repeated run replaces its folders.
    """
    days = _batches(spark, output_path).filter(F.col("date") < before)
    if since:
        days = days.filter(F.col("date") >= since)
    (
        _one_per_key(days)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(closed_path)
    )


def latest_totals(
    spark: SparkSession,
    output_path: str,
    closed_path: str | None = None,
    closed_before: dt.date | None = None,
) -> DataFrame:
    """The newest total of every day and sensor.

    With ``closed_path`` the days before ``closed_before`` come from there, and
    only the folders of later days are read from the batches.
    """
    totals = _batches(spark, output_path)
    if closed_path is None:
        return _one_per_key(totals)
    schema = "agency_name string, counter_id int, daily_visitor_count long, date date"
    closed = spark.read.schema(schema).parquet(closed_path).filter(F.col("date") < closed_before)
    open_days = _one_per_key(totals.filter(F.col("date") >= closed_before))
    return open_days.unionByName(closed.select(*open_days.columns))
