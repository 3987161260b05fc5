"""Daily totals by event time that keep what comes late.

The watermark is kept in a table of its own, one row per batch: the greatest
event time of all batches before, so a replayed batch finds the one it had. Its
readings are split by it and both parts are written: sums of those on time, and
the late readings themselves. Nothing is dropped: on time and late together are
all readings, whatever the delay. Splitting is a filter in the JVM; there is no
state per sensor, since every batch adds its own sums.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from countlake.session import path_is_missing

_KEY = ["date", "agency_name", "counter_id"]
_SUMS = "agency_name string, counter_id int, visitor_count long, readings long, batch_id long, date date"
_MARK = "seen timestamp, batch_id long"


def _seen_before(spark: SparkSession, path: str, batch_id: int) -> dt.datetime | None:
    """Greatest event time of the batches before this one."""
    try:
        marks = spark.read.schema(_MARK).parquet(path).filter(F.col("batch_id") < batch_id)
        return marks.agg(F.max("seen")).first()[0]
    except AnalysisException as error:
        if path_is_missing(error):
            return None
        raise


def is_late(event_ts: Column, closed: dt.datetime | None) -> Column:
    """Whether a reading's day had ended when the watermark passed; one without a time is late."""
    if closed is None:
        return event_ts.isNull()
    day_end = F.date_add(F.to_date(event_ts), 1).cast("timestamp")
    return F.coalesce(day_end <= F.lit(closed), F.lit(True))


def start_daily_with_late(
    readings: DataFrame,
    totals_path: str,
    late_path: str,
    marks_path: str,
    checkpoint_path: str,
    delay: dt.timedelta = dt.timedelta(days=1),
) -> StreamingQuery:
    """Sums of the readings on time to ``totals_path``, late readings whole to ``late_path``.

    A reading is late if its day ended ``delay`` or more before the newest
    event of the batches before. Every batch writes to folders of its own,
    which a replay overwrites with the same.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = _seen_before(spark, marks_path, batch_id)
        late = is_late(F.col("event_ts"), seen - delay if seen else None)
        newest = batch.agg(F.max("event_ts")).first()[0]
        (
            batch.filter(~late)
            .groupBy(F.to_date("event_ts").alias("date"), "agency_name", "counter_id")
            .agg(
                F.sum("visitor_count").cast("long").alias("visitor_count"),
                F.count(F.lit(1)).alias("readings"),
            )
            .write.mode("overwrite")
            .partitionBy("date")
            .parquet(f"{totals_path}/batch_id={batch_id}")
        )
        batch.filter(late).write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}")
        times = [t for t in (seen, newest) if t is not None]
        mark = spark.createDataFrame([(max(times) if times else None,)], "seen timestamp")
        mark.coalesce(1).write.mode("overwrite").parquet(f"{marks_path}/batch_id={batch_id}")

    return (
        readings.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def on_time_totals(spark: SparkSession, totals_path: str) -> DataFrame:
    """Sum and number of the readings on time per sensor and day."""
    sums = spark.read.schema(_SUMS).parquet(totals_path)
    return sums.groupBy(*_KEY).agg(
        F.sum("visitor_count").alias("visitor_count"), F.sum("readings").alias("readings")
    )


def late_readings(spark: SparkSession, late_path: str) -> DataFrame:
    """The late readings, with the batch they came in."""
    return spark.read.parquet(late_path)


def all_totals(spark: SparkSession, totals_path: str, late_path: str) -> DataFrame:
    """Per sensor and day what came on time, what came late, and both."""
    late = (
        late_readings(spark, late_path)
        .groupBy(F.to_date("event_ts").alias("date"), "agency_name", "counter_id")
        .agg(F.sum("visitor_count").cast("long").alias("late_count"))
    )
    on_time = on_time_totals(spark, totals_path).select(*_KEY, F.col("visitor_count").alias("on_time_count"))
    both = on_time.withColumn("late_count", F.lit(0).cast("long")).unionByName(
        late.withColumn("on_time_count", F.lit(0).cast("long"))
    )
    return both.groupBy(*_KEY).agg(
        F.sum("on_time_count").alias("on_time_count"),
        F.sum("late_count").alias("late_count"),
        F.sum(F.col("on_time_count") + F.col("late_count")).alias("all_count"),
    )
