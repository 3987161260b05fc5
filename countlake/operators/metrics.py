"""Daily and monthly counts and the same-weekday rolling metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countlake.functions.measures import pct_over
from countlake.schemas import DAILY_METRICS


def daily_counts(readings: DataFrame) -> DataFrame:
    """Visitors per day, agency, sensor and unit.

    Partial sums run before the shuffle, so a sensor or agency with very many
    readings sends one row per day and task.
    """
    return readings.groupBy("date", "agency_name", "counter_id", "unit").agg(
        F.sum("visitor_count").alias("daily_visitor_count")
    )


def sum_of_counts(counts: DataFrame) -> DataFrame:
    """Daily counts that were summed under several names, summed once more."""
    return counts.groupBy("date", "agency_name", "counter_id", "unit").agg(
        F.sum("daily_visitor_count").alias("daily_visitor_count")
    )


def monthly_counts(daily: DataFrame) -> DataFrame:
    return daily.groupBy(
        F.year("date").alias("year"), F.month("date").alias("month"), "agency_name", "counter_id"
    ).agg(F.sum("daily_visitor_count").alias("monthly_visitor_count"))


WEEKDAY_GROUP = ["agency_name", "counter_id", "weekday"]


def same_weekday() -> Window:
    """Days of one sensor and weekday. A group holds at most one row per week
    and unit, however many readings the sensor has."""
    return Window.partitionBy(*WEEKDAY_GROUP).orderBy("date", "unit")


def with_weekday(daily: DataFrame) -> DataFrame:
    """1 = Sunday ... 7 = Saturday."""
    return daily.withColumn("weekday", F.dayofweek("date"))


def with_rolling_average(daily: DataFrame) -> DataFrame:
    """Rounded mean of this row and up to three rows before it.

    Rows are counted, not weeks: a missing week does not shorten the window.
    """
    last_four = same_weekday().rowsBetween(-3, Window.currentRow)
    return daily.withColumn(
        "avg_visits_4_weekday", F.round(F.avg("daily_visitor_count").over(last_four))
    )


def with_previous_average(daily: DataFrame) -> DataFrame:
    return daily.withColumn(
        "prev_avg_4_visits", F.lag("avg_visits_4_weekday").over(same_weekday())
    )


def with_pct_change(daily: DataFrame) -> DataFrame:
    change = pct_over(F.col("daily_visitor_count"), F.col("prev_avg_4_visits"))
    return daily.withColumn("pct_change", F.round(change))


def rolling_metrics(daily: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """All metric columns on daily counts; the windows share one shuffle.

    ``keep`` names further columns to carry along.
    """
    return (
        daily.transform(with_weekday)
        .transform(with_rolling_average)
        .transform(with_previous_average)
        .transform(with_pct_change)
        .select(*DAILY_METRICS.names, *(keep or []))
    )


def daily_metrics(readings: DataFrame) -> DataFrame:
    """Cleaned readings to the daily metrics table."""
    return rolling_metrics(daily_counts(readings))


def daily_sorted(daily: DataFrame) -> DataFrame:
    return daily.orderBy("agency_name", "counter_id", "date")
