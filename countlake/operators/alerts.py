"""Threshold bands and alerts against the previous four-visit average."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlake.functions import measures


def threshold_bands(daily: DataFrame, factor: float) -> DataFrame:
    """Rows with a positive baseline, with the upper and lower threshold."""
    baseline = F.col("prev_avg_4_visits")
    return (
        daily.filter(baseline > 0)
        .withColumn("upper_threshold", baseline * F.lit(factor))
        .withColumn("lower_threshold", baseline * F.lit(2 - factor))
    )


def band_breaches(daily: DataFrame, factor: float) -> DataFrame:
    """Days strictly outside the band; ``side`` is 'above' or 'below'."""
    actual = F.col("daily_visitor_count")
    side = F.when(actual > F.col("upper_threshold"), F.lit("above")).when(
        actual < F.col("lower_threshold"), F.lit("below")
    )
    return threshold_bands(daily, factor).withColumn("side", side).filter("side is not null")


def with_is_exceeding(daily: DataFrame, factor: float) -> DataFrame:
    flag = measures.exceeds(F.col("daily_visitor_count"), F.col("prev_avg_4_visits"), factor)
    return daily.withColumn("is_exceeding", flag)


def with_variation_sign(daily: DataFrame) -> DataFrame:
    return daily.withColumn("variation", measures.variation_sign(F.col("pct_change")))


def exceeding_days(daily: DataFrame, factor: float) -> DataFrame:
    actual, baseline = F.col("daily_visitor_count"), F.col("prev_avg_4_visits")
    return daily.filter(measures.exceeds(actual, baseline, factor))


def alert_count(daily: DataFrame, factor: float) -> DataFrame:
    return exceeding_days(daily, factor).agg(F.count("*").alias("alert_days"))


def relative_alerts(daily: DataFrame, factor: float, top: int = 10) -> DataFrame:
    """The highest counts above the upper threshold; ties by date and agency."""
    ratio = measures.round_half_even(
        F.col("daily_visitor_count") / F.col("prev_avg_4_visits"), digits=2
    )
    return (
        exceeding_days(daily, factor)
        .select("date", "agency_name", "daily_visitor_count", "prev_avg_4_visits")
        .orderBy(F.desc("daily_visitor_count"), "date", "agency_name", "prev_avg_4_visits")
        .limit(top)
        .withColumn("ratio", ratio)
    )
