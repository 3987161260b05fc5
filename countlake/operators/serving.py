"""Questions asked of the daily metrics table.

Filters compare native columns, so they reach the Parquet scan; where the
table carries its year and month partition columns, a date range also prunes
partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countlake.functions.calendar import month_numbers
from countlake.functions.measures import exceeds, falls_below, pct_over_total, threshold_factor

_METRICS = ["daily_visitor_count", "avg_visits_4_weekday", "prev_avg_4_visits"]


def with_native_date(df: DataFrame) -> DataFrame:
    """Date text becomes a date; a date column is left alone for pushdown."""
    if isinstance(df.schema["date"].dataType, T.DateType):
        return df
    return df.withColumn("date", F.col("date").cast("date"))


def in_date_range(df: DataFrame, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """Inclusive on both ends; None leaves that end open."""
    partitioned = {"year", "month"} <= set(df.columns)
    month = F.col("year") * 12 + F.col("month") if partitioned else None
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start))
        if partitioned:
            df = df.filter(month >= start.year * 12 + start.month)
    if end is not None:
        df = df.filter(F.col("date") <= F.lit(end))
        if partitioned:
            df = df.filter(month <= end.year * 12 + end.month)
    return df


def agency_rollup(
    daily: DataFrame,
    agencies: list[str] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    with_baseline_count: bool = False,
) -> DataFrame:
    """All sensors of an agency added up per day; None means every agency.

    The averages are sums over the sensors that have one, 0 if none has, and
    ``pct_change`` is recomputed from the sums without rounding: +infinity
    where no sensor has a baseline. ``with_baseline_count`` adds the number of
    sensors that have one.
    """
    rows = in_date_range(with_native_date(daily), start, end).filter("date is not null")
    if agencies is not None:
        rows = rows.filter(F.col("agency_name").isin(agencies))
    totals = [F.coalesce(F.sum(m), F.lit(0).cast(rows.schema[m].dataType)).alias(m) for m in _METRICS]
    if with_baseline_count:
        totals.append(F.count("prev_avg_4_visits").alias("baseline_sensors"))
    summed = rows.groupBy("date", "agency_name").agg(*totals)
    change = pct_over_total(F.col("daily_visitor_count"), F.col("prev_avg_4_visits"))
    return summed.withColumn("pct_change", change)


def sensor_series(
    daily: DataFrame,
    agency: str,
    counter_id: int,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    one = with_native_date(daily).filter(
        (F.col("agency_name") == agency) & (F.col("counter_id") == counter_id)
    )
    return in_date_range(one, start, end).orderBy("agency_name", "counter_id", "date")


def average_per_agency(daily: DataFrame) -> DataFrame:
    return daily.groupBy("agency_name").agg(F.avg("daily_visitor_count").alias("avg_daily_visitors"))


def sensor_list(daily: DataFrame) -> DataFrame:
    return daily.select("agency_name", "counter_id").distinct().orderBy("agency_name", "counter_id")


def agency_list(daily: DataFrame) -> DataFrame:
    return daily.select("agency_name").distinct().orderBy("agency_name")


def agency_sensors(daily: DataFrame, agency: str) -> DataFrame:
    one = daily.filter(F.col("agency_name") == agency)
    return one.select("counter_id").distinct().orderBy("counter_id")


def filter_time(df: DataFrame, start: dt.date, end: dt.date, years: list[int]) -> DataFrame:
    """Inclusive date range and a set of years. No date column: unchanged."""
    if "date" not in df.columns:
        return df
    if "year" in df.columns:  # prunes folders
        df = df.filter(F.col("year").isin(years))
    return in_date_range(with_native_date(df), start, end).filter(F.year("date").isin(years))


def filter_months_weeks(
    df: DataFrame, months: list[str] | None = None, weeks: list[int] | None = None
) -> DataFrame:
    """English month names and ISO week numbers; an empty choice does not filter."""
    if "date" not in df.columns:
        return df
    if months:
        if "month" in df.columns:  # prunes folders
            df = df.filter(F.col("month").isin(month_numbers(months)))
        df = df.filter(F.month("date").isin(month_numbers(months)))
    if weeks:
        df = df.filter(F.weekofyear("date").isin(weeks))
    return df


def hourly_totals(readings: DataFrame) -> DataFrame:
    """Per agency and time over all its sensors.

    Only measured counts (0 and above) are added; closed (-1) and broken (-10)
    sensors are counted apart. The total is null if no sensor measured.
    """
    count = F.col("visitor_count")
    return readings.groupBy("agency_name", "date_time").agg(
        F.sum(F.when(count >= 0, count)).alias("visitor_count"),
        F.count_if(count == -1).alias("closed_sensors"),
        F.count_if(count == -10).alias("broken_sensors"),
    )


def reading_lookup(
    readings: DataFrame,
    date_time: str,
    agency: str,
    counter_id: int = -1,
    unit: str = "visitors",
) -> DataFrame:
    """Stored count of one sensor at one time; below 0 all sensors of the agency.

    An unknown agency, sensor or time gives no row. ``unit`` is a label only.
    """
    at = readings.filter((F.col("agency_name") == agency) & (F.col("date_time") == date_time))
    if counter_id < 0:
        counted = hourly_totals(at).withColumn("counter_id", F.lit(None).cast("int"))
    else:
        counted = at.filter(F.col("counter_id") == counter_id)
    return counted.select(
        "agency_name", "date_time", "visitor_count", F.lit(unit).alias("unit"), "counter_id"
    )


def _band_columns(factor: float) -> list[Column]:
    baseline = F.when(F.col("prev_avg_4_visits") > 0, F.col("prev_avg_4_visits"))
    daily = F.col("daily_visitor_count")
    return [
        (baseline * F.lit(factor)).alias("upper_threshold"),
        (baseline * F.lit(2 - factor)).alias("lower_threshold"),
        exceeds(daily, F.col("prev_avg_4_visits"), factor).alias("is_above"),
        falls_below(daily, F.col("prev_avg_4_visits"), factor).alias("is_below"),
    ]


def traffic_view(
    daily: DataFrame,
    agencies: list[str],
    years: list[int],
    counter_id: int | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    months: list[str] | None = None,
    weeks: list[int] | None = None,
    threshold_pct: float = 20,
) -> DataFrame:
    """One frame behind every dashboard view.

    One agency and a sensor gives that sensor's series, anything else the
    rollup of the chosen agencies (``counter_id`` null). The range defaults to
    all of the chosen years. No agency or no year gives no row.
    """
    chosen = daily
    if agencies and years:
        start = start or dt.date(min(years), 1, 1)
        end = end or dt.date(max(years), 12, 31)
        # Filtered by day before the rollup, as the folders of a stored table are.
        chosen = filter_months_weeks(filter_time(daily, start, end, years), months, weeks)
    else:
        chosen = daily.filter(F.lit(False))
    if counter_id is not None and len(agencies) == 1:
        rows = sensor_series(chosen, agencies[0], counter_id, start, end)
    else:
        no_sensor = F.lit(None).cast("int")
        rows = agency_rollup(chosen, agencies, start, end).withColumn("counter_id", no_sensor)
    return rows.select(
        "date",
        "agency_name",
        "counter_id",
        *_METRICS,
        "pct_change",
        *_band_columns(threshold_factor(threshold_pct)),
    )
