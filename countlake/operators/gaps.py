"""Expected readings that never arrived."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countlake.functions.calendar import HOUR_MULTIPLIERS, is_open
from countlake.session import write_through

_SLOT = ["agency_name", "counter_id", "date", "hour"]


def missing_hours(
    readings: DataFrame,
    sensors: DataFrame | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Open hours of each sensor without any reading, to be fetched again.

    Sensors default to those seen in the readings, the span to the readings'
    first and last date. What is not given comes from one extra pass that
    keeps one row per sensor. The readings are reduced to distinct sensor
    hours before they meet the grid, so repeats of one hour do not pile up.
    """
    if sensors is None or start is None or end is None:
        seen = readings.groupBy("agency_name", "counter_id").agg(
            F.min("date").alias("first"), F.max("date").alias("last")
        )
        seen = write_through(seen, "sensors")
        sensors = sensors if sensors is not None else seen
    grid = sensors.select("agency_name", "counter_id").distinct()
    first = F.lit(start) if start else seen.agg(F.min("first")).scalar()
    last = F.lit(end) if end else seen.agg(F.max("last")).scalar()
    tasks = int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hours = F.array(*[F.lit(h) for h in sorted(HOUR_MULTIPLIERS)])
    expected = (
        # Few rows become very many: they are dealt out before they unfold.
        grid.repartition(tasks, "agency_name", "counter_id")
        .withColumn("date", F.explode(F.sequence(first, last)))
        .withColumn("hour", F.explode(hours))
        .filter(is_open(F.col("date"), F.col("hour")))
    )
    arrived = readings.select(*_SLOT).distinct()
    return expected.join(arrived, _SLOT, "left_anti")


# Open hours are numbered without gaps: five days a week from a Monday on, so many hours a day.
_MONDAY = dt.date(1970, 1, 5)
_HOURS = sorted(HOUR_MULTIPLIERS)
_OPEN_DAYS = 5


def _open_days_before(date: Column) -> Column:
    """Number of open days from the first Monday up to a date, the date not included."""
    days = F.datediff(date, F.lit(_MONDAY))
    week = F.floor(days / 7)
    return week * _OPEN_DAYS + F.least(days - week * 7, F.lit(_OPEN_DAYS))


def slot(date: Column, hour: Column) -> Column:
    """Number of an open hour."""
    place = F.array_position(F.array(*[F.lit(h) for h in _HOURS]), hour) - 1
    return _open_days_before(date) * len(_HOURS) + place


def slot_date(number: Column) -> Column:
    day = F.floor(number / len(_HOURS))
    week = F.floor(day / _OPEN_DAYS)
    return F.date_add(F.lit(_MONDAY), (week * 7 + F.pmod(day, F.lit(_OPEN_DAYS))).cast("int"))


def slot_hour(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(h) for h in _HOURS]), (F.pmod(number, F.lit(len(_HOURS))) + 1).cast("int"))


def missing_spans(
    readings: DataFrame,
    sensors: DataFrame | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """The missing hours of :func:`missing_hours` as stretches of consecutive open hours.

    A stretch is what lies between two open hours with readings that follow
    each other, over nights and weekends. Only hours with readings are sorted,
    and the two ends of the span per sensor; no grid of hours is made, so a
    sensor that is silent for years is one row.
    """
    sensor = ["agency_name", "counter_id"]
    seen = write_through(
        readings.groupBy(*sensor).agg(F.min("date").alias("first"), F.max("date").alias("last")), "sensors"
    )
    span = seen.agg(
        F.coalesce(F.lit(start), F.min("first")).alias("first"), F.coalesce(F.lit(end), F.max("last")).alias("last")
    ).first()  # one row: the span of all sensors
    first = _open_days_before(F.lit(span["first"])) * len(_HOURS)
    last = _open_days_before(F.date_add(F.lit(span["last"]), 1)) * len(_HOURS) - 1
    ends = (seen if sensors is None else sensors).select(*sensor).distinct()
    number = slot(F.col("date"), F.col("hour"))
    arrived = (
        readings.filter(F.col("date").between(span["first"], span["last"]))
        .filter(is_open(F.col("date"), F.col("hour")))
        .select(*sensor, number.alias("slot"))
        .distinct()
    )
    if sensors is not None:
        arrived = arrived.join(ends, sensor, "left_semi")
    edges = ends.select(*sensor, F.explode(F.array(first - 1, last + 1)).alias("slot"))
    before = F.lag("slot").over(Window.partitionBy(*sensor).orderBy("slot"))
    gaps = (
        arrived.unionByName(edges)
        .withColumn("from", before + 1)
        .withColumn("to", F.col("slot") - 1)
        .filter(F.col("from") <= F.col("to"))
    )
    return gaps.select(
        *sensor,
        slot_date(F.col("from")).alias("first_date"),
        slot_hour(F.col("from")).alias("first_hour"),
        slot_date(F.col("to")).alias("last_date"),
        slot_hour(F.col("to")).alias("last_hour"),
        (F.col("to") - F.col("from") + 1).alias("hours"),
    )


def hours_of_spans(spans: DataFrame) -> DataFrame:
    """Every hour of the spans, as :func:`missing_hours` gives them."""
    start, end = (slot(F.col(f"{x}_date"), F.col(f"{x}_hour")) for x in ("first", "last"))
    return spans.select("agency_name", "counter_id", F.explode(F.sequence(start, end)).alias("slot")).select(
        "agency_name", "counter_id", slot_date(F.col("slot")).alias("date"), slot_hour(F.col("slot")).alias("hour")
    )
