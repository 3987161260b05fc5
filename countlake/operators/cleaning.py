"""Cleaning of raw readings. Each step is a DataFrame -> DataFrame function."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countlake.functions.parsing import reading_date, standard_name, whole_number
from countlake.operators.matching import correct_names
from countlake.operators.metrics import daily_counts, sum_of_counts
from countlake.session import write_through
from countlake.sources.raw_csv import UNMAPPED

# Fixed values.
KEPT_UNIT = "visitors"
FIRST_COUNTER_ID = 0
LAST_COUNTER_ID = 10

REJECT_REASONS = ["bad_date", "null_agency", "bad_count", "bad_sensor", "bad_unit"]


def _number(readings: DataFrame, name: str) -> Column:
    """Text is parsed; a number column is used as it is, so its filter can be
    pushed into the scan."""
    if isinstance(readings.schema[name].dataType, T.IntegerType):
        return F.col(name)
    return whole_number(name)


def with_date(readings: DataFrame) -> DataFrame:
    return readings.withColumn("date", reading_date("date_time"))


def keep_counted(readings: DataFrame) -> DataFrame:
    """Only measured, positive counts: drops text, zero and the sentinels."""
    typed = readings.withColumn("visitor_count", _number(readings, "visitor_count"))
    return typed.filter(F.col("visitor_count") > 0)


def keep_known_sensors(readings: DataFrame) -> DataFrame:
    typed = readings.withColumn("counter_id", _number(readings, "counter_id"))
    return typed.filter(F.col("counter_id").between(FIRST_COUNTER_ID, LAST_COUNTER_ID))


def keep_visitors(readings: DataFrame) -> DataFrame:
    return readings.withColumn("unit", F.lower("unit")).filter(F.col("unit") == KEPT_UNIT)


def standardise_names(readings: DataFrame) -> DataFrame:
    named = readings.filter(F.col("agency_name").isNotNull())
    return named.withColumn("agency_name", standard_name("agency_name"))


def clean_names(
    readings: DataFrame, dictionary: DataFrame | None, max_distance: int | None = None
) -> DataFrame:
    """Standard spelling, then correction against the known names."""
    return correct_names(standardise_names(readings), dictionary, max_distance)


def keep_valid(readings: DataFrame, keep_bad_dates: bool = False) -> DataFrame:
    """The row filters, without the names.

    Readings without a valid date are rejected unless ``keep_bad_dates``,
    which leaves them with a null date.
    """
    kept = readings.transform(with_date)
    if not keep_bad_dates:
        kept = kept.filter(F.col("date").isNotNull())
    return kept.transform(keep_counted).transform(keep_known_sensors).transform(keep_visitors)


def clean_readings(
    readings: DataFrame,
    dictionary: DataFrame | None,
    keep_bad_dates: bool = False,
    max_distance: int | None = None,
) -> DataFrame:
    """All cleaning steps; the cheap row filters run before name matching."""
    return clean_names(keep_valid(readings, keep_bad_dates), dictionary, max_distance)


def corrected_counts(
    valid: DataFrame,
    dictionary: DataFrame | None,
    max_distance: int | None = None,
    corrections_path: str | None = None,
) -> DataFrame:
    """Daily counts of valid readings in standard spelling, under corrected names.

    Readings are summed under the name they came with, then the small table of
    sums is corrected and summed once more: readings are read once and never
    joined. ``corrections_path`` holds corrections found by earlier runs.
    """
    counts = write_through(daily_counts(valid), "counts")
    if dictionary is None:
        return counts
    return sum_of_counts(correct_names(counts, dictionary, max_distance, corrections_path))


def reject_reason(keep_bad_dates: bool = False) -> Column:
    """First failing rule of a raw reading; null for a reading that is kept."""
    counter = whole_number("counter_id")
    bad_date = F.lit(False) if keep_bad_dates else reading_date("date_time").isNull()
    return (
        F.when(bad_date, F.lit("bad_date"))
        .when(F.col("agency_name").isNull(), F.lit("null_agency"))
        .when(~F.coalesce(whole_number("visitor_count") > 0, F.lit(False)), F.lit("bad_count"))
        .when(
            ~F.coalesce(counter.between(FIRST_COUNTER_ID, LAST_COUNTER_ID), F.lit(False)),
            F.lit("bad_sensor"),
        )
        .when(~F.coalesce(F.lower("unit") == KEPT_UNIT, F.lit(False)), F.lit("bad_unit"))
    )


def judge_lines(mapped: DataFrame, keep_bad_dates: bool = False) -> DataFrame:
    """Lines mapped by header, each with the reason it is left out for, or null."""
    unmapped = F.when(~F.col("has_header"), F.lit(UNMAPPED))
    return mapped.withColumn("reason", unmapped.otherwise(reject_reason(keep_bad_dates)))


def rejected_readings(readings: DataFrame) -> DataFrame:
    """The raw rows that cleaning drops, each with its reason."""
    return readings.withColumn("reason", reject_reason()).filter("reason is not null")


def reject_counts(readings: DataFrame) -> DataFrame:
    """Rows per reason, kept rows included under 'kept'."""
    reason = F.coalesce(reject_reason(), F.lit("kept"))
    return readings.groupBy(reason.alias("reason")).agg(F.count("*").alias("row_count"))
