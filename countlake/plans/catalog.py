"""Every query, by name. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countlake.operators import (
    alerts,
    cleaning,
    dimensions,
    gaps,
    history,
    matching,
    merge,
    metrics,
    quality,
    serving,
)
from countlake.plans.transform import run_transform
from countlake.plans.views import view
from countlake.schemas import DAILY_METRICS, RAW_COLUMNS
from countlake.session import shared_dir
from countlake.sources import daily_table, lookup_table, raw_csv, records
from countlake.streaming.ingest import start_ingest
from countlake.streaming.baselines import start_rolling
from countlake.streaming.late import all_totals, start_daily_with_late
from countlake.streaming.windows import latest_totals, start_daily_windows

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Parameters used by the registered queries.
FACTOR = 1.2
MERGE_CUT = dt.date(2024, 1, 20)
RANGE = (dt.date(2024, 1, 5), dt.date(2024, 1, 25))
LONG_RANGE = (dt.date(1996, 3, 1), dt.date(1998, 9, 30))
UPDATED_AT = dt.datetime(2024, 2, 1)
EXTRACTOR_ORDER = ["agency_name", "date_time", "visitor_count", "unit", "counter_id"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def kept_readings(spark: SparkSession, sf: str) -> DataFrame:
    """The typed readings after the row filters."""
    return (
        view(spark, sf, "v_readings")
        .transform(cleaning.keep_counted)
        .transform(cleaning.keep_known_sensors)
        .transform(cleaning.keep_visitors)
    )


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.daily_metrics(kept_readings(spark, sf))


def daily_long(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.rolling_metrics(view(spark, sf, "v_daily_long"))


def known_agencies(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.agency_dimension(view(spark, sf, "v_agencies"))


def land_raw_files(spark: SparkSession, sf: str) -> str:
    """The dirty readings as CSV files with two different column orders."""
    path = shared_dir(spark, "raw")
    raw = view(spark, sf, "v_raw_dirty")
    first = F.coalesce(F.col("unit") == "visitors", F.lit(False))
    raw_csv.write_raw_csv(raw.filter(first).select(*RAW_COLUMNS), path)
    raw_csv.write_raw_csv(raw.filter(~first).select(*EXTRACTOR_ORDER), path, mode="append")
    return path


# --- sources and sinks ---------------------------------------------------


@query
def scan_raw_readings(spark: SparkSession, sf: str) -> DataFrame:
    return raw_csv.read_raw_readings(spark, land_raw_files(spark, sf))


def land_mixed_files(spark: SparkSession, sf: str) -> str:
    """Three layouts: as declared, with a column in between and other case, without a header."""
    path = shared_dir(spark, "raw")
    raw = view(spark, sf, "v_raw_dirty").withColumn("name", F.coalesce("agency_name", F.lit("")))
    usual = raw.filter("name not like '%3' and name not like '%4'")
    raw_csv.write_raw_csv(usual.select(*RAW_COLUMNS), path)
    wide = raw.filter("name like '%3'").select(
        F.col("unit").alias("Unit"),
        F.lit("note, with a comma").alias("remark"),
        F.col("date_time").alias("Date_Time"),
        F.col("agency_name").alias("AGENCY_NAME"),
        "visitor_count",
        "counter_id",
    )
    raw_csv.write_raw_csv(wide, path, mode="append")
    bare = raw.filter("name like '%4'").select(*RAW_COLUMNS)
    bare.write.mode("append").option("header", False).csv(path)
    return path


@query
def scan_raw_mixed(spark: SparkSession, sf: str) -> DataFrame:
    return raw_csv.read_raw_readings(spark, land_mixed_files(spark, sf))


@query
def transform_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Lines left out by the batch job, by reason; with the readings kept they are all lines."""
    folder = shared_dir(spark, "rejects")
    run_transform(
        spark,
        land_mixed_files(spark, sf),
        view(spark, sf, "v_dictionary"),
        f"{folder}/daily",
        rejects_path=f"{folder}/rejects",
    )
    rejects = spark.read.parquet(f"{folder}/rejects")
    return rejects.groupBy("reason").agg(F.count("*").alias("row_count"))


@query
def write_raw_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "raw")
    raw_csv.write_raw_csv(view(spark, sf, "v_raw_dirty").select(*EXTRACTOR_ORDER), path)
    return raw_csv.read_raw_text(spark, path)


@query
def scan_daily(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "daily")
    daily(spark, sf).write.parquet(path)
    return daily_table.read_daily(spark, path)


@query
def write_daily(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "daily")
    daily_table.write_daily(daily_long(spark, sf), path)
    stored = daily_table.read_daily(spark, path)
    return stored.groupBy("year", "month").agg(
        F.count("*").alias("row_count"), F.sum("daily_visitor_count").alias("visitors")
    )


@query
def ingest_json(spark: SparkSession, sf: str) -> DataFrame:
    return records.read_records(view(spark, sf, "v_json"))


@query
def ingest_json_errors(spark: SparkSession, sf: str) -> DataFrame:
    return records.rejected_records(view(spark, sf, "v_json"))


@query
def peek(spark: SparkSession, sf: str) -> DataFrame:
    return daily_table.peek(daily(spark, sf), 2, "agency_name", "counter_id", "date")


# --- cleaning ------------------------------------------------------------


@query
def extract_date(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.with_date(view(spark, sf, "v_raw_dirty"))


@query
def clean_visitor_count(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.keep_counted(view(spark, sf, "v_raw_dirty"))


@query
def clean_counter_id(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.keep_known_sensors(view(spark, sf, "v_raw_dirty"))


@query
def clean_unit(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.keep_visitors(view(spark, sf, "v_raw_dirty"))


@query
def clean_agency_name(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_names(view(spark, sf, "v_raw_dirty"), view(spark, sf, "v_dictionary"))


@query
def clean_readings(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_readings(view(spark, sf, "v_raw_dirty"), view(spark, sf, "v_dictionary"))


@query
def clean_readings_undated(spark: SparkSession, sf: str) -> DataFrame:
    raw, names = view(spark, sf, "v_raw_dirty"), view(spark, sf, "v_dictionary")
    return cleaning.clean_readings(raw, names, keep_bad_dates=True)


@query
def rejects(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.reject_counts(view(spark, sf, "v_raw_dirty"))


@query
def rejected_readings(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.rejected_readings(view(spark, sf, "v_raw_dirty"))


# --- name matching -------------------------------------------------------


@query
def agency_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return matching.dictionary_entries(view(spark, sf, "v_dictionary"))


@query
def unmatched_names(spark: SparkSession, sf: str) -> DataFrame:
    named = cleaning.standardise_names(view(spark, sf, "v_raw_dirty"))
    return matching.unmatched_names(named, view(spark, sf, "v_dictionary"))


@query
def closest_match(spark: SparkSession, sf: str) -> DataFrame:
    return matching.closest_match(unmatched_names(spark, sf), view(spark, sf, "v_dictionary"))


@query
def closest_match_large(spark: SparkSession, sf: str) -> DataFrame:
    """The matcher for large dictionaries: all customers, names with one to five letters changed."""
    names = view(spark, sf, "v_misspelled").select("agency_name").distinct()
    return matching.closest_match(names, view(spark, sf, "v_customer_names"), array_entries=100)


@query
def correct_agency_name(spark: SparkSession, sf: str) -> DataFrame:
    named = cleaning.standardise_names(view(spark, sf, "v_raw_dirty"))
    fixed = matching.correct_names(named, view(spark, sf, "v_dictionary"))
    return fixed.groupBy("agency_name").agg(F.count("*").alias("reading_count"))


# --- metrics -------------------------------------------------------------


@query
def daily_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return daily(spark, sf)


@query
def daily_visitors(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.daily_counts(kept_readings(spark, sf))


@query
def monthly_visitors(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.monthly_counts(view(spark, sf, "v_daily_long"))


@query
def add_weekday(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.with_weekday(view(spark, sf, "v_daily_long"))


@query
def rolling_metrics(spark: SparkSession, sf: str) -> DataFrame:
    weekday = metrics.with_weekday(view(spark, sf, "v_daily_long"))
    return metrics.with_previous_average(metrics.with_rolling_average(weekday))


@query
def pct_change(spark: SparkSession, sf: str) -> DataFrame:
    return daily_long(spark, sf)


@query
def daily_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.daily_sorted(daily(spark, sf))


# --- serving -------------------------------------------------------------


@query
def agency_daily_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return serving.agency_rollup(daily(spark, sf))


@query
def agency_daily_rollup_range(spark: SparkSession, sf: str) -> DataFrame:
    chosen = ["nation_0", "nation_2", "nation_3"]
    return serving.agency_rollup(daily_long(spark, sf), chosen, *LONG_RANGE)


@query
def agency_daily_rollup_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return serving.agency_rollup(daily(spark, sf), with_baseline_count=True)


@query
def sensor_series(spark: SparkSession, sf: str) -> DataFrame:
    return serving.sensor_series(daily(spark, sf), "nation_1", 2)


@query
def sensor_series_range(spark: SparkSession, sf: str) -> DataFrame:
    return serving.sensor_series(daily(spark, sf), "nation_1", 2, *RANGE)


@query
def avg_daily_per_agency(spark: SparkSession, sf: str) -> DataFrame:
    return serving.average_per_agency(view(spark, sf, "v_daily_long"))


@query
def agency_hourly_total(spark: SparkSession, sf: str) -> DataFrame:
    return serving.hourly_totals(view(spark, sf, "v_hourly"))


@query
def reading_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return serving.reading_lookup(view(spark, sf, "v_hourly"), "2024-01-10 10:00", "nation_1", 1)


@query
def reading_lookup_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The same lookup in readings stored for it: one folder is opened."""
    path, time, agency = shared_dir(spark, "lookup"), "2024-01-10 10:00", "nation_1"
    lookup_table.write_lookup(view(spark, sf, "v_hourly"), path)
    found = lookup_table.stored_readings(spark, path, time, agency)
    return serving.reading_lookup(found, time, agency, 1)


@query
def reading_lookup_all_sensors(spark: SparkSession, sf: str) -> DataFrame:
    return serving.reading_lookup(view(spark, sf, "v_hourly"), "2024-01-10 10:00", "nation_1")


@query
def sensor_list(spark: SparkSession, sf: str) -> DataFrame:
    return serving.sensor_list(view(spark, sf, "v_daily_long"))


@query
def agency_list(spark: SparkSession, sf: str) -> DataFrame:
    return serving.agency_list(view(spark, sf, "v_daily_long"))


@query
def agency_sensors(spark: SparkSession, sf: str) -> DataFrame:
    return serving.agency_sensors(view(spark, sf, "v_daily_long"), "nation_7")


@query
def filter_time(spark: SparkSession, sf: str) -> DataFrame:
    return serving.filter_time(daily_long(spark, sf), *LONG_RANGE, years=[1996, 1998])


@query
def filter_months_weeks(spark: SparkSession, sf: str) -> DataFrame:
    return serving.filter_months_weeks(
        daily_long(spark, sf), months=["January", "December"], weeks=[1, 2, 52]
    )


@query
def traffic_view(spark: SparkSession, sf: str) -> DataFrame:
    return serving.traffic_view(
        daily_long(spark, sf),
        agencies=["nation_4", "nation_9", "nation_11"],
        years=[1995, 1997],
        months=["March", "April", "October"],
    )


@query
def traffic_view_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The same view over the stored table, whose folders the year and month sets prune."""
    path = shared_dir(spark, "daily")
    daily_table.write_daily(daily_long(spark, sf), path)
    return serving.traffic_view(
        daily_table.read_daily(spark, path),
        ["nation_4", "nation_9", "nation_11"],
        [1995, 1997],
        months=["March", "April", "October"],
    )


@query
def traffic_view_agency(spark: SparkSession, sf: str) -> DataFrame:
    return serving.traffic_view(daily(spark, sf), ["nation_2"], [2024], threshold_pct=35)


@query
def traffic_view_sensor(spark: SparkSession, sf: str) -> DataFrame:
    return serving.traffic_view(
        daily_long(spark, sf), ["nation_4"], [1996, 1997], counter_id=3, weeks=[1, 10, 20, 53]
    )


# --- alerts --------------------------------------------------------------


@query
def threshold_bands(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.threshold_bands(daily(spark, sf), FACTOR)


@query
def band_breaches(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.band_breaches(daily_long(spark, sf), FACTOR)


@query
def is_exceeding(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.with_is_exceeding(daily(spark, sf), FACTOR)


@query
def variation_sign(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.with_variation_sign(daily(spark, sf))


@query
def alert_count(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.alert_count(serving.agency_rollup(daily_long(spark, sf)), FACTOR)


@query
def relative_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.relative_alerts(serving.agency_rollup(daily_long(spark, sf)), FACTOR)


@query
def traffic_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """The alert table of a view over several agencies."""
    shown = serving.traffic_view(daily_long(spark, sf), ["nation_4", "nation_9"], [1995, 1996])
    return alerts.relative_alerts(shown, FACTOR)


# --- merge and updates ---------------------------------------------------


@query
def merge_daily(spark: SparkSession, sf: str) -> DataFrame:
    known = daily(spark, sf)
    plus_one = F.col("daily_visitor_count") + 1
    incoming = known.withColumn("daily_visitor_count", plus_one)
    return merge.merge_daily(known.filter(F.col("date") < F.lit(MERGE_CUT)), incoming)


@query
def merge_daily_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same merge done on a stored table, run twice."""
    path = shared_dir(spark, "daily")
    known = daily(spark, sf)
    plus_one = F.col("daily_visitor_count") + 1
    incoming = known.withColumn("daily_visitor_count", plus_one)
    merge.merge_into(spark, path, known.filter(F.col("date") < F.lit(MERGE_CUT)))
    merge.merge_into(spark, path, incoming)
    merge.merge_into(spark, path, incoming)
    return daily_table.read_daily(spark, path).select(*DAILY_METRICS.names)


@query
def merge_daily_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions side by side: the first, read while the second was being written, and the second."""
    path = shared_dir(spark, "daily")
    known = daily(spark, sf)
    first = merge.merge_into(spark, path, known.filter(F.col("date") < F.lit(MERGE_CUT)))
    before = daily_table.read_daily(spark, path).select(F.lit(1).alias("version"), *DAILY_METRICS.names)
    plus_one = F.col("daily_visitor_count") + 1
    merge.merge_into(spark, path, known.withColumn("daily_visitor_count", plus_one))
    again = daily_table.read_daily(spark, path, first.version).select(*DAILY_METRICS.names)
    after = daily_table.read_daily(spark, path).select(F.lit(2).alias("version"), *DAILY_METRICS.names)
    return before.unionByName(again.withColumn("version", F.lit(0))).unionByName(after)


@query
def merge_daily_units(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of a second unit come in beside the stored ones."""
    known = daily(spark, sf)
    late = known.filter(F.col("date") >= F.lit(MERGE_CUT))
    return merge.merge_daily(known, known.unionByName(late.withColumn("unit", F.lit("entries"))))


@query
def recompute_daily_table(spark: SparkSession, sf: str) -> DataFrame:
    """Stored counts from the cut on are replaced and their metrics redone."""
    path = shared_dir(spark, "daily")
    known = daily(spark, sf)
    merge.merge_into(spark, path, known)
    changed = metrics.daily_counts(kept_readings(spark, sf)).filter(F.col("date") >= F.lit(MERGE_CUT))
    plus_one = F.col("daily_visitor_count") + 1
    merge.recompute_into(spark, path, changed.withColumn("daily_visitor_count", plus_one))
    return daily_table.read_daily(spark, path).select(*DAILY_METRICS.names)


@query
def transform_run(spark: SparkSession, sf: str) -> DataFrame:
    """The batch job from landed files to the stored table."""
    path = shared_dir(spark, "daily")
    run_transform(spark, land_raw_files(spark, sf), view(spark, sf, "v_dictionary"), path)
    return daily_table.read_daily(spark, path).select(*DAILY_METRICS.names)


@query
def agency_upsert(spark: SparkSession, sf: str) -> DataFrame:
    updates = dimensions.agency_dimension(view(spark, sf, "v_agency_updates"))
    return merge.upsert(known_agencies(spark, sf), updates, "agency_name")


@query
def agency_upsert_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Two updates per agency: the later one counts."""
    later = dimensions.agency_dimension(view(spark, sf, "v_agency_updates"))
    earlier = later.withColumn("agency_size", F.lit("small"))
    updates = later.withColumn("seq", F.lit(2)).unionByName(earlier.withColumn("seq", F.lit(1)))
    return merge.upsert(known_agencies(spark, sf), updates, "agency_name", order="seq")


@query
def partial_update_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Two updates per branch: per column the later value that is not null counts."""
    later = view(spark, sf, "v_branch_updates").withColumn("seq", F.lit(2))
    earlier = later.withColumn("city", F.lit("Old Town")).withColumn("name", F.lit("old"))
    return merge.partial_update(
        view(spark, sf, "v_branches"),
        later.unionByName(earlier.withColumn("seq", F.lit(1))),
        key="id",
        columns=["name", "city", "postal_code", "is_active"],
        updated_at=F.lit(UPDATED_AT).cast("timestamp_ntz"),
        order="seq",
    )


@query
def partial_update(spark: SparkSession, sf: str) -> DataFrame:
    return merge.partial_update(
        view(spark, sf, "v_branches"),
        view(spark, sf, "v_branch_updates"),
        key="id",
        columns=["name", "city", "postal_code", "is_active"],
        updated_at=F.lit(UPDATED_AT).cast("timestamp_ntz"),
    )


# --- dimensions and calendar ---------------------------------------------


@query
def agency_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return known_agencies(spark, sf)


@query
def sensor_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.sensor_dimension(known_agencies(spark, sf))


@query
def readings_with_agency(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.with_agency(view(spark, sf, "v_readings"), known_agencies(spark, sf))


@query
def readings_with_agency_asof(spark: SparkSession, sf: str) -> DataFrame:
    """Readings with their agency's size as of their day: two agencies grow, one twice."""
    sizes = known_agencies(spark, sf).select(
        "agency_name", F.lit("2020-01-01").cast("date").alias("valid_from"), "agency_size", "base_traffic"
    )
    grown = spark.sql("""
        select * from values ('nation_1', date '2024-01-10', 'big', 5000), ('nation_3', date '2024-01-12', 'medium', 700),
        ('nation_3', date '2024-01-21', 'big', 9000) as t(agency_name, valid_from, agency_size, base_traffic)""")
    known = sizes.filter(F.col("agency_name") != "nation_4")
    versions = history.with_versions(known, grown, "agency_name")
    return history.join_as_of(view(spark, sf, "v_readings"), versions, "agency_name", "date")


@query
def opening_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.opening_calendar(view(spark, sf, "v_readings"))


@query
def expected_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.expected_traffic(view(spark, sf, "v_readings"), sensor_dimension(spark, sf))


@query
def reading_status(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.reading_status(view(spark, sf, "v_readings"))


@query
def stable_bucket(spark: SparkSession, sf: str) -> DataFrame:
    keys = view(spark, sf, "v_daily_long").select("date", "agency_name", "counter_id")
    return dimensions.stable_buckets(keys, 16)


@query
def missing_hours(spark: SparkSession, sf: str) -> DataFrame:
    return gaps.missing_hours(view(spark, sf, "v_readings"))


@query
def missing_spans(spark: SparkSession, sf: str) -> DataFrame:
    return gaps.missing_spans(view(spark, sf, "v_readings"))


# --- validation ----------------------------------------------------------


@query
def validate_footfall(spark: SparkSession, sf: str) -> DataFrame:
    return quality.violation_counts(view(spark, sf, "v_footfall"), quality.footfall_rules())


@query
def invalid_footfall(spark: SparkSession, sf: str) -> DataFrame:
    flagged = quality.with_violations(view(spark, sf, "v_footfall"), quality.footfall_rules())
    broken = flagged.filter(F.size("violations") > 0)
    return broken.withColumn("violations", F.concat_ws(",", "violations"))


@query
def validate_branch(spark: SparkSession, sf: str) -> DataFrame:
    branches = quality.with_branch_defaults(view(spark, sf, "v_branches"))
    return quality.violation_counts(branches, quality.branch_rules())


@query
def branch_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return quality.with_branch_defaults(view(spark, sf, "v_branches"))


@query
def orphan_footfall(spark: SparkSession, sf: str) -> DataFrame:
    return quality.orphan_footfall(view(spark, sf, "v_footfall"), view(spark, sf, "v_branches"))


@query
def footfall_with_branch(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.with_branch(view(spark, sf, "v_footfall"), view(spark, sf, "v_branches"))


# --- streaming -----------------------------------------------------------


@query
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "ingest")
    daily_path = f"{folder}/daily"
    ingest = start_ingest(
        spark,
        land_raw_files(spark, sf),
        view(spark, sf, "v_dictionary"),
        f"{folder}/readings",
        daily_path,
        f"{folder}/checkpoint",
    )
    ingest.awaitTermination()
    return daily_table.read_daily(spark, daily_path).select(*DAILY_METRICS.names)


@query
def stream_ingest_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Files land in three parts, in order of date, with a run after each."""
    folder = shared_dir(spark, "ingest")
    raw = view(spark, sf, "v_raw_dirty")
    for start, end in (("", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "~")):
        part = raw.filter((F.col("date_time") >= start) & (F.col("date_time") < end))
        raw_csv.write_raw_csv(part.select(*RAW_COLUMNS), f"{folder}/raw", mode="append")
        start_ingest(
            spark,
            f"{folder}/raw",
            view(spark, sf, "v_dictionary"),
            f"{folder}/readings",
            f"{folder}/daily",
            f"{folder}/checkpoint",
            rejects_path=f"{folder}/rejects",
        ).awaitTermination()
    return daily_table.read_daily(spark, f"{folder}/daily").select(*DAILY_METRICS.names)


def timed_readings(events: DataFrame) -> DataFrame:
    """Measured readings with the time of their event."""
    return events.select(
        "event_id",
        F.col("ts").cast(T.TimestampType()).alias("event_ts"),
        F.concat(F.lit("nation_"), (F.col("user_id") % 5).cast("string")).alias("agency_name"),
        (F.col("event_id") % 3).cast("int").alias("counter_id"),
        F.floor("value").cast("int").alias("visitor_count"),
        "event_type",
    ).filter(~F.col("event_type").isin("error", "signup") & (F.col("visitor_count") > 0))


@query
def stream_daily(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "windows")
    event_schema = spark.read.parquet(f"{sf}/events.parquet").schema
    # A pattern, so that the table may be one file or a folder of files.
    events = spark.readStream.schema(event_schema).parquet(f"{sf}/events.parquet*")
    totals = start_daily_windows(timed_readings(events), f"{folder}/totals", f"{folder}/checkpoint")
    totals.awaitTermination()
    return latest_totals(spark, f"{folder}/totals")


@query
def stream_late_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Two halves of the month land in order, then one reading in ten of all days, most of them late."""
    folder = shared_dir(spark, "late")
    events = spark.read.parquet(f"{sf}/events.parquet")
    straggling, second_half = F.col("event_id") % 10 == 9, F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (~straggling & ~second_half, ~straggling & second_half, straggling):
        events.filter(part).write.mode("append").parquet(f"{folder}/landed")
        landed = spark.readStream.schema(events.schema).parquet(f"{folder}/landed")
        start_daily_with_late(
            timed_readings(landed),
            f"{folder}/totals",
            f"{folder}/late",
            f"{folder}/marks",
            f"{folder}/checkpoint",
        ).awaitTermination()
    return all_totals(spark, f"{folder}/totals", f"{folder}/late")


@query
def stream_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """All files land twice at once and a third time later; every reading counts once."""
    folder = shared_dir(spark, "replayed")
    events = spark.read.parquet(f"{sf}/events.parquet")
    for copies in (2, 1):
        for _ in range(copies):
            events.write.mode("append").parquet(f"{folder}/landed")
        landed = spark.readStream.schema(events.schema).parquet(f"{folder}/landed")
        start_daily_windows(
            timed_readings(landed), f"{folder}/totals", f"{folder}/checkpoint", reading_key=["event_id"]
        ).awaitTermination()
    return latest_totals(spark, f"{folder}/totals")


@query
def stream_rolling(spark: SparkSession, sf: str) -> DataFrame:
    """Daily counts of six years: the first years are stored, two parts land after them."""
    folder = shared_dir(spark, "rolling")
    counts = view(spark, sf, "v_daily_long")
    stored = counts.filter("year(date) < 1994")
    for part in ("year(date) between 1994 and 1995", "year(date) > 1995"):
        counts.filter(part).write.mode("append").parquet(f"{folder}/landed")
        landed = spark.readStream.schema(counts.schema).parquet(f"{folder}/landed")
        start_rolling(
            landed, f"{folder}/daily", f"{folder}/behind", f"{folder}/state", f"{folder}/checkpoint", stored
        ).awaitTermination()
    streamed = spark.read.schema(DAILY_METRICS).parquet(f"{folder}/daily")
    return metrics.rolling_metrics(stored).unionByName(streamed.select(*DAILY_METRICS.names))
