"""Agency and sensor dimensions and what they say about readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlake.functions.calendar import hour_multiplier, is_open, weekday_multiplier
from countlake.functions.measures import stable_seed

# Daily base traffic by size and location.
BASE_TRAFFIC = {
    ("small", "countryside"): 20,
    ("small", "mid_sized_city"): 50,
    ("small", "metropolis"): 80,
    ("medium", "countryside"): 40,
    ("medium", "mid_sized_city"): 100,
    ("medium", "metropolis"): 200,
    ("big", "countryside"): 100,
    ("big", "mid_sized_city"): 300,
    ("big", "metropolis"): 500,
}

# Number of sensors by size, in every known location.
SENSORS_BY_SIZE = {"small": 1, "medium": 2, "big": 3}

# Status of a reading by its sentinel count.
CLOSED = -1
BROKEN = -10


def agency_dimension(agencies: DataFrame) -> DataFrame:
    """Adds base traffic and sensor count; an unknown pair gives null for both."""
    pairs = [
        F.struct(F.lit(traffic).alias("base_traffic"), F.lit(SENSORS_BY_SIZE[size]).alias("sensors"))
        for (size, _), traffic in BASE_TRAFFIC.items()
    ]
    names = [F.lit(f"{size}/{location}") for size, location in BASE_TRAFFIC]
    lookup = F.map_from_arrays(F.array(*names), F.array(*pairs))
    found = F.try_element_at(lookup, F.concat_ws("/", "agency_size", "location_type"))
    return agencies.select(
        "agency_name",
        "agency_size",
        "location_type",
        found["base_traffic"].alias("base_traffic"),
        found["sensors"].alias("counter_number"),
    )


def sensor_dimension(agencies: DataFrame) -> DataFrame:
    """One row per sensor with its share of the agency's base traffic.

    The first half of the sensors (rounded up) shares 0.8, the rest 0.2, each
    rounded to 2 digits; the last sensor takes up what is missing to 1.
    """
    n = F.col("counter_number")
    first_half = F.ceil(n / 2)
    second_half = n - first_half
    first_share = F.round(F.lit(0.8) / first_half, 2)
    second_share = F.round(F.try_divide(F.lit(0.2), second_half), 2)
    total = first_share * first_half + F.coalesce(second_share, F.lit(0.0)) * second_half
    plain = F.when(F.col("counter_id") < first_half, first_share).otherwise(second_share)
    share = (
        F.when(n == 1, F.lit(1.0))
        .when(F.col("counter_id") == n - 1, F.round(plain + F.round(F.lit(1) - total, 2), 2))
        .otherwise(plain)
    )
    sensors = agencies.filter(n > 0).withColumn("counter_id", F.explode(F.sequence(F.lit(0), n - 1)))
    return sensors.select(
        "agency_name",
        "counter_id",
        share.alias("share"),
        (F.col("base_traffic") * share).cast("int").alias("base_traffic"),
    )


def with_agency(readings: DataFrame, agencies: DataFrame) -> DataFrame:
    """Readings of known agencies with the agency's columns.

    No join hint: the optimizer broadcasts the dimension by its file size, and
    beyond the threshold adaptive execution splits a skewed agency.
    """
    return readings.join(agencies, "agency_name")


def with_branch(footfall: DataFrame, branches: DataFrame) -> DataFrame:
    """Footfall records with the name and city of their branch."""
    branch = branches.select(
        F.col("id").alias("branch_id"), F.col("name").alias("branch_name"), F.col("city").alias("branch_city")
    )
    return footfall.join(branch, "branch_id")


def opening_calendar(times: DataFrame) -> DataFrame:
    """Weekday and hour multipliers for each distinct (date, hour)."""
    date, hour = F.col("date"), F.col("hour")
    return (
        times.select("date", "hour")
        .distinct()
        .select(
            "date",
            "hour",
            weekday_multiplier(date).alias("weekday_multiplier"),
            hour_multiplier(hour).alias("hour_multiplier"),
            is_open(date, hour).alias("is_open"),
        )
    )


def expected_traffic(readings: DataFrame, sensors: DataFrame) -> DataFrame:
    """Expected count of each reading's sensor and hour, and the deviation.

    Expected is base traffic times both multipliers, cut to a whole number; -1
    when closed. The deviation is null unless open and measured. Sensors that
    are not in the dimension have no expectation.
    """
    date, hour, count = F.col("date"), F.col("hour"), F.col("visitor_count")
    mean = (F.col("base_traffic") * weekday_multiplier(date)) * hour_multiplier(hour)
    expected = F.when(F.col("base_traffic").isNull(), None).otherwise(
        F.when(is_open(date, hour), mean.cast("int")).otherwise(F.lit(CLOSED))
    )
    base = sensors.select("agency_name", "counter_id", "base_traffic")
    return (
        readings.join(base, ["agency_name", "counter_id"], "left")
        .withColumn("expected_visitors", expected)
        .select(
            "agency_name",
            "counter_id",
            "date_time",
            "visitor_count",
            "expected_visitors",
            F.when(
                (F.col("expected_visitors") >= 0) & (count >= 0), count - F.col("expected_visitors")
            ).alias("deviation"),
        )
    )


def reading_status(readings: DataFrame) -> DataFrame:
    """Readings per sensor and status."""
    count = F.col("visitor_count")
    status = (
        F.when(count == BROKEN, F.lit("broken"))
        .when(count == CLOSED, F.lit("closed"))
        .when(count >= 0, F.lit("measured"))
        .otherwise(F.lit("invalid"))
    )
    return readings.groupBy("agency_name", "counter_id", status.alias("status")).agg(
        F.count("*").alias("reading_count")
    )


def stable_buckets(df: DataFrame, buckets: int) -> DataFrame:
    """A seed of (date, agency, sensor) and a bucket that never changes."""
    seed = stable_seed(F.col("date"), F.col("agency_name"), F.col("counter_id"))
    return df.withColumn("seed", seed).withColumn("bucket", (F.col("seed") % buckets).cast("int"))
