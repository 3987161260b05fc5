import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from countlake.functions.calendar import is_open
from countlake.operators import dimensions, gaps, quality

KEYS = "agency_name string, agency_size string, location_type string"


def test_dimension_lookup(spark):
    df = spark.createDataFrame(
        [("a", "big", "metropolis"), ("b", "small", "countryside"), ("c", "big", "seaside"), ("d", None, None)],
        KEYS,
    )
    got = {r.agency_name: (r.base_traffic, r.counter_number) for r in dimensions.agency_dimension(df).collect()}
    assert got == {"a": (500, 3), "b": (20, 1), "c": (None, None), "d": (None, None)}


def plain_shares(n):
    if n == 1:
        return [1.0]
    first = -(-n // 2)
    shares = [round(0.8 / first, 2)] * first + [round(0.2 / (n - first), 2)] * (n - first)
    shares[-1] = round(shares[-1] + round(1 - sum(shares), 2), 2)
    return shares


def test_shares(spark):
    df = spark.createDataFrame([(str(n), 100, n) for n in range(0, 61)], "agency_name string, base_traffic int, counter_number int")
    got = {}
    for r in dimensions.sensor_dimension(df).orderBy("counter_id").collect():
        got.setdefault(int(r.agency_name), []).append((r.share, r.base_traffic))
    listed = {1: [1.0], 2: [0.8, 0.2], 3: [0.4, 0.4, 0.2], 4: [0.4, 0.4, 0.1, 0.1], 5: [0.27, 0.27, 0.27, 0.1, 0.09]}
    for n in range(1, 61):
        shares = [s for s, _ in got[n]]
        assert shares == listed.get(n, plain_shares(n)), n
        assert [b for _, b in got[n]] == [int(100 * s) for s in shares]
    assert 0 not in got


def test_opening_hours(spark):
    monday = dt.date(2025, 1, 6)
    df = spark.createDataFrame(
        [(monday + dt.timedelta(days=d), h) for d in range(7) for h in range(24)], "date date, hour int"
    )
    rows = dimensions.opening_calendar(df).collect()
    for r in rows:
        weekday_open = r.date.weekday() < 5
        hour_open = r.hour in (9, 10, 11, 13, 14, 15, 16, 17)
        assert r.is_open == (weekday_open and hour_open)
        assert (r.weekday_multiplier > 0) == weekday_open
        assert (r.hour_multiplier > 0) == hour_open
    one = {(r.date, r.hour): r for r in rows}
    friday = one[monday + dt.timedelta(days=4), 15]
    assert (friday.weekday_multiplier, friday.hour_multiplier) == (1.8, 0.02)
    assert df.filter(is_open(F.col("date"), F.col("hour"))).count() == 40


def test_expected_traffic(spark):
    friday, sunday = dt.date(2025, 1, 10), dt.date(2025, 1, 12)
    readings = spark.createDataFrame(
        [
            ("a", 0, "f10", friday, 10, 95),
            ("a", 0, "f12", friday, 12, -1),
            ("a", 0, "f11", friday, 11, -10),
            ("a", 0, "s10", sunday, 10, 4),
            ("x", 0, "none", friday, 10, 5),
        ],
        "agency_name string, counter_id int, date_time string, date date, hour int, visitor_count int",
    )
    sensors = spark.createDataFrame([("a", 0, 200)], "agency_name string, counter_id int, base_traffic int")
    got = {r.date_time: (r.expected_visitors, r.deviation) for r in dimensions.expected_traffic(readings, sensors).collect()}
    assert got == {"f10": (90, 5), "f12": (-1, None), "f11": (90, None), "s10": (-1, None), "none": (None, None)}


def test_reading_status(spark):
    df = spark.createDataFrame([(c,) for c in (-10, -1, 0, 7, -3)], "visitor_count int")
    named = df.withColumn("agency_name", F.lit("a")).withColumn("counter_id", F.lit(0))
    got = {r.status: r.reading_count for r in dimensions.reading_status(named).collect()}
    assert got == {"broken": 1, "closed": 1, "measured": 2, "invalid": 1}


def test_stable_seed_is_the_hash_modulo_two_to_the_32(spark):
    keys = [(dt.date(2024, 12, 1), "Lyon_1", 2), (dt.date(2025, 5, 29), "Aix_les_bains_1", 0)]
    df = spark.createDataFrame(keys, "date date, agency_name string, counter_id int")
    for r in dimensions.stable_buckets(df, 16).collect():
        text = f"{r.date:%Y%m%d}{r.agency_name}{r.counter_id}"
        assert r.seed == int(hashlib.sha256(text.encode()).hexdigest(), 16) % 2**32
        assert r.bucket == r.seed % 16


HOURS = "agency_name string, counter_id int, date date, hour int"


def test_missing_hours(spark):
    friday, monday = dt.date(2025, 1, 10), dt.date(2025, 1, 13)
    df = spark.createDataFrame(
        [("a", 0, friday, h) for h in (9, 9, 10, 11, 12)] + [("a", 1, monday, 17)], HOURS
    )
    got = gaps.missing_hours(df)
    assert got.count() == 2 * 2 * 8 - 4
    assert got.filter("agency_name = 'a' and counter_id = 0 and hour in (9, 10, 11) and date = '2025-01-10'").isEmpty()
    sensors = spark.createDataFrame([("z", 9)], "agency_name string, counter_id int")
    assert gaps.missing_hours(df, sensors, friday, friday).count() == 8
    assert gaps.missing_hours(df, sensors, dt.date(2025, 1, 11), dt.date(2025, 1, 12)).isEmpty()


FOOTFALL = "branch_id int, detector_id string, timestamp timestamp, visitor_count int, entry_count int, exit_count int"


def test_footfall_rules(spark):
    at = dt.datetime(2025, 1, 1, 10)
    df = spark.createDataFrame(
        [
            (1, "DETECTOR-001", at, 10, 5, 3),
            (1, "d" * 50, at, 0, 0, 0),
            (2, "d" * 51, at, -1, 0, -5),
            (None, None, None, None, None, None),
        ],
        FOOTFALL,
    )
    rules = quality.footfall_rules()
    got = {r.rule: r.violations for r in quality.violation_counts(df, rules).collect()}
    assert got == {
        "branch_id_present": 1,
        "detector_id_max_50": 2,
        "timestamp_present": 1,
        "visitor_count_min_0": 2,
        "entry_count_min_0": 1,
        "exit_count_min_0": 2,
    }
    flagged = [r.violations for r in quality.with_violations(df, rules).collect()]
    assert flagged[0] == [] and flagged[1] == []
    assert flagged[2] == ["detector_id_max_50", "visitor_count_min_0", "exit_count_min_0"]


def test_branch_rules_defaults_and_orphans(spark):
    branches = spark.createDataFrame(
        [(1, "Main", "123 Main St", "Geneva", "1200", None), (2, "n" * 101, None, "c", "p" * 11, False)],
        "id int, name string, address string, city string, postal_code string, is_active boolean",
    )
    got = {r.rule: r.violations for r in quality.violation_counts(branches, quality.branch_rules()).collect()}
    assert got == {"name_max_100": 1, "address_max_200": 1, "city_max_50": 0, "postal_code_max_10": 1}
    active = quality.with_branch_defaults(branches).orderBy("id").collect()
    assert [r.is_active for r in active] == [True, False]
    footfall = spark.createDataFrame([(1, "d", None, 1, 1, 1), (3, "d", None, 1, 1, 1)], FOOTFALL)
    assert [r.branch_id for r in quality.orphan_footfall(footfall, branches).collect()] == [3]
    joined = dimensions.with_branch(footfall, branches).collect()
    assert [(r.branch_id, r.branch_name, r.branch_city) for r in joined] == [(1, "Main", "Geneva")]


@pytest.mark.parametrize("rules", [quality.footfall_rules, quality.branch_rules])
def test_rules_name_their_column(spark, rules):
    assert all(name == name.lower() for name in rules())
