import datetime as dt
import math

import pytest

from countlake.operators import alerts, metrics, serving
from countlake.sources.daily_table import read_daily, write_daily

SUBSET = (
    "agency_name string, counter_id int, date string, daily_visitor_count long,"
    " avg_visits_4_weekday double, prev_avg_4_visits double, pct_change double"
)
FULL = (
    "date date, agency_name string, counter_id int, daily_visitor_count long,"
    " avg_visits_4_weekday double, prev_avg_4_visits double, pct_change double"
)


@pytest.fixture(scope="module")
def dated_text(spark):
    rows = [
        ("A", 1, "2024-01-01", 10, 8.0, 5.0, 100.0),
        ("A", 2, "2024-01-02", 20, 18.0, 10.0, 100.0),
        ("B", 1, "2024-01-01", 5, 4.0, 2.0, 150.0),
    ]
    return spark.createDataFrame(rows, SUBSET)


def test_sensor_list(dated_text):
    assert [tuple(r) for r in serving.sensor_list(dated_text).collect()] == [("A", 1), ("A", 2), ("B", 1)]
    assert [r[0] for r in serving.agency_list(dated_text).collect()] == ["A", "B"]
    assert [r[0] for r in serving.agency_sensors(dated_text, "A").collect()] == [1, 2]


def test_rollup_of_one_agency_with_text_dates(dated_text):
    rows = serving.agency_rollup(dated_text, ["A"], dt.date(2024, 1, 1), dt.date(2024, 1, 2)).collect()
    assert {r.agency_name for r in rows} == {"A"}
    assert len(rows) == 2
    first = min(rows, key=lambda r: r.date)
    assert first.date == dt.date(2024, 1, 1)
    assert first.pct_change == 100 * (first.daily_visitor_count / first.prev_avg_4_visits - 1)


def test_rollup_of_unknown_agency_is_empty(dated_text):
    assert serving.agency_rollup(dated_text, ["Z"], dt.date(1999, 1, 1), dt.date(1999, 1, 2)).isEmpty()


def test_rollup_adds_sensors_and_skips_missing_baselines(spark):
    day = dt.date(2024, 1, 8)
    rows = [
        (day, "A", 1, 10, 8.0, 5.0, 100.0),
        (day, "A", 2, 20, 20.0, None, None),
        (day, "B", 1, 5, 5.0, None, None),
        (None, "A", 1, 1, 1.0, 1.0, 0.0),
    ]
    df = spark.createDataFrame(rows, FULL)
    got = {r.agency_name: r for r in serving.agency_rollup(df, with_baseline_count=True).collect()}
    assert (got["A"].daily_visitor_count, got["A"].prev_avg_4_visits) == (30, 5.0)
    assert (got["A"].pct_change, got["A"].baseline_sensors) == (500.0, 1)
    assert got["B"].prev_avg_4_visits == 0.0
    assert got["B"].pct_change == math.inf
    assert got["B"].baseline_sensors == 0


def test_sensor_series(dated_text):
    assert serving.sensor_series(dated_text, "A", 1).count() == 1
    day = dt.date(2024, 1, 1)
    one = serving.sensor_series(dated_text, "A", 1, day, day).collect()
    assert [r.date for r in one] == [day]
    later = dt.date(2024, 1, 2)
    assert serving.sensor_series(dated_text, "A", 1, later, later).isEmpty()


def test_agency_names_with_quotes(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "l'agence", 1, 3, 3.0, None, None)], FULL)
    assert serving.sensor_series(df, "l'agence", 1).count() == 1


def days(spark, *dates):
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in dates], "date date")


def test_time_filters(spark):
    df = days(spark, "2023-12-31", "2024-01-01", "2024-06-15", "2024-12-30", "2025-01-01")
    start, end = dt.date(2023, 12, 31), dt.date(2024, 12, 30)
    assert serving.filter_time(df, start, end, [2024]).count() == 3
    assert serving.filter_time(df, start, end, [2023, 2024]).count() == 4
    assert serving.filter_time(df, start, end, []).isEmpty()
    # ISO week 1 holds the last days of December too.
    assert serving.filter_months_weeks(df, weeks=[1]).count() == 3
    assert serving.filter_months_weeks(df, months=["December"]).count() == 2
    assert serving.filter_months_weeks(df, months=["December"], weeks=[1]).count() == 1
    assert serving.filter_months_weeks(df, [], []).count() == 5
    with pytest.raises(ValueError):
        serving.filter_months_weeks(df, months=["Decembre"])


def test_filters_pass_frames_without_a_date(spark):
    df = spark.createDataFrame([(1,)], "n int")
    assert serving.filter_time(df, dt.date(2024, 1, 1), dt.date(2024, 1, 2), [2024]) is df
    assert serving.filter_months_weeks(df, ["May"], [1]) is df


def test_average_per_agency(dated_text):
    got = {r.agency_name: r.avg_daily_visitors for r in serving.average_per_agency(dated_text).collect()}
    assert got == {"A": 15.0, "B": 5.0}


READINGS = "date_time string, agency_name string, counter_id int, visitor_count int"


def test_hour_over_all_sensors_leaves_sentinels_out(spark):
    at = "2024-01-10 10:00"
    df = spark.createDataFrame([(at, "A", 0, 57), (at, "A", 1, -10), (at, "A", 2, -1), (at, "B", 0, -1)], READINGS)
    got = {r.agency_name: r for r in serving.hourly_totals(df).collect()}
    assert tuple(got["A"])[2:] == (57, 1, 1)
    assert (got["B"].visitor_count, got["B"].closed_sensors) == (None, 1)


def test_reading_lookup(spark):
    at = "2024-01-10 10:00"
    df = spark.createDataFrame([(at, "A", 0, 57), (at, "A", 1, 3), (at, "B", 0, 9)], READINGS)
    one = serving.reading_lookup(df, at, "A", 1, unit="people").collect()
    assert [tuple(r) for r in one] == [("A", at, 3, "people", 1)]
    everything = serving.reading_lookup(df, at, "A").collect()
    assert [tuple(r) for r in everything] == [("A", at, 60, "visitors", None)]
    assert serving.reading_lookup(df, at, "A", 7).isEmpty()
    assert serving.reading_lookup(df, at, "C").isEmpty()


def alert_frame(spark, *rows):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame(
        [(day + dt.timedelta(days=i), "A", 1, d, 0.0, p, c) for i, (d, p, c) in enumerate(rows)], FULL
    )


def test_band_edges_are_not_breaches(spark):
    df = alert_frame(spark, (15, 10.0, 50.0), (5, 10.0, -50.0), (16, 10.0, 60.0), (4, 10.0, -60.0))
    sides = {r.daily_visitor_count: r.side for r in alerts.band_breaches(df, 1.5).collect()}
    assert sides == {16: "above", 4: "below"}


def test_bands_need_a_positive_baseline(spark):
    df = alert_frame(spark, (15, 0.0, None), (5, None, None), (5, 10.0, -50.0))
    assert alerts.threshold_bands(df, 1.2).count() == 1
    flags = [r.is_exceeding for r in alerts.with_is_exceeding(df, 1.2).orderBy("date").collect()]
    assert flags == [False, False, False]


def test_variation_sign(spark):
    df = alert_frame(spark, (1, 1.0, 0.0), (1, 1.0, -1.0), (1, None, None))
    got = [r.variation for r in alerts.with_variation_sign(df).orderBy("date").collect()]
    assert got == ["up", "down", None]


def test_relative_alerts_top_ten_and_half_even_ratio(spark):
    # 9 / 8 = 1.125 and 11 / 8 = 1.375 are exact halves.
    df = alert_frame(spark, *[(100 + i, 10.0, 0.0) for i in range(12)], (9, 8.0, 0.0), (11, 8.0, 0.0))
    top = alerts.relative_alerts(df, 1.1).collect()
    assert [r.daily_visitor_count for r in top] == list(range(111, 101, -1))
    assert alerts.alert_count(df, 1.1).first().alert_days == 14
    ratios = {r.daily_visitor_count: r.ratio for r in alerts.relative_alerts(df, 1.1, top=14).collect()}
    assert (ratios[9], ratios[11]) == (1.12, 1.38)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("daily") / "table")
    start = dt.date(2023, 11, 1)
    rows = [
        (start + dt.timedelta(days=d), agency, sensor, "visitors", 10 + d + sensor)
        for d in range(120)
        for agency in ("A", "B", "C")
        for sensor in (0, 1)
    ]
    schema = "date date, agency_name string, counter_id int, unit string, daily_visitor_count long"
    write_daily(metrics.rolling_metrics(spark.createDataFrame(rows, schema)), path)
    return path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_traffic_view_modes(spark, stored):
    daily = read_daily(spark, stored)
    sensor = serving.traffic_view(daily, ["A"], [2024], counter_id=1, months=["January"])
    assert sensor.count() == 31
    assert {r.counter_id for r in sensor.collect()} == {1}
    agency = serving.traffic_view(daily, ["A"], [2023])
    assert agency.count() == 61
    several = serving.traffic_view(daily, ["A", "B"], [2023, 2024], weeks=[1])
    assert several.count() == 14
    # A sensor counts only with a single agency.
    assert serving.traffic_view(daily, ["A", "B"], [2024], counter_id=1).columns == sensor.columns
    assert serving.traffic_view(daily, [], [2024]).isEmpty()
    assert serving.traffic_view(daily, ["A"], []).isEmpty()
    one_day = dt.date(2024, 1, 3)
    assert serving.traffic_view(daily, ["A"], [2024], start=one_day, end=one_day).count() == 1


def test_date_range_prunes_partitions_and_is_pushed_down(spark, stored):
    view = serving.traffic_view(read_daily(spark, stored), ["A"], [2024], counter_id=1)
    plan = plan_of(view)
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(agency_name,A)" in pushed and "EqualTo(counter_id,1)" in pushed
    assert "unit" not in plan.split("ReadSchema: ")[1]


@pytest.mark.parametrize("counter_id", [None, 1])
def test_year_and_month_sets_prune_folders(spark, stored, counter_id):
    view = serving.traffic_view(
        read_daily(spark, stored), ["A"], [2022, 2024], counter_id=counter_id, months=["March", "May"]
    )
    filters = plan_of(view).split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and "IN (2022,2024)" in filters
    assert "month" in filters and "IN (3,5)" in filters
