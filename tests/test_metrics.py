import datetime as dt

from countlake.operators import metrics

COUNTS = "date date, agency_name string, counter_id int, unit string, daily_visitor_count long"
MONDAY = dt.date(2024, 1, 1)


def weekly(spark, counts, weeks=None, sensor=1):
    weeks = weeks or range(len(counts))
    rows = [
        (MONDAY + dt.timedelta(weeks=w), "a", sensor, "visitors", c)
        for w, c in zip(weeks, counts, strict=True)
    ]
    return spark.createDataFrame(rows, COUNTS)


def columns(df, *names):
    return [tuple(r[n] for n in names) for r in df.orderBy("date").collect()]


def test_rolling_average_includes_the_day_itself(spark):
    got = columns(
        metrics.rolling_metrics(weekly(spark, [10, 20, 30, 40, 50])),
        "weekday",
        "avg_visits_4_weekday",
        "prev_avg_4_visits",
        "pct_change",
    )
    assert got == [
        (2, 10.0, None, None),
        (2, 15.0, 10.0, 100.0),
        (2, 20.0, 15.0, 100.0),
        (2, 25.0, 20.0, 100.0),
        (2, 35.0, 25.0, 100.0),
    ]


def test_missing_weeks_do_not_shorten_the_window(spark):
    df = weekly(spark, [10, 20, 30, 40, 50], weeks=[0, 1, 3, 9, 30])
    assert columns(metrics.rolling_metrics(df), "avg_visits_4_weekday")[-1] == (35.0,)


def test_averages_and_changes_round_half_away_from_zero(spark):
    got = columns(metrics.rolling_metrics(weekly(spark, [2, 3])), "avg_visits_4_weekday")
    assert got == [(2.0,), (3.0,)]
    # 39 against 40 is -2.5 percent.
    got = columns(metrics.rolling_metrics(weekly(spark, [40, 39])), "pct_change")
    assert got == [(None,), (-3.0,)]


def test_sensors_and_weekdays_do_not_mix(spark):
    other_day = spark.createDataFrame([(MONDAY + dt.timedelta(days=1), "a", 1, "visitors", 99)], COUNTS)
    df = weekly(spark, [10, 20]).union(weekly(spark, [7], sensor=2)).union(other_day)
    rows = metrics.rolling_metrics(df).collect()
    assert sorted((r.counter_id, r.weekday, r.prev_avg_4_visits) for r in rows if r.prev_avg_4_visits) == [
        (1, 2, 10.0)
    ]


def test_daily_and_monthly_counts(spark):
    readings = spark.createDataFrame(
        [(MONDAY, "a", 1, 5, "visitors"), (MONDAY, "a", 1, 6, "visitors"), (None, "a", 1, 7, "visitors")],
        "date date, agency_name string, counter_id int, visitor_count int, unit string",
    )
    daily = metrics.daily_counts(readings)
    assert {r.date: r.daily_visitor_count for r in daily.collect()} == {MONDAY: 11, None: 7}
    monthly = metrics.monthly_counts(daily.filter("date is not null")).collect()
    assert [tuple(r) for r in monthly] == [(2024, 1, "a", 1, 11)]


def test_windows_share_one_shuffle_and_sort(spark):
    plan = metrics.rolling_metrics(weekly(spark, [1, 2]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1
