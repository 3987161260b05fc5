import datetime as dt
import random

from countlake.operators import gaps

SCHEMA = "agency_name string, counter_id int, date date, hour int"
START = dt.date(2024, 1, 6)  # a Saturday


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def hours(df):
    return sorted((r.agency_name, r.counter_id, r.date, r.hour) for r in df.collect())


def test_spans_unfold_to_the_missing_hours(spark):
    rng = random.Random(4)
    rows = [
        ("a" if s < 2 else "b", s, START + dt.timedelta(days=d), h)
        for s in range(4)
        for d in range(40)
        for h in range(24)
        if rng.random() < 0.9 and not (s == 1 and 10 < d < 25)
    ]
    readings = frame(spark, rows + rows[:200])
    spans = gaps.missing_spans(readings)
    assert hours(gaps.hours_of_spans(spans)) == hours(gaps.missing_hours(readings))
    found = sorted(spans.collect())
    for one, two in zip(found, found[1:]):  # as long as they can be
        if one[:2] == two[:2]:
            assert (one.last_date, one.last_hour) < (two.first_date, two.first_hour)
    assert sum(r.hours for r in found) == gaps.missing_hours(readings).count()


def test_a_silent_stretch_is_one_row_over_weekends(spark):
    rows = [("a", 0, dt.date(2015, 1, 1), 9), ("a", 0, dt.date(2024, 12, 31), 17)]
    (span,) = gaps.missing_spans(frame(spark, rows)).collect()
    assert tuple(span)[2:6] == (dt.date(2015, 1, 1), 10, dt.date(2024, 12, 31), 16)


def test_given_sensors_and_span(spark):
    readings = frame(spark, [("a", 0, dt.date(2024, 1, 9), 9), ("z", 9, dt.date(2024, 1, 9), 9)])
    sensors = frame(spark, [("a", 0, None, None), ("b", 1, None, None)]).select("agency_name", "counter_id")
    args = sensors, dt.date(2024, 1, 6), dt.date(2024, 1, 14)
    spans = gaps.missing_spans(readings, *args)
    assert hours(gaps.hours_of_spans(spans)) == hours(gaps.missing_hours(readings, *args))
    assert spans.count() == 3


def test_nothing_is_missing_on_closed_days(spark):
    readings = frame(spark, [("a", 0, START, 9), ("a", 0, START + dt.timedelta(days=1), 10)])
    assert gaps.missing_spans(readings).collect() == []
    assert gaps.missing_spans(readings.limit(0)).collect() == []
