import datetime as dt

import pytest
from pyspark.sql import functions as F

from countlake.functions import parsing
from countlake.operators import cleaning
from countlake.operators.matching import correct_names

RAW = "date_time string, agency_name string, counter_id string, visitor_count string, unit string"


def values(df, column):
    return [r[column] for r in df.collect()]


def test_date_text_must_fit_the_format(spark):
    texts = ["2025-01-01 10:00", "2025-01-01 10:00:30", "2024-1-1 9:05", "2025-02-30 10:00", "bad", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, date_time string")
    got = {r.i: r.date for r in cleaning.with_date(df).collect()}
    assert got == {0: dt.date(2025, 1, 1), 1: None, 2: None, 3: None, 4: None, 5: None}


def test_date_shortcut_agrees_with_the_format_parser(spark):
    texts = [
        f"{day} {time}"
        for day in (
            "2024-02-29", "2023-02-29", "2024-00-10", "2024-13-01", "2024-04-31", "0000-01-01", "0001-01-01",
            "9999-12-31", "1582-10-10", "+12024-01-01", "-2024-01-01", "2024-1-01", "24-01-01", "2024/01/01",
        )
        for time in ("00:00", "23:59", "24:00", "12:60", "1:00", "01:00:00", "01:00 ", "01:00\n", "")
    ]
    df = spark.createDataFrame([(t,) for t in texts + [" 2024-01-01 10:00", "", None]], "t string")
    both = df.select("t", parsing.reading_date("t").alias("a"), F.to_date(parsing.reading_time("t")).alias("b"))
    assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).collect() == []
    assert both.filter("a is not null").count() > 8


def test_only_positive_whole_counts_stay(spark):
    texts = [" 10", "10.0", "", "abc", "-1", "-10", "0", "99999999999", "+5", None, "7", "2147483647"]
    df = spark.createDataFrame([(t,) for t in texts], "visitor_count string")
    assert sorted(values(cleaning.keep_counted(df), "visitor_count")) == [7, 2147483647]


def test_counts_that_are_numbers_already(spark):
    df = spark.createDataFrame([(-10,), (-1,), (0,), (3,), (None,)], "visitor_count int")
    assert values(cleaning.keep_counted(df), "visitor_count") == [3]


@pytest.mark.parametrize("kind", ["string", "int"])
def test_sensor_ids_zero_to_ten(spark, kind):
    df = spark.createDataFrame([(i,) for i in (-1, 0, 10, 11)], "counter_id int")
    typed = df.select(F.col("counter_id").cast(kind).alias("counter_id"))
    assert sorted(values(cleaning.keep_known_sensors(typed), "counter_id")) == [0, 10]


def test_sensor_id_text_is_dropped(spark):
    df = spark.createDataFrame([("x1",), ("1.0",), ("",)], "counter_id string")
    assert cleaning.keep_known_sensors(df).isEmpty()


def test_units(spark):
    df = spark.createDataFrame([("Visitors",), ("VISITORS",), ("visitor",), (" visitors",), (None,)], "unit string")
    assert values(cleaning.keep_visitors(df), "unit") == ["visitors", "visitors"]


def test_names_are_lowered_and_spaces_become_underscores(spark):
    df = spark.createDataFrame([("Main  Branch ",), ("LYON\t1",), (None,)], "agency_name string")
    assert sorted(values(cleaning.standardise_names(df), "agency_name")) == ["lyon\t1", "main__branch_"]


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def test_reject_reasons_take_the_first_failing_rule(spark):
    ok = ("2025-01-01 10:00", "A", "1", "5", "visitors")

    def but(**changes):
        names = ["date_time", "agency_name", "counter_id", "visitor_count", "unit"]
        return tuple(changes.get(n, v) for n, v in zip(names, ok, strict=True))

    df = raw(
        spark,
        ok,
        but(date_time="bad", agency_name=None),
        but(agency_name=None, visitor_count="x"),
        but(visitor_count="0", counter_id="11"),
        but(counter_id="11", unit="entries"),
        but(unit=None),
    )
    counts = {r.reason: r.row_count for r in cleaning.reject_counts(df).collect()}
    assert counts == {**{r: 1 for r in cleaning.REJECT_REASONS}, "kept": 1}
    assert cleaning.rejected_readings(df).count() == 5


def test_kept_and_rejected_rows_are_all_rows(spark):
    rows = [
        ("2025-01-01 10:00", "A", "1", "5", "visitors"),
        ("bad", "A", "1", "5", "visitors"),
        ("2025-01-01 10:00", "A", "1", "-10", "visitors"),
    ]
    df = raw(spark, *rows)
    dictionary = spark.createDataFrame([("a",)], "agency_name string")
    kept = cleaning.clean_readings(df, dictionary)
    assert kept.count() + cleaning.rejected_readings(df).count() == len(rows)
    assert cleaning.clean_readings(df, dictionary, keep_bad_dates=True).count() == 2


def test_no_dictionary_leaves_names(spark):
    df = spark.createDataFrame([("anything",)], "agency_name string")
    assert correct_names(df, None) is df
