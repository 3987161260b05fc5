import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from countlake.operators.metrics import rolling_metrics
from countlake.schemas import DAILY_METRICS
from countlake.streaming import baselines, late
from countlake.streaming.windows import latest_totals, start_daily_windows

READINGS = "event_id long, event_ts timestamp, agency_name string, counter_id int, visitor_count int"
COUNTS = "date date, agency_name string, counter_id int, unit string, daily_visitor_count long"
START = dt.date(2024, 1, 1)


def at(day, hour=10):
    return dt.datetime(2024, 1, day, hour)


def land(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).parquet(folder)


@pytest.fixture()
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def run_late(spark, folder, rows):
    stream = land(spark, folder("landed"), rows, READINGS)
    names = "totals", "late", "marks", "checkpoint"
    late.start_daily_with_late(stream, *map(folder, names)).awaitTermination()


def test_late_and_on_time_are_all_readings(spark, folder):
    batches = [
        [(1, at(1), "a", 0, 5), (2, at(10), "a", 0, 7), (3, None, "a", 0, 9)],
        [(4, at(8, 23), "a", 0, 1), (5, at(9), "a", 0, 2), (6, at(2), "b", 1, 3)],  # the ninth is open still
        [(7, at(20), "a", 0, 4)],
        [(8, at(18), "a", 0, 8), (9, at(19), "a", 0, 16)],
    ]
    for rows in batches:
        run_late(spark, folder, rows)
    came_late = late.late_readings(spark, folder("late"))
    assert {(r.event_id, r.batch_id) for r in came_late.collect()} == {(3, 0), (4, 1), (6, 1), (8, 3)}
    totals = {(r.date.day, r.agency_name): (r.visitor_count, r.readings) for r in late.on_time_totals(spark, folder("totals")).collect()}
    assert totals == {(1, "a"): (5, 1), (10, "a"): (7, 1), (9, "a"): (2, 1), (20, "a"): (4, 1), (19, "a"): (16, 1)}
    both = late.all_totals(spark, folder("totals"), folder("late")).agg(F.sum("all_count")).first()[0]
    assert both == sum(r[4] for rows in batches for r in rows)


def test_a_replayed_batch_splits_as_before(spark, folder):
    run_late(spark, folder, [(1, at(1), "a", 0, 5), (2, at(10), "a", 0, 7)])
    run_late(spark, folder, [(3, at(5), "a", 0, 1), (4, at(30), "a", 0, 2)])
    before = sorted(map(tuple, late.all_totals(spark, folder("totals"), folder("late")).collect()))
    # The run was cut off before it was noted as done, so the next one replays its batch.
    for log in ("commits/1", "commits/.1.crc"):
        (shutil.os.path.exists(f"{folder('checkpoint')}/{log}") and shutil.os.remove(f"{folder('checkpoint')}/{log}"))
    run_late(spark, folder, [(5, at(30), "b", 0, 3)])
    after = sorted(map(tuple, late.all_totals(spark, folder("totals"), folder("late")).collect()))
    assert [r for r in after if r[1] == "a"] == before


def test_an_empty_batch_of_events_keeps_the_mark(spark, folder):
    run_late(spark, folder, [(1, at(10), "a", 0, 5)])
    run_late(spark, folder, [(2, None, "a", 0, 5)])
    run_late(spark, folder, [(3, at(2), "a", 0, 1)])
    assert late.late_readings(spark, folder("late")).count() == 2


def test_readings_delivered_again_count_once(spark, folder):
    rows = [(i, at(1 + i % 3), "a", i % 2, 10 + i) for i in range(12)]

    def run():
        stream = land(spark, folder("landed"), rows, READINGS)
        start_daily_windows(stream, folder("totals"), folder("checkpoint"), reading_key=["event_id"]).awaitTermination()
        return sum(r.daily_visitor_count for r in latest_totals(spark, folder("totals")).collect())

    land(spark, folder("landed"), rows, READINGS)
    assert run() == sum(r[4] for r in rows) == run()


def days(day_range, agency="a", add=0):
    return [(START + dt.timedelta(days=d), agency, 0, "visitors", 10 + d % 17 + add) for d in day_range]


def table(df):
    return sorted((tuple(r) for r in df.select(*DAILY_METRICS.names).collect()), key=str)


def run_rolling(spark, folder, rows, stored=None):
    stream = land(spark, folder("landed"), rows, COUNTS)
    names = "daily", "behind", "state", "checkpoint"
    baselines.start_rolling(stream, *map(folder, names), stored).awaitTermination()
    return spark.read.schema(DAILY_METRICS).parquet(folder("daily"))


@pytest.mark.parametrize("gap", [0, 100])
def test_state_gives_the_baselines_of_the_whole_history(spark, folder, gap):
    stored = days(range(50)) + days(range(3), "new")
    parts = [days(range(50 + gap, 60 + gap)), days(range(60 + gap, 61 + gap)) + days(range(60, 90), "late starter")]
    for part in parts:
        got = run_rolling(spark, folder, part, spark.createDataFrame(stored, COUNTS))
    whole = rolling_metrics(spark.createDataFrame(stored + parts[0] + parts[1], COUNTS))
    expected = whole.join(spark.createDataFrame(stored, COUNTS), ["date", "agency_name", "counter_id"], "left_anti")
    assert table(got) == table(expected)
    state = spark.read.parquet(f"{folder('state')}/batch_id=1")
    assert state.agg(F.max(F.size("ring"))).first()[0] == baselines.RING


def test_days_that_come_behind_are_kept_apart(spark, folder):
    run_rolling(spark, folder, days(range(14)))
    undated = [(None, "a", 0, "visitors", 1)]
    got = run_rolling(spark, folder, days([6, 13], add=100) + days(range(14, 16)) + undated)
    assert table(got) == table(rolling_metrics(spark.createDataFrame(days(range(16)), COUNTS)))
    behind = spark.read.schema(COUNTS).parquet(folder("behind")).collect()
    assert sorted(r.daily_visitor_count for r in behind) == [1, 116, 123]
