import datetime as dt

import pytest
from pyspark.sql import functions as F

from countlake.operators import merge, metrics
from countlake.schemas import DAILY_METRICS
from countlake.sources.daily_table import read_daily, write_daily

COUNTS = "date date, agency_name string, counter_id int, unit string, daily_visitor_count long"
START = dt.date(2024, 1, 1)


def counts(spark, day_range, add=0, sensors=(0, 1)):
    rows = [
        (START + dt.timedelta(days=d), "a", s, "visitors", 10 + d + add) for d in day_range for s in sensors
    ]
    return spark.createDataFrame(rows, COUNTS)


def table(df):
    return sorted((tuple(r) for r in df.select(*DAILY_METRICS.names).collect()), key=str)


def by_key(df):
    return {(r.date, r.counter_id): r.daily_visitor_count for r in df.collect()}


def test_stored_days_win(spark):
    old = metrics.rolling_metrics(counts(spark, range(5)))
    new = metrics.rolling_metrics(counts(spark, range(3, 8), add=100))
    merged = by_key(merge.merge_daily(old, new))
    assert len(merged) == 16
    assert merged[START + dt.timedelta(days=4), 0] == 14
    assert merged[START + dt.timedelta(days=5), 0] == 115


def test_merging_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "daily")
    first = metrics.rolling_metrics(counts(spark, range(40)))
    second = metrics.rolling_metrics(counts(spark, range(20, 70), add=100))
    merge.merge_into(spark, path, first)
    merge.merge_into(spark, path, second)
    once = table(read_daily(spark, path))
    assert once == table(merge.merge_daily(first, second))
    merge.merge_into(spark, path, second)
    assert table(read_daily(spark, path)) == once


def test_rows_without_a_date_are_kept_once(spark, tmp_path):
    path = str(tmp_path / "daily")
    undated = counts(spark, range(2)).withColumn("date", F.lit(None).cast("date"))
    days = metrics.rolling_metrics(counts(spark, range(2)))
    incoming = days.unionByName(metrics.rolling_metrics(undated.limit(1)))
    merge.merge_into(spark, path, days)
    merge.merge_into(spark, path, incoming)
    merge.merge_into(spark, path, incoming)
    assert read_daily(spark, path).filter("date is null").count() == 1
    assert read_daily(spark, path).count() == 5
    assert merge.merge_daily(days, incoming).count() == 4
    assert merge.merge_daily(days, incoming, undated=True).count() == 5


def test_appending_leaves_stored_files_alone(spark, tmp_path):
    path = tmp_path / "daily"
    merge.merge_into(spark, str(path), metrics.rolling_metrics(counts(spark, range(10))))
    before = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    merge.merge_into(spark, str(path), metrics.rolling_metrics(counts(spark, range(20), add=1)))
    after = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    assert before.items() <= after.items()


def test_recompute_replaces_counts_and_redoes_metrics(spark, tmp_path):
    path = str(tmp_path / "daily")
    merge.merge_into(spark, path, metrics.rolling_metrics(counts(spark, range(60))))
    merge.recompute_into(spark, path, counts(spark, range(40, 70), add=100, sensors=(0,)))
    expected = metrics.rolling_metrics(
        counts(spark, range(40))
        .union(counts(spark, range(40, 60), sensors=(1,)))
        .union(counts(spark, range(40, 70), add=100, sensors=(0,)))
    )
    assert table(read_daily(spark, path)) == table(expected)


def test_recompute_leaves_earlier_months_alone(spark, tmp_path):
    path = tmp_path / "daily"
    merge.merge_into(spark, str(path), metrics.rolling_metrics(counts(spark, range(60))))
    january = {p: p.stat().st_mtime_ns for p in (path / "year=2024" / "month=1").rglob("*.parquet")}
    merge.recompute_into(spark, str(path), counts(spark, range(40, 45), add=5))
    now = {p: p.stat().st_mtime_ns for p in (path / "year=2024" / "month=1").rglob("*.parquet")}
    assert january == now


def test_recompute_needs_dates(spark, tmp_path):
    path = str(tmp_path / "daily")
    undated = counts(spark, range(1)).withColumn("date", F.lit(None).cast("date"))
    with pytest.raises(ValueError):
        merge.recompute_into(spark, path, undated)
    merge.recompute_into(spark, path, counts(spark, range(3)))
    with pytest.raises(ValueError):
        merge.recompute_into(spark, path, undated)


def test_recompute_leaves_later_months_alone(spark, tmp_path):
    path = tmp_path / "daily"
    merge.append_counts(spark, str(path), counts(spark, range(400)))
    before = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    merge.recompute_into(spark, str(path), counts(spark, range(200, 205), add=5))
    after = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    changed = {f"{p.parent.parent.name}/{p.parent.name}" for p in after if before.get(p) != after[p]}
    assert changed == {"year=2024/month=7", "year=2024/month=8"}
    expected = metrics.rolling_metrics(
        counts(spark, [d for d in range(400) if not 200 <= d < 205]).union(counts(spark, range(200, 205), add=5))
    )
    assert table(read_daily(spark, str(path))) == table(expected)


@pytest.mark.parametrize("gap", [0, 3, 40, 200])
def test_days_in_parts_equal_all_at_once(spark, tmp_path, gap):
    path = str(tmp_path / "daily")
    parts = [range(30), range(30 + gap, 44 + gap), range(44 + gap, 60 + gap)]
    for part in parts:
        merge.append_counts(spark, path, counts(spark, part))
    merge.append_counts(spark, path, counts(spark, parts[1], add=7))  # stored days stay
    days = [d for part in parts for d in part]
    assert table(read_daily(spark, path)) == table(metrics.rolling_metrics(counts(spark, days)))


def test_units_stay_side_by_side(spark):
    old = metrics.rolling_metrics(counts(spark, range(2)))
    entries = old.withColumn("unit", F.lit("entries"))
    assert merge.merge_daily(old, entries).count() == 8


def test_a_flat_table_is_copied_before_merging(spark, tmp_path):
    flat, path = str(tmp_path / "flat"), str(tmp_path / "daily")
    old = metrics.rolling_metrics(counts(spark, range(5)))
    old.write.parquet(flat)
    new = metrics.rolling_metrics(counts(spark, range(8), add=1))
    with pytest.raises(ValueError, match="write_daily"):
        merge.merge_into(spark, flat, new)
    write_daily(read_daily(spark, flat), path)
    merge.merge_into(spark, path, new)
    assert table(read_daily(spark, path)) == table(merge.merge_daily(old, new))


def test_an_empty_folder_counts_as_no_table(spark, tmp_path):
    path = tmp_path / "daily"
    path.mkdir()
    merge.merge_into(spark, str(path), metrics.rolling_metrics(counts(spark, range(5))))
    assert read_daily(spark, str(path)).count() == 10


def test_upsert(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    updates = spark.createDataFrame([(20, "b"), (30, "c")], "v int, k string")
    assert sorted(tuple(r) for r in merge.upsert(base, updates, "k").collect()) == [("a", 1), ("b", 20), ("c", 30)]


def test_the_last_of_several_updates_counts(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    updates = spark.createDataFrame([("a", 9, 1), ("a", 5, 2), ("c", 7, 1)], "k string, v int, seq int")
    got = merge.upsert(base, updates, "k", order="seq").collect()
    assert sorted(tuple(r) for r in got) == [("a", 5), ("b", 2), ("c", 7)]
    base = spark.createDataFrame([(1, "n", "c")], "id int, name string, city string")
    updates = spark.createDataFrame(
        [(1, "x", "p", 1), (1, None, "q", 2)], "id int, name string, city string, seq int"
    )
    stamp = F.lit(dt.datetime(2024, 2, 1))
    got = merge.partial_update(base, updates, "id", ["name", "city"], stamp, order="seq")
    assert [tuple(r)[:3] for r in got.collect()] == [(1, "x", "q")]


def test_partial_update_null_leaves_the_value(spark):
    stamp = dt.datetime(2024, 2, 1)
    base = spark.createDataFrame(
        [(1, "n1", "c1", None), (2, "n2", "c2", dt.datetime(2020, 1, 1))],
        "id int, name string, city string, updated_at timestamp",
    )
    updates = spark.createDataFrame([(1, "new", None)], "id int, name string, city string")
    got = merge.partial_update(base, updates, "id", ["name", "city"], F.lit(stamp)).orderBy("id").collect()
    assert [tuple(r) for r in got] == [
        (1, "new", "c1", stamp),
        (2, "n2", "c2", dt.datetime(2020, 1, 1)),
    ]
