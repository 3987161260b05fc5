import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from countlake.operators.cleaning import clean_readings
from countlake.operators.metrics import daily_counts, daily_metrics, rolling_metrics
from countlake.plans.transform import run_transform
from countlake.schemas import DAILY_METRICS
from countlake.sources.daily_table import read_daily
from countlake.sources.raw_csv import read_raw_readings
from countlake.streaming.ingest import read_clean_readings, start_ingest
from countlake.streaming.windows import close_days, latest_totals, start_daily_windows

HEADERS = [
    ["date_time", "agency_name", "counter_id", "visitor_count", "unit"],
    ["agency_name", "date_time", "visitor_count", "unit", "counter_id"],
]


def land(folder, name, header, day_range, count=10):
    folder.mkdir(exist_ok=True)
    lines = [",".join(header)]
    for d in day_range:
        for sensor in (0, 1):
            row = {
                "date_time": f"{dt.date(2025, 1, 6) + dt.timedelta(days=d)} 10:00",
                "agency_name": "Main Brnch" if d % 2 else "Main Branch",
                "counter_id": sensor,
                "visitor_count": count + d,
                "unit": "visitors",
            }
            lines.append(",".join(str(row[h]) for h in header))
    lines.append(",".join("bad" for _ in header))
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame([("Main Branch",), ("Lyon_1",)], "agency_name string")


def table(df):
    return sorted((tuple(r) for r in df.select(*DAILY_METRICS.names).collect()), key=str)


def ingest(spark, tmp_path, known, policy):
    folder = {n: str(tmp_path / n) for n in ("raw", "readings", "daily", "checkpoint")}
    start_ingest(
        spark, folder["raw"], known, folder["readings"], folder["daily"], folder["checkpoint"], policy
    ).awaitTermination()
    return read_daily(spark, folder["daily"])


def test_one_run_equals_the_batch_job(spark, tmp_path, known):
    land(tmp_path / "raw", "a.csv", HEADERS[0], range(30))
    land(tmp_path / "raw", "b.csv", HEADERS[1], range(30, 45))
    streamed = table(ingest(spark, tmp_path, known, "keep"))
    run_transform(spark, str(tmp_path / "raw"), known, str(tmp_path / "batch"))
    assert streamed == table(read_daily(spark, str(tmp_path / "batch")))
    assert len(streamed) == 90
    # Nothing new landed: nothing changes.
    assert table(ingest(spark, tmp_path, known, "keep")) == streamed
    assert read_clean_readings(spark, str(tmp_path / "readings")).count() == 90


def test_parts_equal_one_run_in_every_column(spark, tmp_path, known):
    for base, parts in (("parts", True), ("whole", False)):
        (tmp_path / base).mkdir()
        for i, days in enumerate((range(28), range(28, 42), range(90, 110))):
            land(tmp_path / base / "raw", f"{i}.csv", HEADERS[i % 2], days)
            if parts:
                ingest(spark, tmp_path / base, known, "keep")
    run_transform(spark, str(tmp_path / "whole" / "raw"), known, str(tmp_path / "whole" / "daily"))
    streamed = table(read_daily(spark, str(tmp_path / "parts" / "daily")))
    assert streamed == table(read_daily(spark, str(tmp_path / "whole" / "daily")))
    # Each wrong spelling was matched once for all runs.
    corrections = spark.read.parquet(str(tmp_path / "parts" / "readings_corrections"))
    assert corrections.count() == corrections.distinct().count() == 1


def test_lines_left_out_are_written(spark, tmp_path, known):
    raw = tmp_path / "raw"
    land(raw, "a.csv", HEADERS[0], range(3))
    (raw / "b.csv").write_text("2025-01-06 10:00,Main Branch,0,5,visitors\n")
    folder = {n: str(tmp_path / n) for n in ("readings", "daily", "checkpoint", "rejects", "batch")}
    with pytest.raises(Exception, match="without a header"):
        ingest(spark, tmp_path, known, "keep")
    start_ingest(
        spark, str(raw), known, folder["readings"], folder["daily"], folder["checkpoint"],
        rejects_path=folder["rejects"],
    ).awaitTermination()
    run_transform(spark, str(raw), known, folder["batch"], rejects_path=f"{tmp_path}/r")
    for path in (folder["rejects"], f"{tmp_path}/r"):
        reasons = sorted(r.reason for r in spark.read.parquet(path).collect())
        assert reasons == ["bad_date", "unmapped_file"]
    assert table(read_daily(spark, folder["daily"])) == table(read_daily(spark, folder["batch"]))


def test_nothing_is_left_in_the_shared_folder(spark, tmp_path, known):
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(root.glob("*/*/*"))
    land(tmp_path / "raw", "a.csv", HEADERS[0], range(3))
    ingest(spark, tmp_path, known, "keep")
    run_transform(spark, str(tmp_path / "raw"), known, str(tmp_path / "daily"), rejects_path=f"{tmp_path}/r")
    assert set(root.glob("*/*/*")) == before


def test_keep_freezes_days_and_recompute_completes_them(spark, tmp_path, known):
    results = {}
    for policy in ("keep", "recompute"):
        base = tmp_path / policy
        base.mkdir()
        land(base / "raw", "a.csv", HEADERS[0], range(30))
        ingest(spark, base, known, policy)
        land(base / "raw", "b.csv", HEADERS[1], range(25, 45))
        results[policy] = ingest(spark, base, known, policy)
    day = F.col("date") == dt.date(2025, 1, 6) + dt.timedelta(days=27)
    assert {r.daily_visitor_count for r in results["keep"].filter(day).collect()} == {37}
    assert {r.daily_visitor_count for r in results["recompute"].filter(day).collect()} == {74}
    everything = read_raw_readings(spark, str(tmp_path / "recompute" / "raw"))
    assert table(results["recompute"]) == table(daily_metrics(clean_readings(everything, known)))


def test_batch_job_with_recompute(spark, tmp_path, known):
    land(tmp_path / "raw", "a.csv", HEADERS[0], range(10))
    path = str(tmp_path / "daily")
    run_transform(spark, str(tmp_path / "raw"), known, path)
    land(tmp_path / "raw", "b.csv", HEADERS[0], range(5, 12))
    run_transform(spark, str(tmp_path / "raw"), known, path, on_conflict="recompute")
    clean = clean_readings(read_raw_readings(spark, str(tmp_path / "raw")), known)
    assert table(read_daily(spark, path)) == table(rolling_metrics(daily_counts(clean)))
    with pytest.raises(ValueError):
        run_transform(spark, str(tmp_path / "raw"), known, path, on_conflict="replace")


def test_single_raw_row_end_to_end(spark, tmp_path, known):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "one.csv").write_text(
        "date_time,agency_name,counter_id,visitor_count,unit\n2025-01-01 10:00,Main Branch,1,10,visitors\n"
    )
    path = str(tmp_path / "daily")
    run_transform(spark, str(tmp_path / "raw"), known, path)
    row = read_daily(spark, path).select(*DAILY_METRICS.names).collect()
    assert [tuple(r) for r in row] == [
        (dt.date(2025, 1, 1), "main_branch", 1, "visitors", 10, 4, 10.0, None, None)
    ]


def test_daily_windows_over_several_runs(spark, tmp_path):
    schema = "event_ts timestamp, agency_name string, counter_id int, visitor_count int"
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    start = dt.datetime(2025, 1, 6, 9)

    def arrive(*hours):
        rows = [(start + dt.timedelta(hours=h), "a", 0, 1 + h) for h in hours]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        start_daily_windows(stream, out, checkpoint).awaitTermination()
        return {r.date.day: r.daily_visitor_count for r in latest_totals(spark, out).collect()}

    assert arrive(0, 1, 24) == {6: 3, 7: 25}
    # Two hours late but within the watermark.
    assert arrive(2, 25) == {6: 6, 7: 51}
    assert arrive(24 * 5) == {6: 6, 7: 51, 11: 121}
    # Closed days come from their own table, the others from the batches.
    closed, before = str(tmp_path / "closed"), dt.date(2025, 1, 8)
    close_days(spark, out, closed, before)
    both = latest_totals(spark, out, closed, before)
    assert {r.date.day: r.daily_visitor_count for r in both.collect()} == {6: 6, 7: 51, 11: 121}
    assert spark.read.parquet(closed).count() == 2
    # Far behind the watermark: dropped.
    assert arrive(3) == {6: 6, 7: 51, 11: 121}
