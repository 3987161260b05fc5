import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from countlake.operators.serving import reading_lookup
from countlake.sources.lookup_table import stored_readings, write_lookup

SCHEMA = "date_time string, agency_name string, counter_id int, visitor_count int, unit string"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    hours = spark.range(30 * 24).select(
        F.date_format(
            F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(hours=F.col("id").cast("int")), "yyyy-MM-dd HH:mm"
        ).alias("date_time")
    )
    agencies = spark.range(200).select(F.concat(F.lit("agency_"), F.col("id").cast("string")).alias("agency_name"))
    readings = hours.join(F.broadcast(agencies)).select(
        "date_time",
        "agency_name",
        F.lit(1).alias("counter_id"),
        F.pmod(F.xxhash64("date_time", "agency_name"), F.lit(500)).cast("int").alias("visitor_count"),
        F.lit("visitors").alias("unit"),
    )
    odd = spark.createDataFrame([("bad", "agency_1", 1, 7, "visitors"), ("bad", None, 1, 8, "visitors")], SCHEMA)
    path = str(tmp_path_factory.mktemp("lookup") / "readings")
    write_lookup(readings.unionByName(odd), path, buckets=4, group_bytes=1 << 12)
    return readings, path


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("agency", ["agency_0", "agency_77", "nobody"])
@pytest.mark.parametrize("time", ["2024-01-10 10:00", "2024-01-30 23:00", "2025-01-01 00:00"])
def test_lookups_equal_those_in_the_readings(spark, stored, agency, time):
    readings, path = stored
    found = stored_readings(spark, path, time, agency, buckets=4)
    assert rows(reading_lookup(found, time, agency, 1)) == rows(reading_lookup(readings, time, agency, 1))
    assert rows(reading_lookup(found, time, agency)) == rows(reading_lookup(readings, time, agency))


def test_times_that_cannot_be_read_are_kept(spark, stored):
    found = stored_readings(spark, stored[1], "bad", "agency_1", buckets=4)
    assert [r.visitor_count for r in found.collect()] == [7]


def test_a_lookup_reads_few_row_groups(spark, stored):
    _, path = stored
    found = stored_readings(spark, path, "2024-01-10 10:00", "agency_77", buckets=4)
    opened = found._jdf.queryExecution().executedPlan().toString()
    assert "date#" in opened.split("PartitionFilters:")[1].split("PushedFilters")[0]
    files = [r.f for r in found.select(F.input_file_name().alias("f")).distinct().collect()]
    assert len(files) == 1 and "date=2024-01-10" in files[0]
    groups = kept = 0
    for file in files:
        meta = pq.ParquetFile(file.removeprefix("file://")).metadata
        for i in range(meta.num_row_groups):
            column = meta.row_group(i).column(1)
            assert column.path_in_schema == "agency_name"
            groups += 1
            kept += column.statistics.min <= "agency_77" <= column.statistics.max
    assert groups >= 3 > kept >= 1
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(agency_name,agency_77)" in plan and "EqualTo(date_time,2024-01-10 10:00)" in plan


def test_groups_can_be_passed_over_without_reading_them(stored):
    (file, *_) = Path(stored[1]).glob("date=2024-01-10/bucket=*/*.parquet")
    meta = pq.ParquetFile(file).metadata
    for i in range(meta.num_row_groups):
        for c in (0, 1):
            column = meta.row_group(i).column(c)
            # Chunks coded by a dictionary are looked up in it; only others get a bloom filter.
            assert column.statistics.has_min_max and column.has_dictionary_page
