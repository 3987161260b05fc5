import json

import pytest

from countlake.schemas import DAILY_METRICS, RAW_COLUMNS
from countlake.sources import agencies, daily_table, raw_csv, records

DECLARED = "date_time,agency_name,counter_id,visitor_count,unit"
EXTRACTOR = "agency_name,date_time,visitor_count,unit,counter_id"


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def rows(df):
    return sorted((tuple(r) for r in df.select(*RAW_COLUMNS).collect()), key=str)


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "a.csv", DECLARED, "2025-01-01 10:00,Main Branch,1,10,visitors", "2025-01-01 11:00,Main Branch,1,12,visitors")
    write(raw, "b.csv", EXTRACTOR, "Main Branch,2025-01-02 10:00,-10,visitors,2", 'Other,"2025-01-02 10:00",n/a,visitors,')
    got = rows(raw_csv.read_raw_readings(spark, str(raw)))
    assert got == sorted(
        [
            ("2025-01-01 10:00", "Main Branch", 1, 10, "visitors"),
            ("2025-01-01 11:00", "Main Branch", 1, 12, "visitors"),
            ("2025-01-02 10:00", "Main Branch", 2, -10, "visitors"),
            ("2025-01-02 10:00", "Other", None, None, "visitors"),
        ],
        key=str,
    )


def test_glob_and_text_columns(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "a.csv", DECLARED, "2025-01-01 10:00,A,007,1.0,visitors")
    write(raw, "b.txt", "not,read")
    text = raw_csv.read_raw_text(spark, str(raw / "*.csv"))
    assert rows(text) == [("2025-01-01 10:00", "A", "007", "1.0", "visitors")]


def test_files_without_a_header_are_reported(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "good.csv", DECLARED, "2025-01-01 10:00,A,1,1,visitors")
    write(raw, "bad.csv", "2025-01-01 10:00,A,1,1,visitors", "2025-01-01 11:00,A,1,1,visitors")
    assert raw_csv.read_raw_text(spark, str(raw)).count() == 1
    missing = raw_csv.headerless_files(spark, str(raw)).collect()
    assert [(r.source_file.rsplit("/", 1)[1], r.line_count) for r in missing] == [("bad.csv", 2)]


def test_no_file_has_a_header(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "bad.csv", "a,b,c,d,e", "date_time,agency_name,counter_id,visitor_count")
    assert raw_csv.read_raw_text(spark, str(raw)).isEmpty()
    assert raw_csv.headerless_files(spark, str(raw)).first().line_count == 2


def test_other_columns_case_and_width_do_not_matter(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "a.csv", DECLARED, "2025-01-01 10:00,A,1,1,visitors", "2025-01-01 11:00,A,1,1,visitors")
    write(raw, "b.csv", "Agency_Name, site ,Date_Time,visitor_count,unit,counter_id,note", "B,x,2025-01-02 10:00,2,visitors,2,n")
    write(raw, "c.csv", "2025-01-03 10:00,C,3,3,visitors")
    mapped = raw_csv.map_by_header(raw_csv.read_lines(spark, str(raw)))
    assert rows(mapped.filter("has_header")) == [
        ("2025-01-01 10:00", "A", "1", "1", "visitors"),
        ("2025-01-01 11:00", "A", "1", "1", "visitors"),
        ("2025-01-02 10:00", "B", "2", "2", "visitors"),
    ]
    assert [r.value for r in mapped.filter("not has_header").collect()] == ["2025-01-03 10:00,C,3,3,visitors"]


def test_the_first_header_line_rules(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "a.csv", EXTRACTOR, "A,2025-01-01 10:00,1,visitors,2", DECLARED, "B,2025-01-01 11:00,1,visitors,2")
    assert {r[1] for r in rows(raw_csv.read_raw_text(spark, str(raw)))} == {"A", "B"}


def test_raw_csv_sink_creates_folders_and_refuses_to_overwrite(spark, tmp_path):
    path = str(tmp_path / "deep" / "raw")
    df = spark.createDataFrame([("A", "2025-01-01 10:00", 1, "visitors", None)], "agency_name string, date_time string, visitor_count int, unit string, counter_id int")
    raw_csv.write_raw_csv(df, path)
    assert rows(raw_csv.read_raw_text(spark, path)) == [("2025-01-01 10:00", "A", None, "1", "visitors")]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        raw_csv.write_raw_csv(df, path)


def record(**changes):
    base = {
        "agency_name": "Main Branch",
        "date_time": "2025-01-01 10:00",
        "visitor_count": 10,
        "unit": "visitors",
        "counter_id": 1,
    }
    return json.dumps({k: v for k, v in {**base, **changes}.items() if v != "absent"})


@pytest.mark.parametrize(
    ("text", "error"),
    [
        (record(), None),
        (record(counter_id=None), None),
        (record(counter_id="absent"), None),
        (record(extra={"a": 1}), None),
        (record(visitor_count=-10), None),
        (record(visitor_count="12"), None),
        (record(visitor_count=12.0), None),
        (record(visitor_count=12.5), "visitor_count"),
        (record(visitor_count="many"), "visitor_count"),
        (record(visitor_count=None), "visitor_count"),
        (record(visitor_count="absent"), "visitor_count"),
        (record(visitor_count=[1]), "visitor_count"),
        (record(agency_name=17), "agency_name"),
        (record(agency_name="absent"), "agency_name"),
        (record(date_time=None), "date_time"),
        (record(unit=True), "unit"),
        (record(unit={"a": 1}), "unit"),
        (record(agency_name="17"), None),
        (record(agency_name="true"), None),
        (record(agency_name='say "hi" [x]'), None),
        (record(counter_id="first"), "counter_id"),
        (record(counter_id={}), "counter_id"),
        ("{", "malformed"),
        ("", "malformed"),
        ("[1]", "malformed"),
        ("[" + record() + "]", "malformed"),
        (" " + record(), None),
    ],
)
def test_record_validation(spark, text, error):
    got = records.validate_records(spark.createDataFrame([(text,)], "json string")).first()
    assert got.error == error
    kept = records.read_records(spark.createDataFrame([(text,)], "json string"))
    assert kept.count() == (error is None)


def test_record_values(spark):
    df = spark.createDataFrame([(record(visitor_count="12", counter_id="absent"),)], "json string")
    assert tuple(records.read_records(df).first()) == ("Main Branch", "2025-01-01 10:00", 12, "visitors", None)


def test_daily_table_is_read_whole_and_in_schema(spark, tmp_path):
    path = str(tmp_path / "flat")
    df = spark.createDataFrame([(None, "a", i, "visitors", 1, 2, 1.0, None, None) for i in range(20)], DAILY_METRICS)
    df.repartition(5).write.parquet(path)
    got = daily_table.read_daily(spark, path)
    assert got.schema == DAILY_METRICS
    assert got.count() == 20
    assert [r.counter_id for r in daily_table.peek(got, 2, "counter_id").collect()] == [0, 1]


def test_agency_table_is_built_on_demand_only(spark, tmp_path):
    path = str(tmp_path / "agencies")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        agencies.read_agencies(spark, path)
    agencies.build_agencies(spark, path)
    built = agencies.read_agencies(spark, path)
    assert built.count() == 11
    lyon = built.filter("agency_name = 'Lyon_1'").first()
    assert (lyon.base_traffic, lyon.counter_number) == (500, 3)
    assert agencies.read_agencies(spark, path).count() == 11
