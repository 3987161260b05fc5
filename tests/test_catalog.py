import datetime as dt
import math
import os
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from countlake.plans.catalog import QUERIES

DATA = os.environ.get("COUNTLAKE_TEST_DATA", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no test tables")

REJECTS_AT_001 = {
    "bad_date": 104,
    "null_agency": 111,
    "bad_count": 4221,
    "bad_sensor": 1184,
    "bad_unit": 133,
    "kept": 4247,
}


@pytest.fixture(scope="module")
def check():
    con = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(data, key=lambda r: [(v is not None, str(v)) for v in r])


def test_every_query_has_a_check():
    assert set(QUERIES) <= set(driver.oracle_sql())
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_check(spark, check, name):
    frame = driver.queries()[name](spark, DATA)
    got = table(frame.columns, frame.collect())
    cursor = check.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    expected = table(columns, cursor.fetchall())
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1]) > 0
    assert got[1] == expected[1]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_known_reject_counts(spark):
    if not DATA.endswith("sf0.01"):
        pytest.skip("counts are those of sf0.01")
    rows = driver.queries()["rejects"](spark, DATA).collect()
    assert {r.reason: r.row_count for r in rows} == REJECTS_AT_001


def test_entry(spark):
    assert driver.entry(spark).count() > 0
