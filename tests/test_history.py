import datetime as dt
import random

from countlake.operators import history

VERSIONS = "name string, valid_from date, size string, traffic int"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows):
    return spark.createDataFrame(rows, VERSIONS)


def test_versions_follow_each_other(spark):
    old = frame(spark, [("a", day(0), "small", 1), ("b", day(0), "big", 9), (None, day(1), "x", 1)])
    updates = frame(
        spark,
        [
            ("a", day(20), "big", 5),
            ("a", day(10), "medium", 3),
            ("a", day(15), "medium", 3),  # changes nothing
            ("b", day(0), "big", 10),  # takes the first one's place
            ("c", day(5), None, None),
            ("c", None, "x", 1),
        ],
    )
    got = history.with_versions(old, updates, "name")
    rows = sorted(map(tuple, got.collect()))
    assert rows == [
        ("a", day(0), "small", 1, day(10)),
        ("a", day(10), "medium", 3, day(20)),
        ("a", day(20), "big", 5, None),
        ("b", day(0), "big", 10, None),
        ("c", day(5), None, None, None),
    ]
    again = history.with_versions(got, updates, "name")
    assert sorted(map(tuple, again.collect())) == rows


def test_joins_as_of_equal_a_search(spark):
    rng = random.Random(2)
    versions = [(n, day(d), rng.choice("xyz"), d) for n in "abc" for d in sorted(rng.sample(range(60), 6))]
    rows = [(i, rng.choice(["a", "b", "c", "d", None]), day(rng.randrange(-5, 70))) for i in range(300)]
    rows.append((300, "a", None))
    readings = spark.createDataFrame(rows, "id int, name string, date date")
    got = history.join_as_of(readings, frame(spark, versions), "name", "date")
    assert got.columns == ["id", "name", "date", "size", "traffic"]

    def search(name, when):
        past = [v for v in versions if v[0] == name and when is not None and v[1] <= when]
        return max(past, key=lambda v: v[1])[2:] if past else (None, None)

    assert {r.id: (r.size, r.traffic) for r in got.collect()} == {i: search(n, d) for i, n, d in rows}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_history_gives_nulls(spark):
    readings = spark.createDataFrame([(1, "a", day(1))], "id int, name string, date date")
    none = history.with_versions(frame(spark, []), frame(spark, []), "name")
    assert [tuple(r) for r in history.join_as_of(readings, none, "name", "date").collect()] == [
        (1, "a", day(1), None, None)
    ]
