import random
from itertools import combinations

from pyspark.sql import functions as F

from countlake.operators import matching
from countlake.plans.catalog import closest_match_large


def names_df(spark, names):
    return spark.createDataFrame([(n,) for n in names], "agency_name string")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def best(name, entries, limit=None):
    if not entries:
        return None
    d, entry = min((distance(name, e), e) for e in entries)
    return entry if limit is None or d <= limit else None


def matched(df):
    return {r.agency_name: r.closest_match for r in df.collect()}


def random_names(rng, count, alphabet="abc_1", longest=9):
    return sorted({"".join(rng.choices(alphabet, k=rng.randint(1, longest))) for _ in range(count)})


def test_smallest_distance_ties_by_name(spark):
    known = names_df(spark, ["nation_2", "nation_1", "Other Place"])
    got = matched(matching.closest_match(names_df(spark, ["nation_", "other_plaice", "zzz"]), known))
    assert got == {"nation_": "nation_1", "other_plaice": "other_place", "zzz": "nation_1"}


def test_empty_dictionary_gives_null(spark):
    got = matched(matching.closest_match(names_df(spark, ["x"]), names_df(spark, []).limit(0)))
    assert got == {"x": None}


def test_max_distance(spark):
    known = names_df(spark, ["lyon_1"])
    got = matched(matching.closest_match(names_df(spark, ["lyn_1", "paris_9"]), known, max_distance=1))
    assert got == {"lyn_1": "lyon_1", "paris_9": None}


def test_large_dictionary_path_equals_brute_force(spark):
    rng = random.Random(7)
    entries = random_names(rng, 60)
    names = [n for n in random_names(rng, 80) if n not in entries]
    names += ["q" * 40, "abc_1" * 20, "a" * 70]
    known = names_df(spark, entries)
    got = matched(matching.closest_match(names_df(spark, names), known, array_entries=10))
    assert got == {n: best(n, entries) for n in names}


def test_large_dictionary_path_with_max_distance(spark):
    rng = random.Random(8)
    entries = random_names(rng, 40) + ["b" * 69]
    names = [n for n in random_names(rng, 40) if n not in entries] + ["b" * 70, "zzzzzzz"]
    for limit in (1, 2, 3):
        found = matching.closest_match(
            names_df(spark, names), names_df(spark, entries), limit, array_entries=5
        )
        assert matched(found) == {n: best(n, entries, limit) for n in names}


def test_large_query_covers_every_customer(spark, tmp_path):
    keys = range(1, 121)
    customers = [(k, f"Customer#{k:09d}") for k in keys]
    spark.createDataFrame(customers, "c_custkey long, c_name string").write.parquet(
        str(tmp_path / "customer.parquet")
    )
    entries = [name.lower() for _, name in customers]
    changes = [
        lambda k, n: n.replace("#", ""),
        lambda k, n: n[1:],
        lambda k, n: n.replace("customer#0", "kustomar 1"),
        lambda k, n: f"the_{n}_{k}",
    ]
    names = {changes[k % 4](k, n) for k, n in zip(keys, entries)}
    got = matched(closest_match_large(spark, str(tmp_path)))
    assert got == {n: best(n, entries) for n in names}


def test_corrected_names_come_last_and_known_ones_stay(spark):
    readings = spark.createDataFrame(
        [("main_branch", 1), ("mian_branch", 2), ("lyon_1", 3)], "agency_name string, n int"
    )
    # The dictionary is spelled with a space and capitals.
    known = names_df(spark, ["Main Branch", "Lyon_1"])
    fixed = matching.correct_names(readings, known)
    assert fixed.columns == ["n", "agency_name"]
    assert {r.n: r.agency_name for r in fixed.collect()} == {1: "main_branch", 2: "main_branch", 3: "lyon_1"}


def test_small_corrections_are_broadcast(spark):
    readings = names_df(spark, ["lyn_1", "lyon_1"])
    fixed = matching.correct_names(readings, names_df(spark, ["lyon_1"]))
    plan = fixed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_far_names_meet_few_prefixes(spark, monkeypatch):
    entries = [f"customer#{k:09d}" for k in range(20_000)]
    rng = random.Random(3)
    names = sorted({f"the_{e}_{k}" for k, e in enumerate(rng.sample(entries, 200))}) + ["kustomar 100000123"]
    real, met = matching._below, []

    def below(held, level):
        met.append(real(held, level))
        return met[-1]

    monkeypatch.setattr(matching, "_below", below)
    got = matched(matching.closest_match(names_df(spark, names), names_df(spark, entries), array_entries=100))
    # No entry can be nearer than the difference in length; that of the name's origin is as near.
    assert all(distance(n, got[n]) == len(n) - 18 and got[n] <= n[4:22] for n in names if n[0] == "t")
    assert got["kustomar 100000123"] == "customer#000000123"
    pairs = len(names) * len(entries)
    compared = [frame.count() for frame in met]
    assert compared[-1] < pairs / 100  # with whole entries
    assert sum(compared) + 2 * matching.FANOUT * len(names) < pairs / 50  # with prefixes as well


def test_names_of_any_shape_get_the_nearest_entry(spark):
    rng = random.Random(11)
    entries = [*random_names(rng, 150, "ab", 14), "", "é" * 30, "x" * 80, "ab" * 40]
    names = [n for n in random_names(rng, 60, "abc", 20) if n not in entries]
    names += ["ééé", "x" * 64, "xab" * 20, "中文中文中文", "ba" * 31, "_________"]
    got = matched(matching.closest_match(names_df(spark, names), names_df(spark, entries), array_entries=5))
    assert got == {n: best(n, entries) for n in names}


def test_least_distances_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [("", "", 0, 0), ("é" * 9, "中é", 1, 4), ("a" * 64, "ab", 0, 70), ("a\0", "a", 0, 0)]
    for _ in range(60):
        low = rng.randint(0, 4)
        name, prefix = ("".join(rng.choices("ab_é", k=rng.randint(0, 9))) for _ in range(2))
        rows.append((name, prefix, low, low + rng.randint(0, 3)))
    held = spark.createDataFrame(rows, "agency_name string, prefix string, low int, high int").coalesce(1)
    for r in matching._bounded(held).collect():
        own = [distance(r.agency_name[:k], r.prefix) for k in range(len(r.agency_name) + 1)]
        rest = [len(r.agency_name) - k for k in range(len(own))]
        bound = min(o + max(r.low - n, n - r.high, 0) for o, n in zip(own, rest))
        assert tuple(r.least) == (bound, min(own)), r


def test_removal_keys_are_one_for_each_text(spark):
    texts = ["", "a", "aab0", "0000", "éa中", "abcdefgh", "ab" * 33]
    known = names_df(spark, texts).coalesce(1)
    for removed in (1, 2):
        keys = known.select("agency_name", matching._removal_keys(F.col("agency_name"), removed).alias("keys"))
        for r in keys.collect():
            left = {r.agency_name}
            for n in range(1, min(removed, len(r.agency_name)) + 1):
                left |= {"".join(c) for c in combinations(r.agency_name, len(r.agency_name) - n)}
            assert len(r["keys"]) == len(set(r["keys"])) == len(left)
            own = names_df(spark, left).select(matching._removal_keys(F.col("agency_name"), 1).alias("keys"))
            assert all(set(o["keys"]) & set(r["keys"]) for o in own.collect())


def test_far_names_are_spread_and_ties_are_followed_to_earlier_names_only(spark, monkeypatch):
    monkeypatch.setattr(matching, "TASK_NAMES", 2)
    entries = [f"customer#{k:09d}" for k in range(3000)]
    names = [f"the_{e}_{k}" for k, e in enumerate(entries) if k % 300 == 7]
    real, held = matching.write_through, []

    def write_through(df, label):
        written = real(df, label)
        if label == "held":
            held.append((df.rdd.getNumPartitions(), written.count()))
        return written

    monkeypatch.setattr(matching, "write_through", write_through)
    got = matched(matching.closest_match(names_df(spark, names), names_df(spark, entries), array_entries=100))
    assert got == {n: best(n, entries) for n in names}
    assert min(tasks for tasks, _ in held) > 1
    assert held[-1][1] < 12 * len(names)
