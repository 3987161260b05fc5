import random

import numpy as np
import pyarrow as pa
import pytest

from countlake.operators import matching, nearest
from countlake.operators.nearest import TextTree

ANY = 1 << 20


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def best(name, entries, limit=ANY):
    d, entry = min((distance(name, e), e) for e in entries)
    return entry if d <= limit else None


def names_df(spark, names):
    return spark.createDataFrame([(n,) for n in names], "agency_name string")


def matched(df):
    return {r.agency_name: r.closest_match for r in df.collect()}


def binary(texts):
    return pa.array([t.encode() for t in texts], pa.binary())


def texts_of(rng, alphabet, count, longest):
    return sorted({"".join(rng.choices(alphabet, k=rng.randint(0, longest))) for _ in range(count)})


@pytest.mark.parametrize("alphabet", ["ab", "abc_1", "aé中b"])
@pytest.mark.parametrize("together", [(1 << 11, 1 << 20), (5, 40)])
def test_tree_equals_brute_force(monkeypatch, alphabet, together):
    monkeypatch.setattr(nearest, "NAMES_TOGETHER", together[0])
    monkeypatch.setattr(nearest, "WAITING_TOGETHER", together[1])
    monkeypatch.setattr(nearest, "STATES_TOGETHER", 16)
    rng = random.Random(21)
    for longest in (4, 9, 20):
        texts = texts_of(rng, alphabet, 60, longest)
        names = texts_of(rng, alphabet + "z", 40, longest + 3) + ["a" * 64]
        tree = TextTree(binary(texts))
        far = [[distance(n, t) for t in texts] for n in names]
        # The first of the nearest, with and without a cutoff.
        for most in (np.full(len(names), ANY), np.array([rng.randint(-1, 4) for _ in names])):
            name, text, edits = tree.search(binary(names), most)
            got = {n: (d, t) for n, t, d in zip(name, text, edits)}
            least = [min((d, t) for t, d in enumerate(row)) for row in far]
            assert got == {n: l for n, l in enumerate(least) if l[0] <= most[n]}
        # All within a cutoff, of those just so far only the first.
        most, ranks = np.array([[rng.randint(0, 6), rng.randint(0, len(texts))] for _ in names]).T
        found = sorted(zip(*tree.search(binary(names), most, True, ranks)))
        assert found == [
            (n, t, d) for n, row in enumerate(far) for t, d in enumerate(row)
            if d < most[n] or d == most[n] and t < ranks[n]
        ]


def test_cover_holds_all_texts_below_what_they_share():
    texts = texts_of(random.Random(4), "ab", 80, 12)
    for count in (1, 2, 7, 500):
        nodes = TextTree(binary(texts)).cover(count)
        assert [n[1] for n in nodes] == [0, *[n[2] for n in nodes[:-1]]] and nodes[-1][2] == len(texts)
        for depth, low, high in nodes:
            assert len({t[:depth] for t in texts[low:high]}) == 1
            assert all(len(t) >= depth for t in texts[low:high])


def test_a_name_meets_few_nodes_of_a_large_tree(monkeypatch):
    texts = [f"customer#{k:09d}" for k in range(100_000)]
    keys = random.Random(6).sample(range(len(texts)), 400)
    names = [f(k) for k in keys for f in (
        "customer{:09d}".format, "ustomer#{:09d}".format, "kustomar 1{:08d}".format, lambda k: f"the_customer#{k:09d}_{k}"
    )]
    real, met = nearest._Search.bounds, []

    def bounds(self, name, *node):
        met.append(len(name))
        return real(self, name, *node)

    monkeypatch.setattr(nearest._Search, "bounds", bounds)
    name, text, edits = TextTree(binary(texts)).search(binary(names), np.full(len(names), ANY))
    assert sorted(name) == list(range(len(names)))
    assert all(edits[name == i][0] == (1, 1, 4, len(n) - 18)[i % 4] for i, n in enumerate(names))
    assert sum(met) < 200 * len(names)


def test_entries_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(matching, "BLOCK_ENTRIES", 25)
    monkeypatch.setattr(matching, "FANOUT", 4)
    monkeypatch.setattr(matching, "TASK_NAMES", 10)
    monkeypatch.setattr(matching, "PAIRS_TOGETHER", 50)
    rng = random.Random(12)
    entries = sorted({*texts_of(rng, "ab_", 90, 9), *texts_of(rng, "xyé", 60, 12), "中" * 20})
    names = [n for n in [*texts_of(rng, "abc_", 40, 12), *texts_of(rng, "xyzé", 30, 9), "zz" * 32] if n not in entries]
    for limit in (None, 1, 3):
        found = matching.closest_match(names_df(spark, names), names_df(spark, entries), limit, array_entries=5)
        assert matched(found) == {n: best(n, entries, ANY if limit is None else limit) for n in names}


def test_only_names_too_long_for_the_tree_are_given_keys(spark, monkeypatch):
    real, keyed = matching._match_by_keys, []

    def match_by_keys(names, entries, edits):
        keyed.extend((r.agency_name, edits) for r in names.collect())
        return real(names, entries, edits)

    monkeypatch.setattr(matching, "_match_by_keys", match_by_keys)
    entries = [f"customer#{k:09d}" for k in range(40)] + ["b" * 64, "c" * 90, "d" * 150, "e" * 151]
    names = ["customer000000012", "kustomar 100000007", "b" * 65, "c" * 89 + "x", "d" * 149 + "x", "d" * 80]
    found = matching.closest_match(names_df(spark, names), names_df(spark, entries), array_entries=10)
    assert matched(found) == {n: best(n, entries) for n in names}
    assert sorted(keyed) == sorted((n, 1) for n in names if len(n) > 64)


def test_matched_names_are_read_back_without_python(spark):
    entries = [f"customer#{k:09d}" for k in range(40)]
    found = matching.closest_match(names_df(spark, ["customer00000012"]), names_df(spark, entries), array_entries=10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" not in plan


def test_names_with_broken_characters_are_matched(spark):
    raw = ["unhex('FF')", "concat(repeat('é', 30), unhex('C3'))", "concat(repeat('ab', 20), unhex('E4B8E4B8E4B8E4B8E4B8E4B8E4B8E4B8E4B8E4B8E4B8E4B8E4B8'))"]
    names = spark.sql(" union all ".join(f"select cast({r} as string) as agency_name" for r in raw))
    entries = ["é" * 31, *["ab" * k for k in range(1, 25)], *[f"customer#{k}" for k in range(20)]]
    rows = matching.closest_match(names, names_df(spark, entries), array_entries=10).select("closest_match").collect()
    assert len(rows) == 3 and all(r.closest_match in entries for r in rows)
