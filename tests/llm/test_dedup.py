import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from countlake.llm import exact_dedup, near_dedup, substring_dedup
from countlake.llm.components import components, components_of_both
from countlake.llm.words import Runs, words_of

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


# --- words -----------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x1cB中", max_size=30)), max_size=8))
def test_words_are_those_between_separators(texts):
    found = words_of(pa.array(["skipped", *texts], pa.string()).slice(1))
    for i, text in enumerate(texts):
        at = range(found.first[i], found.first[i + 1])
        assert [bytes(found.data[found.starts[k] : found.ends[k]]).decode() for k in at] == words(text)


def test_equal_runs_have_equal_hashes():
    values = np.array([5, 7, 9, 5, 7, 9, 5, 8], dtype="uint64")
    runs = Runs(values)
    h = runs.hash(np.arange(6), np.arange(6) + 3)
    assert h[0] == h[3] and len(set(h.tolist())) == 4
    assert runs.hash(np.array([0]), np.array([2])) != runs.hash(np.array([0]), np.array([3]))


# --- substring duplicates --------------------------------------------------


def brute_substrings(rows, window=35):
    seen, out = Counter(), []
    split = [words(t) for t in rows]
    for w in split:
        seen.update(tuple(w[s : s + window]) for s in range(len(w) - window + 1))
    for w in split:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s : s + window])] > 1:
                gone[s : s + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def test_repeated_windows_go_wherever_they_are(documents, prose, odd_texts):
    passage, long_passage = prose(2, 60), prose(3, 300)
    texts = [
        f"{prose(10, 50)} {passage} {prose(11, 20)}",
        f"{prose(12, 5)} {passage}",
        passage,
        " ".join(passage.split()[5:40]),  # exactly a window
        " ".join(passage.split()[5:39]),  # one word short
        f"{long_passage} {prose(13, 40)} {long_passage}",  # within one document
        f"{' '.join(long_passage.split()[:150])} {passage}",
        " ".join(["a", "b"] * 40),
        *odd_texts,
        *[f"{prose(20 + i, 3)} {prose(4, 36)} {prose(30 + i, 3)}" for i in range(6)],
    ]
    got = substring_dedup.remove_repeats(documents(texts)).orderBy("doc_id").collect()
    expected = brute_substrings(texts)
    assert [(r.n_words, r.n_removed, r.kept) for r in got] == expected
    for row, text in zip(got, texts):
        covered = sum(s.end - s.start for s in row.spans)
        assert covered == row.n_removed


def thue_morse(letters, size=1024):
    return "".join(letters[bin(i).count("1") & 1] for i in range(size))


def test_words_that_polynomials_confuse_are_told_apart(documents, prose):
    a, b = thue_morse("ab"), thue_morse("ba")
    hashes = words_of(pa.array([f"{a} {b} {a}"])).hashes()
    assert hashes[0] == hashes[2] != hashes[1]
    before, after = prose(70, 20), prose(71, 19)
    texts = [f"{before} {a} {after}", f"{before} {b} {after}"]
    got = substring_dedup.remove_repeats(documents(texts)).collect()
    assert [r.n_removed for r in got] == [0, 0]
    shingles = [near_dedup.shingle_sets(words_of(pa.array([t])))[0] for t in texts]
    assert len(np.intersect1d(*shingles)) == 31


def test_hashes_do_not_depend_on_what_is_around(prose):
    texts = [prose(i, 300) + " " + "y" * i * 7 for i in range(12)] + ["x" * 3_000_000, "X" * 2_999_999 + "x"]
    together = words_of(pa.array(texts))
    for lower in (False, True):
        alone = [words_of(pa.array([t])).hashes(lower) for t in texts]
        assert (together.hashes(lower) == np.concatenate(alone)).all()
    assert together.hashes(True)[-1] == together.hashes(True)[-2]
    assert together.hashes()[-1] != together.hashes()[-2]


def test_texts_that_pack_a_thousandfold(documents):
    texts = ["aaaa " * 20_000] * 30
    got = substring_dedup.remove_repeats(documents(texts)).collect()
    assert {(r.n_words, r.n_removed, r.kept) for r in got} == {(20_000, 20_000, "")}


def test_rows_repeated_whole_are_copies(documents, prose):
    frame = documents([prose(5, 50), "short", prose(6, 50)], ids=[1, None, None])
    got = substring_dedup.remove_repeats(frame.union(frame.limit(3))).collect()
    assert sorted((r.n_words, r.n_removed) for r in got) == [(1, 0), (1, 0)] + [(50, 50)] * 4


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_of_few_words(documents, prose, seed):
    texts = [prose(100 * seed + i, 40 + 37 * i, vocabulary=1 + seed) for i in range(8)]
    texts += [f"{texts[3]} {prose(900 + seed, 30)} {texts[1]}"]
    got = substring_dedup.remove_repeats(documents(texts)).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept) for r in got] == brute_substrings(texts)


def test_no_documents_no_rows(documents):
    none = documents(["x"]).limit(0)
    assert substring_dedup.remove_repeats(none).count() == 0
    assert exact_dedup.duplicate_groups(none).count() == 0
    assert exact_dedup.drop_duplicates(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert near_dedup.keep_first(none).count() == 0


# --- exact duplicates ------------------------------------------------------


def plain(text):
    return SPACE.sub("", text or "")


def test_exact_groups_equal_brute_force(documents, odd_texts, prose):
    long = prose(7, 400)
    texts = [*odd_texts, long, long[:-1] + "z", long.replace(" ", "\n\n"), long, "sametexthere"]
    got = exact_dedup.duplicate_groups(documents(texts)).collect()
    groups = {}
    for i, text in enumerate(texts):
        groups.setdefault(plain(text), []).append((-len(text or ""), i))
    for row in got:
        group = groups[plain(texts[row.doc_id])]
        keep = min(group)[1]
        assert (row.keep_id, row.group_size, row.kept) == (keep, len(group), row.doc_id == keep)
        assert row.text_sha256 == hashlib.sha256(plain(texts[row.doc_id]).encode()).hexdigest()
    assert len(got) == len(texts)


def test_one_copy_of_a_repeated_row_stays(documents):
    frame = documents(["a b", "a b", "c", None], ids=[3, None, None, None], copies=3)
    got = exact_dedup.duplicate_groups(frame)
    kept = got.where("kept").orderBy("keep_id").collect()
    assert [(r.keep_id, r.group_size) for r in kept] == [(None, 3), (None, 3), (3, 6)]
    assert got.count() == 12
    rows = exact_dedup.drop_duplicates(frame)
    assert rows.columns == frame.columns
    assert sorted(str(r.text) for r in rows.collect()) == ["None", "a b", "c"]


def test_rows_that_stay_are_whole(documents, odd_texts):
    frame = documents(odd_texts)
    kept = {r.doc_id for r in exact_dedup.duplicate_groups(frame).where("kept").collect()}
    rows = exact_dedup.drop_duplicates(frame)
    assert {r.doc_id for r in rows.collect()} == kept
    assert rows.exceptAll(frame).count() == 0


# --- near duplicates -------------------------------------------------------


def shingles(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute_components(texts, ids):
    sets = [shingles(t) for t in texts]
    head = list(range(len(texts)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        both, union = len(sets[i] & sets[j]), len(sets[i] | sets[j])
        if union and 100 * both >= 75 * union:
            a, b = find(i), find(j)
            head[a] = b
    smallest = {}
    for i in range(len(texts)):
        smallest[find(i)] = min(smallest.get(find(i), ids[i]), ids[i])
    return {ids[i]: (len(sets[i]), smallest[find(i)]) for i in range(len(texts))}


def edited(text, places, mark):
    w = text.split()
    for p in places:
        w[p % len(w)] = f"{mark}{p}"
    return " ".join(w)


@pytest.mark.parametrize("block", [256, 5])
def test_near_groups_equal_brute_force(documents, prose, odd_texts, monkeypatch, block):
    # 5: families are large, so hubs and members outside are compared in blocks.
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block)
    monkeypatch.setattr(near_dedup, "HUBS", 2)
    base, other = prose(40, 120), prose(41, 90)
    texts = [*odd_texts, base, base.upper().replace("W", "W"), other]
    texts += [edited(base, [7 * i, 7 * i + 31, 7 * i + 64][: 1 + i % 3], "e") for i in range(24)]
    texts += [edited(base, range(0, 120, 6 + i), "f") for i in range(20)]
    texts += [f"{prose(60 + i, 60)} {other}" for i in range(5)]
    ids = [500 - 3 * i for i in range(len(texts))]
    got = near_dedup.near_duplicates(documents(texts, ids=ids)).collect()
    expected = brute_components(texts, ids)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    kept = near_dedup.keep_first(documents(texts, ids=ids))
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.kept}


def test_links_in_dense_regions_are_found(documents, prose, monkeypatch):
    # Texts share half of their shingles, so regions have more rows than the
    # scan of the order looks at; linked ones lie apart in it.
    monkeypatch.setattr(near_dedup, "NEIGHBOURS", 1)
    monkeypatch.setattr(near_dedup, "REGION_ROWS", 40)
    shared = prose(70, 100)
    texts = [f"{prose(200 + i, 100, 4000)} {shared}" for i in range(150)]
    texts += [edited(t, [20, 50, 80, 120, 160], "e") for t in texts[:60]]
    ids = list(range(len(texts)))
    got = near_dedup.near_duplicates(documents(texts, ids=ids)).collect()
    expected = brute_components(texts, ids)
    assert sum(i != c for i, (_, c) in expected.items()) == 60
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected


def test_every_two_rows_of_a_region_meet(spark, monkeypatch):
    # One region in every tree; rows that agree lie 50 rows apart in all orders.
    monkeypatch.setattr(near_dedup, "NEIGHBOURS", 4)
    monkeypatch.setattr(near_dedup, "REGION_ROWS", 16)
    rng = np.random.default_rng(5)
    rows = []
    for node in range(100):
        group = node % 50
        values = np.random.default_rng(100 + group).integers(0, 1 << 16, (near_dedup.TREES, near_dedup.DEPTH))
        values[:, : near_dedup.LEAST_DEPTH] = 9
        values[:, near_dedup.LEAST_DEPTH] = rng.permutation(near_dedup.TREES) + 100 * node
        rows.append((node, values.astype(">u2").tobytes()))
    nodes = spark.createDataFrame(rows, "node long, signature binary")
    found = near_dedup.candidate_families(nodes).collect()
    together = {r.node: r.family for r in found}
    assert all(together.get(i) == together.get(i + 50, -1) for i in range(50))


def test_many_null_keys_cost_what_others_do(documents, prose):
    texts = [prose(i // 2, 30) + f" end{i % 2}" for i in range(600)]
    frame = documents(texts, ids=[None] * 600)
    got = near_dedup.near_duplicates(frame).collect()
    assert len(got) == 600 and all(r.component_id is None for r in got)
    kept = near_dedup.keep_first(frame).count()
    assert kept == 300


def test_components_of_both_equal_those_of_all(spark):
    rng = np.random.default_rng(3)
    schema = "a long, b long"
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))]
    first, rest = (spark.createDataFrame(p, schema) for p in (pairs[:100], pairs[100:]))
    expected = sorted(map(tuple, components(spark.createDataFrame(pairs, schema)).collect()))
    assert sorted(map(tuple, components_of_both(first, rest).collect())) == expected
    none = spark.createDataFrame([], schema)
    assert sorted(map(tuple, components_of_both(none, spark.createDataFrame(pairs, schema)).collect())) == expected
    assert components_of_both(none, none).collect() == []


def test_null_and_repeated_keys(documents, prose):
    text = prose(42, 60)
    frame = documents([text, text, text, "alone here", None], ids=[None, 7, 7, None, None])
    got = sorted(
        ((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(frame).collect()),
        key=str,
    )
    assert got == sorted(
        [(None, 56, 7, False), (7, 56, 7, True), (7, 56, 7, True), (None, 1, None, True), (None, 0, None, True)],
        key=str,
    )


def test_one_row_of_a_group_stays_whatever_the_keys(documents, prose):
    text, other, third = prose(42, 60), prose(43, 60), prose(44, 60)
    near, near_third = edited(text, [30], "e"), edited(third, [30], "e")
    rows = [
        (None, text), (7, text), (7, text), (7, near), (None, "alone here"), (None, None), (None, ""),
        (9, near), (9, other), (12, other), (5, third), (5, near_third), (None, "alone here"), (20, "far off"),
    ]
    frame = documents([t for _, t in rows], ids=[i for i, _ in rows])
    kept = near_dedup.keep_first(frame)
    assert kept.columns == frame.columns
    assert kept.exceptAll(frame).count() == 0
    got = [(r.doc_id, r.text) for r in kept.collect()]
    left = sorted(got, key=str)
    assert [i for i, t in left if t in (text, near)] == [7]
    assert [i for i, t in left if t in (third, near_third)] == [5]
    rest = [(i, t) for i, t in left if t not in (text, near, third, near_third)]
    assert rest == sorted([(9, other), (20, "far off"), (None, "alone here"), (None, None), (None, "")], key=str)


def test_components_of_long_paths_and_stars(spark, monkeypatch):
    monkeypatch.setattr("countlake.llm.components.TOGETHER", 20)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, 1000 + i) for i in range(50)] + [(3, 3)]
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    found = {r.node: r.component for r in got}
    assert len(got) == len(found) == 61 + 51
    assert {found[i] for i in range(100, 161)} == {100}
    assert {found[i] for i in (7, 1000, 1049)} == {7}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
