import math

import numpy as np
import pytest

from countlake.llm.vector_search import (
    Settings,
    balanced_centroids,
    link,
    nearest_centroids,
    search,
)

VECTORS = "vec_id long, embedding array<float>, label int, id long, list int, vector string"


@pytest.fixture(scope="module")
def vectors(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, 0, 1, 2, "x") for i, v in rows], VECTORS).repartition(3)

    return build


def brute(rows, k=10, every=100):
    rows = {(i, tuple(v)) for i, v in rows}
    out = {}
    for q, v in rows:
        if q % every:
            continue
        a = np.float32(v).astype("f8")
        near = sorted(
            (math.sqrt(((np.float32(w).astype("f8") - a) ** 2).sum()), i) for i, w in rows if i != q
        )
        out[q] = near[:k]
    return out


def compare(got, expected):
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert found.keys() == {q for q, near in expected.items() if near}
    hits = total = 0
    for q, near in expected.items():
        assert len(found.get(q, [])) == len(near)
        hits += len({i for _, i in near} & {i for _, i in found.get(q, [])})
        total += len(near)
        assert found.get(q, []) == sorted(found.get(q, []))
    return hits / max(total, 1)


def cloud(n, seed, size=16):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(12, size))
    points = centres[random.integers(0, 12, n)] + 0.7 * random.normal(size=(n, size))
    return [(i, [float(x) for x in np.float32(p)]) for i, p in enumerate(points)]


def test_recall_and_scores(vectors):
    rows = cloud(4000, 1)
    got = search(vectors(rows), settings=Settings(list_size=40, probes=24)).collect()
    expected = brute(rows)
    assert compare(got, expected) >= 0.9
    exact = dict(rows)
    for r in got:
        a, b = (np.array(exact[i], dtype="f8") for i in (r.query_id, r.vec_id))
        assert abs(r.score - math.sqrt(((a - b) ** 2).sum())) < 1e-12


def test_one_vector_in_a_third_of_all_rows(vectors):
    rows = cloud(300, 2) + [(1000 + i, [1.0] * 16) for i in range(150)]
    got = search(vectors(rows), settings=Settings(list_size=20, block=16)).collect()
    assert compare(got, brute(rows)) == 1.0
    hot = [r.vec_id for r in got if r.query_id == 1100]
    assert hot == list(range(1000, 1010))


def test_ties_few_rows_and_bad_vectors(vectors):
    bad = [
        (100, None), (1, []), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
        (5, [None, 1.0]), (6, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]),
    ]
    good = [(0, [1.0, 1.0]), (7, [1.0, 2.0]), (8, [2.0, 1.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0])]
    got = search(vectors(bad + good)).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 7, 1.0), (0, 2, 8, 1.0), (0, 3, 9, 1.0)]
    assert search(vectors(bad)).count() == 0
    assert search(vectors(good[:1])).count() == 0
    assert search(vectors(good).limit(0)).count() == 0


def test_lists_are_balanced_and_the_graph_finds_the_nearest():
    points = np.array([v for _, v in cloud(3000, 3)])
    centres = balanced_centroids(points, 30, 1)
    nearest = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
    sizes = np.bincount(nearest, minlength=len(centres))
    assert sizes.max() < 6 * sizes.mean()
    index = link(centres, 12, 16, 1)
    ids, far = nearest_centroids(index, points[:500], 8)
    true = np.argsort(((points[:500, None] - centres[None]) ** 2).sum(2), axis=1)[:, :8]
    found = np.mean([len(set(a) & set(b)) / 8 for a, b in zip(ids.tolist(), true.tolist())])
    assert found > 0.95
    assert (np.diff(far, axis=1) >= 0).all()
