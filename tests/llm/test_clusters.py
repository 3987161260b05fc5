import hashlib

import numpy as np
import pytest

from countlake.llm import vector_clusters


def brute(rows, dimensions, centroids, rounds, scale=256, seed=2):
    kept = [
        (i, [int(np.floor(scale * x)) for x in v])
        for i, v in rows
        if v is not None
        and len(v) == dimensions
        and all(x is not None and np.isfinite(x) and abs(scale * x) < 1 << 27 for x in v)
    ]
    if not kept:
        return []
    name = lambda i: "" if i is None else i
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{name(r[0])}".encode()).hexdigest(), r[1]))
    at = [v for _, v in order[:centroids]]

    def assign():
        out = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in at]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(at)):
            own = [v for (_, v), (j, _) in zip(kept, found) if j == c]
            if own:
                at[c] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    total = sum(d for _, d in found)
    inertia = {c: sum(d for j, d in found if j == c) for c in range(len(at))}
    return sorted(
        ((i, c, d, inertia[c], total, at[c]) for (i, _), (c, d) in zip(kept, found)), key=str
    )


def clustered(frame, **options):
    columns = "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    found = vector_clusters.cluster(frame, **options)
    return sorted((tuple(r[c] for c in columns) for r in found.collect()), key=str)


@pytest.fixture()
def table(spark):
    def build(rows):
        rows = [(i, v, 1, "k") for i, v in rows]
        schema = "vec_id long, embedding array<double>, vector int, key string"
        return spark.createDataFrame(rows, schema).repartition(3)

    return build


@pytest.mark.parametrize("bits,sampled", [(1, 10), (3, 10**6), (6, 50), (8, 10**6)])
def test_clusters_equal_brute_force(table, bits, sampled):
    random = np.random.default_rng(bits)
    centres = random.normal(size=(5, 8))
    rows = [(i, (centres[i % 5] + random.normal(size=8) * 0.3).tolist()) for i in range(300)]
    options = {"dimensions": 8, "centroids": 7, "rounds": 4}
    assert clustered(table(rows), bits=bits, sampled=sampled, **options) == brute(rows, 8, 7, 4)


def test_odd_vectors_take_no_part(table):
    good = [(i, [float(i % 7), -float(i % 3), 0.5]) for i in range(40)]
    odd = [
        (100, None),
        (101, []),
        (102, [1.0, 2.0]),
        (103, [1.0, None, 2.0]),
        (104, [float("nan"), 0.0, 0.0]),
        (105, [0.0, float("-inf"), 0.0]),
        (106, [1e300, 0.0, 0.0]),
        (107, [1.0, 2.0, 3.0, 4.0]),
    ]
    edge = [(108, [0.0, 0.0, 0.0]), (109, [5e5, -5e5, 0.0]), (None, [1.0, 1.0, 1.0])]
    rows = good + odd + edge
    got = clustered(table(rows), dimensions=3, centroids=6, rounds=3)
    assert got == brute(rows, 3, 6, 3)
    assert len(got) == len(good) + len(edge)


def test_ties_copies_and_few_rows(table):
    same = [(1, [1.0, 2.0])] * 30 + [(2, [1.0, 2.0])] * 3 + [(3, [4.0, 0.25])]
    assert clustered(table(same), dimensions=2, centroids=40) == brute(same, 2, 40, 5)
    alone = [(7, [0.1, 0.2])]
    assert clustered(table(alone), dimensions=2) == brute(alone, 2, 40, 5)
    middle = [(i, [float(i), 0.0]) for i in (-1, 0, 1)]  # as near to two centroids
    assert clustered(table(middle), dimensions=2, centroids=2) == brute(middle, 2, 2, 5)


def test_no_vectors_no_rows(table):
    assert clustered(table([(1, None)]), dimensions=2) == []
    assert clustered(table([(1, [0.0, 0.0])]).limit(0), dimensions=2) == []


def test_intervals_hold_the_distances():
    random = np.random.default_rng(4)
    vectors = random.integers(-500, 500, (200, 6))
    centroids = random.integers(-500, 500, (9, 6))
    for bits in (2, 4, 7):
        cells = vector_clusters.Cells.spread(vectors[:50], vectors.min(0), vectors.max(0), bits)
        packed = cells.pack(vectors)
        assert packed.shape[1] == -(-6 * bits // 8)
        possible = cells.candidates(cells.unpack(packed), centroids)
        nearest = ((vectors[:, None] - centroids) ** 2).sum(2).argmin(1)
        assert possible[np.arange(200), nearest].all()
        assert bits < 7 or possible.mean() < 0.3
