from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from countlake.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), epochs=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full = dict.fromkeys(names, 0.0), set()
    left = epochs * sum(sizes.values())
    while left > 1e-9 and len(full) < len(names):
        total = sum(weight[s] for s in names if s not in full)
        share = {s: left * weight[s] / total for s in names if s not in full}
        left = 0.0
        for s, more in share.items():
            target[s] += more
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                full.add(s)
    return target


@pytest.fixture(scope="module")
def mixed(documents, prose):
    texts, sources = [], []
    for i in range(400):
        texts.append(prose(i, 1 + (i * i) % 90))
        sources.append(["a", "B", "é", None, "zz", "a", "a"][i % 7])
    texts += [None, "", "  ", prose(1000, 3000)]
    sources += ["a", None, "empty", "big"]
    return documents(texts, sources=sources), texts, sources


def words(text):
    return len((text or "").split())


@pytest.mark.parametrize("block", [1024, 16])
def test_targets_and_words_taken(mixed, block):
    frame, texts, sources = mixed
    sizes = Counter()
    for t, s in zip(texts, sources):
        sizes[s] += words(t)
    expected = brute_targets(sizes)
    taken = Counter()
    got = mixing.mix(frame, block_docs=block).collect()
    assert sorted(r.id for r in got) == list(range(len(texts)))
    for r in got:
        assert r.size == words(texts[r.id])
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
        assert len(r.placements) <= 2
        taken[r.source] += r.size * len(r.placements)
    for s, target in expected.items():
        assert abs(taken[s] - target) <= (1500 if s == "big" else 45)


def test_reruns_agree_and_draws_are_the_mix(mixed):
    frame, texts, _ = mixed
    once = {r.id: (sorted(map(tuple, r.placements)), r.order_key) for r in mixing.mix(frame, block_docs=16).collect()}
    again = {r.id: (sorted(map(tuple, r.placements)), r.order_key) for r in mixing.mix(frame.repartition(7), block_docs=16).collect()}
    assert once == again
    rows = mixing.draw(frame, block_docs=16)
    assert rows.columns == frame.columns
    drawn = Counter(r.doc_id for r in rows.collect())
    assert drawn == Counter({i: len(p) for i, (p, _) in once.items() if p})


def test_shards_get_like_numbers_of_blocks(mixed):
    frame, _, _ = mixed
    shards = 8
    units = mixing.mix(frame, block_docs=4, shards=shards).select(F.explode("placements").alias("p"))
    counts = {r.shard: r["count"] for r in units.groupBy("p.shard").count().collect()}
    assert set(counts) == set(range(shards))
    assert max(counts.values()) < 2.5 * min(counts.values())


def test_repeated_rows_null_keys_and_nothing(documents, prose):
    frame = documents([prose(1, 10), prose(2, 10), None], ids=[None, 4, 4], copies=40)
    got = mixing.mix(frame).collect()
    assert len(got) == 120
    assert sum(r.size * len(r.placements) for r in got) == pytest.approx(1200, abs=10)
    assert mixing.draw(frame).where("text is not null").count() == pytest.approx(120, abs=1)
    assert mixing.mix(frame.limit(0)).count() == 0
    blank = mixing.mix(documents([None, " "])).collect()
    assert [(r.size, r.target) for r in blank] == [(0, 0.0), (0, 0.0)]


def test_draws_follow_the_hypergeometric_law(spark):
    n = 20_000
    u = mixing._uniform(F.lit(3), F.col("id"))
    drawn = spark.range(n).select(mixing.hypergeometric(F.lit(200), F.lit(60), F.lit(50), u).alias("x"))
    x = np.array([r.x for r in drawn.collect()])
    law = np.random.default_rng(1).hypergeometric(60, 140, 50, n)
    assert abs(x.mean() - 15) < 0.1 and abs(x.std() - law.std()) < 0.1
    ends = spark.range(5).select(
        mixing.hypergeometric(F.lit(10), F.lit(10), F.col("id"), u).alias("all"),
        mixing.hypergeometric(F.lit(10), F.lit(0), F.col("id"), u).alias("none"),
        mixing.hypergeometric(F.lit(10), F.lit(9), F.lit(9), u).alias("most"),
    )
    for i, r in enumerate(ends.collect()):
        assert (r["all"], r.none) == (i, 0) and r.most in (8, 9)


def test_quotas_are_split_without_rest(spark):
    quotas = {1: 100, 2: 7, 3: 0, 4: 1001}
    frame = spark.createDataFrame(list(quotas.items()), "source_no int, quota long")
    for shards in (1, 5, 8):
        by_shard, by_source = defaultdict(int), defaultdict(int)
        for r in mixing.split_quotas(frame, shards, 3).collect():
            by_shard[r.shard] += r.quota
            by_source[r.source_no] += r.quota
        assert {k: by_source[k] for k in quotas} == quotas
        assert len(by_shard) == shards
        assert max(by_shard.values()) - min(by_shard.values()) <= 4


def test_drawn_rows_keep_their_own_columns(spark):
    rows = [(1, "a b c", "s", i % 5, None) for i in range(10)]
    rows += [(2, None, "s", 1, 1), (2, "", "s", 1, 1), (2, "", "s", 1, 2), (None, "x y", None, 7, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang int, extra int")
    drawn = [tuple(r) for r in mixing.draw(docs, epochs=1.0, max_repeats=1).collect()]
    assert sorted(drawn, key=str) == sorted(rows, key=str)
    twice = [tuple(r) for r in mixing.draw(docs, epochs=2.0).collect()]
    assert sorted(twice, key=str) == sorted(rows * 2, key=str)
