import zlib

import numpy as np
import pyarrow as pa
import pytest

from countlake.llm import quality
from countlake.llm.words import words_of


@pytest.fixture(scope="module")
def judged(documents, prose):
    """Good documents, and bad ones of symbols, repeats or capitals."""
    texts, labels = [], []
    for i in range(300):
        good = prose(i, 150 + i)
        kind = i % 4
        bad = [None, " ".join(f"{w}&&&" for w in good.split()), "buy now " * 120, good.upper().replace(" ", "!! ")]
        texts.append(bad[kind] or good)
        labels.append(int(kind == 0))
    return texts, labels


@pytest.fixture(scope="module")
def model(spark, documents, judged):
    texts, labels = judged
    rows = [(i, q, 0) for i, q in enumerate(labels)] + [(0, 1, 0), (None, 1, 0), (7, None, 0), (5000, 1, 0)]
    table = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    return quality.train(documents(texts), table)


def test_held_out_rows_are_told_apart(documents, judged, model):
    texts, labels = judged
    got = quality.score(documents(texts), model).collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert len(held) > 30
    assert all((r.score >= quality.GOOD) == labels[r.doc_id] for r in held)


def test_scores_depend_on_the_text_alone(documents, judged, model, odd_texts):
    texts = odd_texts + judged[0][:5]
    one = quality.score(documents(texts), model).collect()
    two = quality.score(documents(texts, ids=[10**6 + i for i in range(len(texts))], sources=[None] * len(texts)), model)
    by_id = {r.doc_id: r.score for r in two.collect()}
    for r in one:
        assert by_id[10**6 + r.doc_id] == pytest.approx(r.score, abs=1e-9)
    empty = {r.score for r in one if r.doc_id in (0, 1, 2)}
    assert max(empty) - min(empty) < 1e-9


def test_filtering_keeps_whole_rows(documents, judged, model, odd_texts):
    frame = documents(odd_texts + judged[0][:40], copies=2)
    kept = quality.keep_good(frame, model)
    good = {r.doc_id for r in quality.score(frame, model).collect() if r.score >= quality.GOOD}
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == good
    assert kept.exceptAll(frame).count() == 0
    assert quality.keep_good(frame.limit(0), model).count() == 0


def test_slopes_are_those_of_the_loss():
    random = np.random.default_rng(1)
    bags = [random.normal(size=(n, quality.SIZE)).astype("f4") for n in (3, 1, 5)]
    target = np.array([1.0, 0.0, 0.5])
    model = quality.fit(bags, target, rounds=1)
    features, first = np.concatenate(bags).astype("f8"), np.array([0, 3, 4, 9])

    def loss():
        p = model.score(features, first)
        return -(target * np.log(p) + (1 - target) * np.log(1 - p)).mean()

    slopes = quality._gradients(model, model.forward(features, first), first, target)
    for name, slope in slopes.items():
        weights = model.weights[name].reshape(-1)
        for at in random.integers(0, len(weights), 4):
            old = weights[at]
            weights[at] = old + 1e-5
            up = loss()
            weights[at] = old - 1e-5
            down = loss()
            weights[at] = old
            assert slope.reshape(-1)[at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_every_passage_counts_and_weights_add_up():
    texts = pa.array(["a b c", None, " ".join(f"w{i}" for i in range(200))])
    features, first = quality.passages(words_of(texts))
    assert first.tolist() == [0, 1, 2, 6]
    assert not features[1].any()
    model = quality.fit([features[:1], features[2:]], np.array([1.0, 0.0]), rounds=2)
    weights = model.forward(features, first)["a"]
    assert np.add.reduceat(weights, first[:-1]) == pytest.approx([1, 1, 1])


def test_without_labels_there_is_a_score(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(documents(["a", None]), none)
    assert quality.score(documents(["a", None]), model).count() == 2
