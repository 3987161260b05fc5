import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from countlake.llm import decontamination, target_resampling, word_buckets

FEATURE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def feature_words(text):
    return FEATURE_WORD.findall((text or "").translate(UPPER))


# --- word buckets ----------------------------------------------------------


def runs_of(text, longest):
    words = feature_words(text)
    return Counter(
        zlib.crc32(" ".join(words[i : i + n]).encode())
        for n in range(1, longest + 1)
        for i in range(len(words) - n + 1)
    )


@pytest.mark.parametrize("longest", [1, 2, 4])
@pytest.mark.parametrize("chars", [0, 40, 10**6])
def test_features_are_the_hashes_of_runs(odd_texts, prose, longest, chars):
    texts = [*odd_texts, "É é ÀB straße İ 中文x 9z", "a-b_c[d]e{f}g`h@i/j:k", prose(3, 500)]
    held = word_buckets.Dictionary(chars)
    for _ in range(3):  # the dictionary grows, the result stays
        crc, row, n_words = word_buckets.features(texts, longest, held)
        for i, text in enumerate(texts):
            assert Counter(crc[row == i].tolist()) == runs_of(text, longest)
            assert n_words[i] == len(feature_words(text))
    assert held.held <= chars


def test_no_texts_no_features():
    crc, row, n_words = word_buckets.features([])
    assert len(crc) == len(row) == len(n_words) == 0


# --- target resampling -----------------------------------------------------


def brute_resampling(rows, target, buckets=10_000, least=20, percent=10, longest=1):
    def counts(texts):
        total = Counter()
        for text in texts:
            for crc, n in runs_of(text, longest).items():
                total[crc % buckets] += n
        return total

    s, t = counts(x for _, x in rows), counts(target)
    S, T = sum(s.values()), sum(t.values())
    out = []
    for key, text in rows:
        found = runs_of(text, longest)
        n = sum(found.values())
        gain = 0
        for crc, times in found.items():
            b = crc % buckets
            gain += times * math.floor(
                1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))
            )
        weight = gain // n if n else 0
        name = "" if key is None else key
        h = int(hashlib.sha256(f"2024:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, n, weight, score, None, len(feature_words(text))])
    able = [r for r in out if r[5] >= least]
    able.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def resampled(frame, target, **options):
    found = target_resampling.resample(frame, target, **options)
    columns = "doc_id", "n_features", "weight", "score", "rank"
    return sorted((tuple(r[c] for c in columns) for r in found.collect()), key=str)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_equals_brute_force(spark, documents, prose, odd_texts, longest):
    texts = [*odd_texts, *[prose(i, 15 + i, vocabulary=5 * (i + 1)) for i in range(60)]]
    target = [None, "", *[prose(i, 40, vocabulary=20) for i in range(5)]]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampled(documents(texts), bench, longest=longest)
    assert got == brute_resampling(list(enumerate(texts)), target, longest=longest)
    assert sum(r[4] is not None for r in got) > 3


def test_repeated_rows_and_null_keys_are_ranked_one_by_one(spark, documents, prose):
    texts = [prose(1, 30)] * 40 + [prose(2, 30)] * 10
    ids = [None] * 40 + list(range(10))
    bench = spark.createDataFrame([(0, prose(2, 30))], "item_id long, text string")
    got = resampled(documents(texts, ids), bench, percent=90)
    ranks = sorted(r[4] for r in got if r[4])
    assert ranks == list(range(1, 46))
    assert got == brute_resampling(list(zip(ids, texts)), [prose(2, 30)], percent=90)


def test_resampling_without_target_or_documents(spark, documents, prose):
    none = spark.createDataFrame([], "item_id long, text string")
    got = resampled(documents([prose(1, 30), None]), none)
    assert got == brute_resampling([(0, prose(1, 30)), (1, None)], [])
    empty = target_resampling.resample(documents(["x"]).limit(0), none)
    assert empty.collect() == [] and "rank" in empty.columns


# --- decontamination -------------------------------------------------------


def brute_contamination(text, items, window=10):
    words = feature_words(text)
    hit, found = set(), set()
    for item, held in items:
        held = feature_words(held)
        m = min(len(held), window)
        wanted = {tuple(held[i : i + m]) for i in range(len(held) - m + 1)} if m else set()
        for i in range(len(words) - m + 1) if m else ():
            if tuple(words[i : i + m]) in wanted:
                hit.update(range(i, i + m))
                found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


def judged(frame, items, spark, **options):
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit("w"))
    found = decontamination.contamination(frame, bench, **options).collect()
    for row in found:
        assert row.contaminated == (row.n_hit > 0) and row.n_items == len(row["items"])
    return found


def test_contamination_equals_brute_force(spark, documents, prose, odd_texts):
    item, other = prose(50, 40), prose(51, 25)
    part = item.split()
    items = [
        (1, item),
        (2, " ".join(part[5:30])),  # windows of two items
        (2, other),  # an item in two rows
        (10, "short item of five"),
        (11, "One"),
        (12, None),
        (13, " .. "),
        (None, prose(52, 12)),
        (14, " ".join(["a"] * 30)),
    ]
    texts = [
        *odd_texts,
        f"{prose(1, 50)} {item} {prose(2, 20)}",
        f"{prose(3, 10)} {' '.join(part[3:13])} {prose(4, 10)}",  # one window
        f"{prose(3, 10)} {' '.join(part[3:12])} {prose(4, 10)}",  # one word short
        f"X {' '.join(part[5:16]).upper()}! y {' , '.join(part[20:35])}",
        f"{item} {item} {other}",
        "a SHORT, item-of five; one",
        f"{prose(52, 12)}",
        " ".join(["a"] * 9),
        " ".join(["a"] * 5000),
        f"{' '.join(part[:15])} {' '.join(part[10:25])}",  # overlapping passages
    ]
    ids = list(range(len(texts)))
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in judged(documents(texts), items, spark)}
    assert got == {i: brute_contamination(t, items) for i, t in zip(ids, texts)}


@pytest.mark.parametrize("window", [1, 3, 10, 13])
def test_every_window_size(spark, documents, window):
    random_ = random.Random(window)
    letters = lambda n: " ".join(random_.choice("abc") for _ in range(n))
    items = [(i, letters(random_.randrange(1, 25))) for i in range(6)]
    texts = [letters(n) for n in (0, 1, 2, 5, 9, 10, 30, 80)]
    rows = judged(documents(texts), items, spark, window=window)
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in rows}
    assert got == {i: brute_contamination(t, items, window) for i, t in enumerate(texts)}


def test_contamination_of_repeated_rows_and_null_keys(spark, documents, prose):
    item = prose(9, 20)
    texts = [item, prose(1, 30), item] * 5
    rows = judged(documents(texts, ids=[None, None, 1] * 5, copies=3), [(5, item)], spark)
    assert Counter((r.doc_id, r.n_words, r.n_hit) for r in rows) == Counter(
        {(None, 20, 20): 15, (None, 30, 0): 15, (1, 20, 20): 15}
    )


def test_contamination_of_nothing(spark, documents):
    assert judged(documents(["x"]).limit(0), [(1, "x y")], spark) == []
    rows = judged(documents(["x y", None]), [], spark)
    assert sorted((r.n_words, r.n_hit) for r in rows) == [(0, 0), (2, 0)]


def test_contamination_runs_no_python(spark, documents, prose, tmp_path):
    bench = spark.createDataFrame([(1, prose(1, 20))], "item_id long, text string")
    documents([prose(1, 30)]).write.parquet(str(tmp_path / "documents"))
    plan = decontamination.contamination(spark.read.parquet(str(tmp_path / "documents")), bench)
    text = plan._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text


def test_winnowing_guarantees_a_print_per_window(spark):
    random_ = np.random.default_rng(1)
    values = random_.integers(0, 5, 300).tolist()
    frame = spark.createDataFrame([(random_.integers(0, 1 << 60, 5000).tolist(),)], "h array<long>")
    few = frame.select(F.size(decontamination._runs(decontamination._fingerprints(F.col("h"), 10), 10)))
    assert 0.26 < few.first()[0] / 5000 < 0.32  # two runs for seven words
    frame = spark.createDataFrame([(values,)], "h array<long>")
    for m in (1, 2, 4, 10):
        row = frame.select(
            decontamination._fingerprints(F.col("h"), m).alias("p"),
            decontamination._runs(decontamination._fingerprints(F.col("h"), m), m).alias("runs"),
        ).first()
        assert len(row.p) == len(values) - m + 1
        unfolded = [x.print for x in row.runs for _ in range(x.first, x.last + 1)]
        assert unfolded == row.p
        by_window = {}
        for i, p in enumerate(row.p):
            assert by_window.setdefault(tuple(values[i : i + m]), p) == p
