"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage of every whole text is encoded
(character and repetition measures, and signed hash counts of its words, through
a learned layer); gated attention weights say how much each passage counts, and
the weighted sum of the encodings gives the score. Only documents carry labels;
what a passage is worth is learned from them.

The model is fitted on the driver from a bounded, documented sample of labelled
documents. Scoring is one pass over the texts without a shuffle; the model is a
few thousand numbers and travels with the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countlake.llm.common import releasing
from countlake.llm.words import Words, slices

#: Words of a passage.
PASSAGE = 64
#: Labelled documents to learn from, about (chosen by a hash of the id), and their longest text.
TRAIN_DOCS = 6000
TRAIN_BYTES = 60_000
#: Scores from here on count as good.
GOOD = 0.3
FOLDS = 5

_BUCKETS = 32
_LAGS = 8
_CLASSES = np.zeros(256, dtype="int8")
for _i, _chars in enumerate(
    (
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"abcdefghijklmnopqrstuvwxyz",
        b"0123456789",
        b".,;:?'\"-()",
        b"!",
        b"|",
        b"&$#*%@=+<>{}[]~^_\\/`",
    ),
    start=1,
):
    _CLASSES[list(_chars)] = _i
_CLASSES[128:] = 8
_N_CLASSES = 9
SIZE = 2 * _N_CLASSES + 3 + _LAGS + _BUCKETS


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: CRC-32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def passages(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(features, first): a row per passage; those of text i are first[i] to first[i + 1].

    A text without words has one passage of zeros.
    """
    counts = np.diff(words.first)
    per_text = np.maximum(1, -(-counts // PASSAGE))
    first = np.concatenate([[0], np.cumsum(per_text)])
    out = np.zeros((first[-1], SIZE), dtype="float32")
    n = len(words.starts)
    if not n:
        return out, first
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(n) - words.first[text]
    passage = first[text] + place // PASSAGE
    size = np.bincount(passage, minlength=len(out)).astype("float32")
    per_word = np.maximum(size, 1)
    length = words.ends - words.starts
    chars = np.maximum(np.bincount(passage, length, minlength=len(out)), 1)
    kinds = _CLASSES[words.data]
    for kind in range(_N_CLASSES):
        seen = np.concatenate([[0], np.cumsum(kinds == kind, dtype="int32")])
        held = seen[words.ends] - seen[words.starts]
        out[:, kind] = np.bincount(passage, held, minlength=len(out)) / chars
        out[:, _N_CLASSES + kind] = (
            np.bincount(passage, held == length, minlength=len(out)) / per_word
        )
    at = 2 * _N_CLASSES
    out[:, at] = chars / per_word / 8
    spread = np.bincount(passage, length.astype("f8") ** 2, minlength=len(out)) / per_word
    out[:, at + 1] = np.sqrt(np.maximum(spread - (chars / per_word) ** 2, 0)) / 8
    out[:, at + 2] = size / PASSAGE
    at += 3
    hashes = words.hashes()
    for lag in range(1, _LAGS + 1):
        same = np.zeros(n, dtype=bool)
        same[lag:] = (hashes[lag:] == hashes[:-lag]) & (passage[lag:] == passage[:-lag])
        out[:, at + lag - 1] = np.bincount(passage, same, minlength=len(out)) / per_word
    at += _LAGS
    bucket = (hashes % np.uint64(_BUCKETS)).astype("int64")
    sign = np.where(hashes >> np.uint64(63), 1.0, -1.0)
    signed = np.bincount(passage * _BUCKETS + bucket, sign, minlength=len(out) * _BUCKETS)
    out[:, at:] = signed.reshape(-1, _BUCKETS) / np.sqrt(per_word)[:, None]
    out[size == 0] = 0
    return out, first


@dataclass
class Model:
    """Weights of the network; ``mean`` and ``scale`` make features comparable."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, features: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """All layers, for bags of passages that follow each other."""
        w = self.weights
        x = np.clip((features - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ w["encode"] + w["encode0"])
        t = np.tanh(h @ w["tanh"])
        g = _sigmoid(h @ w["gate"])
        e = np.clip((t * g) @ w["attend"], -30, 30)
        starts = first[:-1]
        bags = np.repeat(np.arange(len(starts)), np.diff(first))
        e = np.exp(e - np.maximum.reduceat(e, starts)[bags])
        a = e / np.add.reduceat(e, starts)[bags]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        p = _sigmoid(z @ w["judge"] + w["judge0"])
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "p": p, "bags": bags}

    def score(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.forward(features, first)["p"] if len(first) > 1 else np.zeros(0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gradients(model: Model, o: dict[str, np.ndarray], first, target) -> dict[str, np.ndarray]:
    """Slopes of the mean cross-entropy."""
    w, starts, bags = model.weights, first[:-1], o["bags"]
    slope = (o["p"] - target) / len(target)
    to_z = slope[:, None] * w["judge"]
    to_a = (to_z[bags] * o["h"]).sum(1)
    to_e = o["a"] * (to_a - np.add.reduceat(o["a"] * to_a, starts)[bags])
    gated = o["t"] * o["g"]
    to_gated = to_e[:, None] * w["attend"]
    to_t = to_gated * o["g"] * (1 - o["t"] ** 2)
    to_g = to_gated * o["t"] * o["g"] * (1 - o["g"])
    to_h = o["a"][:, None] * to_z[bags] + to_t @ w["tanh"].T + to_g @ w["gate"].T
    to_x = to_h * (1 - o["h"] ** 2)
    return {
        "encode": o["x"].T @ to_x,
        "encode0": to_x.sum(0),
        "tanh": o["h"].T @ to_t,
        "gate": o["h"].T @ to_g,
        "attend": gated.T @ to_e,
        "judge": o["z"].T @ slope,
        "judge0": slope.sum(keepdims=True),
    }


def fit(
    bags: list[np.ndarray],
    target: np.ndarray,
    *,
    hidden: int = 24,
    attention: int = 12,
    rounds: int = 25,
    batch: int = 64,
    rate: float = 0.004,
    decay: float = 1e-4,
    seed: int = 3,
) -> Model:
    """A model from bags of passage features and their labels (0 to 1), by Adam."""
    random = np.random.default_rng(seed)
    every = np.concatenate(bags) if bags else np.zeros((1, SIZE), dtype="float32")
    model = Model(
        every.mean(0),
        every.std(0) + 0.02,
        {
            "encode": random.normal(0, SIZE**-0.5, (SIZE, hidden)),
            "encode0": np.zeros(hidden),
            "tanh": random.normal(0, hidden**-0.5, (hidden, attention)),
            "gate": random.normal(0, hidden**-0.5, (hidden, attention)),
            "attend": random.normal(0, attention**-0.5, attention),
            "judge": random.normal(0, hidden**-0.5, hidden),
            "judge0": np.zeros(1),
        },
    )
    first_moment = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second_moment = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step, steps = 0, rounds * -(-len(bags) // batch)
    for _ in range(rounds):
        order = random.permutation(len(bags))
        for start in range(0, len(order), batch):
            chosen = order[start : start + batch]
            first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in chosen])])
            out = model.forward(np.concatenate([bags[i] for i in chosen]), first)
            slopes = _gradients(model, out, first, target[chosen])
            step += 1
            pace = rate * (1 - step / (steps + 1))
            for name, slope in slopes.items():
                slope = slope + decay * model.weights[name]
                m = first_moment[name] = 0.9 * first_moment[name] + 0.1 * slope
                v = second_moment[name] = 0.999 * second_moment[name] + 0.001 * slope**2
                fix = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                model.weights[name] -= pace * fix * m / (np.sqrt(v) + 1e-8)
    return model


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    train_docs: int = TRAIN_DOCS,
    train_bytes: int = TRAIN_BYTES,
    seed: int = 1,
) -> Model:
    """Fits a model on about ``train_docs`` labelled documents outside the held-out fold.

    They are chosen by a hash of the id; texts over ``train_bytes`` bytes are
    not learned from, and repeated rows count once. Several labels of one id count
    as their mean, null labels as none. Without labels the model is the untrained one.
    """
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
        .groupBy(F.col(key).alias("key"))
        .agg(F.avg(F.col(label).cast("double")).alias("label"))
    )
    share = min(1.0, train_docs / max(known.count(), 1))
    chosen = known.where(
        F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    )

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in slices(batches, "text"):
            features, first = passages(words)
            held = [features[a:b].astype("<f4").tobytes() for a, b in zip(first, first[1:])]
            yield pa.record_batch(
                [batch.column("key"), batch.column("label"), pa.array(held, pa.binary())],
                names=["key", "label", "bag"],
            )

    kind = docs.schema[key].dataType.simpleString()
    short = F.coalesce(F.octet_length(F.col(text)), F.lit(0)) <= train_bytes
    rows = (  # about train_docs ids: small enough to send to every task
        docs.where(short)
        .select(F.col(key).alias("key"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), "key")
        .withColumn("hash", F.xxhash64("text"))
        .dropDuplicates(["key", "hash"])  # copies of a document teach once
        .select("key", "text", "label")
        .mapInArrow(releasing(bag), f"key {kind}, label double, bag binary")
        .toArrow()
        .sort_by([("key", "ascending"), ("bag", "ascending")])
    )
    bags = [np.frombuffer(b, dtype="<f4").reshape(-1, SIZE) for b in rows.column("bag").to_pylist()]
    return fit(bags, np.array(rows.column("label").to_pylist(), dtype="float64"))


def score(docs: DataFrame, model: Model, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, held_out, score.

    Whole texts are read. Null, empty and blank texts have one empty passage
    and get its score. Other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in slices(batches, "text"):
            found = model.score(*passages(words))
            yield pa.record_batch(
                [batch.column("key"), batch.column("held_out"), pa.array(found, pa.float64())],
                names=["key", "held_out", "score"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return (
        docs.select(
            F.col(key).alias("key"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text")
        )
        .mapInArrow(releasing(run), f"key {kind}, held_out boolean, score double")
        .withColumnRenamed("key", key)
    )


def keep_good(
    docs: DataFrame, model: Model, *, text: str = "text", good: float = GOOD
) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``good``, with all their columns."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [f"c{i}" for i in range(batch.num_columns)]
            plain = pa.RecordBatch.from_arrays(batch.columns, names=names)
            for part, words in slices([plain], f"c{place}"):
                kept = part.filter(pa.array(model.score(*passages(words)) >= good))
                yield pa.RecordBatch.from_arrays(kept.columns, names=batch.schema.names)

    return docs.mapInArrow(releasing(run), docs.schema)
