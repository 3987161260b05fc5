"""Centroid clustering of vectors by a VA-file: k-means in whole numbers, exact.

Each component of a vector lies in one of ``2 ** bits`` cells of its dimension;
the cells' numbers, packed, are the vector's approximation. For a centroid, a
lookup table per dimension gives the least and the greatest squared distance to
every cell, so the sums over an approximation bound the distance to the vector.
Only centroids whose interval reaches below the least upper bound are
candidates. A vector with one candidate is assigned by its approximation alone;
the full vector is fetched only where intervals overlap.

A round works on the change of the sums: a row counts only if its centroid is
another one than in the round before. Both are bounded from the approximation,
so no state is kept for rows, and a round is one job over a table that never
changes. Approximations go to Python for all rows, full vectors only for rows
with several candidates or a new centroid, within the same task: the rows are
never shuffled. (Both columns are read from the file; a join that fetched only
some vectors would move more than that.) A task gives one row of sums per
centroid.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from countlake.session import write_through

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
#: A component x becomes floor(SCALE * x).
SCALE = 256
SEED = 2
#: Bits of a cell's number.
BITS = 6
#: Rows the cells' borders are chosen from, about; results don't depend on them.
SAMPLED = 20_000
#: Greatest scaled component: up to it all squared distances fit a long.
LARGEST = 1 << 27
#: Vectors compared at a time.
TOGETHER = 2048


@dataclass
class Cells:
    """Least and greatest whole number of each cell: arrays of (dimension, cell)."""

    low: np.ndarray
    high: np.ndarray
    bits: int

    @classmethod
    def spread(cls, sample: np.ndarray, least: np.ndarray, most: np.ndarray, bits: int) -> Cells:
        """Cells that hold about equally many of the sample's values, from least to most."""
        shares = np.linspace(0, 1, (1 << bits) + 1)[1:-1]
        if len(sample):
            borders = np.ceil(np.quantile(sample, shares, axis=0)).astype("int64").T
        else:
            borders = np.ceil(np.outer(most - least, shares)).astype("int64") + least[:, None]
        borders = np.clip(borders, least[:, None], most[:, None] + 1)
        low = np.hstack([least[:, None], borders])
        high = np.hstack([borders - 1, most[:, None]])
        return cls(low, np.maximum(high, low), bits)

    def pack(self, vectors: np.ndarray) -> np.ndarray:
        """The cells of the vectors, ``bits`` bits each, as rows of bytes."""
        cells = np.stack(
            [
                np.searchsorted(low[1:], values, side="right")
                for low, values in zip(self.low, vectors.T)
            ],
            axis=1,
        )
        bits = (cells[:, :, None] >> np.arange(self.bits)) & 1
        return np.packbits(bits.astype("uint8").reshape(len(vectors), -1), axis=1)

    def unpack(self, packed: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(packed, axis=1)[:, : len(self.low) * self.bits]
        bits = bits.reshape(len(packed), len(self.low), self.bits)
        return bits @ (1 << np.arange(self.bits))

    def candidates(self, cells: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Whether a centroid can be the nearest of a vector: (vector, centroid)."""
        least = np.zeros((len(cells), len(centroids)), dtype="int64")
        most = np.zeros_like(least)
        for d in range(len(self.low)):
            low, high, at = self.low[d][:, None], self.high[d][:, None], centroids[:, d]
            below, above = low - at, at - high
            outside = np.maximum(np.maximum(below, above), 0)
            farthest = np.maximum(-below, -above)
            least += (outside * outside)[cells[:, d]]
            most += (farthest * farthest)[cells[:, d]]
        return least <= most.min(axis=1)[:, None]


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """A list column of equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype("int64").reshape(-1, width)


def _binary(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="uint8").reshape(len(column), -1)


def _nearest(
    vectors: np.ndarray, centroids: np.ndarray, possible: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Nearest possible centroid and squared distance per vector, ties to the smaller number."""
    best = np.zeros(len(vectors), dtype="int64")
    least = np.full(len(vectors), np.iinfo("int64").max)
    for j, at in enumerate(centroids):
        rows = np.flatnonzero(possible[:, j])
        gap = vectors[rows] - at
        far = np.einsum("rd,rd->r", gap, gap)
        closer = far < least[rows]
        best[rows[closer]], least[rows[closer]] = j, far[closer]
    return best, least


def _masks(packed: pa.Array, centroids: int) -> np.ndarray:
    """Candidates as the first step packed them: (vector, centroid)."""
    held = np.frombuffer(b"".join(packed.to_pylist()), dtype="uint8").reshape(len(packed), -1)
    return np.unpackbits(held, axis=1)[:, :centroids].astype(bool)


def scaled(vector: Column, dimensions: int = DIMENSIONS, scale: int = SCALE) -> Column:
    """The vector in whole numbers; null where it takes no part."""
    far = F.lit(float(LARGEST))
    values = F.transform(vector, lambda x: F.lit(float(scale)) * x.cast("double"))
    fine = (F.size(vector) == dimensions) & F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < far)
    )
    return F.when(fine, F.transform(values, lambda x: F.floor(x).cast("int")))


def _file(rows: DataFrame, dimensions: int, bits: int, sampled: int, seed: int) -> tuple[DataFrame, Cells]:
    """The stored table of key, vector and approximation, and its cells."""

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.full(dimensions, LARGEST, dtype="int64")
        most, n = -least, 0
        for batch in batches:
            if batch.num_rows:
                vectors = _rows(batch.column("vector"), dimensions)
                least = np.minimum(least, vectors.min(axis=0))
                most = np.maximum(most, vectors.max(axis=0))
                n += len(vectors)
        yield pa.record_batch(
            [pa.array(np.arange(dimensions)), pa.array(least), pa.array(most), pa.array([n] * dimensions)],
            names=["d", "least", "most", "n"],
        )

    reached = (
        rows.select("vector")
        .mapInArrow(reach, "d long, least long, most long, n long")
        .groupBy("d")
        .agg(F.min("least"), F.max("most"), F.sum("n"))
        .orderBy("d")
        .collect()  # one row per dimension
    )
    if not reached or not reached[0][3]:
        least, most, n = np.zeros(dimensions, "int64"), np.zeros(dimensions, "int64"), 0
    else:
        least, most = (np.array([r[i] for r in reached], dtype="int64") for i in (1, 2))
        n = reached[0][3]
    share = min(1.0, sampled / max(n, 1))
    sample = rows.select("vector").sample(share, seed) if share < 1 else rows.select("vector")
    vectors = _rows(sample.toArrow().column("vector").combine_chunks(), dimensions)
    cells = Cells.spread(vectors, least, most, bits)

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = cells.pack(_rows(batch.column("vector"), dimensions))
            cut = pa.array([row.tobytes() for row in packed], pa.binary())
            yield pa.record_batch(
                [batch.column("key"), batch.column("vector"), cut], names=["key", "vector", "cells"]
            )

    kind = rows.schema["key"].dataType.simpleString()
    stored = rows.mapInArrow(approximate, f"key {kind}, vector array<int>, cells binary")
    return write_through(stored, "va-file"), cells


def first_centroids(rows: DataFrame, n: int, seed: int = SEED) -> np.ndarray:
    """The ``n`` vectors with the smallest hashes of seed and key, in that order."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    first = rows.withColumn("hash", F.sha2(text, 256)).orderBy("hash", "vector").limit(n)
    return np.array([r.vector for r in first.select("vector").collect()], dtype="int64")


def _moves(stored: DataFrame, cells: Cells, old: np.ndarray | None, new: np.ndarray) -> DataFrame:
    """cluster, d, moved: what the new centroids add to the clusters' sums.

    Dimension -1 is the count. Without ``old`` centroids, all rows are new.
    """
    k, dimensions = new.shape
    both = [new] if old is None else [old, new]

    @pandas_udf("binary")
    def overlap(packed: pd.Series) -> pd.Series:
        """Candidates under the old and the new centroids; null where both are one and the same."""
        out = []
        for start in range(0, len(packed), TOGETHER):
            found = cells.unpack(_binary(packed[start : start + TOGETHER]))
            masks = [cells.candidates(found, c) for c in both]
            stay = np.zeros(len(found), dtype=bool)
            if old is not None:
                stay = (masks[0] == masks[1]).all(axis=1) & (masks[0].sum(axis=1) == 1)
            bits = np.packbits(np.hstack(masks), axis=1)
            out += [None if s else b.tobytes() for s, b in zip(stay, bits)]
        return pd.Series(out, dtype=object)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dimensions + 1), dtype="int64")
        for batch in batches:
            for start in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(start, TOGETHER)
                vectors = _rows(part.column("vector"), dimensions)
                masks = _masks(part.column("overlap"), k * len(both))
                counted = np.hstack([np.ones((len(vectors), 1), dtype="int64"), vectors])
                to = _nearest(vectors, new, masks[:, -k:])[0]
                if old is not None:
                    was = _nearest(vectors, old, masks[:, :k])[0]
                    moved = was != to
                    counted, to = counted[moved], to[moved]
                    np.subtract.at(sums, was[moved], counted)
                np.add.at(sums, to, counted)
        at, d = np.nonzero(sums)
        yield pa.record_batch(
            [pa.array(at), pa.array(d - 1), pa.array(sums[at, d])], names=["cluster", "d", "moved"]
        )

    return (
        stored.withColumn("overlap", overlap("cells"))
        .where("overlap is not null")
        .select("vector", "overlap")
        .mapInArrow(add_up, "cluster long, d long, moved long")
        .groupBy("cluster", "d")
        .agg(F.sum(F.col("moved").cast("decimal(38,0)")).alias("moved"))
    )


def _assigned(stored: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """key, cluster and distance of every row."""
    k, dimensions = centroids.shape

    @pandas_udf("binary")
    def overlap(packed: pd.Series) -> pd.Series:
        out = []
        for start in range(0, len(packed), TOGETHER):
            found = cells.unpack(_binary(packed[start : start + TOGETHER]))
            bits = np.packbits(cells.candidates(found, centroids), axis=1)
            out += [b.tobytes() for b in bits]
        return pd.Series(out, dtype=object)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _rows(batch.column("vector"), dimensions)
            at, far = _nearest(vectors, centroids, _masks(batch.column("overlap"), k))
            yield pa.record_batch(
                [batch.column("key"), pa.array(at.astype("int32")), pa.array(far)],
                names=["key", "cluster", "distance"],
            )

    kind = stored.schema["key"].dataType.simpleString()
    return (
        stored.withColumn("overlap", overlap("cells"))
        .select("key", "vector", "overlap")
        .mapInArrow(assign, f"key {kind}, cluster int, distance long")
    )


def cluster(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    dimensions: int = DIMENSIONS,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = SEED,
    bits: int = BITS,
    sampled: int = SAMPLED,
) -> DataFrame:
    """One row per vector that takes part: key, cluster, distance, cluster_inertia, inertia, centroid.

    Components are floor(``scale`` * x). Left out are vectors that are null,
    have another number of components, hold null or non-finite ones, or one
    beyond ``LARGEST`` (its squared distances would not fit a long). The first
    centroids are rows, by the smallest hash of ``seed`` and key (a null key
    counts as an empty one), ties by the vector; fewer rows give fewer
    centroids. Equal centroids may stand side by side: the smaller number takes
    all. Repeated rows each count. An inertia too large for a long is null.
    Other columns are not looked at; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(key).alias("key"), scaled(F.col(vector), dimensions, scale).alias("vector")
    ).where("vector is not null")
    stored, cells = _file(rows, dimensions, bits, sampled, seed)
    new, old = first_centroids(stored, centroids, seed), None
    kind = stored.schema["key"].dataType.simpleString()
    if not len(new):
        return spark.createDataFrame(
            [],
            f"`{key}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, "
            "centroid array<long>",
        )
    sums = [[0] * (dimensions + 1) for _ in new]  # count and components, of any size
    for _ in range(rounds):
        for c, d, moved in _moves(stored, cells, old, new).collect():  # a row per number of a centroid
            sums[c][d + 1] += int(moved)
        old, new = new, np.array(
            [[x // s[0] for x in s[1:]] if s[0] else at for s, at in zip(sums, new.tolist())],
            dtype="int64",
        )
    found = write_through(_assigned(stored, cells, new), "va-assigned")
    per_cluster = (
        found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    )
    inertia = sum(int(r.total) for r in per_cluster)

    def fitting(n: int) -> int | None:
        return n if n < 1 << 63 else None

    table = spark.createDataFrame(  # one row per centroid
        [
            (r.cluster, fitting(int(r.total)), fitting(inertia), new[r.cluster].tolist())
            for r in per_cluster
        ],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    return found.join(F.broadcast(table), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
