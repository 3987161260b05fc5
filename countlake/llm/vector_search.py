"""Approximate nearest neighbours with balanced posting lists.

* Equal vectors become one, with its ``k + 1`` smallest ids: no more of them
  can be among the nearest ``k``, so a vector in a third of all rows is one row.
* Centroids come from halving a bounded sample again and again; each cut is
  kept near the middle, so that the lists are about equally long.
* The centroids and a neighbour graph over them are small (bounded by
  ``max_sample``) and held in memory by every task. A beam search on the graph,
  done for a batch of vectors at a time, finds the nearest centroids.
* Every vector goes to the list of its nearest centroid and, if it lies near a
  border, to those almost as near. A query visits the lists whose centroid is
  at most ``probe_ratio`` times as far as the nearest, and more where these
  hold too few vectors.
* Lists and the queries that visit them meet in a co-group, cut into blocks
  of bounded size on both sides. Distances are exact, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from countlake.session import write_through


@dataclass(frozen=True)
class Settings:
    """Bounds and ratios of the index; see the module's text."""

    list_size: int = 200
    max_sample: int = 100_000
    copies: int = 4
    copy_ratio: float = 1.08
    probes: int = 48
    probe_ratio: float = 1.7
    degree: int = 16
    entries: int = 32
    block: int = 4096
    seed: int = 5


@dataclass
class Centroids:
    """Centroids and the graph over them."""

    points: np.ndarray
    links: np.ndarray
    entries: np.ndarray


def balanced_centroids(sample: np.ndarray, leaf: int, seed: int) -> np.ndarray:
    """Means of the leaves when ``sample`` is halved until no leaf has more than ``leaf`` rows."""
    random = np.random.default_rng(seed)
    waiting, means = [np.arange(len(sample))], []
    while waiting:
        rows = waiting.pop()
        points = sample[rows]
        if len(rows) <= max(leaf, 1):
            means.append(points.mean(axis=0))
            continue
        two = points[random.choice(len(rows), 2, replace=False)]
        for _ in range(6):
            lean = ((points - two[0]) ** 2).sum(1) - ((points - two[1]) ** 2).sum(1)
            first = lean < 0
            if first.all() or not first.any():
                break
            two = np.stack([points[first].mean(0), points[~first].mean(0)])
        cut = int(np.clip((lean < 0).sum(), len(rows) * 0.3, len(rows) * 0.7))
        cut = min(max(cut, 1), len(rows) - 1)
        order = np.argsort(lean, kind="stable")
        waiting += [rows[order[:cut]], rows[order[cut:]]]
    return np.array(means)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1), 0)


def link(points: np.ndarray, degree: int, entries: int, seed: int) -> Centroids:
    """Graph with the nearest centroids of each and two far links, and spread entry points."""
    random = np.random.default_rng(seed)
    near = min(degree, len(points) - 1)
    links = np.empty((len(points), near + 2), dtype=np.int32)
    for start in range(0, len(points), 1024):
        gaps = _squares(points[start : start + 1024], points)
        gaps[np.arange(len(gaps)), start + np.arange(len(gaps))] = np.inf
        links[start : start + 1024, :near] = np.argsort(gaps, axis=1, kind="stable")[:, :near]
    links[:, near:] = random.integers(0, len(points), (len(points), 2))
    spread = [0]
    gaps = _squares(points[:1], points)[0]
    while len(spread) < min(entries, len(points)):
        spread.append(int(gaps.argmax()))
        gaps = np.minimum(gaps, _squares(points[spread[-1:]], points)[0])
        gaps[spread] = -1
    return Centroids(points, links, np.array(spread, dtype=np.int32))


def nearest_centroids(index: Centroids, vectors: np.ndarray, width: int):
    """(ids, distances) of about the ``width`` nearest centroids per vector, nearest first.

    Beam search for all vectors at once; places beyond the centroids found
    have an infinite distance.
    """
    points, rows = index.points, np.arange(len(vectors))[:, None]
    norms = (points * points).sum(1)
    own = (vectors * vectors).sum(1)[:, None]

    def gaps(ids: np.ndarray) -> np.ndarray:
        dots = np.einsum("rd,rnd->rn", vectors, points[ids])
        return np.maximum(own - 2 * dots + norms[ids], 0)

    ids = np.repeat(index.entries[None, :], len(vectors), axis=0)
    far = _squares(vectors, points[index.entries])
    done = np.zeros(ids.shape, dtype=bool)
    for _ in range(4 * width):
        order = np.argsort(far, axis=1, kind="stable")[:, : max(width, len(index.entries))]
        ids, far, done = ids[rows, order], far[rows, order], done[rows, order]
        at = np.where(done | np.isinf(far), np.inf, far)[:, :width].argmin(axis=1)
        here = rows[:, 0], at
        if (done[here] | np.isinf(far[here])).all():
            break
        done[here] = True
        new = np.sort(index.links[ids[here]], axis=1)
        gap = gaps(new)
        gap[:, 1:][new[:, 1:] == new[:, :-1]] = np.inf
        gap[(new[:, :, None] == ids[:, None, :]).any(axis=2)] = np.inf
        ids, far = np.hstack([ids, new]), np.hstack([far, gap])
        done = np.hstack([done, np.isinf(gap)])
    order = np.argsort(far, axis=1, kind="stable")[:, :width]
    return ids[rows, order], np.sqrt(far[rows, order])


def usable(vector: F.Column) -> F.Column:
    """Whether a vector has only finite components, not all of them zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors: vector, ids (the k + 1 smallest), first (smallest id)."""
    by_id = Window.partitionBy("vector").orderBy("id")
    return (
        rows.distinct()
        .withColumn("rank", F.row_number().over(by_id))
        .where(F.col("rank") <= k + 1)
        .groupBy("vector")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .withColumn("first", F.col("ids")[0])
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long lists as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return flat.reshape(len(column), -1)


def search(
    vectors: DataFrame,
    *,
    every: int = 100,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    settings: Settings = Settings(),
) -> DataFrame:
    """Nearest rows of every query: query_id, rank, vec_id, score (Euclidean distance).

    Queries are the rows whose key is divisible by ``every``; candidates are all
    rows but those with the query's key. Nearest first, ties to the smaller
    key; ``k`` rows a query, or all candidates if there are fewer. Rows with a
    null key, and vectors that are null, zero or hold null or non-finite
    components, take no part; of vectors of several lengths those of the most
    frequent length (the shorter on a tie) do. Rows repeated whole count once.
    Other columns are not looked at. An empty table gives an empty result.
    """
    spark, s = vectors.sparkSession, settings
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("vector")).where(
        F.col("id").isNotNull() & usable(F.col("vector"))
    )
    size = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size")
    found = size.first()
    out = "query_id long, rank int, vec_id long, score double"
    if not found:
        return spark.createDataFrame([], out)
    rows = rows.where(F.size("vector") == found["size"])
    points = write_through(_distinct(rows, k), "ann-points")
    total = points.count()
    share = min(1.0, s.max_sample / total)
    sample = points.where(
        F.pmod(F.xxhash64(F.lit(s.seed), "vector"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    ).select("vector")
    sample = _matrix(sample.toArrow().column("vector"))
    leaf = max(8, int(s.list_size * len(sample) / total))
    centres = balanced_centroids(sample, leaf, s.seed)
    index = spark.sparkContext.broadcast(link(centres, s.degree, s.entries, s.seed))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                at, far = nearest_centroids(index.value, _matrix(part.column("vector")), 2 * s.copies)
                near = far[:, : s.copies] <= far[:, :1] * s.copy_ratio
                near[:, 0] = True
                row, place = np.nonzero(near & np.isfinite(far[:, : s.copies]))
                held = part.take(pa.array(row))
                yield pa.record_batch(
                    [
                        pa.array(at[row, place].astype("int32")),
                        pa.array(place == 0),
                        *(held.column(c) for c in ("first", "ids", "vector")),
                    ],
                    names=["list", "home", "first", "ids", "vector"],
                )

    kind = points.schema["vector"].dataType.simpleString()
    posted = points.select("first", "ids", "vector").mapInArrow(
        post, f"list int, home boolean, first long, ids array<long>, vector {kind}"
    )
    posted = write_through(posted, "ann-lists")
    sizes = (  # one row per centroid
        posted.groupBy("list")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("home").cast("long")).alias("home"))
        .toArrow()
    )
    at_home = np.zeros(len(centres), dtype="int64")
    at_home[sizes.column("list").to_numpy()] = sizes.column("home").to_numpy()
    blocks = np.zeros(len(centres), dtype="int64")
    blocks[sizes.column("list").to_numpy()] = -(-sizes.column("n").to_numpy() // s.block)
    homes = spark.sparkContext.broadcast(at_home)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                query = _matrix(part.column("vector"))
                at, far = nearest_centroids(index.value, query, s.probes)
                near = np.isfinite(far) & (far <= far[:, :1] * s.probe_ratio)
                # Each vector is at home in one list: so many are there to be found.
                there = np.cumsum(np.where(np.isfinite(far), homes.value[at], 0), axis=1)
                near |= np.isfinite(far) & (there - homes.value[at] < 4 * k)
                row, place = np.nonzero(near)
                lists = at[row, place]
                short = np.nonzero(there[:, -1] < k + 1)[0]
                if len(short):  # too few vectors near: all lists
                    stay = ~np.isin(row, short)
                    row = np.r_[row[stay], np.repeat(short, len(homes.value))]
                    lists = np.r_[lists[stay], np.tile(np.arange(len(homes.value)), len(short))]
                held = part.take(pa.array(row))
                yield pa.record_batch(
                    [
                        pa.array(lists.astype("int32")),
                        held.column("query"),
                        held.column("vector"),
                    ],
                    names=["list", "query", "vector"],
                )

    asked = rows.where(F.col("id") % every == 0).distinct()
    queries = write_through(
        asked.groupBy("vector").agg(F.min("id").alias("query")), "ann-queries"
    )
    visits = write_through(
        queries.select("query", "vector").mapInArrow(
            visit, f"list int, query long, vector {kind}"
        ),
        "ann-visits",
    )
    per_list = visits.groupBy("list").agg(F.count(F.lit(1)).alias("n")).toArrow()
    asks = np.zeros(len(centres), dtype="int64")
    asks[per_list.column("list").to_numpy()] = -(-per_list.column("n").to_numpy() // s.block)
    cuts = spark.createDataFrame(
        pa.table({"list": np.arange(len(centres), dtype="int32"), "blocks": blocks, "asks": asks})
    )

    def dealt(rows: DataFrame, own: str, other: str, by: str) -> DataFrame:
        """Gives each row its own block, and a copy for each block of the other side."""
        return (
            rows.join(cuts, "list")
            .where((F.col("blocks") > 0) & (F.col("asks") > 0))
            .withColumn(own, F.pmod(F.xxhash64(by), F.col("blocks" if own == "block" else "asks")))
            .withColumn(
                other,
                F.explode(
                    F.sequence(
                        F.lit(0).cast("long"), F.col("asks" if own == "block" else "blocks") - 1
                    )
                ),
            )
        )

    lists = dealt(posted, "block", "ask", "first").select(
        "list", "block", "ask", "first", "ids", "vector"
    )
    asking = dealt(visits, "ask", "block", "query").select(
        "list", "block", "ask", "query", "vector"
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        picked: list[tuple[int, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            near = _matrix(left.column("vector"))
            first = left.column("first").to_numpy()
            for query, point in zip(
                right.column("query").to_pylist(), _matrix(right.column("vector"))
            ):
                far = np.sqrt(((near - point) ** 2).sum(axis=1))
                best = np.lexsort((first, far))[: k + 1]
                picked.append((query, best, far[best]))
        rows = np.concatenate([p[1] for p in picked]) if picked else np.array([], dtype="int64")
        held = left.take(pa.array(rows))
        return pa.table(
            {
                "query": pa.array(
                    np.repeat([p[0] for p in picked], [len(p[1]) for p in picked]).astype("int64")
                ),
                "first": held.column("first"),
                "ids": held.column("ids"),
                "score": pa.array(
                    np.concatenate([p[2] for p in picked]) if picked else np.array([], dtype="f8")
                ),
            }
        )

    places = ["list", "block", "ask"]
    hits = (
        lists.groupBy(*places)
        .cogroup(asking.groupBy(*places))
        .applyInArrow(meet, "query long, first long, ids array<long>, score double")
    )
    best = Window.partitionBy("query").orderBy("score", "first")
    near = (
        hits.dropDuplicates(["query", "first"])
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k + 1)
        .groupBy("query")
        .agg(F.array_sort(F.collect_list(F.struct("score", "ids"))).alias("near"))
    )
    # A query's result is its vector's, less its own id.
    members = asked.join(queries, "vector").select("query", F.col("id").alias("query_id"))
    flat = F.flatten(
        F.transform(
            "near",
            lambda n: F.transform(n["ids"], lambda i: F.struct(n["score"].alias("score"), i.alias("id"))),
        )
    )
    own = F.filter(flat, lambda x: x["id"] != F.col("query_id"))
    top = F.slice(F.array_sort(own), 1, k)
    return (
        members.join(near, "query")
        .select("query_id", F.posexplode(top).alias("pos", "hit"))
        .select(
            "query_id",
            (F.col("pos") + 1).cast("int").alias("rank"),
            F.col("hit.id").alias("vec_id"),
            F.col("hit.score").alias("score"),
        )
    )
