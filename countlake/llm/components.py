"""Connected components of a graph of pairs, by stars that are joined up and linked."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlake.llm.common import releasing
from countlake.session import write_through


#: Pairs that a task joins up at a time; a graph with fewer is joined up at once.
TOGETHER = 500_000


def _join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of a part as stars: every node with the smallest that it reaches within them."""

    def stars(head: dict[int, int]) -> pa.RecordBatch:
        nodes = [x for x in head if root(x) != x]
        return pa.record_batch(
            [pa.array(nodes, pa.int64()), pa.array([head[x] for x in nodes], pa.int64())],
            names=["a", "b"],
        )

    def root(x: int) -> int:
        top = x
        while (up := head.get(top, top)) != top:
            top = up
        while head.get(x, x) != top:
            head[x], x = top, head.get(x, x)
        return top

    head: dict[int, int] = {}
    pairs = 0
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                head[max(a, b)] = min(a, b)
        pairs += batch.num_rows
        if pairs >= TOGETHER:
            yield stars(head)
            head, pairs = {}, 0
    yield stars(head)


def _link(stars: DataFrame) -> DataFrame:
    """Links the heads that a node has in several stars to the smallest of them.

    Minima are summed up per task first; a node in very many stars meets a
    single row in a join that is split if hot.
    """
    least = stars.groupBy("a").agg(F.min("b").alias("least"))
    heads = stars.join(least, "a").where("b <> least")
    return heads.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
        least.select("a", F.col("least").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges`` (a, b) with the smallest node it reaches.

    In a round each task joins up what it holds of the graph to stars, and the
    stars that share a node are linked by their heads. It is written to the
    shared folder, so no lineage grows. The rounds end when one changes
    nothing: then every node is in one star, that of its component. That takes
    about the logarithm of the longest path. An empty graph gives no rows.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = write_through(edges.distinct(), "components")
    state = None
    while True:
        marks = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if marks == state or marks[0] == 0:
            break
        if marks[0] < TOGETHER:
            edges = write_through(edges.coalesce(1).mapInArrow(releasing(_join_up), "a long, b long"), "components")
            break
        state = marks
        edges = write_through(_link(edges.mapInArrow(releasing(_join_up), "a long, b long")), "components")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def components_of_both(first: DataFrame, rest: DataFrame) -> DataFrame:
    """Components of the pairs in ``first`` and ``rest`` together.

    ``first`` is to connect most of what ``rest`` does: of the pairs in
    ``rest`` only those between different components of ``first`` are joined up.
    """
    known = write_through(components(first), "components")

    def of(end: str) -> DataFrame:
        return known.select(F.col("node").alias(end), F.col("component").alias(f"{end}_in"))

    apart = (
        rest.join(of("a"), "a", "left")
        .join(of("b"), "b", "left")
        .select(F.coalesce("a_in", "a").alias("a"), F.coalesce("b_in", "b").alias("b"))
        .where("a <> b")
    )
    more = components(apart).withColumnRenamed("component", "reached")
    joined = known.join(
        more.withColumnRenamed("node", "component"), "component", "left"
    ).select("node", F.coalesce("reached", "component").alias("component"))
    new = more.join(known.select("node"), "node", "left_anti")
    return joined.union(new.select("node", F.col("reached").alias("component")))
