"""Near duplicates by an LSH forest of MinHash signatures, confirmed on full shingle sets.

1. Every text gets the set of its word shingles, a MinHash signature and a
   128-bit hash of the set. Texts with equal sets become one node.
2. Forest. Each tree sorts all nodes by its own part of the signatures; the
   sort is a range shuffle, so a dense region is spread over tasks like any
   other. Neighbours in the order that share at least ``least_depth`` leading
   values are candidates. In a thin region the scan of the order meets everybody
   in it. Of a dense one it meets the neighbours with the longest common
   prefixes; then the region's rows outside its largest family so far meet all
   of its rows, block by block, and so do those of regions that were cut by the
   edge of a task. Candidates whose short signatures agree well enough are
   joined to families; each task reports only a spanning forest of what it
   finds, at most one pair per row.
3. Families are components of these pairs; links exist only within them. A
   family of bounded size is compared in one place. Of a larger one, a few hubs
   are compared with all members first; then the members outside the largest
   component found so far are compared with all members, block by block. Two
   members of the largest component need no further link, so none is missed
   and a large group of near copies is never compared pair by pair.
4. Links are confirmed on the full sets, in whole numbers; components of the
   links are the result.

What is moved: signatures once per tree in short form, and the texts once, for
the sets of family members.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from countlake.llm.components import components, components_of_both
from countlake.llm.common import releasing
from countlake.llm.words import Runs, Words, scramble, slices
from countlake.session import write_through

SHINGLE_WORDS = 5
SIMILARITY = 75  # in hundredths
TREES, DEPTH = 24, 8
LEAST_DEPTH = 3
#: Trees whose pairs are joined up before those of the others.
FIRST_TREES = 2
#: Rows after a row that are looked at in a tree's order, while they share its prefix.
#: Regions with more rows are compared in blocks afterwards.
NEIGHBOURS = 128
#: Rows of such a region that are compared in one place.
REGION_ROWS = 8192
#: Agreement of short signatures (64 values of 4 bits) that makes candidates, of 64.
AGREE = 34
#: Members and shingles of a family that are compared in one place.
BLOCK_ROWS, BLOCK_SHINGLES = 256, 2_000_000
HUBS = 16

_KEYS = TREES * DEPTH
_random = np.random.default_rng(20240602)
_MULTIPLY = _random.integers(1, 1 << 63, _KEYS, dtype="uint64") | np.uint64(1)
_FLIP = _random.integers(1, 1 << 63, _KEYS, dtype="uint64")


def shingle_sets(words: Words, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the distinct shingles of text i are hashes[first[i]:first[i + 1]], sorted.

    Fewer words than ``size`` make one shingle of all of them; none make none.
    """
    counts = np.diff(words.first)
    runs = Runs(words.hashes(lower=True))
    per_text = np.where(counts >= size, counts - size + 1, (counts > 0).astype("int64"))
    text = np.repeat(np.arange(len(counts)), per_text)
    before = np.cumsum(per_text) - per_text
    start = words.first[text] + np.arange(len(text)) - before[text]
    hashes = runs.hash(start, start + np.minimum(counts, size)[text])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.searchsorted(text[new], np.arange(len(counts) + 1))


def _set_names(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set."""
    sums = np.zeros(len(hashes) + 1, dtype="uint64")
    np.cumsum(hashes * np.uint64(0xA24BAED4963EE407), out=sums[1:])
    mixed = np.zeros(len(hashes) + 1, dtype="uint64")
    np.cumsum(scramble(hashes ^ np.uint64(0x5851F42D4C957F2D)), out=mixed[1:])
    size = np.diff(first).astype("uint64")
    return (
        scramble(sums[first[1:]] - sums[first[:-1]] + size).view("int64"),
        scramble(mixed[first[1:]] - mixed[first[:-1]] - size).view("int64"),
    )


def _signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """16-bit MinHash values, a row per non-empty set."""
    filled = np.flatnonzero(np.diff(first))
    out = np.empty((len(filled), _KEYS), dtype=">u2")
    if len(filled):
        for i in range(_KEYS):
            least = np.minimum.reduceat((hashes ^ _FLIP[i]) * _MULTIPLY[i], first[filled])
            out[:, i] = scramble(least) >> np.uint64(48)
    return out


def _sign(docs: DataFrame, text: str, key: str) -> DataFrame:
    """uid, key, mark (hash of the text), n_shingles, s1, s2 (name of the set), signature.

    The signature is null for an empty set.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in slices(batches, "text"):
            hashes, first = shingle_sets(words)
            s1, s2 = _set_names(hashes, first)
            sizes = np.diff(first)
            rows = iter(_signatures(hashes, first))
            held = [next(rows).tobytes() if n else None for n in sizes]
            yield pa.record_batch(
                [
                    batch.column("key"),
                    batch.column("mark"),
                    pa.array(sizes, pa.int64()),
                    pa.array(s1),
                    pa.array(s2),
                    pa.array(held, pa.binary()),
                ],
                names=["key", "mark", "n_shingles", "s1", "s2", "signature"],
            )

    return (
        docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
        .mapInArrow(releasing(run), f"key {kind}, mark long, n_shingles long, s1 long, s2 long, signature binary")
        .withColumn("uid", F.monotonically_increasing_id())
    )


def _short(signatures: np.ndarray) -> np.ndarray:
    """64 values of 4 bits, two to a byte."""
    low = (signatures[:, : 2 * 64 : 2] & 15).astype("uint8")
    return low[:, ::2] << 4 | low[:, 1::2]


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per node and tree: the tree's part of the signature, and the short signature."""
    for batch in batches:
        if not batch.num_rows:
            continue
        held = b"".join(batch.column("signature").to_pylist())
        rows = np.frombuffer(held, dtype=">u2").reshape(-1, _KEYS)
        short = pa.array([s.tobytes() for s in _short(rows)], pa.binary())
        for tree in range(TREES):
            part = np.ascontiguousarray(rows[:, tree * DEPTH : (tree + 1) * DEPTH])
            yield pa.record_batch(
                [
                    pa.array(np.full(len(rows), tree, dtype="int32")),
                    pa.array([p.tobytes() for p in part], pa.binary()),
                    batch.column("node"),
                    short,
                ],
                names=["tree", "order", "node", "short"],
            )


#: Number of equal 4-bit halves of two bytes, by their exclusive or.
_HALVES = np.array([(x < 16) + (x % 16 == 0) for x in range(256)], dtype="uint8")


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[int]:
    """Joins the labels of pairs; the places of the pairs that joined something."""
    parent = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    useful = []
    for place, (x, y) in enumerate(zip(label[a].tolist(), label[b].tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            useful.append(place)
    if useful:
        heads = np.arange(len(label))
        for x in parent:
            heads[x] = root(x)
        label[:] = heads[label]
    return useful


def _regions(tree: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Number of each row's region: its tree and the first values of its order."""
    region = tree.astype("int64") << 48
    for i in range(LEAST_DEPTH):
        region = region | lead[:, i].astype("int64") << 16 * i
    return region


def _neighbours(reach: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spanning pairs (a, b) of the candidates in sorted rows, and marks of regions.

    Rows are held a window at a time. A region is marked with 2 if some of its
    rows are further apart than ``reach``, and with 1 by each task whose rows
    begin or end with it.
    """

    def found(a: np.ndarray, b: np.ndarray, tree: np.ndarray) -> pa.RecordBatch:
        return _marked(a, b, [None] * len(a), [None] * len(a), tree)

    def marks(regions: list[int], mark: int) -> pa.RecordBatch:
        none = [None] * len(regions)
        return _marked(none, none, regions, [mark] * len(regions), none)

    def _marked(*columns) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array(c, pa.int64()) for c in columns], names=["a", "b", "region", "mark", "tree"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[np.ndarray, ...] | None = None
        begin = end = last = None
        for batch in batches:
            for start in range(0, batch.num_rows, 8192):
                part = batch.slice(start, 8192)
                raw = np.frombuffer(b"".join(part.column("order").to_pylist()), dtype=">u2")
                lead = raw.reshape(-1, DEPTH)[:, :LEAST_DEPTH]
                region = _regions(part.column("tree").to_numpy(), lead)
                begin = int(region[0]) if begin is None else begin
                end = int(region[-1])
                short = np.frombuffer(b"".join(part.column("short").to_pylist()), dtype="uint8")
                tree = part.column("tree").to_numpy()
                now = region, part.column("node").to_numpy(), short.reshape(part.num_rows, -1), tree
                if kept is not None:
                    now = tuple(np.concatenate([k, n]) for k, n in zip(kept, now))
                region, node, short, tree = now
                label = np.arange(len(node))
                alive = np.arange(len(node))
                for step in range(1, reach + 1):
                    alive = alive[alive < len(node) - step]
                    alive = alive[region[alive] == region[alive + step]]
                    if not len(alive):
                        break
                    apart = alive[label[alive] != label[alive + step]]
                    agree = _HALVES[short[apart] ^ short[apart + step]].sum(1)
                    near = apart[agree >= AGREE]
                    useful = near[_union(label, near, near + step)] if len(near) else near
                    yield found(node[useful], node[useful + step], tree[useful])
                far = region[: -reach - 1][region[: -reach - 1] == region[reach + 1 :]]
                dense = [r for r in np.unique(far).tolist() if r != last]
                if dense:
                    last = int(far[-1])
                    yield marks(dense, 2)
                kept = tuple(x[-reach - 1 :] for x in now)
        yield marks(sorted({begin, end} - {None}), 1)

    return run


def _agreeing(left: pa.Table, right: pa.Table) -> pa.Table:
    """Spanning pairs between a block of a region's rows and a block of asking ones."""
    a: list[int] = []
    b: list[int] = []
    if left.num_rows and right.num_rows:
        node, asking = left.column("node").to_numpy(), right.column("node").to_numpy()
        held, asked = (
            np.frombuffer(b"".join(t.column("short").to_pylist()), dtype="uint64").reshape(
                t.num_rows, -1
            )
            for t in (left, right)
        )
        held = np.ascontiguousarray(held.T)
        families = np.concatenate([t.column("family").to_numpy() for t in (left, right)])
        every, place = np.unique(families, return_inverse=True)
        label = np.arange(len(every))
        own, asks = place[: len(node)], place[len(node) :]
        ones = np.uint64(0x1111111111111111)
        for i in range(len(asking)):
            differ = np.zeros(len(node), dtype="uint8")
            for column, value in zip(held, asked[i]):
                x = column ^ value
                x |= x >> np.uint64(1)
                x |= x >> np.uint64(2)
                x &= ones
                differ += np.bitwise_count(x)
            near = np.flatnonzero(differ <= 64 - AGREE)
            near = near[label[own[near]] != label[asks[i]]]
            useful = _union(label, np.full(len(near), asks[i]), own[near]) if len(near) else []
            a += [int(asking[i])] * len(useful)
            b += node[near[useful]].tolist() if len(useful) else []
    return _edges(a, b)


def _loose_pairs(planted: DataFrame, loose: DataFrame, families: DataFrame) -> DataFrame | None:
    """Pairs (a, b) that connect the candidates of whole regions; None if all are connected.

    Every two rows of a region are compared, unless both are in its largest
    family: the rows outside it meet all rows, in blocks.
    """
    kind = "region long, node long, short binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = np.frombuffer(b"".join(batch.column("order").to_pylist()), dtype=">u2")
                lead = raw.reshape(-1, DEPTH)[:, :LEAST_DEPTH]
                region = _regions(batch.column("tree").to_numpy(), lead)
                yield pa.record_batch(
                    [pa.array(region), batch.column("node"), batch.column("short")],
                    names=["region", "node", "short"],
                )

    dense = planted.mapInArrow(releasing(run), kind).join(loose, "region", "left_semi")
    rows = write_through(
        dense.join(families, "node", "left").select(
            "region", "node", "short", F.coalesce("family", "node").alias("family")
        ),
        "near-regions",
    )
    counted = rows.groupBy("region", "family").agg(F.count(F.lit(1)).alias("n"))
    largest = F.max(F.struct("n", "family"))
    sizes = write_through(
        counted.groupBy("region")
        .agg(F.sum("n").alias("n"), largest.alias("top"))
        .where("n > top.n")
        .select(
            "region",
            F.col("top.family").alias("top"),
            F.ceil(F.col("n") / REGION_ROWS).alias("blocks"),
            F.ceil((F.col("n") - F.col("top.n")) / REGION_ROWS).alias("asks"),
        ),
        "near-region-sizes",
    )
    if not sizes.limit(1).count():
        return None
    rows = rows.join(sizes, "region")

    def every(n: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    def part_of(n: str) -> F.Column:
        return F.pmod(F.xxhash64("node"), F.col(n))

    held = rows.withColumn("block", part_of("blocks")).withColumn("ask", every("asks"))
    asked = rows.where("family <> top")
    asked = asked.withColumn("ask", part_of("asks")).withColumn("block", every("blocks"))
    places = ["region", "block", "ask"]
    taken = [*places, "node", "short", "family"]
    return (
        held.select(*taken)
        .groupBy(*places)
        .cogroup(asked.select(*taken).toDF(*taken).groupBy(*places))
        .applyInArrow(_agreeing, "a long, b long")
    )


def candidate_families(nodes: DataFrame) -> DataFrame:
    """(node, family): every node with a candidate in the forest, and its family's smallest node.

    ``nodes`` has node and signature. The first trees connect most of what the
    others find again.
    """
    planted = nodes.select("node", "signature").mapInArrow(
        releasing(_plant), "tree int, order binary, node long, short binary"
    )
    scanned = write_through(
        planted.repartitionByRange("tree", "order", "node")
        .sortWithinPartitions("tree", "order", "node")
        .mapInArrow(releasing(_neighbours(NEIGHBOURS)), "a long, b long, region long, mark long, tree long")
        .groupBy("a", "b", "region")
        .agg(F.sum("mark").alias("mark"), F.min("tree").alias("tree")),
        "near-forest",
    )
    pairs = scanned.where("a is not null").select("a", "b", "tree")
    first = pairs.where(F.col("tree") < FIRST_TREES).select("a", "b")
    rest = pairs.where(F.col("tree") >= FIRST_TREES).select("a", "b")
    families = write_through(
        components_of_both(first, rest).withColumnRenamed("component", "family"), "near-families"
    )
    loose = write_through(scanned.where("mark > 1").select("region"), "near-loose")
    if not loose.limit(1).count():
        return families
    more = _loose_pairs(planted, loose, families)
    if more is None:
        return families
    stars = families.select(F.col("node").alias("a"), F.col("family").alias("b"))
    return components(stars.union(more)).withColumnRenamed("component", "family")


class _Sets:
    """Sets in one place, with their elements numbered."""

    def __init__(self, *groups: list[bytes]):
        arrays = [[np.frombuffer(s, dtype="<u8") for s in g] for g in groups]
        every = np.concatenate([a for g in arrays for a in g] or [np.zeros(0, "u8")])
        self.size, codes = np.unique(every, return_inverse=True)
        self.seen = np.zeros(len(self.size), dtype="int32")
        self.sizes, self.codes, self.first = [], [], []
        at = 0
        for group in arrays:
            sizes = np.array([len(a) for a in group], dtype="int64")
            first = np.concatenate([[0], np.cumsum(sizes)])
            self.sizes.append(sizes)
            self.first.append(first)
            self.codes.append(codes[at : at + first[-1]])
            at += first[-1]

    def linked(self, left: int, i: int, right: int, start: int = 0) -> np.ndarray:
        """Sets from ``start`` on of group ``right`` that are linked to set i of group ``left``."""
        own = self.codes[left][self.first[left][i] : self.first[left][i + 1]]
        self.seen[own] = 1
        first = self.first[right]
        places = self.codes[right][first[start] :]
        both = np.add.reduceat(self.seen[places], first[start:-1] - first[start])
        self.seen[own] = 0
        union = len(own) + self.sizes[right][start:] - both
        return start + np.flatnonzero(100 * both >= SIMILARITY * union)


def _edges(a: list[int], b: list[int]) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _within(table: pa.Table) -> pa.Table:
    """Spanning links of each family of a bucket of small families."""
    table = table.sort_by([("family", "ascending"), ("node", "ascending")])
    family = table.column("family").to_numpy()
    starts = np.flatnonzero(np.r_[True, family[1:] != family[:-1]]) if len(family) else []
    a: list[int] = []
    b: list[int] = []
    for start, end in zip(starts, [*starts[1:], len(family)]):
        node = table.column("node").slice(start, end - start).to_numpy()
        sets = _Sets(table.column("elements").slice(start, end - start).to_pylist())
        label = np.arange(len(node))
        for i in range(len(node) - 1):
            if (label == label[0]).all():
                break
            found = sets.linked(0, i, 0, i + 1)
            found = found[label[found] != label[i]]
            useful = _union(label, np.full(len(found), i), found) if len(found) else []
            a += [int(node[i])] * len(useful)
            b += node[found[useful]].tolist()
    return _edges(a, b)


def _across(left: pa.Table, right: pa.Table) -> pa.Table:
    """Spanning links between a block of members and a block of asking sets."""
    a: list[int] = []
    b: list[int] = []
    if left.num_rows and right.num_rows:
        node, asking = left.column("node").to_numpy(), right.column("node").to_numpy()
        sets = _Sets(left.column("elements").to_pylist(), right.column("elements").to_pylist())
        every, place = np.unique(np.concatenate([node, asking]), return_inverse=True)
        label = np.arange(len(every))
        held, own = place[: len(node)], place[len(node) :]
        for i in range(len(asking)):
            found = sets.linked(1, i, 0)
            found = found[label[held[found]] != label[own[i]]]
            useful = (
                _union(label, np.full(len(found), own[i]), held[found]) if len(found) else []
            )
            a += [int(asking[i])] * len(useful)
            b += node[found[useful]].tolist()
    return _edges(a, b)


def _ask(members: DataFrame, asking: DataFrame) -> DataFrame:
    """Links between asking members of large families and all members of theirs, in blocks.

    Both have family, blocks, node, elements; the asking rows are cut into
    blocks like the members.
    """
    asks = asking.groupBy("family").agg(
        F.ceil(
            F.greatest(
                F.count(F.lit(1)) / BLOCK_ROWS, F.sum(F.length("elements")) / (8 * BLOCK_SHINGLES)
            )
        ).alias("asks")
    )

    def every(n: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    held = (
        members.join(asks, "family")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("ask", every("asks"))
        .select("family", "block", "ask", "node", "elements")
    )
    asked = (
        asking.join(asks, "family")
        .withColumn("ask", F.pmod(F.xxhash64("node"), F.col("asks")))
        .withColumn("block", every("blocks"))
        .select("family", "block", "ask", "node", "elements")
    )
    places = ["family", "block", "ask"]
    return (
        held.groupBy(*places)
        .cogroup(asked.groupBy(*places))
        .applyInArrow(_across, "a long, b long")
    )


def _elements(docs: DataFrame, members: DataFrame, text: str, key: str) -> DataFrame:
    """Members with their sets, taken from the texts again: adds elements.

    ``members`` has row (key and hash of a text), s1, s2 and more. The texts are
    shuffled by both, at any size, since members grow with the corpus; so rows
    with a null or repeated key meet the members of their own text only.
    """
    extra = [c for c in members.columns if c not in ("row", "s1", "s2")]
    kinds = ", ".join(f"{c} {members.schema[c].dataType.simpleString()}" for c in extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in slices(batches, "text"):
            hashes, first = shingle_sets(words)
            s1, s2 = _set_names(hashes, first)
            right = (s1 == batch.column("s1").to_numpy()) & (s2 == batch.column("s2").to_numpy())
            held = [hashes[x:y].astype("<u8").tobytes() for x, y in zip(first, first[1:])]
            part = pa.record_batch(
                [*(batch.column(c) for c in extra), pa.array(held, pa.binary())],
                names=[*extra, "elements"],
            )
            yield part.filter(pa.array(right))

    mine = F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("mark"))
    rows = docs.select(mine.alias("__row"), F.col(text).alias("text"))
    return (
        rows.hint("shuffle_merge")
        .join(members, F.col("__row").eqNullSafe(F.col("row")))
        .select("text", "s1", "s2", *extra)
        .mapInArrow(releasing(run), f"{kinds}, elements binary")
        .dropDuplicates(["node"])
    )


def _links(docs: DataFrame, nodes: DataFrame, text: str, key: str) -> DataFrame:
    """Confirmed links (a, b) between nodes that connect all linked nodes."""
    families = candidate_families(nodes)
    rows = write_through(families.join(nodes.drop("signature"), "node"), "near-families")
    sizes = rows.groupBy("family").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
        ).alias("blocks")
    )
    members = rows.join(sizes, "family").select(
        "row", "s1", "s2", "family", "blocks", "node", "n_shingles"
    )
    sets = write_through(_elements(docs, members, text, key), "near-sets")
    small = sets.where("blocks = 1")
    buckets = small.agg(F.sum("n_shingles")).first()[0] or 0
    bucket = F.pmod(F.xxhash64("family"), F.lit(1 + buckets // BLOCK_SHINGLES * 4 + buckets // 250_000))
    near = (
        small.select("family", "node", "elements", bucket.alias("bucket"))
        .groupBy("bucket")
        .applyInArrow(_within, "a long, b long")
    )
    large = sets.where("blocks > 1").select("family", "blocks", "node", "elements")
    if not large.limit(1).count():
        return near
    turn = Window.partitionBy("family").orderBy(F.xxhash64("node"), "node")
    hubs = (
        large.select("family", "node")
        .withColumn("turn", F.row_number().over(turn))
        .where(F.col("turn") <= HUBS)
        .select("node")
    )
    asking = write_through(large.join(hubs, "node"), "near-hubs")
    first = write_through(_ask(large, asking), "near-hub-links")
    parts = (
        large.select("family", "node")
        .join(components(first), "node", "left")
        .select("family", "node", F.coalesce("component", "node").alias("component"))
    )
    counted = parts.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n"))
    biggest = counted.groupBy("family").agg(
        F.max_by("component", F.struct("n", "component")).alias("component")
    )
    outside = parts.join(biggest, ["family", "component"], "left_anti").select("node")
    asking = write_through(large.join(outside, "node"), "near-outside")
    return near.union(first).union(_ask(large, asking))


def _judge(docs: DataFrame, text: str, key: str) -> DataFrame:
    """A row per row of ``docs``: key, n_shingles, s1, s2, component_id, first.

    ``first`` tells the rows with the key and the set that stand for their
    component: the smallest key, null last, then the smallest set name. Rows
    without shingles stand for themselves.
    """
    rows = write_through(_sign(docs, text, key), "near-signatures")
    nodes = write_through(
        rows.where("n_shingles > 0")
        .groupBy("s1", "s2", "n_shingles")
        .agg(
            F.min("uid").alias("node"),
            F.min("key").alias("key"),
            F.min_by(F.struct("key", "mark"), "uid").alias("row"),
            F.first("signature").alias("signature"),
        ),
        "near-nodes",
    )
    found = components(write_through(_links(docs, nodes, text, key), "near-links"))
    keys = nodes.select("node", "s1", "s2", "key").join(found, "node", "left")
    keys = keys.withColumn("component", F.coalesce("component", "node"))
    least = F.min(F.struct(F.col("key").isNull().alias("unknown"), "key", "s1", "s2"))
    smallest = keys.groupBy("component").agg(least.alias("best"))
    named = keys.join(smallest, "component").select("s1", "s2", "best")
    filled = F.col("n_shingles") > 0
    return (
        rows.select("key", "n_shingles", "s1", "s2")
        .join(named, ["s1", "s2"], "left")
        .select(
            "key",
            "n_shingles",
            "s1",
            "s2",
            F.when(filled, F.col("best.key")).otherwise(F.col("key")).alias("component_id"),
            F.when(
                filled,
                F.col("key").eqNullSafe(F.col("best.key"))
                & (F.col("s1") == F.col("best.s1"))
                & (F.col("s2") == F.col("best.s2")),
            )
            .otherwise(True)
            .alias("first"),
        )
    )


def near_duplicates(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id, kept.

    ``component_id`` is the smallest key reachable over links, the row's own
    included; ``kept`` is whether it is the row's key. Null, empty and blank
    texts have no shingles and are linked with nothing. Equal texts are linked.
    Rows with one key but different texts are judged each by its text; null
    keys are never a component's id unless all of its keys are null. Other
    columns are not looked at. An empty table gives an empty result.
    """
    return _judge(docs, text, key).select(
        F.col("key").alias(key),
        "n_shingles",
        "component_id",
        F.col("key").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _named(docs: DataFrame, text: str, key: str) -> DataFrame:
    """__row (all columns), key, n_shingles, s1, s2 of every row."""
    body = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(body.alias("__row"), F.col(key).alias("key"), F.col(text).alias("text"))
    schema = rows.drop("text").schema.add("n_shingles", "long").add("s1", "long").add("s2", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in slices(batches, "text"):
            hashes, first = shingle_sets(words)
            names = [pa.array(s) for s in _set_names(hashes, first)]
            yield pa.record_batch(
                [
                    batch.column("__row"),
                    batch.column("key"),
                    pa.array(np.diff(first), pa.int64()),
                    *names,
                ],
                names=["__row", "key", "n_shingles", "s1", "s2"],
            )

    return rows.mapInArrow(releasing(run), schema)


def keep_first(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: one row per group of near duplicates.

    Rows are judged each by its key and its set of shingles. Of a group the row
    with the smallest key stays, null keys last; of several such rows the one
    with the smallest set name, and of copies of that one any. Rows without
    shingles all stay. Keys whose rows share one fate are dropped by key; only
    rows of the others are read again and told apart by their sets.
    """
    judged = write_through(_judge(docs, text, key), "near-result")
    filled = F.col("n_shingles") > 0
    stays = F.count_if("first")
    marks = write_through(
        judged.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            stays.alias("stay"),
            F.count_if(F.col("first") & filled).alias("groups"),
        )
        .where("stay < n or groups > 1")
        .select(F.col("key").alias("__key"), (F.col("stay") > 0).alias("__mixed")),
        "near-marks",
    )
    same_key = F.col(key).eqNullSafe(F.col("__key"))
    plain = docs.join(marks, same_key, "left_anti")
    mixed = marks.where("__mixed")
    if not mixed.limit(1).count():
        return plain
    rows = _named(docs.join(mixed, same_key, "left_semi"), text, key)
    best = judged.where(F.col("first") & filled).select(
        F.col("key").alias("__key"), F.col("s1").alias("__s1"), F.col("s2").alias("__s2")
    )
    one_each = (
        rows.where(filled)
        .join(
            best,
            F.col("key").eqNullSafe(F.col("__key"))
            & (F.col("s1") == F.col("__s1"))
            & (F.col("s2") == F.col("__s2")),
            "left_semi",
        )
        .groupBy("key", "s1", "s2")
        .agg(F.min_by("__row", F.xxhash64(F.col("__row")[text])).alias("__row"))
    )
    told = rows.where(~filled).select("__row").unionByName(one_each.select("__row"))
    return plain.unionByName(told.select("__row.*"))
