"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets. Sources share ``epochs`` times all words by weight. A target stops
   at ``max_repeats`` times its source's words; the excess is shared again by
   weight among the rest, which is the level at which the capped shares add up.
2. Blocks. Each source is dealt into blocks of about ``block_docs`` documents by
   a hash. As many whole passes are taken as fit the target, and for the rest
   blocks in permuted order; in the one block per source where the target ends,
   documents that still fit are taken in permuted order.
3. Splitting tree. The exact number of taken blocks of every source is split
   between two halves of the output shards, then within each half, and so on.
   Each split is a draw without replacement (multivariate hypergeometric, source
   by source given the earlier ones) from a seeded hash, so reruns agree.
4. Draw. A source's permuted blocks are cut into disjoint runs as long as the
   quotas of its shards; within a shard documents are ordered by a hash.

Only DataFrame functions are used. Rows of documents meet per-source and
per-block tables; running totals over the blocks of one source are kept in
two steps over hash ranges, so a source with a third of all rows is split too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from countlake.llm.common import word_count
from countlake.session import write_through

#: Fixed value: weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix over words of all sources.
EPOCHS = 1.5
#: A target stops at this many times its source's words.
MAX_REPEATS = 2
BLOCK_DOCS = 1024
SHARDS = 16
#: Tasks that write one shard of the mix.
SLICES = 16
SEED = 17


def _uniform(*columns: Column) -> Column:
    """A number from 0 to below 1 that depends on the columns alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...], epochs: float, max_repeats: int
) -> DataFrame:
    """One row per source: source_no, weight, source_size, docs, target."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", "source_no")
    everything = Window.partitionBy()
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
        .withColumn("source_no", F.row_number().over(by_name))
        .withColumn(
            "weight",
            F.element_at(
                F.array(*[F.lit(float(w)) for w in weights]),
                F.pmod(F.col("source_no") - 1, F.lit(len(weights))).cast("int") + 1,
            ),
        )
        .withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
        .withColumn("room", F.col("cap") / F.col("weight"))
        .withColumn("all_words", F.sum("source_size").over(everything))
    )
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(0, Window.unboundedFollowing)
    level = (
        F.col("all_words") * F.lit(float(epochs)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(after)
    return (
        ranked.withColumn("level", level)
        .withColumn(
            "level", F.max(F.when(F.col("level") <= F.col("room"), F.col("level"))).over(everything)
        )
        .select(
            "source",
            "source_no",
            "source_size",
            "docs",
            F.least(
                F.coalesce(F.col("level") * F.col("weight"), F.col("cap")), F.col("cap")
            ).alias("target"),
        )
    )


def _running(rows: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """Adds the total of ``value`` over the rows of ``key`` that come earlier by ``order``.

    ``order`` is a hash: its leading byte cuts the rows of a key into ranges,
    each summed on its own, and the totals of the ranges are added up.
    """
    rows = rows.withColumn("__range", F.shiftrightunsigned(F.col(order), 56))
    totals = rows.groupBy(key, "__range").agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    inner = (
        Window.partitionBy(key, "__range")
        .orderBy(order, "block", "pass")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = totals.select(
        key, "__range", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start")
    )
    return (
        rows.join(starts, [key, "__range"])
        .withColumn(out, F.col("__start") + F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .drop("__range", "__start")
    )


def hypergeometric(total: Column, marked: Column, drawn: Column, uniform: Column) -> Column:
    """Marked items among ``drawn`` of ``total`` items, by inversion of ``uniform``.

    Terms are summed from the most likely value outwards, 12 standard
    deviations and 8 values to either side; what lies beyond is below 1e-30.
    """
    n, k, m = (c.cast("double") for c in (total, marked, drawn))
    known = F.struct(
        F.floor((m + 1) * (k + 1) / (n + 2)).cast("double").alias("mode"),
        F.sqrt(m * k * (n - k) * (n - m) / (n * n * F.greatest(n - 1, F.lit(1.0)))).alias("sd"),
    )

    def draw(s: Column) -> Column:
        mode, reach = s["mode"], F.ceil(s["sd"] * 12) + 8
        up = F.sequence(
            F.lit(0).cast("long"), F.least(reach, F.least(m, k) - mode).cast("long")
        )
        down = F.sequence(
            F.lit(0).cast("long"),
            F.least(reach, mode - F.greatest(F.lit(0.0), m + k - n)).cast("long"),
        )

        def rise(i: Column) -> Column:  # from mode + i - 1 to mode + i
            x = mode + i - 1
            return (k - x) * (m - x) / ((x + 1) * (n - k - m + x + 1))

        def fall(i: Column) -> Column:  # from mode - i + 1 to mode - i
            x = mode - i + 1
            return x * (n - k - m + x) / ((k - x + 1) * (m - x + 1))

        def walk(steps: Column, ratio, first: float, goal: Column) -> Column:
            start = F.struct(
                F.lit(1.0).alias("w"), F.lit(0.0).alias("s"), F.lit(-1).cast("long").alias("at")
            )

            def step(acc: Column, i: Column) -> Column:
                w = F.when(i == 0, F.lit(1.0)).otherwise(acc["w"] * ratio(i))

                def add(w: Column) -> Column:
                    s = acc["s"] + F.when(i == 0, F.lit(first)).otherwise(w)
                    return F.struct(
                        w.alias("w"),
                        s.alias("s"),
                        F.when((acc["at"] < 0) & (s >= goal), i).otherwise(acc["at"]).alias("at"),
                    )

                return _let(w, add)

            return F.aggregate(steps, start, step)

        never = F.lit(float("inf"))
        sums = F.struct(
            walk(up, rise, 1.0, never)["s"].alias("up"),
            walk(down, fall, 0.0, never)["s"].alias("down"),
        )

        def invert(t: Column) -> Column:
            goal = uniform * (t["up"] + t["down"])
            return F.when(goal <= t["up"], mode + walk(up, rise, 1.0, goal)["at"]).otherwise(
                mode - F.greatest(walk(down, fall, 0.0, goal - t["up"])["at"], F.lit(0))
            )

        return _let(sums, invert)

    trivial = (total <= 0) | (marked <= 0) | (drawn <= 0)
    return (
        F.when(trivial, F.lit(0))
        .when(drawn >= total, marked)
        .otherwise(_let(known, draw))
        .cast("long")
    )


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source_no, quota) to (source_no, shard, quota) down the tree.

    One row per node holds an array with one entry per source.
    """
    nodes = quotas.agg(
        F.array_sort(F.collect_list(F.struct("source_no", "quota"))).alias("held")
    ).select(F.lit(0).alias("first"), F.lit(shards).alias("end"), "held")
    while shards > 1:  # one level of the tree
        shards = (shards + 1) // 2
        middle = F.floor((F.col("first") + F.col("end") + 1) / 2).cast("int")
        total = F.aggregate("held", F.lit(0).cast("long"), lambda a, x: a + x["quota"])
        nodes = nodes.withColumn("middle", middle).withColumn("total", total)
        left = F.floor(
            F.col("total") * (F.col("middle") - F.col("first")) / (F.col("end") - F.col("first"))
        ).cast("long")
        start = F.struct(
            F.col("total").alias("total"),
            left.alias("drawn"),
            F.expr("array() :: array<bigint>").alias("out"),
        )

        def deal(acc: Column, x: Column) -> Column:
            u = _uniform(F.lit(seed), F.col("first"), F.col("end"), x["source_no"])
            got = hypergeometric(acc["total"], x["quota"], acc["drawn"], u)
            return _let(
                got,
                lambda g: F.struct(
                    (acc["total"] - x["quota"]).alias("total"),
                    (acc["drawn"] - g).alias("drawn"),
                    F.concat(acc["out"], F.array(g)).alias("out"),
                ),
            )

        nodes = nodes.withColumn("lefts", F.aggregate("held", start, deal)["out"])

        def half(side: str, first: Column, end: Column) -> Column:
            share = lambda x, n: n if side == "left" else x["quota"] - n
            return F.struct(
                first.alias("first"),
                end.alias("end"),
                F.zip_with(
                    "held",
                    "lefts",
                    lambda x, n: F.struct(
                        x["source_no"].alias("source_no"), share(x, n).alias("quota")
                    ),
                ).alias("held"),
            )

        children = F.array(
            half("left", F.col("first"), F.col("middle")),
            half("right", F.col("middle"), F.col("end")),
        )
        nodes = (
            nodes.select(F.explode(children).alias("node"))
            .select("node.*")
            .where(F.col("first") < F.col("end"))
        )
        nodes = write_through(nodes, "mix-tree")
    return nodes.select(F.col("first").alias("shard"), F.explode("held").alias("x")).select(
        "x.source_no", "shard", "x.quota"
    )


def _identity(docs: DataFrame, text: str, key: str, source: str) -> DataFrame:
    """What tells rows apart: rows equal in all of it are interchangeable."""
    return docs.select(
        F.col(key).alias("id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
    )


def mix(
    docs: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    epochs: float = EPOCHS,
    max_repeats: int = MAX_REPEATS,
    block_docs: int = BLOCK_DOCS,
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: where its copies go.

    Columns: id, source, size (words), text_hash, copy (number among equal
    rows), source_size, target, order_key, placements (array of pass and
    shard; empty if the mix leaves the row out). Every source's taken words
    differ from its target by less than half the smallest document that would
    not fit where its last block ends. Null sources are one source,
    the last; null or blank texts have size 0 and are taken like others. A
    null or repeated key is allowed. An empty table gives an empty result.
    """
    sizes = write_through(_identity(docs, text, key, source), "mix-sizes")
    sources = (
        source_targets(sizes, weights, epochs, max_repeats)
        .withColumn("blocks", F.ceil(F.col("docs") / F.lit(block_docs)).cast("long"))
        .withColumn(
            "passes",
            F.when(
                F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
            ).otherwise(F.lit(0)),
        )
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    )
    sources = write_through(sources, "mix-sources")
    # Equal rows are counted and numbered: a hash can then tell copies apart.
    rows = (
        sizes.groupBy("id", "source", "size", "text_hash")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .drop("copies")
        .withColumn(
            "doc_hash", F.xxhash64(F.lit(seed), F.col("id"), F.col("text_hash"), F.col("copy"))
        )
    )
    own = F.col("source")
    rows = (
        rows.join(
            sources.select(F.col("source").alias("__source"), "source_no", "blocks"),
            own.eqNullSafe(F.col("__source")),
        )
        .withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("doc_hash")), F.col("blocks")))
        .drop("__source", "blocks")
    )
    rows = write_through(rows, "mix-rows")
    blocks = (
        rows.groupBy("source_no", "block")
        .agg(F.sum("size").alias("words"))
        .withColumn("pass", F.lit(-1))
        .withColumn("turn", F.xxhash64(F.lit(seed + 2), F.col("source_no"), F.col("block")))
    )
    limits = sources.select("source_no", "passes", "rest")
    blocks = write_through(
        _running(blocks, "source_no", "turn", "words", "before").join(limits, "source_no"),
        "mix-blocks",
    )
    whole = F.col("before") + F.col("words") <= F.col("rest")
    cut = ~whole & (F.col("before") < F.col("rest"))
    chosen = write_through(
        _fill(rows.join(blocks.where(cut), ["source_no", "block"])), "mix-chosen"
    )
    units = blocks.select(
        "source_no",
        "block",
        F.explode(
            F.concat(
                F.when(
                    F.col("passes") > 0,
                    F.transform(
                        F.sequence(F.lit(0).cast("long"), F.greatest("passes", F.lit(1)) - 1),
                        lambda p: F.struct(p.alias("pass"), F.lit(False).alias("part")),
                    ),
                ).otherwise(F.expr("array() :: array<struct<pass: bigint, part: boolean>>")),
                F.when(
                    whole | cut,
                    F.array(F.struct(F.col("passes").alias("pass"), cut.alias("part"))),
                ).otherwise(F.expr("array() :: array<struct<pass: bigint, part: boolean>>")),
            )
        ).alias("unit"),
    ).select("source_no", "block", "unit.*")
    units = units.withColumn("one", F.lit(1)).withColumn(
        "turn",
        F.xxhash64(F.lit(seed + 3), F.col("source_no"), F.col("block"), F.col("pass")),
    )
    quotas = units.groupBy("source_no").agg(F.count(F.lit(1)).alias("quota"))
    tree = split_quotas(quotas, shards, seed)
    ends = tree.groupBy("source_no").agg(
        F.array_sort(F.collect_list(F.struct("shard", "quota"))).alias("by_shard")
    )
    placed = _running(units, "source_no", "turn", "one", "rank").join(ends, "source_no")
    shard = F.aggregate(
        "by_shard",
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).alias("shard")),
        lambda a, x: F.struct(
            (a["sum"] + x["quota"]).alias("sum"),
            F.when(
                (a["shard"] < 0) & (F.col("rank") < a["sum"] + x["quota"]), x["shard"]
            )
            .otherwise(a["shard"])
            .alias("shard"),
        ),
    )["shard"]
    by_block = (
        placed.withColumn("shard", shard)
        .groupBy("source_no", "block")
        .agg(F.array_sort(F.collect_list(F.struct("pass", "shard", "part"))).alias("units"))
    )
    picks = chosen.select("source_no", "block", "doc_hash", F.lit(True).alias("picked"))
    return (
        rows.join(by_block, ["source_no", "block"], "left")
        .join(picks, ["source_no", "block", "doc_hash"], "left")
        .join(sources.select("source_no", "source_size", "target"), "source_no")
        .select(
            "id",
            "source",
            "size",
            "text_hash",
            "copy",
            "source_size",
            "target",
            F.xxhash64(F.lit(seed + 4), F.col("doc_hash")).alias("order_key"),
            F.transform(
                F.filter(
                    F.coalesce(
                        "units",
                        F.expr(
                            "array() :: array<struct<pass: bigint, shard: int, part: boolean>>"
                        ),
                    ),
                    lambda u: ~u["part"] | F.coalesce("picked", F.lit(False)),
                ),
                lambda u: F.struct(u["pass"].alias("pass"), u["shard"].alias("shard")),
            ).alias("placements"),
        )
    )


def _fill(rows: DataFrame) -> DataFrame:
    """Documents of a source's last block that fit, one after the other in permuted order.

    One document more is taken if that comes nearer to the target. There is
    one such block per source, of about ``block_docs`` documents.
    """
    start = F.struct(
        (F.col("rest") - F.col("before")).alias("left"),
        F.expr("array() :: array<bigint>").alias("taken"),
    )
    fits = F.aggregate(
        "members",
        start,
        lambda a, x: F.when(
            x["size"] <= a["left"],
            F.struct(
                (a["left"] - x["size"]).alias("left"),
                F.concat(a["taken"], F.array(x["doc_hash"])).alias("taken"),
            ),
        ).otherwise(a),
    )

    def nearest(filled: Column) -> Column:
        over = F.filter(
            "members",
            lambda x: (x["size"] < 2 * filled["left"])
            & ~F.array_contains(filled["taken"], x["doc_hash"]),
        )
        by_size = F.transform(over, lambda x: F.struct(x["size"], x["doc_hash"]))
        return F.concat(
            filled["taken"], F.transform(F.slice(F.array_sort(by_size), 1, 1), lambda x: x["doc_hash"])
        )

    return (
        rows.groupBy("source_no", "block", "rest", "before")
        .agg(F.array_sort(F.collect_list(F.struct("doc_hash", "size"))).alias("members"))
        .select("source_no", "block", F.explode(_let(fits, nearest)).alias("doc_hash"))
    )


def draw(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` with all columns, as often as they are taken.

    Rows are spread by shard, then in hash order within a shard. Options are
    those of :func:`mix`. Rows with one key, source, size and text are copies
    of each other to the mix; each of them is drawn with its own other columns.
    """
    text, key, source = (
        options.get(k, d) for k, d in (("text", "text"), ("key", "doc_id"), ("source", "source"))
    )
    def same(id: Column, source: Column, size: Column) -> Column:
        return F.xxhash64(id.isNull(), id, source.isNull(), source, size)

    alike = ["__same", "__text_hash"]
    placed = mix(docs, **options).select(
        same(F.col("id"), F.col("source"), F.col("size")).alias("__same"),
        F.col("text_hash").alias("__text_hash"),
        F.col("copy").alias("__copy"),
        "order_key",
        F.explode("placements").alias("place"),
    )
    others = F.struct(
        F.col(text).isNull().alias("__null"), *[F.col(f"`{c}`") for c in docs.columns if c != text]
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        same(F.col(key), F.col(source), word_count(F.col(text))).alias("__same"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__text_hash"),
        F.xxhash64(F.to_json(others, {"ignoreNullFields": "false"})).alias("__kind"),
    )
    packed = rows.dropDuplicates([*alike, "__kind"])
    # Rows equal in all columns take as many of the mix's copies as they are.
    before = Window.partitionBy(*alike).orderBy("__kind").rowsBetween(Window.unboundedPreceding, -1)
    numbers = (
        rows.groupBy(*alike, "__kind")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0).cast("long")))
        .select(
            *alike,
            "__kind",
            F.explode(F.sequence(F.col("__before") + 1, F.col("__before") + F.col("__n"))).alias("__copy"),
        )
    )
    taken = placed.join(numbers, [*alike, "__copy"]).select(*alike, "__kind", "order_key", "place")
    return (
        packed.join(taken, [*alike, "__kind"])
        .select("__row", "order_key", "place")
        .withColumn("order_key", F.xxhash64("order_key", "place.pass"))
        .repartition("place.shard", F.pmod("order_key", F.lit(SLICES)))
        .sortWithinPartitions("place.shard", "order_key")
        .select("__row.*")
    )
