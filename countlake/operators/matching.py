"""Correction of misspelled names against a dictionary of known names.

The match is the entry with the smallest Levenshtein distance, ties by name.
By default there is no cutoff, so every unknown name gets an entry. Matching
runs once per distinct unknown name, never per reading.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from countlake.functions.parsing import standard_name
from countlake.operators.nearest import LONGEST, TextTree
from countlake.session import path_is_missing, write_through

# A dictionary up to this size is compared as one array inside each name's row.
ARRAY_ENTRIES = 2000
ARRAY_CHARS = 1_000_000

# Beyond it, names up to this length are searched in a tree of the entries.
INDEXED_LENGTH = LONGEST
# So many entries or characters of entries are one block, which one task holds.
BLOCK_ENTRIES = 250_000
BLOCK_CHARS = 8_000_000
# Prefixes that tell what is in a block.
FANOUT = 32
# Names that one task takes at least, while tasks are fewer than shuffle partitions.
TASK_NAMES = 500
# Pairs of names and prefixes that a task gives at a time.
PAIRS_TOGETHER = 1 << 20

# Longer names, up to this length, first look for entries within so many edits.
KEYED_LENGTH = 128
KEYED_DISTANCE = 1
# Keys that a task makes at a time.
KEYS_TOGETHER = 1 << 18


def dictionary_entries(dictionary: DataFrame) -> DataFrame:
    """Known names in the same spelling as the readings: one column ``entry``."""
    entry = standard_name("agency_name").alias("entry")
    return dictionary.select(entry).filter("entry is not null").distinct()


def unmatched_names(readings: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Distinct standardised names that the dictionary does not hold."""
    names = readings.select("agency_name").filter("agency_name is not null").distinct()
    entries = dictionary_entries(dictionary)
    return names.join(entries, names.agency_name == entries.entry, "left_anti")


def _scored(entry: Column) -> Column:
    return F.struct(
        F.levenshtein(F.col("agency_name"), entry).alias("distance"), entry.alias("closest_match")
    )


def _best_of(entries: Column) -> Column:
    return F.array_min(F.transform(entries, _scored))


def _match_in_array(names: DataFrame, entries: DataFrame) -> DataFrame:
    known = entries.agg(F.collect_list("entry").alias("known")).scalar()
    return names.select("agency_name", known.alias("known")).select(
        "agency_name", _best_of(F.col("known")).alias("best")
    )


def _code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the texts, and a table of their characters with one column per text."""
    strings = [t.decode("utf-8", "surrogateescape") for t in texts.to_pylist()]
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if codes.size and codes.max() < 256:
        codes = codes.astype(np.uint8)
    table = np.zeros((len(strings), sizes.max(initial=0)), dtype=codes.dtype)
    table[np.arange(table.shape[1]) < sizes[:, None]] = codes
    return sizes, np.ascontiguousarray(table.T)


def _hashes_without(codes: np.ndarray, removed: int) -> np.ndarray:
    """Hashes of texts of one length (a row of characters each) with up to so many characters removed."""
    count, size = codes.shape
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    power = np.full(size + 1, 0xD6E8FEB86659FD93, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    begun = np.zeros((count, size + 1), dtype=np.uint64)  # of the first 0, 1, 2... characters
    for i in range(size):
        begun[:, i + 1] = begun[:, i] * power[1] + mixed[:, i]

    def between(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return begun[:, stop] - begun[:, start] * power[stop - start]

    # The length takes part, so that no text is like one with a character less.
    found = [begun[:, [size]]]
    if size:
        i = np.arange(size)
        found.append(begun[:, i] * power[size - 1 - i] + between(i + 1, np.full(size, size)))
    if removed > 1 and size > 1:
        i, j = np.triu_indices(size, 1)
        kept = begun[:, i] * power[size - 2 - i] + between(i + 1, j) * power[size - 1 - j]
        found.append(kept + between(j + 1, np.full(len(j), size)))
    return np.concatenate([f + np.uint64(size - less) for less, f in enumerate(found)], axis=1)


def _removal_keys(text: Column, removed: int) -> Column:
    """Hashes of the text with up to ``removed`` characters removed.

    Two texts within so many edits of each other share at least one key.
    """

    def keys(texts: pa.Array) -> pa.Array:
        sizes, table = _code_points(texts)
        counts, parts, places = np.zeros(len(sizes), dtype=np.int64), [], []
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            together = max(1, KEYS_TOGETHER // (1 + int(size) ** removed))
            for at in range(0, len(rows), together):
                some = rows[at : at + together]
                found = np.sort(_hashes_without(table[:size, some].T, removed), axis=1)
                new = np.ones(found.shape, dtype=bool)
                new[:, 1:] = found[:, 1:] != found[:, :-1]
                counts[some] = new.sum(axis=1)
                parts.append(found[new])
                places.append(some)
        # The parts go back to the order of their texts.
        order = np.concatenate(places) if places else np.zeros(0, dtype=np.int64)
        start = np.zeros(len(sizes), dtype=np.int64)
        start[order] = np.cumsum(counts[order]) - counts[order]
        ends = np.concatenate([[0], np.cumsum(counts)])
        move = np.repeat(start - ends[:-1], counts) + np.arange(ends[-1])
        values = (np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64))[move]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.view(np.int64)))

    return F.arrow_udf(keys, ArrayType(LongType()))(text.cast("binary"))


def _match_by_keys(names: DataFrame, entries: DataFrame, distance: int) -> DataFrame:
    """Best entry within ``distance`` edits of names too long for the tree, by an equi-join on removal keys."""
    keyed_names = names.filter(F.length("agency_name") <= KEYED_LENGTH).select(
        "agency_name", F.explode(_removal_keys(F.col("agency_name"), distance)).alias("key")
    )
    sizes = F.length("entry").between(INDEXED_LENGTH - distance, KEYED_LENGTH + distance)
    keyed_entries = entries.filter(sizes).select(
        "entry", F.explode(_removal_keys(F.col("entry"), distance)).alias("key")
    )
    # The keys of a text are many times its size, which the optimizer can't see:
    # both sides are shuffled, never broadcast.
    return (
        keyed_names.hint("shuffle_merge").join(keyed_entries, "key")
        .select("agency_name", _scored(F.col("entry")).alias("best"))
        .filter(F.col("best.distance") <= distance)
        .groupBy("agency_name")
        .agg(F.min("best").alias("best"))
    )


def _match_by_chunks(names: DataFrame, entries: DataFrame, chunk_count: int) -> DataFrame:
    """Exact best entry for names that are very long.

    The dictionary is cut into arrays of bounded size; each name meets each
    array once and keeps one candidate from it. A second key spreads the names
    that meet the same array, so that there are keys for all tasks however few
    the arrays are.
    """
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = max(1, -(-2 * tasks // chunk_count))
    chunks = (
        entries.groupBy(F.pmod(F.xxhash64("entry"), F.lit(chunk_count)).alias("chunk"))
        .agg(F.collect_list("entry").alias("known"))
        .withColumn("spread", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    )
    placed = names.select(
        "agency_name",
        F.pmod(F.xxhash64("agency_name"), F.lit(spread)).cast("int").alias("spread"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunk_count - 1).cast("long"))).alias("chunk"),
    )
    return (
        placed.hint("shuffle_merge").join(chunks, ["chunk", "spread"])
        .select("agency_name", _best_of(F.col("known")).alias("best"))
        .groupBy("agency_name")
        .agg(F.min("best").alias("best"))
    )


def _blocks(entries: DataFrame, count: int) -> DataFrame:
    """The entries in so many blocks (block, entry), each of them the next ones by name."""
    placed = entries.repartitionByRange(count, "entry").sortWithinPartitions("entry")
    return write_through(placed.select(F.spark_partition_id().alias("block"), "entry"), "blocks")


def _block_prefixes(blocks: DataFrame, count: int) -> DataFrame:
    """Per block about FANOUT prefixes (parent) that together begin all its entries.

    ``prefix`` is all that the entries below have in common, ``low`` and
    ``high`` are the lengths of what follows, ``first`` is the block's first entry.
    """

    texts = [(c, pa.binary()) for c in ("parent", "prefix", "first")]
    schema = pa.schema([*texts, *[(c, pa.int32()) for c in ("low", "high", "block")]])

    def beginning(entry: pa.Scalar, size: int) -> bytes:
        return entry.as_py().decode("utf-8", "surrogateescape")[:size].encode("utf-8", "surrogateescape")

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(batch["block"], batch["entry"]) for batch in batches if batch.num_rows]
        if not held:
            return
        block, tree = held[0][0][0].as_py(), TextTree(pa.concat_arrays([entry for _, entry in held]))
        rows = []
        for depth, low, high in tree.cover(FANOUT):
            prefix, sizes = beginning(tree.texts[low], depth), tree.size[low:high] - depth
            rows.append({
                "parent": prefix, "prefix": prefix, "first": tree.texts[0].as_py(),
                "low": int(sizes.min()), "high": int(sizes.max()), "block": block,
            })
        yield pa.RecordBatch.from_pylist(rows, schema)

    placed = blocks.repartitionById(count, F.col("block")).sortWithinPartitions("entry")
    found = placed.select("block", F.col("entry").cast("binary")).mapInArrow(
        prefixes, "parent binary, prefix binary, first binary, low int, high int, block int"
    )
    texts = [F.col(c).cast("string") for c in ("parent", "prefix", "first")]
    return write_through(found.select(*texts, "low", "high", "block"), "prefixes")


def _distances_of_beginnings(name: np.ndarray, prefix: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Levenshtein distances to each prefix from the first 0, 1, 2... characters of its name."""
    held = np.repeat(np.arange(len(name) + 1, dtype=np.int16)[:, None], name.shape[1], axis=1)
    found = held.copy()
    for i, letter in enumerate(prefix, 1):
        row = np.empty_like(held)
        row[0] = i
        np.minimum(held[:-1] + (name != letter), held[1:] + 1, out=row[1:])
        for before, after in zip(row, row[1:]):
            np.minimum(after, before + 1, out=after)
        held = row
        if (ended := depth == i).any():
            found = np.where(ended, held, found)
    return found


@F.arrow_udf(StructType([StructField("bound", IntegerType()), StructField("own", IntegerType())]))
def _least_distances(names: pa.Array, prefixes: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
    """A bound on the distance from the name to every entry with the prefix.

    Some beginning of the name is turned into the prefix (``own`` is the least
    distance of any), and the rest of it differs from what follows at least by
    its length. All pairs of a batch are compared at once.
    """
    size, name = _code_points(names)
    depth, prefix = _code_points(prefixes)
    own = _distances_of_beginnings(name, prefix, depth).astype(np.int32)
    rest = size - np.arange(len(own))[:, None]
    own[rest < 0] = 1 << 20
    follows = np.maximum(low.to_numpy() - rest, rest - high.to_numpy()).clip(0)
    bound = (own + follows).min(axis=0).astype(np.int32)
    return pa.StructArray.from_arrays([pa.array(bound), pa.array(own.min(axis=0))], ["bound", "own"])


def _bounded(held: DataFrame) -> DataFrame:
    """Adds the least distances of the names to what lies below the prefixes they hold."""
    least = _least_distances(
        F.col("agency_name").cast("binary"), F.col("prefix").cast("binary"), F.col("low"), F.col("high")
    )
    return held.withColumn("least", least)


def _below(held: DataFrame, level: DataFrame) -> DataFrame:
    """The prefixes of a level under those that the names hold."""
    return held.withColumnRenamed("prefix", "parent").join(level, "parent").drop("parent")


def _prefix_tree(level: DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The prefixes of all blocks with the least and greatest length of entries that begin so."""
    size = F.length("prefix")
    rows = (
        level.groupBy("parent").agg(F.min(size + F.col("low")).alias("low"), F.max(size + F.col("high")).alias("high"))
        .select(F.col("parent").cast("binary"), "low", "high")
        .collect()
    )
    rows = sorted((bytes(r.parent), r.low, r.high) for r in rows)
    return [r[0] for r in rows], np.array([r[1] for r in rows]), np.array([r[2] for r in rows])


def _with_prefixes(held: DataFrame, known: tuple[list[bytes], np.ndarray, np.ndarray]) -> DataFrame:
    """The names with prefixes that entries near them begin with.

    Names without one to beat (``beat``) get the most promising prefix, others
    all that can begin a nearer entry, or one as near that comes earlier by name.
    """
    parents, shortest, longest = known
    beaten = "beat" in held.columns
    together = max(1, min(1 << 12, PAIRS_TOGETHER // len(parents)))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pa.array(parents, pa.binary())
        tree = TextTree(texts, shortest, longest)
        for batch in batches:
            for at in range(0, batch.num_rows, together):
                part = batch.slice(at, together)
                if beaten:
                    ranks = np.array([bisect_right(parents, b) for b in part["closest_match"].to_pylist()], np.int64)
                    name, found, _ = tree.search(part["agency_name"], part["distance"].to_numpy(), True, ranks)
                else:
                    name, found, _ = tree.search(part["agency_name"], np.full(part.num_rows, 1 << 30))
                columns = [part["agency_name"].take(pa.array(name)), texts.take(pa.array(found))]
                yield pa.RecordBatch.from_arrays(columns, ["agency_name", "prefix"])

    texts = [F.col("agency_name").cast("binary")]
    if beaten:
        closest = F.coalesce("beat.closest_match", F.lit("")).cast("binary")
        texts += [closest.alias("closest_match"), F.col("beat.distance").alias("distance")]
    found = held.select(*texts).mapInArrow(prefixes, "agency_name binary, prefix binary")
    return found.select(*[F.col(c).cast("string") for c in ("agency_name", "prefix")])


def _nearest_in_blocks(held: DataFrame, blocks: DataFrame, names_together: int) -> DataFrame:
    """Best entry of the blocks that the names hold, null if none is within ``most`` edits.

    A task has the entries of one block first, then names that hold it, and
    takes these a batch at a time.
    """
    counts = held.groupBy("block").count().collect()
    share = np.array([-(-row["count"] // names_together) for row in counts], dtype=np.int32)
    tasks = int(share.sum())
    shares = pa.table({
        "block": pa.array([row.block for row in counts], pa.int32()),
        "task": (np.cumsum(share) - share).astype(np.int32), "share": share,
    })
    shares = F.broadcast(held.sparkSession.createDataFrame(shares))
    nth = F.pmod(F.xxhash64("agency_name"), F.col("share")).cast("int")
    own = held.join(shares, "block").select(
        (F.col("task") + nth).alias("task"), F.lit(True).alias("is_name"), F.col("agency_name").alias("text"),
        "block", "most",
    )
    last = F.col("task") + F.col("share") - 1
    known = blocks.join(shares, "block").select(
        F.explode(F.sequence("task", last)).alias("task"), F.lit(False).alias("is_name"), F.col("entry").alias("text"),
        "block", F.lit(None).cast("int").alias("most"),
    )

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, tree = [], None
        for batch in batches:
            after = batch.num_rows - batch["is_name"].true_count
            if after:
                entries.append(batch["text"].slice(0, after))
            names = batch.slice(after)
            if not names.num_rows:
                continue
            if tree is None:
                tree = TextTree(pa.concat_arrays(entries))
            name, found, distance = tree.search(names["text"], names["most"].to_numpy())
            place, least = np.zeros(names.num_rows, np.int64), np.zeros(names.num_rows, np.int32)
            none = np.ones(names.num_rows, dtype=bool)
            place[name], least[name], none[name] = found, distance, False
            columns = [
                names["text"], names["block"], pa.array(least, mask=none),
                tree.texts.take(pa.array(place, mask=none)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["agency_name", "block", "distance", "closest_match"])

    met = own.unionByName(known).repartitionById(max(tasks, 1), F.col("task")).sortWithinPartitions("is_name", "text")
    found = met.select("is_name", F.col("text").cast("binary"), "block", "most").mapInArrow(
        nearest, "agency_name binary, block int, distance int, closest_match binary"
    )
    best = F.struct("distance", F.col("closest_match").cast("string").alias("closest_match"))
    best = F.when(F.col("distance").isNotNull(), best).alias("best")
    return found.select(F.col("agency_name").cast("string"), "block", best)


def _match_by_prefixes(
    names: DataFrame, entries: DataFrame, entry_count: int, chars: int, max_distance: int | None
) -> DataFrame:
    """Exact best entry by branch and bound over prefixes of the entries.

    Blocks of entries are searched as trees. First each name goes to the block
    with the most promising prefix; its best entry there is the one to beat.
    Then it goes to all other blocks with a prefix that can begin a nearer entry,
    or one as near that comes earlier by name. What is compared grows with the
    prefixes near a name, not with the entries.
    """
    count = max(-(-entry_count // BLOCK_ENTRIES), -(-chars // BLOCK_CHARS))
    blocks = _blocks(entries, count)
    level = _block_prefixes(blocks, count)
    known = _prefix_tree(level)
    # What is held is small and what is compared is not, so the sizes of files and
    # shuffles don't tell how many tasks it is worth.
    most = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(most, -(-names.count() // TASK_NAMES)))
    # A task takes names enough to be worth the entries it has to hold.
    together = max(TASK_NAMES, entry_count // count // 4)
    limit = (1 << 30) - 1 if max_distance is None else max_distance

    def spread(held: DataFrame) -> DataFrame:
        return write_through(held.repartition(tasks), "held")

    def best(held: DataFrame) -> DataFrame:
        return write_through(_nearest_in_blocks(held, blocks, together), "nearest")

    held = spread(_below(_with_prefixes(spread(names), known), level).select("agency_name", "block"))
    found = best(held.withColumn("most", F.lit(limit)))
    if count > 1:
        # Without an entry within the limit, any within it is better.
        none = F.struct(F.lit(limit + 1).alias("distance"), F.lit(None).cast("string").alias("closest_match"))
        beat = F.coalesce(F.min("best"), none).alias("beat")
        beat = spread(found.groupBy("agency_name").agg(beat, F.collect_set("block").alias("seen")))
        bound, distance, closest = F.col("least.bound"), F.col("beat.distance"), F.col("beat.closest_match")
        better = (bound < distance) | ((bound == distance) & (F.col("prefix") <= closest))
        others = _below(_with_prefixes(beat, known).join(beat, "agency_name"), level)
        others = _bounded(others.filter(~F.array_contains("seen", F.col("block")))).filter(better)
        most = F.when(F.col("first") <= closest, distance).otherwise(distance - 1).alias("most")
        found = found.unionByName(best(spread(others.select("agency_name", "block", most).distinct())))
    return found.filter("best is not null").groupBy("agency_name").agg(F.min("best").alias("best"))


def closest_match(
    names: DataFrame,
    dictionary: DataFrame,
    max_distance: int | None = None,
    array_entries: int = ARRAY_ENTRIES,
) -> DataFrame:
    """(agency_name, closest_match) for distinct names.

    ``closest_match`` is null for an empty dictionary or when the best entry
    is further than ``max_distance``.
    """
    entries = dictionary_entries(dictionary)
    size = entries.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.length("entry")), F.lit(0)).alias("chars")
    ).first()
    if size.n <= array_entries and size.chars <= ARRAY_CHARS:
        best = _match_in_array(names, entries)
    else:
        entries = write_through(entries, "entries")
        names = write_through(names, "names")
        # Bytes that are no characters count one by one in the tree.
        is_long = (F.length("agency_name") > INDEXED_LENGTH) | (
            ~F.is_valid_utf8("agency_name") & (F.octet_length("agency_name") > INDEXED_LENGTH)
        )
        found = _match_by_prefixes(names.filter(~is_long), entries, size.n, size.chars, max_distance)
        if not (long_names := names.filter(is_long)).isEmpty():
            near = write_through(_match_by_keys(long_names, entries, KEYED_DISTANCE), "near")
            far = long_names.join(near, "agency_name", "left_anti")
            chunk_count = max(-(-size.n // array_entries), -(-size.chars // ARRAY_CHARS))
            found = found.unionByName(near).unionByName(_match_by_chunks(far, entries, chunk_count))
        found = write_through(found, "matched")
        best = names.join(found, "agency_name", "left")
    match = F.col("best.closest_match")
    if max_distance is not None:
        match = F.when(F.col("best.distance") <= max_distance, match)
    return best.select("agency_name", match.alias("closest_match"))


def apply_corrections(readings: DataFrame, corrections: DataFrame) -> DataFrame:
    """Replaces names that have a correction; ``agency_name`` becomes last."""
    others = [c for c in readings.columns if c != "agency_name"]
    fixes = corrections.select("agency_name", "closest_match")
    return readings.join(fixes, "agency_name", "left").select(
        *others, F.coalesce("closest_match", "agency_name").alias("agency_name")
    )


def _fingerprint(dictionary: DataFrame, max_distance: int | None) -> str:
    """Tells one dictionary and cutoff from another."""
    marks = dictionary_entries(dictionary).agg(
        F.count("*"), F.sum(F.xxhash64("entry").cast("decimal(38,0)"))
    )
    return f"{marks.first()}/{max_distance}"


def stored_corrections(
    names: DataFrame, dictionary: DataFrame, max_distance: int | None, path: str
) -> DataFrame:
    """Corrections of ``names``; only names without a stored one are matched, and then stored.

    A change of the dictionary or the cutoff leaves earlier corrections unused.
    """
    spark = names.sparkSession
    mark = _fingerprint(dictionary, max_distance)
    schema = "agency_name string, closest_match string, dictionary string"
    try:
        known = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if not path_is_missing(error):
            raise
        known = spark.createDataFrame([], schema)
    known = known.filter(F.col("dictionary") == mark).select("agency_name", "closest_match")
    unseen = write_through(names.join(known, "agency_name", "left_anti"), "unseen")
    found = write_through(closest_match(unseen, dictionary, max_distance), "matched")
    if not found.isEmpty():
        found.withColumn("dictionary", F.lit(mark)).write.mode("append").parquet(path)
    return known.unionByName(found).distinct()


def correct_names(
    readings: DataFrame,
    dictionary: DataFrame | None,
    max_distance: int | None = None,
    corrections_path: str | None = None,
) -> DataFrame:
    """Readings with unknown names replaced by their closest known name.

    The corrections (one row per distinct unknown name) are written through,
    so the join to the readings broadcasts them only when they are known to be
    small. Without a dictionary the readings are returned unchanged.
    """
    if dictionary is None:
        return readings
    names = unmatched_names(readings, dictionary)
    if corrections_path:
        found = stored_corrections(names, dictionary, max_distance, corrections_path)
    else:
        found = closest_match(names, dictionary, max_distance)
    corrections = write_through(found, "corrections")
    return apply_corrections(readings, corrections)
