"""Substring duplicates by relative Lempel-Ziv parsing against indexed blocks.

The whole corpus is the reference, cut into blocks by its content. Every window
of ``window`` words contains ``window - GRAM + 1`` runs of GRAM words; the run
with the smallest hash is its anchor. Neighbouring windows with one anchor form
a block: so equal windows, wherever they are, lie at the same place of a block
with the same anchor. Blocks are indexed by anchor.

1. Index: anchors that occur more than once, from counts that are summed up per
   task. All other blocks are done with.
2. Factors: each document is parsed into blocks from left to right, and a block
   whose word sequence occurs again is copied whole from the reference. Runs of
   such blocks are the long factors; their words are duplicates.
3. Factor boundaries: where an anchor has blocks with different words (the ends
   of shared passages), the windows of one block of each kind are compared one
   by one. A window found in a second block is a duplicate.

This finds every window that starts anywhere else, and only those: a match is
a match of an anchor hash and a hash of the words, 128 bits together. No pairs
are made; a passage in a third of all documents is one row per task in the
counts, and joins on it are split by adaptive execution. Documents are moved
compressed, twice; blocks are moved as 32 bytes each, about one for ten words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlake.llm.common import byte_sizes, pieces
from countlake.llm.words import CHUNK, Runs, Words, scramble, slices, words_of
from countlake.session import write_through

WINDOW = 35
#: Words of an anchor.
GRAM = 16


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """For each start, the place of the first smallest of the next ``width`` values."""

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[b] < values[a], b, a)

    best, reach = np.arange(len(values)), 1
    powers = [(best, reach)]
    while 2 * reach <= width:
        best = better(best[: len(best) - reach], best[reach:])
        reach *= 2
        powers.append((best, reach))
    result, covered = powers[-1]
    for best, reach in reversed(powers[:-1]):
        if covered + reach <= width:
            size = len(values) - covered - reach + 1
            result = better(result[:size], best[covered : covered + size])
            covered += reach
    return result


def blocks_of(words: Words, window: int = WINDOW, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Blocks of all texts: text, start (first window, as a word of the text), windows, anchor, phrase.

    ``phrase`` is a hash of the block's words and of the anchor's place in it.
    """
    counts = np.diff(words.first)
    runs = Runs(words.hashes())
    n = len(words.starts)
    if n < window:
        empty = np.zeros(0, dtype="int64")
        return dict.fromkeys(("text", "start", "windows"), empty) | dict.fromkeys(
            ("anchor", "phrase"), empty.astype("uint64")
        )
    at = np.arange(n - gram + 1)
    grams = runs.hash(at, at + gram)
    place = _least(grams, window - gram + 1)
    starts = np.arange(n - window + 1)
    text = np.repeat(np.arange(len(counts)), counts)
    inside = text[starts] == text[starts + window - 1]
    starts, place = starts[inside], place[starts[inside]]
    text = text[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(starts)))
    first, anchor = starts[head], place[head]
    inner = (anchor - first).astype("uint64")
    phrase = runs.hash(first, first + size - 1 + window)
    return {
        "text": text[head],
        "start": first - words.first[text[head]],
        "windows": size,
        "anchor": grams[anchor],
        "phrase": scramble(phrase + inner * np.uint64(0xD1342543DE82EF95)),
    }


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    """key, text and name: a hash of both, by which documents are joined."""
    return docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("name", F.xxhash64(F.col("key").isNull(), "key", "text"))


def _blocks(rows: DataFrame, window: int) -> DataFrame:
    """anchor, phrase, name, start, windows: a row per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in slices(batches, "text"):
            found = blocks_of(words, window)
            yield pa.record_batch(
                [
                    pa.array(found["anchor"].view("int64")),
                    pa.array(found["phrase"].view("int64")),
                    batch.column("name").take(pa.array(found["text"])),
                    pa.array(found["start"].astype("int32")),
                    pa.array(found["windows"].astype("int32")),
                ],
                names=["anchor", "phrase", "name", "start", "windows"],
            )

    return rows.select("name", "text").mapInArrow(
        run, "anchor long, phrase long, name long, start int, windows int"
    )


def _packed(rows: DataFrame) -> DataFrame:
    """The documents with compressed text, to be shuffled."""
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in pieces(batches, "text"):
            held = [pack(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [
                    batch.column("key"),
                    batch.column("name"),
                    pa.array(held, pa.binary()),
                    pa.array(byte_sizes(batch.column("text")), pa.int64()),
                ],
                names=["key", "name", "packed", "plain"],
            )

    return rows.mapInArrow(run, f"key {kind}, name long, packed binary, plain long")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in pieces(batches, "plain", limit=CHUNK):
        texts = pa.array([unpack(p) for p in batch.column("packed").to_pylist()], pa.large_binary())
        yield batch, words_of(texts.cast(pa.large_string()))


def _spans(
    rows: DataFrame, packed: DataFrame, window: int
) -> DataFrame:
    """name and spans: places (start, windows) whose windows are all duplicates."""
    blocks = _blocks(rows, window)
    index = write_through(
        blocks.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("anchor"),
        "substring-index",
    )
    found = write_through(blocks.join(index, "anchor"), "substring-blocks")
    phrases = write_through(
        found.groupBy("anchor", "phrase").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("name", "start", "windows")).alias("one")
        ),
        "substring-phrases",
    )
    factors = (
        found.join(phrases.where("n > 1").select("anchor", "phrase"), ["anchor", "phrase"])
        .select("name", "start", "windows")
    )
    mixed = phrases.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    edges = (
        phrases.join(mixed, "anchor")
        .select("one.name", F.struct("anchor", "one.start", "one.windows", (F.col("n") == 1).alias("single")).alias("edge"))
        .groupBy("name")
        .agg(F.collect_list("edge").alias("edges"))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _unpacked(batches):
            runs = Runs(words.hashes())
            held = batch.column("edges")
            edge = held.flatten()
            per_text = np.diff(held.offsets.to_numpy()[: len(held) + 1])
            text = np.repeat(np.arange(len(held)), per_text)
            size = edge.field("windows").to_numpy()
            which = np.repeat(np.arange(len(size)), size)
            step = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
            start = edge.field("start").to_numpy()[which] + step
            at = words.first[text[which]] + start
            yield pa.record_batch(
                [
                    edge.field("anchor").take(pa.array(which)),
                    pa.array(runs.hash(at, at + window).view("int64")),
                    batch.column("name").take(pa.array(text[which])),
                    pa.array(start.astype("int32")),
                    edge.field("single").take(pa.array(which)),
                ],
                names=["anchor", "words", "name", "start", "single"],
            )

    windows = write_through(
        packed.join(edges, "name")
        .select("name", "packed", "plain", "edges")
        .mapInArrow(compare, "anchor long, words long, name long, start int, single boolean"),
        "substring-windows",
    )
    twice = (
        windows.groupBy("anchor", "words").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    at_edges = (
        windows.where("single")
        .join(twice, ["anchor", "words"])
        .select("name", "start", F.lit(1).alias("windows"))
    )
    return (
        factors.union(at_edges)
        .groupBy("name")
        .agg(F.collect_set(F.struct("start", "windows")).alias("spans"))
    )


def remove_repeats(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", window: int = WINDOW
) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_removed, kept, spans.

    Every word is removed that lies in a window of ``window`` words which also
    starts anywhere else, in the same document included; all copies go.
    ``kept`` is what stays, joined by one space; ``spans`` are the removed
    stretches as (start, end) in words. Null and empty texts have no words;
    texts under ``window`` words lose none. Rows repeated whole are copies of
    each other. Other columns are not looked at. An empty table gives an empty
    result.
    """
    rows = _keyed(docs, text, key)
    packed = _packed(rows)
    spans = _spans(rows, packed, window)
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _unpacked(batches):
            held = batch.column("spans")
            span = held.flatten()
            per_text = np.diff(held.offsets.to_numpy()[: len(held) + 1])
            per_text[held.is_null().to_numpy(zero_copy_only=False)] = 0
            text = np.repeat(np.arange(len(held)), per_text)
            start = words.first[text] + span.field("start").to_numpy()
            change = np.zeros(len(words.starts) + 1, dtype="int32")
            np.add.at(change, start, 1)
            np.add.at(change, start + span.field("windows").to_numpy() + window - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            data = words.data.tobytes()
            kept, removed, places = [], [], []
            for first, end in zip(words.first, words.first[1:]):
                out = gone[first:end]
                stay = np.flatnonzero(~out) + first
                kept.append(
                    b" ".join(
                        data[a:b]
                        for a, b in zip(words.starts[stay].tolist(), words.ends[stay].tolist())
                    )
                )
                removed.append(int(out.sum()))
                turn = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]])))
                places.append([{"start": a, "end": b} for a, b in turn.reshape(-1, 2).tolist()])
            yield pa.record_batch(
                [
                    batch.column("key"),
                    pa.array(np.diff(words.first), pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(places, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                names=["key", "n_words", "n_removed", "kept", "spans"],
            )

    return (
        packed.join(spans, "name", "left")
        .select("key", "packed", "plain", "spans")
        .mapInArrow(
            cut,
            f"key {kind}, n_words long, n_removed long, kept string, "
            "spans array<struct<start: long, end: long>>",
        )
        .withColumnRenamed("key", key)
    )
