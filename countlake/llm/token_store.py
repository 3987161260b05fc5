"""Token ids as Parquet list columns, in key order, for selective reads.

Each row is one document: ``ids`` (list of int), ``n_tokens``, the key, and its
place (``part``, ``start_in_part``). Ids are dictionary encoded (a vocabulary
of 49,000 ids fits the dictionary page, 16 bits an id), keys and places are
delta encoded (writer version 2), row groups and pages have a set size, and
the writer adds column and offset indexes: a read of the places alone touches
no ids, and a filter on the key reads only the row groups and pages it needs.

Texts are shuffled once, by ranges of the key, before they are encoded; ties
of the key are spread over ranges by a hash of the text. Positions are running
sums within a part, and the sums of the parts are added on reading.
"""

from __future__ import annotations

import json
import string
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from countlake.llm.common import pieces

#: Appended to each document.
END_ID = 2
ROW_GROUP_BYTES = 32 << 20
PAGE_ROWS = 2000
#: Words remembered by a Python worker from its last texts, and as many from those before.
REMEMBERED = 250_000
#: Words given to the tokenizer at a time.
TOGETHER = 2000
#: Marks that a word of letters may end in, how many of them at most, and how many endings are remembered.
_MARKS = string.punctuation.encode()
_LONGEST_TAIL = 4
_TAILS_REMEMBERED = 10_000
#: Below it letters are Latin, and the same in all versions of Unicode in use.
_LATIN_END = "\u0250"


def _plain(text: str) -> str:
    """The text in lower case if it has no character that could join with others."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


def _stay_letters(run: str) -> bool:
    """Whether a run is of letters, and remains so when it is normalised and in lower case."""
    return run.isalpha() and unicodedata.is_normalized("NFC", run) and run.lower().isalpha()


def _latin(word: bytes) -> bool:
    """Whether a word is of Latin letters, and remains so when it is normalised and in lower case."""
    if not word or word.isascii():
        return False
    letters = word.decode()
    return max(letters) < _LATIN_END and _stay_letters(letters)


class WordCoder:
    """Ids of words as little-endian bytes, remembered in two generations.

    The vocabulary drops white space and no token, normalisation or split
    reaches across it, so a text's ids are those of its words in a row. New
    words go to the tokenizer together:

    * words of letters are encoded in one text: the tokenizer makes one part of
      each, which ends in the only token of it that ends a word.
    * of words of Latin letters and some ASCII marks after them, the letters are
      encoded so, and the marks once; an ending that the tokenizer does not
      treat as a part of its own is left to the next.
    * other words are encoded with a special token between them, across which
      nothing reaches either; those in which it could begin go alone.

    Texts of Latin-1 characters go in as lower case, as they come out anyway.
    """

    def __init__(self, definition: bytes):
        self.tokenizer = Tokenizer.from_buffer(definition)
        added = self.tokenizer.get_added_tokens_decoder()
        self.mark = next((i for i, t in added.items() if t.special and not t.normalized), None)
        self.between = added[self.mark].content if self.mark is not None else ""
        suffix = json.loads(definition)["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.tails: dict[bytes, bytes | None] = {}
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(found, dtype="<u4")

    def _tail(self, marks: bytes) -> bytes | None:
        """Ids of marks that follow letters, None if they are no part of their own."""
        if marks not in self.tails:
            if len(self.tails) >= _TAILS_REMEMBERED:
                self.tails.clear()
            own, letter, both = (self._ids(t).tobytes() for t in (marks.decode(), "a", "a" + marks.decode()))
            self.tails[marks] = own if both == letter + own else None
        return self.tails[marks]

    def _letters(self, words: list[bytes], learned: dict[bytes, bytes]) -> None:
        """Learns words that the tokenizer takes for one part each."""
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            ids = self._ids(b" ".join(some).decode())
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                raw, ends = ids.tobytes(), (4 * ends).tolist()
                learned.update(zip(some, [raw[a:b] for a, b in zip([0, *ends], ends)]))
            else:  # the tokenizer knows other letters than Python
                self._others(some, learned)

    def _others(self, words: list[bytes], learned: dict[bytes, bytes]) -> None:
        start = self.between[:1].encode()
        together = [w for w in words if start and start not in w]
        for w in words:
            if not start or start in w:
                learned[w] = self._ids(w.decode()).tobytes()
        for at in range(0, len(together), TOGETHER):
            part = together[at : at + TOGETHER]
            ids = self._ids(self.between.join(w.decode() for w in part))
            marks = np.flatnonzero(ids == self.mark)
            raw = ids.tobytes()
            for w, a, b in zip(part, [0, *(4 * marks + 4).tolist()], [*(4 * marks).tolist(), None]):
                learned[w] = raw[a:b]

    def _learn(self, words: list[bytes]) -> None:
        if not self.ends.any():
            return self._others(words, self.young)
        letters, marked, others = [], [], []
        for w in words:
            if w.isalpha():
                letters.append(w)
                continue
            stem = w.rstrip(_MARKS)
            if 0 < len(w) - len(stem) <= _LONGEST_TAIL and (stem.isalpha() or _latin(stem)):
                tail = self._tail(w[len(stem) :])
                if tail is not None:
                    marked.append((w, stem, tail))
                    continue
            if not w.isascii() and _stay_letters(w.decode()):
                letters.append(w)
            else:
                others.append(w)
        self._letters(letters, self.young)
        self._others(others, self.young)
        stems = {stem: self.young.get(stem) or self.old.get(stem) for _, stem, _ in marked}
        self._letters([stem for stem, ids in stems.items() if not ids], stems)
        self.young.update([(w, stems[stem] + tail) for w, stem, tail in marked])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts; null counts as empty."""
        rows = pc.ascii_split_whitespace(pa.array([_plain(t or "") for t in texts], pa.large_string()))
        coded = rows.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.large_binary()).to_pylist()
        new = []
        for w in set(words).difference(self.young):
            ids = self.old.get(w)
            if ids is None:
                new.append(w)
            else:
                self.young[w] = ids
        self._learn(new)
        learned = [self.young[w] for w in words]
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        # The ids of each distinct word go to all its places.
        sizes = np.array([len(i) // 4 for i in learned], dtype=np.int64)
        which = coded.indices.to_numpy()
        counts = sizes[which]
        ends = np.concatenate([[0], np.cumsum(counts)])
        moved = np.repeat((np.cumsum(sizes) - sizes)[which] - ends[:-1], counts) + np.arange(ends[-1])
        raw = np.frombuffer(b"".join(learned), dtype="<u4")[moved].tobytes()
        cuts = (4 * ends[rows.offsets.to_numpy()]).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def _coder(definition: bytes) -> WordCoder:
    return WordCoder(definition)


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    text: str = "text",
    key: str = "doc_id",
    end_id: int = END_ID,
    partitions: int | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Writes the ids of every whole text, ``end_id`` after each, in ascending key order.

    Null and empty texts give the end id alone; null keys come first; rows
    with one key keep one row each, ordered by a hash of their text. An empty
    table writes an empty one. Other columns are left out.
    """
    spark = docs.sparkSession
    with open(tokenizer, "rb") as file:
        definition = spark.sparkContext.broadcast(file.read())
    end = np.array([end_id], dtype="<u4").tobytes()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(definition.value)
        part, at = TaskContext.get().partitionId(), 0
        for batch in pieces(batches, "text"):
            ids = [i + end for i in coder.encode(batch.column("text").to_pylist())]
            ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype="int64")
            values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
            yield pa.record_batch(
                [
                    batch.column("key"),
                    pa.array(np.full(len(ids), part, dtype="int32")),
                    pa.array(at + ends[:-1]),
                    pa.array(np.diff(ends)),
                    pa.ListArray.from_arrays(pa.array(ends.astype("int32")), values),
                ],
                names=["key", "part", "start_in_part", "n_tokens", "ids"],
            )
            at += int(ends[-1])

    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = (
        rows.repartitionByRange(partitions, *order)
        if partitions
        else rows.repartitionByRange(*order)
    )
    columns = f"key {kind}, part int, start_in_part long, n_tokens long, ids array<int>"
    (
        rows.sortWithinPartitions(*order)
        .mapInArrow(run, columns)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .parquet(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files: key, n_tokens, start (ids of all documents before it), ids.

    Leaving out ``ids`` or filtering on ``key`` reaches the Parquet scan.
    """
    rows = spark.read.parquet(path)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (  # one row per part, as many as the writer was told: at most some thousands
        rows.groupBy("part")
        .agg(F.sum("n_tokens").alias("total"))
        .select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    )
    return rows.join(F.broadcast(parts), "part").select(
        "key", "n_tokens", (F.col("offset") + F.col("start_in_part")).alias("start"), "ids"
    )


def checksums(rows: DataFrame) -> DataFrame:
    """Adds ids_crc32, the CRC-32 of the ids as little-endian unsigned integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            ends = ids.offsets.to_numpy()
            raw = memoryview(ids.values.to_numpy().astype("<i4", copy=False)).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
            yield pa.record_batch(
                [
                    *(batch.column(c) for c in ("key", "start", "n_tokens")),
                    pa.array(sums, pa.int64()),
                ],
                names=["key", "start", "n_tokens", "ids_crc32"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.select("key", "start", "n_tokens", "ids").mapInArrow(
        run, f"key {kind}, start long, n_tokens long, ids_crc32 long"
    )
