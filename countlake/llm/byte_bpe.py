"""Byte-level BPE by backtracking over longest matches, and its inverse.

A text is cut by the vocabulary's pattern and each part is encoded alone. The
bytes of a part are mapped to Latin-1, so that a pyahocorasick automaton over
the vocabulary finds the longest token starting at each byte. From left to
right the longest token is taken that is compatible with the one before it;
where none is, the last token is given up for its next shorter prefix, and its
place is marked so that no place is tried twice. Compatibility of two tokens
(no merge across their border would have come before the merges that made
them) is memoised per pair, so the work is linear in the bytes.

This gives the result of applying the merges in order of rank, for every
vocabulary whose tokens encode to themselves; the others, if there are any, are
found when the vocabulary is loaded and only stand for parts equal to them.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlake.llm.common import pieces, releasing

#: Parts remembered by a Python worker from its last texts, and as many from those before:
#: about 200 bytes each.
REMEMBERED = 80_000
#: Pairs of tokens whose compatibility is remembered, about 130 bytes each.
REMEMBERED_PAIRS = 200_000
#: Longer parts are encoded each time.
REMEMBERED_CHARS = 48


class ByteCoder(dict):
    """Encodes and decodes by one vocabulary; as a dict, part to ids as little-endian bytes."""

    def __init__(self, rank_file: bytes, pattern: str):
        super().__init__()
        self.tokens: dict[int, bytes] = {}
        for line in rank_file.split(b"\n"):
            if line:
                token, rank = line.split()
                self.tokens[int(rank)] = base64.b64decode(token)
        self.ranks = {t: r for r, t in self.tokens.items()}
        self.cut = regex.compile(pattern).findall
        self.split: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.shorter: dict[int, int] = {}
        self.known_pairs: dict[int, bool] = {}
        self.old: dict[str, bytes] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for token, rank in self.ranks.items():
            if len(token) > 1:
                halves = self._halves(token)
                if len(halves) != 2:
                    continue  # no sequence of merges makes this token
                self.split[rank] = halves
                self.joined[halves] = rank
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        reachable = {r for t, r in self.ranks.items() if len(t) == 1 or r in self.split}
        for rank in reachable:
            token = self.tokens[rank]
            for end in range(len(token) - 1, 0, -1):
                prefix = self.ranks.get(token[:end])
                if prefix in reachable:
                    self.shorter[rank] = prefix
                    break

    def _halves(self, token: bytes) -> tuple[int, ...]:
        """Ranks of the parts left when all merges but the last are done."""
        parts = [token[i : i + 1] for i in range(len(token))]
        own = self.ranks[token]
        while len(parts) > 2:
            best = min(
                (self.ranks.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1)
            )
            if best[0] >= own:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return tuple(self.ranks[p] for p in parts)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the tokens can stand side by side in an encoded part."""
        pair = left << 32 | right
        found = self.known_pairs.get(pair)
        if found is None:
            if len(self.known_pairs) >= REMEMBERED_PAIRS:
                self.known_pairs.clear()
            found = self.known_pairs[pair] = self._compatible(left, right)
        return found

    def _compatible(self, left: int, right: int) -> bool:
        # Undo the merges of both tokens, latest first, down to their touching
        # bytes. At each point the border pair must not merge before the merge
        # undone last; on equal rank the leftmost merge comes first.
        limit = len(self.tokens) + 1
        while True:
            merged = self.joined.get((left, right))
            if merged is not None and merged < limit:
                return False
            open_left, open_right = self.split.get(left), self.split.get(right)
            if open_left and (left > right or not open_right):
                limit, left = left, open_left[1]
            elif open_right:
                limit, right = right + 1, open_right[0]
            else:
                return True

    def encode_part(self, part: bytes) -> list[int]:
        whole = self.ranks.get(part)
        if whole is not None:
            return [whole]
        longest: list[tuple[int, int]] = [(0, 0)] * len(part)
        for end, found in self.automaton.iter(part.decode("latin-1")):
            start = end + 1 - found[0]
            if found[0] > longest[start][0]:
                longest[start] = found
        tokens, shorter = self.tokens, self.shorter
        out: list[int] = []
        blocked = bytearray(len(part) + 1)
        at, size = 0, len(part)
        token: int | None = longest[0][1]
        while at < size:
            while token is not None:
                end = at + len(tokens[token])
                if not blocked[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = shorter.get(token)
            if token is not None:
                out.append(token)
                at = end
                token = longest[at][1] if at < size else None
            else:
                blocked[at] = 1
                token = out.pop()
                at -= len(tokens[token])
                token = shorter.get(token)
        return out

    def __missing__(self, part: str) -> bytes:
        ids = self.old.get(part)
        if ids is None:
            ids = array("I", self.encode_part(part.encode())).tobytes()
        if len(part) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, self.cut(text)))

    def forget(self) -> None:
        """Drops what is remembered of texts."""
        self.clear()
        self.old = {}
        self.known_pairs = {}

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def _coder(rank_file: bytes, pattern: str) -> ByteCoder:
    return ByteCoder(rank_file, pattern)


def _vocabulary(docs: DataFrame, path: str):
    """The rank file (under 1 MB for 50,000 tokens), read once and sent to the executors."""
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(
    docs: DataFrame, path: str, pattern: str, *, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per row of ``docs``: key and ids (array of int). Null and empty texts have no ids.

    Texts are encoded whole, in pieces of a batch; nothing is shuffled. Other
    columns are left out, whatever their names; repeated keys stay repeated.
    """
    rank_file = _vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(rank_file.value, pattern)
        for batch in pieces(batches, "text"):
            ids = [coder.encode(t or "") for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype="int32")
            values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
            yield pa.record_batch(
                [batch.column("key"), pa.ListArray.from_arrays(pa.array(ends), values)],
                names=["key", "ids"],
            )
        coder.forget()  # the worker goes on to other stages

    kind = docs.schema[key].dataType.simpleString()
    return (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .mapInArrow(releasing(run), f"key {kind}, ids array<int>")
        .withColumnRenamed("key", key)
    )


def decode(
    tokens: DataFrame, path: str, *, ids: str = "ids", key: str = "doc_id"
) -> DataFrame:
    """One row per row of ``tokens``: key and content (binary). Null ids give empty content."""
    rank_file = _vocabulary(tokens, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(rank_file.value, r"\X")
        for batch in batches:
            content = [
                coder.decode(np.array(i or [], dtype="<u4").tobytes())
                for i in batch.column("ids").to_pylist()
            ]
            yield pa.record_batch(
                [batch.column("key"), pa.array(content, pa.binary())], names=["key", "content"]
            )

    kind = tokens.schema[key].dataType.simpleString()
    return (
        tokens.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
        .mapInArrow(releasing(run), f"key {kind}, content binary")
        .withColumnRenamed("key", key)
    )


def round_trip(
    docs: DataFrame, path: str, pattern: str, *, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Encodes and decodes every text: key, n_tokens, ids_sha256, decoded_sha256.

    The ids stay in the worker that made them. A null text counts as empty.
    """
    rank_file = _vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(rank_file.value, pattern)
        for batch in pieces(batches, "text"):
            sizes, encoded, decoded = [], [], []
            for body in batch.column("text").to_pylist():
                ids = coder.encode(body or "")
                sizes.append(len(ids) // 4)
                encoded.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.record_batch(
                [
                    batch.column("key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(encoded, pa.string()),
                    pa.array(decoded, pa.string()),
                ],
                names=["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    columns = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .mapInArrow(releasing(run), columns)
        .withColumnRenamed("key", key)
    )
