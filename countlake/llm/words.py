"""Words and word hashes of many texts at once, in numpy.

A word's hash is a sum over its pieces of eight bytes, each scrambled with its
place, so no arrangement of letters makes two words collide but by chance. Hashes
of runs of words are polynomials modulo 2**64 taken from running sums, so that
any run costs two look-ups; they are scrambled at the end. (Polynomials of this
kind collide by construction only for some runs of over 1,000 words; none are
hashed here that long.)
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from countlake.llm.common import SPACES, pieces

#: Bytes of text worked on at a time, unless one text alone is longer.
CHUNK = 1 << 20
#: Powers kept from call to call, at most.
KEPT_POWERS = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SALT, _STEP = (np.uint64(x) for x in np.random.default_rng(20240601).integers(1, 1 << 63, 2, dtype="uint64") | 1)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True
_LOWER = np.arange(256, dtype="uint8")
_LOWER[65:91] += 32
_powers = [np.ones(1, dtype="uint64"), np.ones(1, dtype="uint64")]


def scramble(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _up_to(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of them."""
    if len(_powers[0]) >= n:
        return _powers
    size = 1 << (n - 1).bit_length()
    found = []
    for base in (_BASE, _UNBASE):
        steps = np.full(size, base, dtype="uint64")
        steps[0] = 1
        found.append(np.cumprod(steps))
    if size <= KEPT_POWERS:
        _powers[:] = found
    return found


class Runs:
    """Hashes of runs of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        up, self.down = _up_to(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype="uint64")
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the runs from ``starts`` up to ``ends``."""
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return scramble(raw + (ends - starts).astype("uint64") * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of some texts: ``first[i]`` to ``first[i + 1]`` are those of text ``i``.

    ``starts`` and ``ends`` are places in ``data``, the bytes of all texts.
    """

    data: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A hash per word; with ``lower``, of the word with A-Z in lower case."""
        sizes = self.ends - self.starts
        if not len(sizes):
            return np.zeros(0, dtype="uint64")
        out = []
        cuts = np.searchsorted(self.ends, np.arange(self.starts[0], self.ends[-1], CHUNK))
        for at, end in zip(cuts, [*cuts[1:], len(sizes)]):
            if at < end:
                out.append(self._hashes(self.starts[at:end], sizes[at:end], lower))
        return np.concatenate(out)

    def _hashes(self, starts: np.ndarray, sizes: np.ndarray, lower: bool) -> np.ndarray:
        first = np.cumsum(sizes) - sizes
        place = np.arange(first[-1] + sizes[-1]) - np.repeat(first, sizes)  # of a byte in its word
        data = self.data[np.repeat(starts, sizes) + place]
        data = (_LOWER[data] if lower else data).astype("uint64")
        inside = (place & 7).astype("uint64")
        heads = np.flatnonzero(inside == 0)  # first bytes of pieces
        pieces_ = np.add.reduceat(data << (inside << np.uint64(3)), heads)
        number = (place[heads] >> 3).astype("uint64")
        mixed = scramble(scramble(pieces_ + _SALT) + (number + np.uint64(1)) * _STEP)
        per_word = (sizes + 7) >> 3
        total = np.add.reduceat(mixed, np.cumsum(per_word) - per_word)
        return scramble(total + sizes.astype("uint64") * np.uint64(0xD6E8FEB86659FD93))


def words_of(texts: pa.Array) -> Words:
    """Words of a string column; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype="int64")
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype="uint8") if held else np.zeros(0, dtype="uint8")
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    word = ~_IS_SPACE[data]
    edge = np.ones(len(data) + 1, dtype=bool)  # a text begins here, or a space is before
    edge[1:-1] = ~word[:-1]
    edge[offsets] = True
    starts = np.flatnonzero(word & edge[:-1])
    edge[:-1] = ~word
    edge[offsets] = True
    edge[-1] = True
    ends = np.flatnonzero(word & edge[1:]) + 1
    return Words(data, np.searchsorted(starts, offsets), starts, ends)


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Bounded slices of the batches with the words of a text column."""
    for batch in pieces(batches, column, limit=CHUNK):
        yield batch, words_of(batch.column(column))
