"""Words of texts as hashed feature buckets, by an Aho-Corasick dictionary of payloads.

The dictionary holds distinct words between two delimiters, `` word ``, each
with the CRC-32 and the length of its bytes as payload. One scan of the
automaton over a text gives the payloads of its words in order. A word that the
dictionary does not hold shows as a gap between payloads: its CRC is taken
directly, and it joins the dictionary, which a Python worker keeps from task to
task up to a fixed size. So the dictionary changes the cost only, never a
result. Payloads of neighbouring words compose to the CRC of the words joined
by a space, without looking at their bytes again.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa

from countlake.llm.common import pieces

#: Characters of words in a worker's dictionary; about 20 bytes of memory each.
DICTIONARY_CHARS = 2_000_000
#: Longer words are hashed each time they come.
WORD_CHARS = 64
#: Bytes of text scanned at a time, unless one text alone is longer.
SCANNED_BYTES = 1 << 20

#: Fixed value: the polynomial of CRC-32, lowest power first.
_POLYNOMIAL = 0xEDB88320
_SPACE = 0x20


def _word_table() -> bytes:
    """Maps A-Z to a-z and other ASCII but digits and letters to a space; the rest stays."""
    return bytes(
        b if b >= 0x80 or chr(b).isalnum() else _SPACE for b in bytes(range(256)).lower()
    )


_TABLE = _word_table()


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of CRC polynomials, as unsigned 64-bit values below 2**32."""
    a, b = np.broadcast_arrays(a, b)
    b, product = b.copy(), np.zeros(a.shape, dtype="uint64")
    one, low = np.uint64(1), np.uint64(_POLYNOMIAL)
    for power in range(31, -1, -1):
        product ^= b * ((a >> np.uint64(power)) & one)
        b = (b >> one) ^ (low * (b & one))
    return product


@cache
def _shift(size: int) -> int:
    """The polynomial that a CRC is multiplied with when ``size`` bytes follow."""
    result, square = np.uint64(1 << 31), np.uint64(1 << 23)  # 1, and x**8 for one byte
    while size:
        if size & 1:
            result = _times(result, square)[()]
        square = _times(square, square)[()]
        size >>= 1
    return int(result)


def _followed_by(left: np.ndarray, right: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRCs of left and right bytes together; ``sizes`` are those of the right ones."""
    distinct, place = np.unique(sizes, return_inverse=True)
    shifts = np.array([_shift(int(n)) for n in distinct], dtype="uint64")
    return _times(left, shifts[place]) ^ right


class Dictionary:
    """Words with their payloads (CRC-32, and length above it), found by one automaton."""

    def __init__(self, chars: int = DICTIONARY_CHARS):
        self.chars = chars
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)  # ints of 32 bits: places in
        self.table = np.zeros(0, dtype="int64")  # the table of payloads
        self.held = 0
        self.waiting: dict[bytes, int] = {}

    def _learn(self) -> None:
        """Takes the waiting words up once they are as many as the words held."""
        if not self.waiting or len(self.waiting) < len(self.automaton) // 2:
            return
        for place, word in enumerate(self.waiting, len(self.table)):
            self.automaton.add_word(f" {word.decode('latin-1')} ", place)
        self.automaton.make_automaton()
        self.table = np.append(self.table, np.fromiter(self.waiting.values(), "int64"))
        self.waiting = {}

    def payloads(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Payloads of the words from ``starts`` to ``ends`` of ``data``, in order."""
        found = np.zeros(len(starts), dtype="int64")
        if len(self.automaton):
            hits = np.fromiter(
                itertools.chain.from_iterable(self.automaton.iter(data.decode("latin-1"))), "int64"
            ).reshape(-1, 2)
            found[np.searchsorted(ends, hits[:, 0])] = self.table[hits[:, 1]]
        gaps = np.flatnonzero(found == 0)  # a payload holds a length, so it is never 0
        met: dict[bytes, int] = {}
        for i, start, end in zip(gaps.tolist(), starts[gaps].tolist(), ends[gaps].tolist()):
            word = data[start:end]
            payload = met.get(word) or self.waiting.get(word)
            if payload is None:
                payload = zlib.crc32(word) | len(word) << 32
                if len(word) <= WORD_CHARS and self.held + len(word) <= self.chars:
                    self.waiting[word] = payload
                    self.held += len(word)
                else:
                    met[word] = payload
            found[i] = payload
        self._learn()
        return found


@cache
def _worker_dictionary() -> Dictionary:
    return Dictionary()


def _joined(texts: list[str | None]) -> tuple[bytes, np.ndarray]:
    """The texts in the spelling of features, a space before and after each, and where each starts."""
    parts = [(t or "").encode() for t in texts]
    places = np.cumsum([1, *(len(p) + 1 for p in parts)])
    return (b" " + b" ".join(parts) + b" ").translate(_TABLE), places


def features(
    texts: list[str | None], longest: int = 1, dictionary: Dictionary | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(crc, text, n_words): the CRC-32 of every feature, the number of its text, words per text.

    Features are all runs of 1 to ``longest`` words of a text, repeats counted;
    null counts as a text without words.
    """
    data, places = _joined(texts)
    is_word = np.frombuffer(data, dtype="uint8") != _SPACE
    edges = np.flatnonzero(is_word[1:] != is_word[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    first = np.searchsorted(starts, places)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    payloads = (dictionary or _worker_dictionary()).payloads(data, starts, ends)
    sizes = payloads >> 32
    words = (payloads & 0xFFFFFFFF).astype("uint64")
    crcs, owners, run = [words], [text], words
    if longest > 1:
        spaced = _followed_by(np.uint64(zlib.crc32(b" ")), words, sizes)
    for n in range(2, longest + 1):
        run = _followed_by(run[:-1], spaced[n - 1 :], sizes[n - 1 :] + 1)
        inside = text[: len(run)] == text[n - 1 :]
        crcs.append(run[inside])
        owners.append(text[: len(run)][inside])
    return np.concatenate(crcs), np.concatenate(owners), np.diff(first)


def scanned(
    batches: Iterator[pa.RecordBatch], column: str, longest: int, buckets: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of the batches with (bucket, row, words per row) of the text column's features."""
    for piece in pieces(batches, column, SCANNED_BYTES):
        crc, row, n_words = features(piece.column(column).to_pylist(), longest)
        yield piece, (crc % np.uint64(buckets)).astype("int64"), row, n_words
