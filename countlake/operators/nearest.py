"""Nearest texts by Levenshtein distance, for batches of names in one process.

The texts are sorted and searched as a tree of their beginnings. A state is one
name at one node of the tree, with the column of the distance table that belongs
there, held as bits (Myers, Hyyrö). All states of a round take one letter at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Longest name: one bit a letter.
LONGEST = 64
# Names that are searched together, unless more than so many of their states wait.
NAMES_TOGETHER = 2048
WAITING_TOGETHER = 1 << 20
# States that take a letter together.
STATES_TOGETHER = 1 << 13
# Cells of the table of names by letters.
LETTER_CELLS = 1 << 22

_ONE = np.uint64(1)
_FIRST_BITS = np.array([(1 << n) - 1 for n in range(LONGEST + 1)], dtype=np.uint64)
_LOW = np.int64((1 << 32) - 1)


def letters_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts one after another, and where each text begins and the last one ends."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    codes = np.frombuffer(held, dtype=np.uint8)[ends[0] : ends[-1]] if held else np.zeros(0, np.uint8)
    if not codes.size or codes.max() < 128:
        return codes, ends - ends[0]
    strings = [t.decode("utf-8", "surrogateescape") for t in texts.to_pylist()]
    codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return codes, np.cumsum([0, *map(len, strings)], dtype=np.int64)


class _Spans:
    """The least of any span of values, from those of spans of 1, 2, 4... of them."""

    def __init__(self, values: np.ndarray):
        self.only = int(values[0]) if (values == values[0]).all() else None
        self.rows = [values.astype(np.int32)]
        while self.only is None and (1 << len(self.rows)) <= len(values):
            half = 1 << (len(self.rows) - 1)
            last = self.rows[-1]
            row = last.copy()
            np.minimum(last[:-half], last[half:], out=row[:-half])
            self.rows.append(row)
        self.rows = None if self.only is not None else np.stack(self.rows)

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if self.only is not None:
            return np.full(len(low), self.only, dtype=np.int64)
        size = np.frexp((high - low).astype(np.float64))[1] - 1
        return np.minimum(self.rows[size, low], self.rows[size, high - (1 << size)]).astype(np.int64)


class TextTree:
    """Distinct texts in the order of their bytes.

    A text may stand for all longer ones that begin with it: ``shortest`` and
    ``longest`` then are their least and greatest lengths.
    """

    def __init__(self, texts: pa.Array, shortest: np.ndarray | None = None, longest: np.ndarray | None = None):
        self.texts = texts
        codes, self.begin = letters_of(texts)
        self.size = np.diff(self.begin)
        if codes.dtype == np.uint8:
            self.alphabet, self.letters = np.arange(128), codes
        else:
            self.alphabet = np.unique(codes)
            self.letters = np.searchsorted(self.alphabet, codes).astype(np.int32)
        self.shared = self._shared()
        # Where children of a node begin: positions by the number of letters shared with the text before.
        order = np.argsort(self.shared[1:], kind="stable")
        self.forks = order + 1
        self.fork_keys = (self.shared[1:][order] << 32) | self.forks
        if len(self.size):
            self.least = _Spans(self.size if shortest is None else shortest)
            self.most = _Spans(-(self.size if longest is None else longest))

    def _shared(self) -> np.ndarray:
        """Number of first letters that each text shares with the one before."""
        shared = np.zeros(len(self.size), dtype=np.int64)
        alike, depth = np.arange(1, len(self.size)), 0
        while alike.size:
            alike = alike[(self.size[alike] > depth) & (self.size[alike - 1] > depth)]
            same = self.letters[self.begin[alike] + depth] == self.letters[self.begin[alike - 1] + depth]
            alike, depth = alike[same], depth + 1
            shared[alike] = depth
        return shared

    def children(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of nodes that hold the texts from low to high: per child its parent, low and high.

        Texts that end at a node are its first; they are to be left out before.
        """
        first, count = np.zeros(len(low), dtype=np.int64), np.ones(len(low), dtype=np.int64)
        many = np.flatnonzero(high - low > 1)
        first[many] = np.searchsorted(self.fork_keys, (depth[many] << 32) | low[many], side="right")
        count[many] += np.searchsorted(self.fork_keys, (depth[many] << 32) | high[many], side="left") - first[many]
        parent = np.repeat(np.arange(len(low)), count)
        begun = np.cumsum(count) - count
        nth = np.arange(len(parent)) - begun[parent]
        start = low[parent]
        forked = nth > 0
        start[forked] = self.forks[(first[parent] + nth - 1)[forked]]
        stop = np.empty_like(start)
        stop[:-1] = start[1:]
        stop[begun + count - 1] = high
        return parent, start, stop

    def cover(self, count: int) -> list[tuple[int, int, int]]:
        """About so many nodes (depth, low, high) that together hold all texts, the largest cut first.

        ``depth`` is the number of first letters that all texts of a node share.
        """
        nodes, done = [(0, 0, len(self.size))] if len(self.size) else [], []
        while nodes and len(nodes) + len(done) < count:
            nodes.sort(key=lambda node: node[1] - node[2], reverse=True)
            depth, low, high = nodes.pop()
            if high - low == 1:
                done.append((depth, low, high))
                continue
            depth = max(depth, int(self.shared[low + 1 : high].min()))  # down to where it forks
            if self.size[low] == depth:
                done.append((depth, low, low + 1))
                low += 1
            _, starts, stops = self.children(np.array([low]), np.array([high]), np.array([depth]))
            nodes += [(depth + 1, int(a), int(z)) for a, z in zip(starts, stops)]
        nodes = sorted(nodes + done, key=lambda node: node[1])
        return [(int(min(self.size[low], self.shared[low + 1 : high].min(initial=self.size[low]))), low, high)
                for _, low, high in nodes]

    def search(self, names: pa.Array, most: np.ndarray, every: bool = False, ranks: np.ndarray | None = None):
        """Per name the nearest text (the first of them) within ``most`` edits: name, text, distance.

        With ``every`` all texts within ``most`` edits, of those just so far only
        the first ``ranks``.
        """
        codes, begin = letters_of(names)
        sizes = np.diff(begin)
        if sizes.max(initial=0) > LONGEST:
            raise ValueError(f"names are longer than {LONGEST}")
        limit = (most.astype(np.int64) + (0 if every else 1)) << 32
        if every:
            limit |= ranks
        none_at = limit.copy()
        found = [np.zeros((3, 0), dtype=np.int64)]
        order = np.argsort(sizes, kind="stable")
        done, together = 0, NAMES_TOGETHER
        while done < len(order) and len(self.size):
            some = order[done : done + together]
            at = np.arange(sizes[some].max(initial=0))
            held = at < sizes[some][:, None]
            table = np.where(held, codes[(begin[some][:, None] + at) * held] if codes.size else 0, 0)
            known = np.unique(table[held])
            if len(some) > 1 and len(some) * (len(known) + 1) > LETTER_CELLS:
                together = len(some) // 2
                continue
            places = np.zeros((len(some), len(known) + 1), dtype=np.uint64)
            for i in at:
                rows = np.flatnonzero(held[:, i])
                places[rows, np.searchsorted(known, table[rows, i])] |= _ONE << np.uint64(i)
            # The texts' letters as columns of that table; the last one is for letters of no name.
            column = np.searchsorted(known, self.alphabet)
            column[~np.isin(self.alphabet, known)] = len(known)
            search = _Search(self, sizes[some], places, column, limit[some], every)
            if not search.run():
                limit[some] = search.limit
                together = max(1, len(some) // 4)
                continue
            name, key = search.found()
            new = key < none_at[some[name]]
            found.append(np.stack([some[name], key & _LOW, key >> 32])[:, new])
            done += len(some)
            if search.peak * 4 < WAITING_TOGETHER:
                together = min(2 * together, NAMES_TOGETHER)
        return np.concatenate(found, axis=1)


class _Search:
    """One search of some names in a tree.

    A bound tells what no text below a node can be nearer than; bound and first
    text of a node as one number are its key. A node is followed if its key is
    less than the name's limit, the key of the best text so far.
    """

    def __init__(self, tree: TextTree, sizes: np.ndarray, places: np.ndarray, column: np.ndarray, limit: np.ndarray, every: bool):
        self.tree, self.sizes, self.places, self.column = tree, sizes, places, column
        self.limit, self.every = limit, every
        self.hits: list[np.ndarray] = []
        self.waiting: dict[int, list[list[np.ndarray]]] = {}
        self.held = self.peak = 0

    def bounds(self, name, low, high, depth, vp, vn) -> np.ndarray:
        """Least distance from the name to a text below the node.

        Neighbours in the column differ by one at most, so the least of column
        and difference in length lies where what is left of both can be as long.
        """
        size = self.sizes[name]
        least, most = self.tree.least.least(low, high), -self.tree.most.least(low, high)
        first = np.maximum(size - (most - depth), 0)
        last = np.maximum(size - (least - depth), 0)
        bits = _FIRST_BITS[first]
        value = depth + np.bitwise_count(vp & bits).astype(np.int64) - np.bitwise_count(vn & bits)
        bound = value.copy()
        rows = np.flatnonzero(last > first)
        value = value[rows]
        while rows.size:
            at = first[rows].astype(np.uint64)
            value = value + ((vp[rows] >> at) & _ONE).astype(np.int64) - ((vn[rows] >> at) & _ONE).astype(np.int64)
            bound[rows] = np.minimum(bound[rows], value)
            first[rows] += 1
            more = first[rows] < last[rows]
            rows, value = rows[more], value[more]
        return bound + np.maximum(least - depth - size, 0)

    def expand(self, states: list[np.ndarray]) -> list[np.ndarray]:
        """The states one letter further, of those that can hold something better."""
        name, low, high, depth, vp, vn, _ = states
        tree = self.tree
        ended = tree.size[low] == depth
        if ended.any():
            some = [s[ended] for s in states[:6]]
            bound = self.bounds(some[0], some[1], some[1] + 1, *some[3:])
            self.reached(some[0], (bound << 32) | some[1])
            low = low + ended
            left = low < high
            name, low, high, depth, vp, vn = (s[left] for s in (name, low, high, depth, vp, vn))
        parent, low, high = tree.children(low, high, depth)
        name, depth, vp, vn = name[parent], depth[parent], vp[parent], vn[parent]
        same = self.places[name, self.column[tree.letters[tree.begin[low] + depth]]]
        across = (((same & vp) + vp) ^ vp) | same | vn
        hp = ((vn | ~(across | vp)) << _ONE) | _ONE
        hn = (across & vp) << _ONE
        vp, vn, depth = hn | ~(across | hp), hp & across, depth + 1
        key = (self.bounds(name, low, high, depth, vp, vn) << 32) | low
        return self.better([name, low, high, depth, vp, vn, key])

    def better(self, states: list[np.ndarray]) -> list[np.ndarray]:
        keep = states[-1] < self.limit[states[0]]
        return states if keep.all() else [s[keep] for s in states]

    def reached(self, name: np.ndarray, key: np.ndarray) -> None:
        if self.every:
            keep = key < self.limit[name]
            self.hits.append(np.stack([name[keep], key[keep]]))
        else:
            np.minimum.at(self.limit, name, key)

    def wait(self, states: list[np.ndarray]) -> None:
        self.held += states[0].size
        self.peak = max(self.peak, self.held)
        bound = states[-1] >> 32
        for b in np.unique(bound):
            rows = bound == b
            self.waiting.setdefault(int(b), []).append([s[rows] for s in states])

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        if self.every:
            name, key = np.concatenate([np.zeros((2, 0), dtype=np.int64), *self.hits], axis=1)
            return name, key
        return np.arange(len(self.limit)), self.limit

    def run(self) -> bool:
        """False if too many states wait for this many names."""
        count = len(self.sizes)
        name, zero = np.arange(count), np.zeros(count, dtype=np.int64)
        start = [name, zero, zero + len(self.tree.size), zero, ~np.zeros(count, np.uint64), np.zeros(count, np.uint64)]
        states = self.better([*start, self.bounds(*start) << 32])
        if not self.every:
            # Down to a text that is near each name; what is left beside the way waits.
            while states[0].size:
                states = self.expand(states)
                if not states[0].size:
                    break
                begun = np.flatnonzero(np.diff(states[0], prepend=-1))
                least = np.minimum.reduceat(states[-1], begun)
                first = states[-1] == np.repeat(least, np.diff(begun, append=states[0].size))
                self.wait([s[~first] for s in states])
                states = [s[first] for s in states]
        self.wait(states)
        while self.waiting:
            bound = min(self.waiting)
            if (bound << 32) >= self.limit.max():
                break
            if self.held > WAITING_TOGETHER and count > 1:
                self.forget()
                if self.held > WAITING_TOGETHER:
                    return False
            chunks, held = [], 0
            while self.waiting[bound] and held < STATES_TOGETHER:
                chunk = self.waiting[bound].pop()
                self.held -= chunk[0].size
                chunks.append(self.better(chunk))
                held += chunks[-1][0].size
            if not self.waiting[bound]:
                del self.waiting[bound]
            states = [np.concatenate(s) for s in zip(*chunks)]
            for at in range(0, held, STATES_TOGETHER):
                self.wait(self.expand(self.better([s[at : at + STATES_TOGETHER] for s in states])))
        return True

    def forget(self) -> None:
        """Leaves out waiting states that can't hold something better any more."""
        self.held = 0
        for chunks in self.waiting.values():
            chunks[:] = [self.better(chunk) for chunk in chunks]
            self.held += sum(chunk[0].size for chunk in chunks)
