"""Suffix order of many short segments by induced sorting with disk-backed queues.

The text is the segments, each closed by the sentinel 0. Suffixes are of type L (larger
than their successor) or S. Leftmost S suffixes are ranked first; the other suffixes
follow by induction: their order is that of their successors. A queue for each symbol
takes the suffixes to come, in order, and is emptied when the symbol's turn comes, so
the queues together are a priority queue over (symbol, order of arrival). Beyond a
budget they go on in a file.
"""

from __future__ import annotations

import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

#: bytes of queued suffixes held in memory
MEMORY = 64 << 20
#: suffixes that are induced from at once
BLOCK = 1 << 20


class Queues:
    """First-in-first-out queues of suffix positions, one for each symbol."""

    def __init__(self, symbols: int, memory: int = MEMORY):
        self.parts: list[deque] = [deque() for _ in range(symbols)]
        self.memory, self.held, self.file = memory, 0, None

    def push(self, symbols: np.ndarray, values: np.ndarray):
        """Append each value to the queue of its symbol, in the order given."""
        if not len(values):
            return
        order = np.argsort(symbols, kind="stable")
        symbols, values = symbols[order], values[order]
        starts = [0, *(np.flatnonzero(symbols[1:] != symbols[:-1]) + 1).tolist()]
        for s, a, b in zip(symbols[starts].tolist(), starts, [*starts[1:], len(values)]):
            part = values[a:b]
            if self.held + part.nbytes > self.memory:
                if self.file is None:
                    self.file = tempfile.TemporaryFile()
                self.file.seek(0, 2)
                part = (self.file.tell(), len(part), self.file.write(part.tobytes()))[:2]
            else:
                self.held += part.nbytes
            self.parts[s].append(part)

    def _read(self, part) -> np.ndarray:
        if isinstance(part, np.ndarray):
            self.held -= part.nbytes
            return part
        self.file.seek(part[0])
        return np.frombuffer(self.file.read(8 * part[1]), np.int64)

    def drain(self, symbol: int) -> Iterator[np.ndarray]:
        """A queue in order, in large blocks, also what arrives meanwhile."""
        parts = self.parts[symbol]
        while parts:
            block, size = [], 0
            while parts and size < BLOCK:
                block.append(self._read(parts.popleft()))
                size += len(block[-1])
            yield block[0] if len(block) == 1 else np.concatenate(block)

    def close(self):
        if self.file is not None:
            self.file.close()


def types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is of type S; the text ends with the sentinel."""
    n = len(text)
    differs = np.r_[text[1:] != text[:-1], True]
    smaller = np.r_[text[:-1] < text[1:], True] | (text == 0)
    at = np.where(differs | (text == 0), np.arange(n), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]  # next place that decides
    return smaller[nearest]


def _rank_leftmost(text: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The leftmost S positions ``low`` in the order of their suffixes.

    Each is named by its first symbols up to the next one, and names are joined with
    those that follow, twice as many each round, until every name is decided within its
    segment.
    """
    m = len(low)
    following = np.r_[low[1:], len(text)]
    closing = text[low] == 0
    size = np.where(closing, 1, following - low + 1)
    name = np.zeros(m, np.int64)
    # six symbols at a time; one that has ended stops at a suffix of type S, while a
    # longer one with the same symbols goes on with type L there, which is smaller
    for k in range(0, int(size.max()) if m else 0, 6):
        word = np.zeros(m, np.int64)
        for j in range(k, k + 6):
            symbol = text[np.minimum(low + j, len(text) - 1)].astype(np.int64)
            word = (word << 9) | np.where(size > j, symbol, 300)
        if k:
            word = np.unique(word, return_inverse=True)[1]
        _, name = np.unique(name * (m + 1) + word if k else word, return_inverse=True)
    segment = np.cumsum(np.r_[0, closing[:-1]]) if m else name
    step = 1
    while step < m:
        other = np.full(m, -1, np.int64)
        inside = segment[step:] == segment[:-step]
        other[:-step][inside] = name[step:][inside]
        _, new = np.unique(name * (m + 2) + other + 1, return_inverse=True)
        if not inside.any() or new.max() == name.max():
            name = new
            break
        name, step = new, 2 * step
    return low[np.argsort(name, kind="stable")]


def suffix_order(text: np.ndarray, memory: int = MEMORY) -> Iterator[np.ndarray]:
    """Positions of all suffixes in order, in blocks.

    ``text`` holds symbols from 0 to 256 and ends with the sentinel 0, which may also
    stand inside. Suffixes are compared up to their first sentinel; equal ones come in
    any order beside each other.
    """
    n = len(text)
    if not n:
        return
    is_s = types(text)
    low = np.flatnonzero(is_s & np.r_[True, ~is_s[:-1]] | (text == 0))
    seeds = _rank_leftmost(text, low)
    symbols = int(text.max()) + 1
    seed_of = text[seeds]
    cuts = np.searchsorted(seed_of, np.arange(symbols + 1))
    waiting, larger = Queues(symbols, memory), Queues(symbols, memory)
    rising, smaller = Queues(symbols, memory), Queues(symbols, memory)
    try:
        for c in range(symbols):
            for part in waiting.drain(c):
                larger.push(np.full(len(part), c), part)
                _induce(text, is_s, part, False, waiting)
            _induce(text, is_s, seeds[cuts[c] : cuts[c + 1]], False, waiting)
        done = [[] for _ in range(symbols)]
        for c in range(symbols - 1, 0, -1):
            for part in rising.drain(c):
                smaller.push(np.full(len(part), c), part)
                _induce(text, is_s, part, True, rising)
            done[c] = list(larger.drain(c))
            for part in reversed(done[c]):
                _induce(text, is_s, part[::-1], True, rising)
            for part in done[c]:
                larger.push(np.full(len(part), c), part)
            done[c] = None
        yield seeds[cuts[0] : cuts[1]]
        for c in range(1, symbols):
            yield from larger.drain(c)
            for part in reversed(list(smaller.drain(c))):
                yield part[::-1]
    finally:
        for q in (waiting, larger, rising, smaller):
            q.close()


def _induce(text, is_s, part, to_s: bool, queue: Queues):
    """Queue the predecessors of ``part`` that are of the type to be induced."""
    before = part[part > 0] - 1
    before = before[(is_s[before] == to_s) & (text[before] > 0)]
    queue.push(text[before].astype(np.int64), before)
