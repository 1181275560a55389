"""Words and word runs of many texts as numpy arrays, and a table that interns them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: bytes of text worked on at once; a longer document is cut between words
PIECE = 1 << 21

# Primes of the 64-bit xxHash
P1, P2, P3, P4, P5 = (
    np.uint64(p)
    for p in (
        11400714785074694791,
        14029467366897019727,
        1609587929392839161,
        9650029242287828579,
        2870177450012600261,
    )
)
_TAIL = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)
_KEEP = np.zeros(256, np.uint8)
_KEEP[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = 1
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8), at


def pieces(data: np.ndarray, at: np.ndarray, piece: int = PIECE) -> Iterator[tuple[int, list[int]]]:
    """``(first row, offsets)`` of rows of about ``piece`` bytes; a longer row is alone."""
    first = 0
    while first < len(at) - 1:
        last = int(np.searchsorted(at, at[first] + piece, "right")) - 1
        last = max(last, first + 1)
        yield first, at[first : last + 1]
        first = last


def _lanes(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one number; ``buffer`` has eight spare bytes."""
    return np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def hashes(buffer: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of the slices of ``buffer``, which has eight spare bytes."""
    lanes = _lanes(buffer)
    out = P5 + length.astype(np.uint64)
    at = start.copy()
    for k in range(1, 4):
        some = np.flatnonzero(length >= 8 * k)
        if len(some):
            mixed = _turn(lanes[at[some]] * P2, 31) * P1
            out[some] = _turn(out[some] ^ mixed, 27) * P1 + P4
            at[some] += 8
    some = np.flatnonzero(length & 4)
    if len(some):
        mixed = (lanes[at[some]] & _TAIL[4]) * P1
        out[some] = _turn(out[some] ^ mixed, 23) * P2 + P3
        at[some] += 4
    for k in range(1, 4):
        some = np.flatnonzero((length & 3) >= k)
        if len(some):
            out[some] = _turn(out[some] ^ (buffer[at[some]].astype(np.uint64) * P5), 11) * P1
            at[some] += 1
    out ^= out >> np.uint64(33)
    out *= P2
    out ^= out >> np.uint64(29)
    out *= P3
    out ^= out >> np.uint64(32)
    for i in np.flatnonzero(length >= 32):
        out[i] = xxhash.xxh64_intdigest(buffer[start[i] : start[i] + length[i]].tobytes())
    return out


def same_bytes(buffer: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Where the slices of equal length from ``a`` and from ``b`` have equal bytes."""
    lanes = _lanes(buffer)
    out = np.ones(len(a), bool)
    left, at = np.arange(len(a)), 0
    while len(left):
        tail = _TAIL[np.minimum(length[left] - at, 8)]
        equal = ((lanes[a[left] + at] ^ lanes[b[left] + at]) & tail) == 0
        out[left[~equal]] = False
        at += 8
        left = left[equal & (length[left] > at)]
    return out


class Table:
    """Open-addressed table over the slices of one buffer.

    A slot holds the first occurrence of a string; its hash is compared first, then its
    length and bytes, so strings of equal hash get slots of their own. Slots are probed
    one after the other by all occurrences at once. There are at least twice as many
    slots as occurrences, so the table never grows and slot ids stay.
    """

    def __init__(self, buffer: np.ndarray, start: np.ndarray, length: np.ndarray, keys: np.ndarray):
        self.buffer, self.start, self.length, self.keys = buffer, start, length, keys
        size = 1 << max(4, (2 * len(keys) - 1).bit_length())
        self.owner = np.full(size, -1, np.int64)
        self.slots = self._interned(size - 1)
        self.used = np.flatnonzero(self.owner >= 0)
        self.count = np.bincount(self.slots, minlength=size)

    def _interned(self, mask: int) -> np.ndarray:
        """The slot of every occurrence."""
        out = (self.keys & np.uint64(mask)).astype(np.int64)
        left = np.arange(len(out))
        while len(left):
            slot = out[left]
            free = self.owner[slot] < 0
            self.owner[slot[free]] = left[free]
            first = self.owner[slot]
            same = (self.keys[first] == self.keys[left]) & (self.length[first] == self.length[left])
            look = np.flatnonzero(same & (first != left))
            a, b = first[look], left[look]
            same[look] = same_bytes(self.buffer, self.start[a], self.start[b], self.length[b])
            left = left[~same]
            out[left] = (out[left] + 1) & mask
        return out

    def strings(self) -> Iterator[bytes]:
        """The string of each used slot."""
        for i in self.owner[self.used]:
            yield self.buffer[self.start[i] : self.start[i] + self.length[i]].tobytes()


def split_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the rows ``data[at[i]:at[i + 1]]`` with A-Z lowered.

    Returns a buffer with the words and one space after each, their starts and lengths
    in it, and their rows. Words are runs of bytes other than ASCII punctuation, space and
    control characters, so a character above ASCII is part of a word.
    """
    sizes = np.diff(at)
    # a zero byte after each row keeps the words of rows apart
    spread = np.zeros(int(at[-1] - at[0]) + len(sizes), np.uint8)
    row = np.repeat(np.arange(len(sizes)), sizes)
    spread[np.arange(len(row)) + row] = _FOLD[data[at[0] : at[-1]]]
    inside = _KEEP[spread].astype(bool)
    before = np.r_[False, inside[:-1]]
    kept = inside | before
    buffer = np.zeros(int(np.count_nonzero(kept)) + 8, np.uint8)
    buffer[:-8] = np.where(inside, spread, 32)[kept]
    place = np.cumsum(kept) - 1
    begins = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(before & ~inside)
    start = place[begins]
    lengths = place[ends] - start
    ends_of_rows = np.cumsum(sizes + 1)
    return buffer, start, lengths, np.searchsorted(ends_of_rows, begins, "right")


def cut_long(data: np.ndarray, begin: int, end: int, piece: int = PIECE) -> Iterator[np.ndarray]:
    """Offsets of parts of one row, each about ``piece`` bytes and cut between words."""
    while end - begin > piece:
        cut = begin + piece
        while cut < end:
            gaps = np.flatnonzero(_KEEP[_FOLD[data[cut : min(end, cut + 65536)]]] == 0)
            if len(gaps):
                cut += int(gaps[0])
                break
            cut = min(end, cut + 65536)
        yield np.array([begin, cut])
        begin = cut
    yield np.array([begin, end])
