"""Removal of long byte strings that an earlier document holds too.

Every string of ``window`` bytes goes to the shard that its minimizer decides (the
smallest hash of its short substrings), so equal strings meet. Neighbouring strings
with one minimizer travel together as a segment. First only the minimizers are counted
over all documents; segments travel where another document has the minimizer too. A
shard puts the suffixes of its segments in order by induced sorting (see ``induced``);
in that order equal strings lie side by side, and all but those of the smallest
document are marked.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkyield.llm.common import texts
from sparkyield.llm.induced import suffix_order

WINDOW = 50
#: bytes of the substrings whose hashes are compared
GRAM = 24
#: bytes of one text that are looked at together
CHUNK = 1 << 20
#: minimizers that a task gathers before it sends them on
ENTRIES = 1_000_000
#: bytes of segments that a task gathers before it sends them on
GATHER = 24 << 20
#: bytes of segments that a shard sorts at once
SORT = 16 << 20
#: bytes of the input for each shard
SHARD_BYTES = 16 << 20
#: stands for a null id: later than any other
NO_ID = (1 << 63) - 1


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of every ``gram`` bytes, joined from hashes of powers of two."""

    def joined(left, right):
        h = left * np.uint64(0x9E3779B97F4A7C15) + right
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        return h

    h, width, out, done = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        if gram & width:
            n = len(data) - done - width + 1
            out = h if out is None else joined(h[:n], out[width : width + n])
            done += width
        if 2 * width > gram:
            return out
        h = joined(h[:-width], h[width:])
        width *= 2


def segments(data: bytes, window: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """First and past-the-last byte of the segments of a text, and their minimizers."""
    mask = np.uint64((1 << 21) - 1)
    for start in range(0, len(data) - window + 1, CHUNK):
        part = np.frombuffer(data, np.uint8, min(CHUNK + window - 1, len(data) - start), start)
        h = gram_hashes(part)
        # hash first, then place: the leftmost of the smallest
        low = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
        span, width = window - GRAM + 1, 1
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
        place = (low & mask).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], len(place)] - 1
        yield first + start, last + start + window, h[place[first]]


class Gathered:
    """Segments of many documents on their way to the shards."""

    def __init__(self, shards: int):
        self.shards = shards
        self.clear()

    def clear(self):
        self.size = 0
        self.seen: dict[bytes, int] = {}
        self.rows: list[list[tuple]] = [[] for _ in range(self.shards)]
        self.marks: list[tuple[int, int, int, int]] = []

    def add(self, doc: int, body: int, data: bytes, wanted: np.ndarray | None = None):
        """Take in a document, all its segments or those with the numbers ``wanted``.

        A segment that a smaller one here holds is marked at once.
        """
        seen, rows, marks = self.seen, self.rows, self.marks
        number = 0
        for first, last, key in segments(data):
            if wanted is not None:
                here = wanted[(wanted >= number) & (wanted < number + len(key))] - number
                number += len(key)
                first, last, key = first[here], last[here], key[here]
            to = (key % np.uint64(self.shards)).tolist()
            for a, b, k, s in zip(first.tolist(), last.tolist(), key.tolist(), to):
                segment = data[a:b]
                other = seen.get(segment)
                if other is not None and other < doc:
                    if marks and marks[-1][0] == doc and marks[-1][1] == body and marks[-1][3] >= a:
                        marks[-1] = (doc, body, marks[-1][2], b)
                    else:
                        marks.append((doc, body, a, b))
                    continue
                seen[segment] = doc
                rows[s].append((k, doc, body, a, segment))
                self.size += b - a

    def blobs(self) -> Iterator[tuple[int, bytes]]:
        """A shard and what it gets; marks travel with any shard."""
        marks = np.array(self.marks, np.int64).reshape(-1, 4)
        for shard, rows in enumerate(self.rows):
            mine = marks[shard :: self.shards]
            if not rows and not len(mine):
                continue
            keys, docs, bodies, starts, data = zip(*rows) if rows else ((), (), (), (), ())
            head = np.array([len(rows), len(mine)], np.int64)
            columns = [
                np.array(keys, np.uint64),
                np.array(docs, np.int64),
                np.array(bodies, np.int64),
                np.array(starts, np.int64),
                np.fromiter(map(len, data), np.int64, len(data)),
                np.ascontiguousarray(mine),
            ]
            raw = head.tobytes() + b"".join(c.tobytes() for c in columns) + b"".join(data)
            yield shard, zstandard.ZstdCompressor(level=3).compress(raw)
        self.clear()


def unpack(blob: bytes) -> tuple[dict[str, np.ndarray], np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    at, out = 16, {}
    for name, kind in (("key", np.uint64), ("doc", np.int64), ("body", np.int64), ("start", np.int64), ("size", np.int64)):
        out[name] = np.frombuffer(raw, kind, n, at)
        at += 8 * n
    marks = np.frombuffer(raw, np.int64, 4 * m, at).reshape(-1, 4)
    out["data"] = np.frombuffer(raw, np.uint8, -1, at + 32 * m)
    return out, marks


def _take(rows: dict[str, np.ndarray], chosen: np.ndarray) -> dict[str, np.ndarray]:
    """Some rows, with their bytes."""
    ends = np.cumsum(rows["size"])
    size = rows["size"][chosen]
    new = np.cumsum(size)
    total = int(new[-1]) if len(new) else 0
    at = np.arange(total) + np.repeat(ends[chosen] - rows["size"][chosen] - (new - size), size)
    out = {k: rows[k][chosen] for k in ("key", "doc", "body", "start", "size")}
    return out | {"data": rows["data"][at]}


def _shared(rows: dict[str, np.ndarray]) -> np.ndarray:
    """Rows whose minimizer other documents have too."""
    order = np.argsort(rows["key"], kind="stable")
    if not len(order):
        return order
    key, doc = rows["key"][order], rows["doc"][order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    mixed = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
    return np.sort(order[np.repeat(mixed, np.diff(np.r_[first, len(key)]))])


def _without_copies(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows to be sorted, and rows that are marked as a whole.

    Of equal segments those of the smallest document remain.
    """
    ends = np.cumsum(rows["size"])
    raw, best = rows["data"].tobytes(), {}
    names = [raw[b - n : b] for b, n in zip(ends.tolist(), rows["size"].tolist())]
    docs = rows["doc"].tolist()
    for name, doc in zip(names, docs):
        if best.setdefault(name, doc) > doc:
            best[name] = doc
    copy = np.fromiter((best[n] < d for n, d in zip(names, docs)), bool, len(docs))
    return np.flatnonzero(~copy), np.flatnonzero(copy)


def _sorted_marks(rows: dict[str, np.ndarray], window: int) -> np.ndarray:
    """Marks ``(doc, body, start, stop)`` from the suffix order of the segments."""
    n = len(rows["size"])
    total = int(rows["size"].sum()) + n
    text = np.zeros(total, np.int16)
    stops = np.cumsum(rows["size"] + 1) - 1  # places of the sentinels
    inside = np.ones(total, bool)
    inside[stops] = False
    text[inside] = rows["data"].astype(np.int16) + 1
    row = np.repeat(np.arange(n), rows["size"] + 1)
    # eight bytes from each place on; windows hold no sentinel
    words = np.zeros(total, np.uint64)
    for k in range(8):
        words[: total - k] |= (text[k:] - 1).astype(np.uint8).astype(np.uint64) << np.uint64(8 * k)
    out, held = [], np.zeros(0, np.int64)

    def close(part):
        """Marks of suffixes of which equal windows are complete."""
        equal = np.ones(max(len(part) - 1, 0), bool)
        for k in [*range(0, window - 8, 8), window - 8]:
            word = words[part + k]
            equal &= word[1:] == word[:-1]
        first = np.flatnonzero(np.r_[True, ~equal])
        doc = rows["doc"][row[part]]
        lowest = np.repeat(np.minimum.reduceat(doc, first), np.diff(np.r_[first, len(part)]))
        return part[doc > lowest]

    for part in suffix_order(text):
        part = part[stops[row[part]] - part >= window]
        held = np.r_[held, part]
        if len(held) > (1 << 20):
            # the last equal windows may go on
            same = np.ones(len(held), bool)
            for k in [*range(0, window - 8, 8), window - 8]:
                same &= words[held + k] == words[held[-1] + k]
            cut = int(np.argmax(same))
            if cut:
                out.append(close(held[:cut]))
                held = held[cut:]
    if len(held):
        out.append(close(held))
    at = np.sort(np.concatenate(out)) if out else held
    if not len(at):
        return np.zeros((0, 4), np.int64)
    new = np.flatnonzero(np.r_[True, (np.diff(at) > window) | (row[at][1:] != row[at][:-1])])
    last = np.r_[new[1:], len(at)] - 1
    r = row[at[new]]
    start = at[new] - (stops[r] - rows["size"][r]) + rows["start"][r]
    return np.stack([rows["doc"][r], rows["body"][r], start, start + at[last] - at[new] + window], axis=1)


def _windows(rows: dict[str, np.ndarray], window: int) -> dict[str, np.ndarray]:
    """The single windows of segments, with a hash of the whole window as key."""
    n = rows["size"] - window + 1
    ends = np.cumsum(rows["size"])
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(ends - rows["size"], n) + step
    data = rows["data"][(at[:, None] + np.arange(window)).ravel()]
    key = np.zeros(len(at), np.uint64)
    for k in range(window):
        key = key * np.uint64(0x9E3779B97F4A7C15) + data[k::window]
        key ^= key >> np.uint64(32)
    out = {k: np.repeat(rows[k], n) for k in ("doc", "body")}
    return out | {
        "key": key, "start": np.repeat(rows["start"], n) + step,
        "size": np.full(len(at), window), "data": data,
    }


def shard_marks(rows: dict[str, np.ndarray], window: int = WINDOW, limit: int = SORT) -> Iterator[np.ndarray]:
    """Marks of a shard; one larger than ``limit`` is worked on in parts by key."""
    if not len(rows["key"]):
        return
    rows = _take(rows, _shared(rows))
    if not len(rows["key"]):
        return
    keep, copies = _without_copies(rows)
    if len(copies):
        start = rows["start"][copies]
        columns = [rows["doc"][copies], rows["body"][copies], start, start + rows["size"][copies]]
        yield np.stack(columns, axis=1)
    rows = _take(rows, keep)
    rows = _take(rows, _shared(rows))
    size = len(rows["data"])
    if not size:
        return
    if size <= limit:
        yield _sorted_marks(rows, window)
        return
    # parts of whole keys; a key that alone is too large is cut into its windows
    order = np.argsort(rows["key"], kind="stable")
    rows = _take(rows, order)
    first = np.flatnonzero(np.r_[True, rows["key"][1:] != rows["key"][:-1]])
    weight = np.add.reduceat(rows["size"], first)
    stop = np.r_[first[1:], len(rows["key"])]
    at = 0
    while at < len(first):
        end, held = at, 0
        while end < len(first) and (end == at or held + weight[end] <= limit):
            held += weight[end]
            end += 1
        part = _take(rows, np.arange(first[at], stop[end - 1]))
        if held <= limit:
            yield _sorted_marks(part, window)
        elif int(part["size"].max()) > window:
            yield from _by_windows(part, window, limit)
        else:
            yield _sorted_marks(part, window)
        at = end


def _by_windows(rows: dict[str, np.ndarray], window: int, limit: int) -> Iterator[np.ndarray]:
    """Marks of one large key: its windows in several passes by their hash."""
    passes = max(2, int(2 * rows["size"].sum() * window // limit) // 8)
    step = max(1, limit // (40 * window))
    for k in range(passes):
        mine = []
        for a in range(0, len(rows["key"]), step):
            block = _windows(_take(rows, np.arange(a, min(a + step, len(rows["key"])))), window)
            chosen = np.flatnonzero((block["key"] >> np.uint64(7)) % np.uint64(passes) == k)
            mine.append(_take(block, chosen))
        part = {c: np.concatenate([m[c] for m in mine]) for c in mine[0]}
        part = _take(part, _shared(part))
        if len(part["key"]):
            yield _sorted_marks(part, window)


def _mixed(key: np.ndarray, doc: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: rows whose key several documents have, and the first row of each key.

    ``known`` are rows that stand for several documents already.
    """
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
    several |= np.logical_or.reduceat(known, first)
    return np.repeat(several, np.diff(np.r_[first, len(key)])), first


def _pack(columns: list[np.ndarray]) -> bytes:
    head = np.array([len(columns[0])], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(c.tobytes() for c in columns))


def _open(blob: bytes, kinds: list) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


#: of minimizers: the high half of the hash, document (differences), number, several
_ENTRY = [np.uint32, np.int64, np.uint32, np.bool_]
#: of wanted segments: document (differences), number
_WANTED = [np.int64, np.uint32]


def _wanted_blobs(doc: np.ndarray, number: np.ndarray, shards: int):
    """Numbers of wanted segments, to the shards of their documents (after the others)."""
    if not len(doc):
        return
    to = (doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(shards)
    order = np.lexsort((number, doc, to))
    to, doc, number = to[order], doc[order], number[order]
    cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1], True])
    for a, b in zip(cuts, cuts[1:]):
        blob = _pack([np.diff(doc[a:b], prepend=0), number[a:b].astype(np.uint32)])
        yield int(to[a]) + shards, blob


def _entries(shards: int):
    """Minimizers of the documents to their shards (0 to ``shards`` - 1).

    Where a task has a minimizer in several documents, all but one row stay here: they
    are wanted at once, and the one that goes on says so.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], [], []]

        def flush():
            if not held[0]:
                return
            key, doc, number = (np.concatenate(c) for c in held)
            for c in held:
                c.clear()
            order = np.argsort(key, kind="stable")
            key, doc, number = key[order], doc[order], number[order]
            several, first = _mixed(key, doc, np.zeros(len(key), bool))
            for shard, blob in _wanted_blobs(doc[several], number[several], shards):
                yield shard, blob
            going = ~several
            going[first] = True
            key, doc, number, several = key[going], doc[going], number[going], several[going]
            to = (key & np.uint64(0xFFFFFFFF)) % np.uint64(shards)
            order = np.lexsort((number, doc, to))
            cuts = np.flatnonzero(np.r_[True, np.diff(to[order]) != 0, True])
            for a, b in zip(cuts, cuts[1:]):
                at = order[a:b]
                high = (key[at] >> np.uint64(32)).astype(np.uint32)
                columns = [high, np.diff(doc[at], prepend=0), number[at].astype(np.uint32), several[at]]
                yield int(to[at[0]]), _pack(columns)

        def out():
            rows = list(flush())
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                ["shard", "blob"],
            )

        count = 0
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                number = 0
                for _, _, key in segments(value.encode("utf-8", "replace")):
                    held[0].append(key)
                    held[1].append(np.full(len(key), doc, np.int64))
                    held[2].append(np.arange(number, number + len(key)))
                    number += len(key)
                count += number
                if count > ENTRIES:
                    yield out()
                    count = 0
        yield out()

    return scan


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[bytes]]]:
    """The blobs of each shard; the rows are sorted by shard."""
    rows = ((s, b) for x in batches for s, b in zip(x.column(0).to_pylist(), x.column(1)))
    for shard, group in itertools.groupby(rows, key=lambda r: r[0]):
        yield shard, (b.as_py() for _, b in group)


def _counted(shards: int):
    """Which minimizers are wanted; what is wanted already passes on to its document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blobs in _by_shard(batches):
            if shard >= shards:
                for blob in blobs:
                    yield pa.RecordBatch.from_pydict(
                        {"shard": pa.array([shard], pa.int64()), "blob": pa.array([blob], pa.binary())}
                    )
                continue
            parts = [_open(b, _ENTRY) for b in blobs]
            key, number, several = (np.concatenate([p[i] for p in parts]) for i in (0, 2, 3))
            doc = np.concatenate([np.cumsum(p[1]) for p in parts])
            order = np.argsort(key, kind="stable")
            key, doc, number, several = key[order], doc[order], number[order], several[order]
            chosen = _mixed(key, doc, several)[0] & ~several
            rows = list(_wanted_blobs(doc[chosen], number[chosen], shards))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                ["shard", "blob"],
            )

    return scan


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document with the numbers of its wanted segments."""
    for _, blobs in _by_shard(batches):
        held, size, limit = [], 0, 4_000_000
        for blob in blobs:
            doc, number = _open(blob, _WANTED)
            held.append(np.stack([np.cumsum(doc), number.astype(np.int64)], axis=1))
            size += len(doc)
            if size > limit:  # the same numbers again where an id is repeated
                held = [np.unique(np.concatenate(held), axis=0)]
                size, limit = len(held[0]), max(limit, 2 * len(held[0]))
        rows = np.concatenate(held)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        cuts = np.flatnonzero(np.r_[True, np.diff(rows[:, 0]) != 0, True])
        blobs = [rows[a:b, 1].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])]
        for at in range(0, len(blobs), 2000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[cuts[at : at + 2000][: len(blobs[at : at + 2000])], 0]), pa.array(blobs[at : at + 2000], pa.binary())],
                ["doc", "numbers"],
            )


def _sent(shards: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = Gathered(shards)

        def flush():
            for shard, blob in gathered.blobs():
                yield pa.RecordBatch.from_pydict(
                    {"shard": pa.array([shard], pa.int64()), "blob": pa.array([blob], pa.binary())}
                )

        for batch in batches:
            ids, bodies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, body, data, numbers in zip(ids, bodies, _opened(batch.column(2)), batch.column(3)):
                wanted = np.unique(np.frombuffer(numbers.as_py(), "<u4")).astype(np.int64)
                gathered.add(doc, body, data, wanted)
                if gathered.size > GATHER:
                    yield from flush()
        yield from flush()

    return scan


def _marked(window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(marks: np.ndarray):
            names = ["doc", "body", "start", "stop"]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(marks[:, i])) for i in range(4)], names
            )

        def finish(parts):
            if not parts:
                return
            rows = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
            parts.clear()
            for marks in shard_marks(rows, window):
                if len(marks):
                    yield out(marks)

        for _, blobs in _by_shard(batches):
            parts = []
            for blob in blobs:
                rows, marks = unpack(blob)
                if len(marks):
                    yield out(marks)
                parts.append(rows)
            yield from finish(parts)

    return scan


def _prepared(docs: DataFrame, text: str, id_col: str, carry: list[str]) -> DataFrame:
    """``carry`` as d0, d1 ..., then ``doc``, ``body`` and ``value``, the text compressed."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    names = [f"d{i}" for i in range(len(carry))]
    rows = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)],
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(value).alias("body"),
        value.alias("value"),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress(t.encode("utf-8", "replace")) for t in texts(batch.column(len(names) + 2))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(packed, pa.binary())], [*names, "doc", "body", "value"]
            )

    kinds = [f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(carry, names)]
    packed = rows.mapInArrow(scan, ", ".join([*kinds, "doc bigint", "body bigint", "value binary"]))
    # never null; said here as the inner join says it, so that both joins read one shuffle
    return packed.where("doc is not null")


def _opened(column: pa.Array) -> Iterator[bytes]:
    opener = zstandard.ZstdDecompressor()
    return (opener.decompress(x.as_py()) for x in column)


def repeated_spans(
    docs: DataFrame, rows: DataFrame, text: str, id_col: str, shards: int | None = None
) -> DataFrame:
    """``(doc, body, start, stop)``: byte ranges of a document that a smaller one holds.

    ``rows`` has ``doc``, ``body``, the hash of the text, and ``value``, the text packed
    as in ``_prepared``. The ranges may overlap. Each step hands a bounded amount to a
    task: rows for one minimizer or one segment that a task has from several documents
    are sent on once.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    if shards is None:
        total = docs.agg(F.sum(F.octet_length(value))).first()[0] or 0
        shards = max(8, -(-total // SHARD_BYTES))
    given = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)), value)
    kind = "shard bigint, blob binary"

    def dealt(df):
        return df.repartition(shards, "shard").sortWithinPartitions("shard")

    entries = dealt(given.mapInArrow(_entries(shards), kind))
    wanted = dealt(entries.mapInArrow(_counted(shards), kind))
    numbers = wanted.mapInArrow(_numbers, "doc bigint, numbers binary")
    chosen = rows.join(numbers, "doc").select("doc", "body", "value", "numbers")
    segments_ = dealt(chosen.mapInArrow(_sent(shards), kind))
    return segments_.mapInArrow(_marked(WINDOW), "doc bigint, body bigint, start bigint, stop bigint")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal ranges of overlapping or touching ones."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """What the ranges leave."""
    at, out = 0, []
    for a, b in spans:
        out.append(data[at:a])
        at = b
    out.append(data[at:])
    return b"".join(out)


def _with_spans(docs: DataFrame, text: str, id_col: str, shards: int | None, carry: list[str]):
    """The columns ``carry`` as d0, d1 ..., then ``doc, body, value, spans`` of each row.

    Both joins are on the id: with nothing to carry, one shuffle of the documents serves
    the two.
    """
    rows = _prepared(docs, text, id_col, carry)
    spans = repeated_spans(docs, rows, text, id_col, shards)
    grouped = spans.groupBy("doc").agg(F.collect_set(F.struct("body", "start", "stop")).alias("spans"))
    names = [f"d{i}" for i in range(len(carry))]
    return rows.join(grouped, "doc", "left").select(*names, "doc", "body", "value", "spans")


def _of_body(spans: pa.Scalar, body: int) -> list[tuple[int, int]]:
    return merged([(s["start"], s["stop"]) for s in spans.as_py() or () if s["body"] == body])


def digests(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", shards: int | None = None
) -> DataFrame:
    """Per document what is removed and a digest of the rest.

    A byte goes if a string of ``WINDOW`` bytes covers it that also starts in a document
    with a smaller id. ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed ranges)
    and ``kept_sha256``. Null texts count as empty; texts shorter than that stay
    whole. A null id is later than any other; rows with the same id never remove from
    each other, and rows repeated with id and text get the same result.
    """
    joined = _with_spans(docs, text, id_col, shards, [])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, data, spans in zip(batch.column(1).to_pylist(), _opened(batch.column(2)), batch.column(3)):
                found = _of_body(spans, body)
                rest = cut(data, found)
                out.append((len(data), len(data) - len(rest), len(found), hashlib.sha256(rest).hexdigest()))
            columns = list(zip(*out)) if out else [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    schema = "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    name = F.when(F.col("doc") != NO_ID, F.col("doc")).cast(docs.schema[id_col].dataType)
    return joined.mapInArrow(scan, schema).select(name.alias(id_col), F.col("*")).drop("doc")


def remove(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", shards: int | None = None
) -> DataFrame:
    """``docs`` with the repeated bytes removed from their texts; broken characters too."""
    columns = docs.columns
    at, n = columns.index(text), len(columns)
    joined = _with_spans(docs, text, id_col, shards, columns)
    names = [f"d{i}" for i in range(n)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = []
            for plain, body, spans in zip(batch.column(at), batch.column(n + 1).to_pylist(), batch.column(n + 3)):
                plain, found = plain.as_py(), _of_body(spans, body)
                if found:
                    plain = cut(plain.encode("utf-8", "replace"), found).decode("utf-8", "ignore")
                new.append(plain)
            given = list(batch.columns[:n])
            given[at] = pa.array(new, given[at].type)
            yield pa.RecordBatch.from_arrays(given, names)

    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, columns))
    out = joined.mapInArrow(scan, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, columns)])
