"""Token ids packed into rows of fixed length, best fit decreasing.

Documents are tokenised and packed in groups of bounded size inside the tasks that read
them, so no id is shuffled. In a group, pieces are placed from the longest to the
shortest, each into the fullest row that still has room; a segment tree over the free
room of the rows finds it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from sparkyield.llm.bpe import PATTERN, load
from sparkyield.llm.common import texts

LENGTH = 2048
#: id at the end of every document; also fills what is left of a row
END = 50256
#: tokens that are packed together
GROUP = 2_000_000
#: white space that is encoded apart: the coder's word pattern can't go back over a longer run
RUN = 100_000


class Room:
    """Rows by their free room: a segment tree finds the smallest room that suffices."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, row: int, room: int):
        self.rows[room].append(row)
        at = self.leaves + room
        while at and not self.some[at]:
            self.some[at] = 1
            at >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """A row with the smallest room of at least ``size``, and that room."""
        some, at = self.some, self.leaves + size
        if not some[at]:
            while at > 1 and (at & 1 or not some[at + 1]):  # up until the right brother has one
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if some[2 * at] else 2 * at + 1
        room = at - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            some[at] = 0
            at >>= 1
            while at and not (some[2 * at] or some[2 * at + 1]):
                some[at] = 0
                at >>= 1
        return row, room


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of indexes into ``sizes``, each 1 to ``length``, best fit decreasing.

    Equal sizes keep their order; of rows with equal room the latest is filled.
    """
    room, out = Room(length), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = room.take(sizes[i])
        if found is None:
            out.append([i])
            left = length - sizes[i]
            row = len(out) - 1
        else:
            row, free = found
            out[row].append(i)
            left = free - sizes[i]
        if left:
            room.put(row, left)
    return out


def _pieces(ids: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """A document cut into full rows and a rest: start and ids."""
    for start in range(0, len(ids), length):
        yield start, ids[start : start + length]


def _packed(docs: Iterator[tuple[object, np.ndarray]], length: int, group: int):
    """Rows of ``(document, start, ids)`` pieces."""
    held, tokens = [], 0
    for doc, ids in docs:
        for start, piece in _pieces(ids, length):
            if len(piece) == length:
                yield [(doc, start, piece)]
            else:
                held.append((doc, start, piece))
                tokens += len(piece)
        if tokens >= group:
            for row in best_fit([len(p) for _, _, p in held], length):
                yield [held[i] for i in row]
            held, tokens = [], 0
    for row in best_fit([len(p) for _, _, p in held], length):
        yield [held[i] for i in row]


def encoding(raw: bytes, pattern: str = PATTERN) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Coder:
    """Texts to ids; white space of any length is a word like others."""

    def __init__(self, raw: bytes, longest: int = RUN):
        self.coder = encoding(raw)
        # a text as one word; without a look ahead the pattern needs no way back
        self.word = encoding(raw, r"[\s\S]+")
        self.long = regex.compile(rf"\p{{White_Space}}{{{longest},}}")

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text.

        The last character of white space before other characters is not part of the
        run's word: a space goes to the next word, others stand alone.
        """
        parts, done = [], 0
        for run in self.long.finditer(text):
            start, end = run.span()
            end -= end < len(text)
            parts.append(self.coder.encode_to_numpy(text[done:start], disallowed_special=()))
            parts.append(self.word.encode_to_numpy(text[start:end], disallowed_special=()))
            done = end
        parts.append(self.coder.encode_to_numpy(text[done:], disallowed_special=()))
        return np.concatenate(parts)


def _rows(docs, path, text, id_col, length, end, group, full: bool) -> DataFrame:
    raw = load(docs, path)
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(raw.value)
        docs_type = None

        def encoded():
            nonlocal docs_type
            for batch in batches:
                docs_type = batch.column(0).type
                for doc, value in zip(batch.column(0), texts(batch.column(1))):
                    yield doc.as_py(), np.append(coder.encode(value), end).astype(np.int32)

        part, out = TaskContext.get().partitionId(), []
        for number, row in enumerate(_packed(encoded(), length, group)):
            sizes = [len(p) for _, _, p in row]
            ids_of = np.concatenate([p for _, _, p in row])
            cumulative = np.cumsum([0, *sizes]).astype(np.int32)
            places = np.arange(len(ids_of), dtype=np.int32) - np.repeat(cumulative[:-1], sizes)
            fill = length - len(ids_of)
            if fill:  # what fills a row is a segment of its own
                cumulative = np.append(cumulative, np.int32(length))
                ids_of = np.append(ids_of, np.full(fill, end, np.int32))
                places = np.append(places, np.arange(fill, dtype=np.int32))
            record = {
                "part": part,
                "row": number,
                "n_tokens": length - fill,
                "docs": [d for d, _, _ in row],
                "starts": [s for _, s, _ in row],
                "cu_seqlens": cumulative.tolist(),
            }
            if full:
                record |= {"ids": ids_of.astype("<i4").tobytes(), "positions": places.astype("<i4").tobytes()}
            else:
                record |= {
                    "ids_sha256": hashlib.sha256(ids_of.astype("<i4")).hexdigest(),
                    "positions_sha256": hashlib.sha256(places.astype("<i4")).hexdigest(),
                }
            out.append(record)
            if len(out) == 512:
                yield pa.RecordBatch.from_pylist(out, schema(docs_type))
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema(docs_type))

    def schema(docs_type):
        last = pa.binary() if full else pa.string()
        names = ("ids", "positions") if full else ("ids_sha256", "positions_sha256")
        return pa.schema(
            [
                ("part", pa.int32()),
                ("row", pa.int64()),
                ("n_tokens", pa.int32()),
                ("docs", pa.list_(docs_type)),
                ("starts", pa.list_(pa.int64())),
                ("cu_seqlens", pa.list_(pa.int32())),
                *[(n, last) for n in names],
            ]
        )

    head = f"part int, row bigint, n_tokens int, docs array<{kind}>, starts array<bigint>, cu_seqlens array<int>"
    tail = "ids binary, positions binary" if full else "ids_sha256 string, positions_sha256 string"
    return docs.select(id_col, text).mapInArrow(scan, f"{head}, {tail}")


def pack(
    docs: DataFrame,
    path: str,
    text: str = "text",
    id_col: str = "doc_id",
    length: int = LENGTH,
    end: int = END,
    group: int = GROUP,
) -> DataFrame:
    """Packed rows: ``ids`` and ``positions`` as little-endian int32, and their segments.

    Every document ends with ``end``; null and empty texts are that id alone. A document
    longer than a row fills whole rows, and only its rest shares one. ``docs`` and
    ``starts`` say for each segment its document and where in it the segment starts;
    ``cu_seqlens`` are the cumulative segment lengths, and the positions start at 0 in
    each segment. What is left of a row is filled with ``end`` as a last segment, not
    counted in ``n_tokens``. ``part`` and ``row`` number the rows. Repeated documents
    are packed each. Rows depend on how the input is split into partitions.
    """
    return _rows(docs, path, text, id_col, length, end, group, True)


def digests(
    docs: DataFrame,
    path: str,
    text: str = "text",
    id_col: str = "doc_id",
    length: int = LENGTH,
    end: int = END,
    group: int = GROUP,
) -> DataFrame:
    """The rows of ``pack`` with SHA-256 digests in place of ids and positions."""
    return _rows(docs, path, text, id_col, length, end, group, False)


def write(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet with binary columns."""
    packed.write.parquet(path)


def matrix(rows: list, length: int = LENGTH) -> np.ndarray:
    """The id matrix of some packed rows."""
    return np.stack([np.frombuffer(r["ids"], "<i4") for r in rows]) if rows else np.zeros((0, length), "<i4")
