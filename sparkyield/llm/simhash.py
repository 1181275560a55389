"""SimHash near-duplicates found through the anchors of a covering code.

Fingerprints differ in at most three of 64 bits, so on one of their two halves they
differ in at most one bit. A half of 32 bits is covered with radius 1 by the perfect
Hamming code of length 31, taken with either value of the last bit. Every fingerprint
has one home anchor within the covering radius of each half. Whoever differs from it
by one bit there lies within radius 2 of that home. So each fingerprint is copied to
its anchors within 2 (17 for each half) and compared with the others of an anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkyield.llm.common import checkpointed, components, texts

LIMIT = 3
SHINGLE = 3
SEED = 42
#: distinct fingerprints of one anchor that a task compares at once
ANCHOR_ROWS = 1_000_000
_SMALL = 48


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of ``text``; 0 without words."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: ASCII rules only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    stops = ends[width - 1 :].tolist()
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    hashes = np.fromiter(
        (digest(view[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(stops)
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = np.ascontiguousarray(hashes[at : at + (1 << 15)]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, fp)`` with the fingerprint as a signed long. Null texts count as empty."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t) for t in texts(batch.column(1))]
            signed = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], [id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text).mapInArrow(scan, f"`{id_col}` {kind}, fp bigint")


# bit i of a word of the Hamming code stands at position i + 1
_POSITIONS = np.arange(1, 32, dtype=np.uint64)
#: the pairs of bits whose positions differ by each syndrome
_PAIRS = np.array(
    [
        [(1 << (p - 1)) | (1 << ((p ^ s) - 1)) for p in range(1, 32) if p < p ^ s]
        for s in range(1, 32)
    ],
    dtype=np.uint64,
)


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor keys within radius 2 of both halves of each fingerprint.

    Returns ``keys`` of shape (n, 34) and ``home``, True for those in the covering
    radius. A half that is a code word itself has no others near: those keys are 0.
    """
    keys, home = [], []
    one = np.uint64(1)
    for half in (0, 1):
        word = (fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        code, last = word & np.uint64(0x7FFFFFFF), word & np.uint64(0x80000000)
        syndrome = np.zeros(len(fp), np.uint64)
        for p in _POSITIONS:
            syndrome ^= ((code >> (p - one)) & one) * p
        off = syndrome > 0
        nearest = np.where(off, code ^ (one << (np.maximum(syndrome, one) - one)), code)
        others = code[:, None] ^ _PAIRS[np.maximum(syndrome, one).astype(np.int64) - 1]
        tag = np.uint64((half + 1) << 32)
        mine = np.concatenate(
            [
                (nearest | last)[:, None],
                (nearest | (last ^ np.uint64(0x80000000)))[:, None],
                np.where(off[:, None], others | last[:, None], 0),
            ],
            axis=1,
        )
        keys.append(np.where((np.arange(mine.shape[1]) < 2) | off[:, None], mine | tag, 0))
        home.append(np.arange(mine.shape[1]) == 0)
    return np.concatenate(keys, axis=1), np.concatenate(home)


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        for at in range(0, len(fp), 1 << 14):
            part = fp[at : at + (1 << 14)]
            keys, home = anchors(part)
            rows, cols = np.nonzero(keys)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[rows, cols].view(np.int64)),
                    pa.array(part[rows].view(np.int64)),
                    pa.array(home[cols]),
                ],
                ["anchor", "fp", "home"],
            )


def spanning(fp: np.ndarray, home: np.ndarray, limit: int = LIMIT) -> list[tuple[int, int]]:
    """Links that connect what distances up to ``limit`` from a home connect.

    Breadth-first: whatever is reached leaves the rest, so a dense group costs few
    passes and gives fewer links than it has members. ``fp`` are distinct.
    """
    out = []
    while home.any():
        first = int(np.argmax(home))
        queue = [(fp[first], True)]
        fp, home = np.delete(fp, first), np.delete(home, first)
        while queue and len(fp):
            at, from_home = queue.pop()
            near = np.bitwise_count(fp ^ at) <= limit
            if not from_home:
                near &= home
            if near.any():
                found = fp[near]
                out.extend((int(at), int(x)) for x in found)
                queue.extend(zip(found, home[near]))
                fp, home = fp[~near], home[~near]
    return out


def _compare(keys: np.ndarray, fp: np.ndarray, home: np.ndarray, limit: int) -> list[np.ndarray]:
    """Links between a home and another row of the same key; ``keys`` are sorted."""
    out = []
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    for start, n in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL]):
        own, at = np.unique(fp[start : start + n], return_index=True)
        found = spanning(own, home[start : start + n][at], limit)
        if found:
            out.append(np.array(found, np.uint64).reshape(-1, 2))
    small = np.repeat(sizes <= _SMALL, sizes)
    keys, fp, home = keys[small], fp[small], home[small]
    for step in range(1, _SMALL):
        same = np.flatnonzero(keys[step:] == keys[:-step])
        if not len(same):
            break
        a, b = fp[same], fp[same + step]
        near = (np.bitwise_count(a ^ b) <= limit) & (a != b) & (home[same] | home[same + step])
        out.append(np.stack([a[near], b[near]], axis=1))
    return out


def _links(limit: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)]

        def done(rows):
            found = _compare(*rows, limit)
            if found:
                ab = np.unique(np.concatenate(found), axis=0).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(ab[:, i])) for i in (0, 1)], ["a", "b"]
                )

        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            new[1] = new[1].view(np.uint64)
            held = [np.concatenate(pair) for pair in zip(held, new)]
            # the last key may go on in the next batch
            cut = np.searchsorted(held[0], held[0][-1]) if len(held[0]) else 0
            if cut:
                yield from done([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if len(held[0]):
            yield from done(held)

    return scan


def links(fps: DataFrame, limit: int = LIMIT, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct fingerprints ``fps (fp)``.

    Each link is true (at most ``limit`` differing bits), and whatever is connected
    by such distances is connected by the links; a dense group gives a spanning tree
    of links for each anchor instead of all its pairs. An anchor with more than
    ``anchor_rows`` homes is cut into blocks by fingerprint hash, and each pair of
    blocks is compared by another task.
    """
    if not 0 <= limit <= LIMIT:
        raise ValueError(f"limit must be between 0 and {LIMIT}")
    copies = fps.select("fp").mapInArrow(_copies, "anchor bigint, fp bigint, home boolean")
    homes = copies.where("home").groupBy("anchor").count()
    heavy = checkpointed(homes.where(F.col("count") > anchor_rows))
    if not heavy.isEmpty():
        blocks = F.ceil(F.coalesce("count", F.lit(0)) / anchor_rows).cast("int")
        mine = F.pmod(F.xxhash64("fp"), F.greatest("n", F.lit(1))).cast("int")
        pairs = F.transform(
            F.sequence(F.lit(0), F.greatest("n", F.lit(1)) - 1),
            lambda j: F.least("mine", j) * 65536 + F.greatest("mine", j),
        )
        copies = (
            copies.join(heavy, "anchor", "left")
            .withColumn("n", blocks)
            .withColumn("mine", mine)
            .select("anchor", "fp", "home", F.explode(pairs).alias("part"))
        )
        key = F.xxhash64("anchor", "part")
    else:
        key = F.col("anchor")
    placed = copies.select(key.alias("key"), "fp", "home").repartition("key").sortWithinPartitions("key")
    return placed.mapInArrow(_links(limit), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", limit: int = LIMIT
) -> DataFrame:
    """One row per document: ``id_col``, ``fingerprint`` and ``component_id``.

    ``component_id`` is the smallest id that can be reached over links of at most
    ``limit`` differing bits, the document itself included. Equal texts have equal
    fingerprints and so one component. Null texts count as empty; documents without
    words have fingerprint zero and link like any other. Rows without an id keep
    their fingerprint; their component is that of the group, null if no member has
    an id. Repeated rows stay repeated. Other columns are ignored.
    """
    marks = checkpointed(fingerprints(docs.select(id_col, text), text, id_col))
    first = checkpointed(marks.groupBy("fp").agg(F.min(id_col).alias("first")))
    found = checkpointed(links(first, limit).distinct())
    roots = components(found)
    group = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    group = checkpointed(group.select("fp", "first", F.coalesce("root", "fp").alias("root")))
    lowest = group.groupBy("root").agg(F.min("first").alias("component_id"))
    named = group.join(lowest, "root").select("fp", "component_id")
    return marks.join(named, "fp").select(
        id_col,
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def deduplicate(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", limit: int = LIMIT
) -> DataFrame:
    """One row of each group of near duplicates, all columns as they are.

    It is the one with the smallest id, a null id coming last; of several rows with it
    the one with the smallest text hash, and of equal rows one.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = F.struct(
        F.col(f"`{id_col}`").isNull().alias("none"),
        F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(value).alias("body"),
    )
    narrow = docs.select(key.alias("key"), F.col(f"`{text}`").alias("text"))
    marks = checkpointed(fingerprints(narrow, "text", "key"))
    first = checkpointed(marks.groupBy("fp").agg(F.min("key").alias("first")))
    roots = components(checkpointed(links(first, limit).distinct()))
    group = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    kept = group.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    kept = kept.select("first.id", "first.body")
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(value).alias("body"),
    ).alias("l")
    found = row.join(kept.alias("r"), F.expr("l.body = r.body and l.id <=> r.id"), "left_semi")
    # rows equal in id and text are told apart only where there are some
    unique = marks.groupBy("key").count().where("count > 1").isEmpty()
    return (found if unique else found.dropDuplicates(["id", "body"])).select("row.*")
