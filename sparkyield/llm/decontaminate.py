"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of k edits is split into k + 1 pieces. Wherever the
item occurs with at most k edits, one piece at least occurs unchanged. An automaton of
all pieces finds those places in one pass over a text; around them Myers' bit-parallel
algorithm finds the exact edit distance.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkyield.llm.common import texts

#: one edit is allowed for so many characters of an item
CHARS_PER_EDIT = 12
#: characters of the items that one pass over the documents looks for
BLOCK_CHARS = 2_000_000


def normal(text: str) -> str:
    """Lower case, and each run of white space one space."""
    return " ".join(text.lower().split())


def budget(item: str, chars_per_edit: int = CHARS_PER_EDIT) -> int:
    return len(item) // chars_per_edit


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """The item cut into ``edits`` + 1 pieces of nearly equal length, with their places."""
    cuts = [len(item) * j // (edits + 1) for j in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def nearest(pattern: str, masks: dict[str, int], text: str) -> int:
    """Smallest edit distance between ``pattern`` and any substring of ``text``."""
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    for c in text:
        equal = masks.get(c, 0)
        vertical = equal | minus
        equal = (((equal & plus) + plus) ^ plus) | equal
        rise = minus | (full & ~(equal | plus))
        fall = plus & equal
        if rise & high:
            score += 1
        elif fall & high:
            score -= 1
            if score < best:
                best = score
        rise = (rise << 1) & full
        fall = (fall << 1) & full
        plus = fall | (full & ~(vertical | rise))
        minus = rise & vertical
    return best


class Items:
    """Test items ready to be looked for."""

    def __init__(self, items: list[tuple[object, str]], chars_per_edit: int):
        self.ids, self.items, self.edits, self.masks = [], [], [], []
        places = defaultdict(list)
        for item_id, text in items:
            text = normal(text)
            if not text:
                continue
            edits = budget(text, chars_per_edit)
            masks = defaultdict(int)
            for i, c in enumerate(text):
                masks[c] |= 1 << i
            for at, piece in pieces(text, edits):
                places[piece].append((len(self.ids), at))
            self.ids.append(item_id)
            self.items.append(text)
            self.edits.append(edits)
            self.masks.append(dict(masks))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[object, int]]:
        """Ids and smallest distances of the items within their budgets in ``text``."""
        text = normal(text)
        if not text or not self.ids:
            return []
        # start of the item -> windows, merged as they come in the order of the text
        windows: dict[int, list[list[int]]] = defaultdict(list)
        for end, (size, found) in self.automaton.iter(text):
            for i, at in found:
                start = end - size + 1 - at
                low, high = start - self.edits[i], start + len(self.items[i]) + self.edits[i]
                mine = windows[i]
                if mine and low <= mine[-1][1]:
                    mine[-1] = [min(low, mine[-1][0]), max(high, mine[-1][1])]
                else:
                    mine.append([low, high])
        out = []
        for i, mine in sorted(windows.items()):
            item, best = self.items[i], self.edits[i] + 1
            if item in text:
                best = 0
            else:
                for low, high in mine:
                    part = text[max(low, 0) : max(high, 0)]
                    best = min(best, nearest(item, self.masks[i], part))
            if best <= self.edits[i]:
                out.append((self.ids[i], best))
        return out


def blocks(bench: DataFrame, item_id: str, item_text: str, block_chars: int) -> Iterator[list]:
    """The test items in blocks of bounded size."""
    block, chars = [], 0
    for row in bench.select(item_id, item_text).toLocalIterator():
        if row[1]:
            block.append((row[0], row[1]))
            chars += len(row[1])
        if chars >= block_chars:
            yield block
            block, chars = [], 0
    if block:
        yield block


def mark(docs: DataFrame, items: list, id_type: str, text: str, chars_per_edit: int) -> DataFrame:
    """Add ``matches`` with the items of one block found in each row."""
    keep = [c for c in docs.columns if c != "matches"]
    at = keep.index(text)
    given = docs.select(*[F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(keep)])
    schema = ", ".join(f"d{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    schema += f", matches array<struct<item_id:{id_type},distance:int>>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Items(items, chars_per_edit)
        for batch in batches:
            found = [
                [{"item_id": i, "distance": d} for i, d in known.find(t)]
                for t in texts(batch.column(at))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, kind)], [f"d{i}" for i in range(len(keep))] + ["matches"]
            )

    kind = pa.list_(pa.struct([("item_id", _ARROW.get(id_type, pa.string())), ("distance", pa.int32())]))
    out = given.mapInArrow(scan, schema)
    return out.select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(keep)], "matches")


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _prepared(bench: DataFrame, item_id: str, item_text: str) -> tuple[DataFrame, str]:
    kind = bench.schema[item_id].dataType.simpleString()
    if kind not in _ARROW:
        kind = "string"
    return bench.select(F.col(item_id).cast(kind).alias("item_id"), F.col(item_text).alias("item")), kind


def contaminations(
    docs: DataFrame,
    bench: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
    chars_per_edit: int = CHARS_PER_EDIT,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and test item it contains: ``id_col, item_id, distance``.

    An item is contained if a part of the text is within one edit for each
    ``chars_per_edit`` characters of it, both in lower case with single spaces;
    ``distance`` is the smallest one. Null and empty texts and items match nothing.
    Repeated documents or items give repeated rows. The items are taken in blocks of
    bounded size, each with a pass over the documents.
    """
    bench, kind = _prepared(bench, item_id, item_text)
    out = None
    for block in blocks(bench, "item_id", "item", block_chars):
        found = mark(docs.select(id_col, text), block, kind, text, chars_per_edit)
        found = found.select(F.col(id_col), F.explode("matches").alias("m"))
        found = found.select(id_col, "m.item_id", "m.distance")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.select(id_col, F.lit(None).cast(kind).alias("item_id"), F.lit(0).alias("distance"))
        out = out.where(F.lit(False))
    return out


def clean(
    docs: DataFrame,
    bench: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    chars_per_edit: int = CHARS_PER_EDIT,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs`` that contain no test item, all columns as they are."""
    bench, kind = _prepared(bench, item_id, item_text)
    columns = docs.columns
    kept = docs.withColumnRenamed("matches", "_matches")
    for block in blocks(bench, "item_id", "item", block_chars):
        kept = mark(kept, block, kind, text, chars_per_edit).where(F.size("matches") == 0).drop("matches")
    return kept.withColumnRenamed("_matches", "matches").select(*[F.col(f"`{c}`") for c in columns])
