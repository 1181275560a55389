"""Quality rules: statistics of a text and the lines it shares with its host.

A line that many different documents of one host carry is boilerplate: it is removed
there, and a document of which too little is left is rejected. Line counts come from
hashes of normalised lines. Documents count as different by a hash of all their words
in order, so exact copies count once and do not turn their own text into boilerplate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkyield.llm.common import checkpointed, texts

WIDTH = 5
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
_CACHE = 500_000


@dataclass(frozen=True)
class Limits:
    """When a document fails and when a line is boilerplate of its host."""

    min_words: int = 10
    repeat_percent: int = 20
    #: a line goes if more different documents than both of these carry it
    line_docs: int = 20
    line_share: float = 0.1
    #: a document goes if fewer words or a smaller share of them are left
    left_words: int = 10
    left_share: float = 0.2


LIMITS = Limits()


class Words:
    """64-bit hashes of words, kept between documents up to a bound."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > _CACHE:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """A hash of each ``width`` words in a row; of all of them if there are fewer."""
    n = max(1, len(words) - width + 1) if len(words) else 0
    out = np.zeros(n, np.uint64)
    for i in range(min(width, len(words))):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
        out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def repeated_words(windows: np.ndarray, n_words: int, width: int = WIDTH) -> int:
    """Words within windows that occur twice or more."""
    if n_words <= width:
        return 0
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    again = order[np.r_[False, same] | np.r_[same, False]]
    if not len(again):
        return 0
    change = np.zeros(n_words + 1, np.int64)
    change[again] += 1
    change[again + width] -= 1
    return int(np.count_nonzero(np.cumsum(change[:-1])))


def line_hash(line: bytes) -> int:
    """Signed hash of a line: A-Z lowered, digits as 0, white space as one space."""
    plain = b" ".join(line.lower().translate(_DIGITS).split())
    value = xxhash.xxh64_intdigest(plain)
    return value - (1 << 64) if value >> 63 else value


def _signature(data: bytes) -> tuple[int | None, list[int]]:
    """A hash of all words and the distinct line hashes of a text."""
    split = data.split()
    if not split:
        return None, []
    lines = {line_hash(x) for x in set(data.split(b"\n")) if x.strip(SPACE)}
    return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(split))).view(np.int64)), list(lines)


def host_lines(
    docs: DataFrame, host: str = "source", text: str = "text", limits: Limits = LIMITS
) -> DataFrame:
    """``(host, lines)``: the hashes of the lines above the limits of each host.

    A host has at most ``mean lines of a document / line_share`` such lines.
    Null is a host like any other.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_signature(t.encode("utf-8", "replace")) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([s for s, _ in found], pa.int64()),
                    pa.array([x for _, x in found], pa.list_(pa.int64())),
                ],
                ["host", "doc", "lines"],
            )

    rows = docs.select(F.col(host).cast("string").alias("host"), text)
    marks = rows.mapInArrow(scan, "host string, doc bigint, lines array<bigint>")
    marks = checkpointed(marks.where("doc is not null"))
    lines = marks.select("host", "doc", F.explode("lines").alias("line")).distinct()
    counts = lines.groupBy("host", "line").count().where(F.col("count") > limits.line_docs)
    hosts = marks.select("host", "doc").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    counts, hosts = checkpointed(counts), checkpointed(hosts)
    frequent = counts.alias("c").join(hosts.alias("h"), F.expr("c.host <=> h.host"))
    frequent = frequent.where(F.col("count") > limits.line_share * F.col("docs"))
    return checkpointed(frequent.groupBy("c.host").agg(F.collect_set("line").alias("lines")))


RESULT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, n_removed_lines bigint, "
    "n_left_words bigint, kept boolean"
)


def judge(text: str, frequent: set[int], words: Words, limits: Limits = LIMITS) -> dict:
    """All figures of one text, the verdict, and under ``left`` the remaining text."""
    data = text.encode("utf-8", "replace")
    split = data.split()
    windows = window_hashes(words.hashes(split))
    lines = data.split(b"\n")
    spoken = [x for x in lines if x.strip(SPACE)]
    n = len(split)
    repeat = repeated_words(windows, n)
    failed = n < limits.min_words or 100 * repeat > limits.repeat_percent * n
    gone = {x for x in set(spoken) if line_hash(x) in frequent} if frequent else set()
    left = n - sum(len(x.split()) for x in spoken if x in gone) if gone else n
    depleted = bool(gone) and (left < limits.left_words or left < limits.left_share * n)
    return {
        "n_words": n,
        "word_chars": len(text) - (len(data) - len(data.translate(None, SPACE))),
        "n_symbols": len(data) - len(data.translate(None, SYMBOLS)),
        "n_dup_lines": len(spoken) - len(set(spoken)),
        "n_repeat_words": repeat,
        "base_failed": failed,
        "n_removed_lines": sum(x in gone for x in spoken) if gone else 0,
        "n_left_words": left,
        "kept": not failed and not depleted,
        "left": b"\n".join(x for x in lines if x not in gone).decode() if gone else text,
    }


def apply_rules(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    limits: Limits = LIMITS,
    left: bool = False,
) -> DataFrame:
    """Add the figures and the verdict ``kept`` to every row of ``docs``.

    ``left`` replaces the text by what remains of it without the removed lines.
    Null and empty texts have no words and fail. A null host is a host of its own.
    Repeated rows get the same verdict each. Columns of ``docs`` that bear a name of
    the result are replaced.
    """
    names = [c.split()[0] for c in RESULT.split(", ")]
    keep = [c for c in docs.columns if c not in names]
    lines = host_lines(docs, host, text, limits)
    given = docs.select(*[F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(keep)])
    at, host_at = keep.index(text), f"d{keep.index(host)}"
    joined = given.join(
        lines.select(F.col("host").alias("h"), F.col("lines").alias("frequent")),
        F.col(host_at).cast("string").eqNullSafe(F.col("h")),
        "left",
    ).drop("h")
    schema = ", ".join(f"d{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        last, frequent = None, set()
        for batch in batches:
            rows = []
            for value, known in zip(texts(batch.column(at)), batch.column(len(keep))):
                if known != last:
                    last, frequent = known, set(known.as_py() or ())
                rows.append(judge(value, frequent, words, limits))
            columns = list(batch.columns[: len(keep)])
            if left:
                null = columns[at].is_null().to_pylist()
                columns[at] = pa.array(
                    [None if x else r["left"] for x, r in zip(null, rows)], columns[at].type
                )
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array([r[c] for r in rows]) for c in names],
                [f"d{i}" for i in range(len(keep))] + names,
            )

    out = joined.mapInArrow(scan, f"{schema}, {RESULT}")
    return out.select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(keep)], *names)


