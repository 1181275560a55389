"""Resampling of documents towards a target distribution of hashed word runs.

Raw and target texts are counted in hashed buckets. A bucket's gain is the logarithm of
its smoothed share in the target over that in the raw texts; a document's weight is the
sum of its features' gains. Gumbel noise on the weights and a cut at the highest scores
draw without replacement in proportion to the importance weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkyield.functions.ordered import POS, positioned
from sparkyield.llm.common import checkpointed
from sparkyield.llm.interning import PIECE, Table, cut_long, hashes, pieces, raw, split_words
from sparkyield.runtime import attach

BUCKETS = 10_000
WORDS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024


class Runs:
    """Occurrences of runs of 1 to ``words`` words of some rows, interned, with their buckets."""

    def __init__(self, data: np.ndarray, at: np.ndarray, words: int, buckets: int, known: bytes = b""):
        """``known`` are the words before the first row; runs that end in them are not counted."""
        if known:
            data, at = np.r_[np.frombuffer(known + b" ", np.uint8), data[at[0] : at[-1]]], at - at[0] + len(known) + 1
            at = np.r_[0, at[1:]]
        buffer, start, length, row = split_words(data, at)
        skip = len(known.split())
        self.n_words = np.bincount(row[skip:], minlength=len(at) - 1)
        # what the next part of a long row needs
        tail = start[-(words - 1)] if words > 1 and len(start) >= words else 0
        self.last = buffer[tail:-9].tobytes()
        starts, lengths, rows = [], [], []
        for n in range(1, words + 1):
            first = np.arange(max(0, skip - n + 1), max(0, len(start) - n + 1))
            first = first[row[first] == row[first + n - 1]]
            starts.append(start[first])
            lengths.append(start[first + n - 1] + length[first + n - 1] - start[first])
            rows.append(row[first])
        start, length = np.concatenate(starts), np.concatenate(lengths)
        self.row = np.concatenate(rows)
        self.table = Table(buffer, start, length, hashes(buffer, start, length))
        self.bucket = np.zeros(len(self.table.owner), np.int64)
        found = (zlib.crc32(x) % buckets for x in self.table.strings())
        self.bucket[self.table.used] = np.fromiter(found, np.int64, len(self.table.used))


def runs_of(column, words: int, buckets: int, piece: int = PIECE) -> Iterator[tuple[int, int, Runs]]:
    """``(first row, rows, runs)`` over a text column; a long row comes in parts."""
    data, at = raw(column)
    for first, ends in pieces(data, at, piece):
        if len(ends) > 2 or ends[-1] - ends[0] <= piece:
            yield first, len(ends) - 1, Runs(data, ends, words, buckets)
            continue
        known = b""
        for part in cut_long(data, int(ends[0]), int(ends[1]), piece):
            runs = Runs(data, part, words, buckets, known)
            known = runs.last if words > 1 else b""
            yield first, 1, runs


def bucket_counts(
    texts: DataFrame, text: str = "text", words: int = WORDS, buckets: int = BUCKETS
) -> DataFrame:
    """``(bucket, n)`` over all rows; every task sends one row for each bucket it has met."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, runs in runs_of(batch.column(0), words, buckets):
                used = runs.table.used
                np.add.at(total, runs.bucket[used], runs.table.count[used])
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    parts = texts.select(text).mapInArrow(scan, "bucket bigint, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw_counts: DataFrame, target_counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket; ``buckets`` numbers reach the driver."""
    table = raw_counts.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    for name, counts in (("s", raw_counts), ("t", target_counts)):
        table = table.join(counts.withColumnRenamed("n", name), "bucket", "left").fillna(0, [name])
    table = checkpointed(table)
    sums = table.agg(F.sum("s").cast("double").alias("s_all"), F.sum("t").cast("double").alias("t_all"))
    up = (F.col("t") + 1).cast("double") * (F.col("s_all") + float(buckets))
    down = (F.col("s") + 1).cast("double") * (F.col("t_all") + float(buckets))
    found = attach(table, sums, []).select("bucket", F.floor(1000 * F.ln(up / down)).alias("gain"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():
        out[r["bucket"]] = r["gain"]
    return out


def weights(
    docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", words: int = WORDS
) -> DataFrame:
    """``(key, n_words, n_features, weight)`` of every row."""
    buckets = len(gain)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            out = {k: np.zeros(n, np.int64) for k in ("n_words", "n_features", "weight")}
            for first, size, runs in runs_of(batch.column(1), words, buckets):
                rows = slice(first, first + size)
                own = gain[runs.bucket[runs.table.slots]]
                sums = np.zeros(size, np.int64)
                np.add.at(sums, runs.row, own)
                out["weight"][rows] += sums
                out["n_words"][rows] += runs.n_words
                out["n_features"][rows] += np.bincount(runs.row, minlength=size)
            columns = [batch.column(0), *map(pa.array, out.values())]
            yield pa.RecordBatch.from_arrays(columns, [key, *out])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_words bigint, n_features bigint, weight bigint"
    return docs.select(key, text).mapInArrow(scan, schema)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    words: int = WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Every row of ``docs`` with its weight and score, and its ``rank`` if it is drawn.

    Of the rows with ``least_words`` words, ``percent`` per cent with the highest scores
    are drawn, ties by id. A null text has no features and weight 0; a null id is hashed
    as ``null`` and comes first among ties. Rows with equal ids share their noise and are
    ranked one after the other by their other columns. Only ``doc_id`` and ``text`` are
    read. Of no rows none is drawn; without a target all its counts are 0.
    """
    gain = gains(
        bucket_counts(docs, words=words, buckets=buckets),
        bucket_counts(target, words=words, buckets=buckets),
        buckets,
    )
    light = weights(docs.select("doc_id", "text"), gain, words=words)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))
    scored = checkpointed(light.withColumn("score", F.col("weight") + noise))
    able = F.col("n_words") >= least_words
    drawn = scored.where(able).count() * percent // 100
    order = scored.where(able).withColumn("_low", -F.col("score"))
    placed = positioned(order, ["_low", "doc_id", "weight", "n_features", "n_words"])
    rank = F.when(F.col(POS) < drawn, F.col(POS) + 1)
    names = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    return placed.select(*names, rank.alias("rank")).unionByName(scored.where(~able).select(*names, none))


def sample(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn documents with all their columns; ``doc_id`` must be unique."""
    ranks = resample(docs, target, **settings).where("rank is not null")
    return docs.join(ranks.select("doc_id"), "doc_id", "left_semi")
