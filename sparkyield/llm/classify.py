"""Quality scores learnt from preferences (Bradley-Terry).

A document of label 1 is preferred to one of label 0. Logistic loss on the difference
of their features gives a linear score; a second logistic fit turns it into the
probability of label 1, and a quantile of the scores is the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import eq

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkyield.llm.common import checkpointed, texts

FEATURES = [
    "length", "word_length", "symbols", "exclamations", "capitals", "digits",
    "same_as_before", "distinct", "lone_symbols", "punctuation", "line_length",
]
#: labelled rows that are fitted, at most
SAMPLE_ROWS = 200_000
#: pairs that each row of the more frequent label is part of, on average
PAIRS = 4
THRESHOLD = 0.3

_SYMBOLS, _DIGITS = b"#*$%&|<>~^=_+@\\/{}[]", b"0123456789"
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PUNCTUATION = b".,;:?'\"()-"


def features(text: str) -> list[float]:
    """Figures of the whole text, each about 0 to 1; all 0 without words."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = sum(map(len, words))
    share = lambda those: math.sqrt((len(data) - len(data.translate(None, those))) / chars)
    distinct = set(words)
    lone = sum(len(w) == 1 and not w.isalnum() for w in words)
    return [
        min(1.0, math.log1p(n) / 10),
        min(1.0, chars / n / 20),
        share(_SYMBOLS),
        share(b"!"),
        share(_CAPITALS),
        share(_DIGITS),
        math.sqrt(sum(map(eq, words, words[1:])) / n),
        math.log1p(len(distinct)) / math.log1p(n),
        math.sqrt(lone / n),
        share(_PUNCTUATION),
        min(1.0, math.log1p(n / (data.count(b"\n") + 1)) / 10),
    ]


def measured(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and ``f``, the features of every text; null texts count as empty."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.float64()))], [id_col, "f"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text).mapInArrow(scan, f"`{id_col}` {kind}, f array<double>")


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fifth of the ids that is never learnt from; a null id counts as ''."""
    value = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.pmod(value, F.lit(5)) == 0


def preferences(rows: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """Differences ``x`` of a preferred and another row; ``rows`` has ``f`` and ``y``.

    Both labels are dealt into as many slots as the rarer one has rows, ``pairs`` times,
    and rows that meet in a slot form a pair. So their number grows with the rows.
    """
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    slots = max(1, min(counts.get(0, 0), counts.get(1, 0)))
    turn = F.explode(F.sequence(F.lit(1), F.lit(pairs))).alias("turn")
    dealt = rows.select("f", "y", turn).withColumn(
        "slot", F.pmod(F.xxhash64("f", "y", "turn"), F.lit(slots))
    )
    better = dealt.where("y = 1").select("turn", "slot", F.col("f").alias("a"))
    worse = dealt.where("y = 0").select("turn", "slot", F.col("f").alias("b"))
    return better.join(worse, ["turn", "slot"]).select(F.zip_with("a", "b", lambda a, b: a - b).alias("x"))


class Ranking:
    """A fitted score: weights of the features, and its scale as a probability."""

    def __init__(self, weights: list[float], slope: float, offset: float):
        self.weights, self.slope, self.offset = weights, slope, offset

    def score(self, f: Column) -> Column:
        total = F.lit(self.offset)
        for i, w in enumerate(self.weights):
            total = total + f[i] * F.lit(self.slope * w)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, pairs: int = PAIRS) -> Ranking:
    """Learn from ``rows (f, y)``: at most ``sample_rows`` different ones, by hash order.

    With one label only, or none, every score is the share of label 1, or one half.
    """
    rows = rows.where("y in (0, 1)").distinct()
    order = F.xxhash64("f", "y")
    rows = checkpointed(rows.withColumn("o", order).orderBy("o").limit(sample_rows).drop("o"))
    n, ones = rows.agg(F.count("*"), F.sum("y")).first()
    if not n or ones in (0, n):
        share = min(max((ones or 0) / n, 0.001), 0.999) if n else 0.5
        return Ranking([0.0] * len(FEATURES), 1.0, math.log(share / (1 - share)))
    x = preferences(rows, pairs)
    both = x.select("x", F.lit(1.0).alias("label")).unionByName(
        x.select(F.transform("x", lambda v: -v).alias("x"), F.lit(0.0).alias("label"))
    )
    both = checkpointed(both)
    model = LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=60, standardization=True)
    weights = model.fit(both.select(array_to_vector("x").alias("features"), "label")).coefficients
    weights = [float(w) for w in weights]
    raw = sum((F.col("f")[i] * F.lit(w) for i, w in enumerate(weights)), F.lit(0.0))
    scaled = rows.select(array_to_vector(F.array(raw)).alias("features"), F.col("y").cast("double").alias("label"))
    scale = LogisticRegression(regParam=1e-5, maxIter=60).fit(scaled)
    return Ranking(weights, float(scale.coefficients[0]), float(scale.intercept))


def rank(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    text: str = "text",
    id_col: str = "doc_id",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Score every document: ``held_out``, ``score``, ``predicted`` and ``above``.

    Labels are learnt from ids outside the held-out fifth; of several labels of an id
    the mean counts, half as 1, and other values or nulls are left out. Only the text
    is an input of a score. ``predicted`` is 1 from a score of 0.3 on. ``above`` says
    whether the score is over the quantile that the share of label 0 sets. Null and
    empty texts get a score too; repeated rows stay.
    """
    marks = checkpointed(measured(docs, text, id_col))
    given = labels.where(f"`{label}` in (0, 1)").groupBy(F.col(id_col).alias("id"))
    given = given.agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    known = marks.where(~held_out(id_col)).join(given, F.col(id_col) == F.col("id"))
    known = checkpointed(known.select("f", "y"))
    model = fit(known, sample_rows)
    scored = marks.select(id_col, held_out(id_col).alias("held_out"), model.score(F.col("f")).alias("score"))
    share = known.agg(F.coalesce(1 - F.avg("y"), F.lit(0.0))).first()[0]
    cut = scored.agg(F.percentile_approx("score", float(share), 10_000)).first()[0]
    return scored.select(
        "*",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        (F.col("score") > F.lit(cut if share else -1.0)).alias("above"),
    )
