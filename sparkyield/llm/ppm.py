"""Language-model scores of documents by prediction by partial matching.

The model is a trie of byte contexts, counted over all training texts. A byte is coded
in its longest known context; where that has not seen it, an escape leads to the next
shorter one, in which symbols of the longer one are excluded. As a context's symbols are
among those of every shorter one, three figures of a context give all this exactly: its
count ``n``, its different symbols ``d``, and the count ``m`` that these symbols have in
the next shorter context. A text's last symbol is an end mark.

The trie lives in tables and grows with the texts. Only byte runs (and words, for the base
score) that make up a fixed share of all occurrences go to the tasks, so their number has
a bound that does not depend on the input; what is rarer is joined.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkyield.llm.common import checkpointed
from sparkyield.llm.interning import pieces, raw
from sparkyield.runtime import small

#: bytes of context; 9 bits a symbol, so at most 6
ORDER = 4
BITS = 9
END = 257
SYMBOLS = 257
#: a byte run or word goes to every task if it has this share of all occurrences
RUN_SHARE = 1 << 21
WORD_SHARE = 1 << 19
#: bytes of text looked up at once, few enough for a processor's cache
NEAR = 1 << 18
#: different byte runs or words that a task holds before it sends them on
HELD = 2_000_000
#: words that a task remembers, none longer than this
CACHE, CACHED_BYTES = 300_000, 100
_FOLD = np.arange(256, dtype=np.uint64) + 1
_FOLD[0x41:0x5B] += 32


def codes(data: np.ndarray, at: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """A number for each symbol with the ``order`` before it, and the symbols of each row.

    The row's bytes are numbered from 1 with A-Z lowered, the end mark comes last, and
    zeros stand before the first byte.
    """
    sizes = np.diff(at)
    row = np.repeat(np.arange(len(sizes)), sizes)
    full = np.zeros(int(sizes.sum()) + len(sizes) * (order + 1), np.uint64)
    full[np.arange(len(row)) + row * (order + 1) + order] = _FOLD[data[at[0] : at[-1]]]
    ends = np.cumsum(sizes + order + 1) - 1
    full[ends] = END
    out = full.copy()
    for k in range(1, order + 1):
        out[k:] |= full[:-k] << np.uint64(BITS * k)
    return out[full > 0].view(np.int64), sizes + 1


def _word_key(word: bytes) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(word)
    low, high = value & (1 << 64) - 1, value >> 64
    return low - (low >> 63 << 64), high - (high >> 63 << 64)


def _lowered(data: np.ndarray, a: int, b: int) -> bytes:
    return data[a:b].tobytes().lower()


COUNTS = "is_word boolean, a bigint, b bigint, n bigint"


def _sent(runs: list, words: Counter) -> Iterator[pa.RecordBatch]:
    """What a task has counted so far."""
    if runs:
        every, n = _merged(runs)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.zeros(len(every), bool)),
                pa.array(every),
                pa.array(np.zeros(len(every), np.int64)),
                pa.array(n),
            ],
            ["is_word", "a", "b", "n"],
        )
    if words:
        keys = np.array([_word_key(w) for w in words], np.int64)
        n = np.fromiter(words.values(), np.int64, len(words))
        columns = [np.ones(len(n), bool), keys[:, 0], keys[:, 1], n]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["is_word", "a", "b", "n"])


def _merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate([c for c, _ in runs])
    n = np.concatenate([x for _, x in runs])
    by = np.argsort(every, kind="stable")
    every, n = every[by], n[by]
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
    return every[first], np.add.reduceat(n, first)


def counts(texts: DataFrame, text: str = "text", order: int = ORDER) -> DataFrame:
    """Occurrences of every byte run of ``order`` + 1 symbols (``a``) and of every word (``a, b``).

    The empty word counts the rows: it is the end that follows the last word.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, words, held, word_bytes = [], Counter(), 0, 0
        for batch in batches:
            data, at = raw(batch.column(0))
            words[b""] += batch.num_rows
            for _, ends in pieces(data, at):
                found = np.unique(codes(data, ends, order)[0], return_counts=True)
                runs.append(found)
                held += len(found[0])
                for a, b in zip(ends[:-1], ends[1:]):
                    words.update(_lowered(data, a, b).split())
                if held > HELD:
                    runs = [_merged(runs)]
                    held = len(runs[0][0])
                if held > HELD or len(words) > HELD:
                    yield from _sent(runs, words)
                    runs, words, held = [], Counter(), 0
        yield from _sent(runs, words)

    parts = texts.select(text).mapInArrow(scan, COUNTS)
    return parts.groupBy("is_word", "a", "b").agg(F.sum("n").alias("n"))


def _context(code: Column) -> Column:
    return F.shiftright(code, BITS)


class Trie:
    """``levels[k]``: ``(code, c)`` of runs with k bytes of context; ``contexts[k]``: ``(context, n, d, m)``."""

    def __init__(self, runs: DataFrame, order: int = ORDER):
        """``runs (code, c)`` are the longest ones; shorter ones follow by summing."""
        self.order, self.levels, self.contexts = order, {}, {}
        level = runs
        for k in range(order, -1, -1):
            if k < order:
                low = F.col("code").bitwiseAND(F.lit((1 << BITS * (k + 1)) - 1)).alias("code")
                level = checkpointed(level.groupBy(low).agg(F.sum("c").alias("c")))
            self.levels[k] = level
        for k in range(order + 1):
            rows = self.levels[k].withColumn("shorter", F.lit(0).cast("long"))
            if k:
                low = F.col("code").bitwiseAND(F.lit((1 << BITS * k) - 1))
                below = self.levels[k - 1].select(F.col("code").alias("low"), F.col("c").alias("in_shorter"))
                rows = rows.withColumn("low", low).join(below, "low")
                rows = rows.withColumn("shorter", F.col("in_shorter"))
            sums = rows.groupBy(_context(F.col("code")).alias("context")).agg(
                F.sum("c").alias("n"), F.count("*").alias("d"), F.sum("shorter").alias("m")
            )
            self.contexts[k] = checkpointed(sums)

    def known(self) -> DataFrame:
        """``(code, c, lp)`` of all runs of full length: log10 of the share in their context."""
        rows = self.levels[self.order].withColumn("context", _context(F.col("code")))
        rows = rows.join(self.contexts[self.order].select("context", "n", "d"), "context")
        return rows.select("code", "c", F.log10(F.col("c") / (F.col("n") + F.col("d"))).alias("lp"))

    def scored(self, runs: DataFrame) -> DataFrame:
        """``lp`` of every row of ``runs (code)``, known or not, with escapes and exclusion."""
        out = runs.select(
            "code",
            F.lit(0.0).alias("lp"),
            F.lit(False).alias("done"),
            F.lit(0).cast("long").alias("pm"),
            F.lit(0).cast("long").alias("pd"),
        )
        for k in range(self.order, -1, -1):
            low = F.col("code").bitwiseAND(F.lit((1 << BITS * (k + 1)) - 1))
            level = self.levels[k].withColumnRenamed("code", "low")
            out = out.withColumn("low", low).withColumn("context", _context(F.col("low")))
            out = out.join(level, "low", "left").join(self.contexts[k], "context", "left")
            n, d = F.col("n") - F.col("pm"), F.col("d") - F.col("pd")
            visit = ~F.col("done") & F.col("n").isNotNull()
            hit = visit & F.col("c").isNotNull()
            escape = F.when(n + d > 0, F.log10(d / (n + d))).otherwise(0.0)
            gain = F.when(hit, F.log10(F.col("c") / (n + d))).when(visit, escape).otherwise(0.0)
            out = out.select(
                "code",
                (F.col("lp") + gain).alias("lp"),
                (F.col("done") | hit).alias("done"),
                F.when(visit, F.col("m")).otherwise(F.col("pm")).alias("pm"),
                F.when(visit, F.col("d")).otherwise(F.col("pd")).alias("pd"),
            )
        rest = F.when(F.col("done"), 0.0).otherwise(-F.log10(F.lit(float(SYMBOLS)) - F.col("pd")))
        return out.select("code", (F.col("lp") + rest).alias("lp"))


class Values:
    """Numbers of known codes in an open-addressed array, looked up many at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, np.nan)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            s = slot[left]
            free = self.keys[s] < 0
            self.keys[s[free]] = keys[left[free]]
            mine = self.keys[s] == keys[left]
            self.values[s[mine]] = values[left[mine]]
            left = left[~mine]
            slot[left] = (slot[left] + 1) % size

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, NaN for unknown ones."""
        slot = self._slots(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], np.nan)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[left]]
            hit = there == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out


class Words:
    """Base score of frequent words, remembered by their bytes up to a bound."""

    def __init__(self, frequent: dict[tuple[int, int], float]):
        self.frequent, self.known = frequent, {}

    def first(self, word: bytes) -> float | tuple[int, int]:
        """What :func:`split` needs of a word that is not remembered."""
        key = _word_key(word)
        got = self.frequent.get(key, key)
        if len(word) <= CACHED_BYTES:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[word] = got
        return got

    def split(self, met: Counter) -> tuple[float, int, list[tuple[int, int, int]]]:
        """Score and number of the frequent words of ``met``; key and number of each other one."""
        base, known, others, remembered = 0.0, 0, [], self.known
        for word, n in met.items():
            got = remembered.get(word)
            if got is None:
                got = self.first(word)
            if type(got) is float:
                base += n * got
                known += n
            else:
                others.append((*got, n))
        return base, known, others


FIRST = (
    "n_tokens bigint, n_known bigint, base_score double, score double, "
    "run array<bigint>, run_n array<bigint>, word_a array<bigint>, word_b array<bigint>, word_n array<bigint>"
)


def _first(column, runs: Values, words: Words, order: int) -> list:
    """Columns of ``FIRST``: sums over frequent runs and words, and lists of all others."""
    data, at = raw(column)
    out = {c.split()[0]: [] for c in FIRST.split(", ")}
    for _, ends in pieces(data, at, NEAR):
        every, sizes = codes(data, ends, order)
        lp = runs.find(every)
        row = np.repeat(np.arange(len(sizes)), sizes)
        rare = np.flatnonzero(np.isnan(lp))
        lp[rare] = 0.0
        out["score"] += np.bincount(row, lp, len(sizes)).tolist()
        split = np.searchsorted(row[rare], np.arange(1, len(sizes)))
        for (a, b), some in zip(zip(ends[:-1], ends[1:]), np.split(every[rare], split)):
            met = Counter(_lowered(data, a, b).split())
            met[b""] = 1
            base, known, others = words.split(met)
            code, code_n = np.unique(some, return_counts=True)
            out["n_tokens"].append(met.total())
            out["n_known"].append(known)
            out["base_score"].append(base)
            out["run"].append(code.tolist())
            out["run_n"].append(code_n.tolist())
            for i, c in enumerate(("word_a", "word_b", "word_n")):
                out[c].append([x[i] for x in others])
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), *[pa.list_(pa.int64())] * 5]
    return [pa.array(v, k) for v, k in zip(out.values(), kinds)]


def held_out(key: Column) -> Column:
    """Rows the model does not learn from; a null id is learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 1, F.lit(False))


def score(
    docs: DataFrame,
    training: Column | None = None,
    key: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    run_share: int = RUN_SHARE,
    word_share: int = WORD_SHARE,
) -> DataFrame:
    """Log10 probability of every text of ``docs`` under the model and under word counts.

    ``training`` marks the rows to learn from, by default those that :func:`held_out`
    leaves. A null text is empty: it has the end mark only. Rows with equal ids or equal
    texts are rows of their own, and each counts in training. Without training rows every
    symbol has probability 1/257 and a text's base score is 0. Only ``key`` and ``text``
    are read. ``run_share`` and ``word_share`` decide what goes to the tasks, not results.
    """
    training = ~held_out(F.col(key)) if training is None else training
    table = checkpointed(counts(docs.where(training).select(text), text, order))
    words = table.where("is_word").select("a", "b", "n")
    runs = table.where("NOT is_word").select(F.col("a").alias("code"), F.col("n").alias("c"))
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    symbols = runs.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    trie = Trie(runs, order)
    below = total + 0.5 * (kinds + 1)

    # at most run_share runs and word_share words
    frequent = trie.known().where(F.col("c") >= -(-symbols // run_share))
    frequent = frequent.select("code", "lp").toPandas()
    often = words.where(F.col("n") >= -(-total // word_share)).collect()
    base = {(r["a"], r["b"]): math.log10((r["n"] + 0.5) / below) for r in often}
    shared = docs.sparkSession.sparkContext.broadcast(
        (frequent["code"].to_numpy(np.int64), frequent["lp"].to_numpy(np.float64), base)
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, lp, often = shared.value
        values, known = Values(code, lp), Words(often)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                columns = _first(part.column(1), values, known, order)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *columns], names)

    names = [key, "held_out", *(c.split()[0] for c in FIRST.split(", "))]
    kind = docs.schema[key].dataType.simpleString()
    light = docs.select(F.col(key), F.col(text), (~training).alias("held_out"))
    first = light.mapInArrow(scan, f"`{key}` {kind}, held_out boolean, {FIRST}")
    # the stored table keeps the numbers
    first = checkpointed(first.withColumn("no", F.monotonically_increasing_id()))

    rare = first.select("no", F.explode(F.arrays_zip("run", "run_n")).alias("z")).select("no", "z.run", "z.run_n")
    lp = trie.scored(rare.select(F.col("run").alias("code")).distinct())
    by_run = rare.join(small(lp.withColumnRenamed("code", "run")), "run").select(
        "no", (F.col("run_n") * F.col("lp")).alias("score"), F.lit(0.0).alias("base_score"), F.lit(0).cast("long").alias("n_known")
    )
    zipped = F.explode(F.arrays_zip("word_a", "word_b", "word_n")).alias("z")
    parts = first.select("no", zipped).select("no", F.col("z.word_a").alias("a"), F.col("z.word_b").alias("b"), "z.word_n")
    parts = parts.join(words, ["a", "b"], "left")
    here = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(below))
    by_word = parts.select(
        "no", F.lit(0.0).alias("score"), (F.col("word_n") * here).alias("base_score"),
        F.when(F.col("n").isNotNull(), F.col("word_n")).otherwise(0).alias("n_known"),
    )
    sums = by_run.unionByName(by_word).groupBy("no").agg(
        F.sum("score").alias("more_score"), F.sum("base_score").alias("more_base"), F.sum("n_known").alias("more_known")
    )
    out = first.select(key, "held_out", "n_tokens", "n_known", "base_score", "score", "no")
    out = out.join(sums, "no", "left")
    more = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    return out.select(
        key,
        "held_out",
        "n_tokens",
        more("n_known", "more_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        more("base_score", "more_base"),
        more("score", "more_score"),
    )
