import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkyield.llm import ppm

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def symbols(text):
    return [b + 1 for b in (text or "").translate(LOWER).encode()] + [257]


def train(texts, order):
    """Counts of every symbol after every context of up to ``order`` symbols, zeros before a text."""
    seen = defaultdict(Counter)
    for t in texts:
        s = [0] * order + symbols(t)
        for i in range(order, len(s)):
            for k in range(order + 1):
                seen[tuple(s[i - k : i])][s[i]] += 1
    return seen


def probability(seen, context, symbol):
    """From the longest context down, with a set of excluded symbols."""
    out, gone = 0.0, set()
    for k in range(len(context), -1, -1):
        here = seen.get(tuple(context[len(context) - k :]))
        if not here:
            continue
        left = {s: c for s, c in here.items() if s not in gone}
        n, d = sum(left.values()), len(left)
        if symbol in left:
            return out + math.log10(left[symbol] / (n + d))
        if n:
            out += math.log10(d / (n + d))
        gone |= set(here)
    return out - math.log10(257 - len(gone))


def plain(rows, order, held):
    learnt = [t for i, t in rows if not held(i)]
    seen = train(learnt, order)
    words = lambda t: WORD.findall((t or "").translate(LOWER)) + [None]
    count = Counter(w for t in learnt for w in words(t))
    N, V = count.total(), len(count)
    out = []
    for i, t in rows:
        s, w = [0] * order + symbols(t), words(t)
        lp = sum(probability(seen, s[k - order : k], s[k]) for k in range(order, len(s)))
        base = sum(math.log10((count[x] + 0.5) / (N + 0.5 * (V + 1))) for x in w)
        out.append((i, held(i), len(w), sum(count[x] > 0 for x in w), N, base, lp))
    return out


def corpus(n=60, seed=5):
    rng = random.Random(seed)
    words = ["the", "The", "of", "und", "él", "naïve", "zz9", "日本", "q" * 120, "\x00", "a\tb"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(25)))) for i in range(n)]
    rows += [(100 + i, "rare%d %x" % (i, rng.getrandbits(60))) for i in range(20)]
    return rows + [(None, "null id"), (7, None), (7, ""), (7, "the same"), (7, "the same"), (500, "x" * 9000)]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


@pytest.mark.parametrize("order,run_share,word_share", [(4, 1 << 21, 1 << 18), (4, 8, 6), (2, 1, 1), (0, 40, 3)])
def test_same_as_the_plain_model(make, order, run_share, word_share):
    rows = corpus()
    docs = make(rows, 4).withColumn("code", F.lit("clash")).withColumn("run", F.lit(1))
    got = ppm.score(docs, order=order, run_share=run_share, word_share=word_share)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])
    got, want = sorted(map(tuple, got.collect()), key=key), sorted(plain(rows, order, held), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


def test_tasks_that_send_early(make, monkeypatch):
    monkeypatch.setattr(ppm, "HELD", 50)
    rows = corpus()
    got = {(r["a"], r["b"]): r["n"] for r in ppm.counts(make(rows)).where("is_word").collect()}
    assert sum(got.values()) == sum(len(WORD.findall((t or "").translate(LOWER))) + 1 for _, t in rows)
    runs = ppm.counts(make(rows)).where("NOT is_word").agg(F.sum("n"), F.count("*"), F.count_distinct("a")).first()
    assert runs[0] == sum(len(symbols(t)) for _, t in rows) and runs[1] == runs[2]


def test_probabilities_of_a_context_sum_to_one(spark, make):
    rows = corpus(30)
    table = ppm.counts(make(rows)).where("NOT is_word").select(F.col("a").alias("code"), F.col("n").alias("c"))
    trie = ppm.Trie(table)
    context = 0
    for s in symbols("the ")[:4]:
        context = context << 9 | s
    runs = spark.range(1, 258).select((F.lit(context << 9) + F.col("id")).alias("code"))
    assert abs(sum(10 ** r["lp"] for r in trie.scored(runs).collect()) - 1) < 1e-9


def test_no_rows_and_nothing_learnt(make):
    none = make([(1, "a")]).where("false")
    assert ppm.score(none).collect() == []
    only = ppm.score(make([(1, "ab")]), training=F.lit(False)).first()
    assert math.isclose(only["score"], -3 * math.log10(257)) and only["base_score"] == 0.0
    assert (only["held_out"], only["n_known"], only["train_tokens"], only["n_tokens"]) == (True, 0, 0, 2)


def test_held_out_text_of_the_language_scores_above_noise(make):
    rng = random.Random(2)
    words = "one two three four five six seven eight nine ten".split()
    rows = [(i, " ".join(rng.choices(words, k=30))) for i in range(200)]
    noise = [(i + 1000, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=140))) for i in range(200)]
    got = {r["doc_id"]: r["score"] / r["n_tokens"] for r in ppm.score(make(rows + noise), training=F.col("doc_id") < 100).collect()}
    assert min(got[i] for i in range(100, 200)) > max(got[i] for i in range(1000, 1200))
