import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkyield.llm import interning, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]
    return len(words), runs


def plain(docs, target, n, buckets, least, percent, seed):
    bucket = lambda w: zlib.crc32(w.encode()) % buckets
    s = Counter(bucket(w) for _, t in docs for w in features(t, n)[1])
    t = Counter(bucket(w) for _, x in target for w in features(x, n)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (S + float(buckets)) / ((s[b] + 1.0) * (T + float(buckets)))))
    rows = []
    for i, text in docs:
        words, runs = features(text, n)
        weight = sum(gain(bucket(w)) for w in runs)
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    able = [r for r in rows if r[4] >= least]
    able.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[2], r[1], r[4]))
    drawn = percent * len(able) // 100
    out = [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)]
    return out + [(*r[:4], None) for r in rows if r[4] < least]


def ordered(rows):
    return sorted((tuple((v is None, v or 0) for v in r) for r in rows))


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = ["Alpha", "beta9", "ÉTÉ", "x" * 40, "the", "of", "日本", "z" * 9, "q" * 31, "w" * 32, "a1b2c3d4"]
    seps = [" ", "  ", "\n", "-", ", ", "\x00", "\x7f"]
    out = []
    for i in range(n):
        out.append((i * 7 % 1009, "".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randrange(60)))))
    return out


@pytest.mark.parametrize("n,buckets", [(1, 10_000), (3, 97)])
def test_same_as_the_plain_form(make, n, buckets):
    docs = corpus(150) + [(None, None), (None, "the " * 30), (5, ""), (5, "of " * 25), (5, "of " * 25), (2000, "...")]
    target = corpus(9, 2) + [(None, None)]
    frame = make(docs, 4).withColumn("rank", F.lit(1)).withColumn("_low", F.lit(2))
    got = resample.resample(frame, make(target), percent=30, words=n, buckets=buckets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = plain(docs, target, n, buckets, 20, 30, 2024)
    assert ordered(map(tuple, got.collect())) == ordered(want)


def test_no_rows(make):
    docs, none = make(corpus(30)), make([(1, "a")]).where("false")
    assert resample.resample(none, docs).collect() == []
    assert resample.resample(docs, none).count() == 30


def test_drawn_documents(make):
    docs = make(corpus(100))
    ranks = resample.resample(docs, docs, percent=50).where("rank is not null")
    drawn = resample.sample(docs, docs, percent=50)
    assert drawn.columns == docs.columns
    assert {r["doc_id"] for r in drawn.collect()} == {r["doc_id"] for r in ranks.collect()}


@pytest.mark.parametrize("n", [1, 2, 4])
def test_long_rows_come_in_parts(n):
    import pyarrow as pa

    texts = ["".join(t for _, t in corpus(40, s)) for s in range(3)] + [None, "a" * 5000, "", "b"]
    total = [Counter() for _ in texts]
    words = [0] * len(texts)
    for first, size, runs in interning_runs(pa.array(texts), n, 300):
        strings = dict(zip(runs.table.used, runs.table.strings()))
        for slot, row in zip(runs.table.slots, runs.row):
            total[first + row][strings[slot].decode()] += 1
        for r in range(size):
            words[first + r] += int(runs.n_words[r])
    for got, count, text in zip(total, words, texts):
        assert (count, got) == (features(text, n)[0], Counter(features(text, n)[1]))


def interning_runs(column, n, piece):
    return resample.runs_of(column, n, 50, piece)


def test_hashes_are_xxhash64():
    rng = np.random.default_rng(4)
    buffer = rng.integers(0, 256, 5000, dtype=np.uint8)
    length = rng.integers(0, 70, 800)
    start = rng.integers(0, 4900, 800)
    got = interning.hashes(buffer, start, length)
    assert [int(x) for x in got] == [xxhash.xxh64_intdigest(buffer[a : a + n].tobytes()) for a, n in zip(start, length)]


def test_equal_hashes_get_slots_of_their_own():
    data = np.frombuffer(b"abcabdabcabeabc" + b"\0" * 8, np.uint8)
    start, length = np.array([0, 3, 6, 9, 12]), np.full(5, 3)
    table = interning.Table(data, start, length, np.full(5, 7, np.uint64))
    assert len(set(table.slots)) == 3 and table.slots[0] == table.slots[2] == table.slots[4]
    assert sorted(table.strings()) == [b"abc", b"abd", b"abe"]
    assert table.count[table.slots[0]] == 3
