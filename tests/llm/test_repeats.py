import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkyield.llm import induced, repeats


def naive_order(text):
    data = text.tolist()
    key = lambda i: tuple(data[i : data.index(0, i) + 1])
    return key, sorted(range(len(data)), key=key)


@pytest.mark.parametrize("memory", [0, 200, 1 << 20])
def test_induced_order_is_the_suffix_order(memory):
    rng = random.Random(memory)
    for _ in range(150):
        most = rng.choice([1, 2, 3, 256])
        parts = [[rng.randint(1, most) for _ in range(rng.randint(0, 30))] for _ in range(rng.randint(1, 12))]
        text = np.array([x for p in parts for x in p + [0]], np.int16)
        got = np.concatenate(list(induced.suffix_order(text, memory))).tolist()
        key, want = naive_order(text)
        assert sorted(got) == list(range(len(text)))
        assert [key(i) for i in got] == [key(i) for i in want]


def test_segments_hold_every_window_and_equal_windows_meet(monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 300)
    rng = random.Random(4)
    data = bytes(rng.choice(b"ab") for _ in range(1000)) + b"x" * 200
    data = data + data[100:400]
    keys, seen = {}, set()
    for first, last, key in repeats.segments(data):
        for a, b, k in zip(first, last, key):
            assert b - a <= 2 * repeats.WINDOW - repeats.GRAM
            for at in range(a, b - repeats.WINDOW + 1):
                seen.add(int(at))
                assert keys.setdefault(data[at : at + repeats.WINDOW], k) == k
    assert seen == set(range(len(data) - repeats.WINDOW + 1))


def plain(rows):
    """Covered bytes of every row, from a table of all windows."""
    rank = lambda i: repeats.NO_ID if i is None else i
    lowest = {}
    for i, t in rows:
        d = (t or "").encode()
        for p in range(len(d) - 49):
            w = d[p : p + 50]
            lowest[w] = min(lowest.get(w, rank(i)), rank(i))
    out = []
    for i, t in rows:
        d = (t or "").encode()
        gone = bytearray(len(d))
        for p in range(len(d) - 49):
            if lowest[d[p : p + 50]] < rank(i):
                gone[p : p + 50] = b"\1" * 50
        rest = bytes(x for x, g in zip(d, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "and", "über", "of", "stone", "river", "a", "🙂"]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "s", "ed"]) for _ in range(n))
    passages = [prose(rng.randint(8, 40)) for _ in range(6)]
    rows = []
    for i in range(60):
        text = prose(rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            text += " " + p[a : a + rng.randint(20, 200)] + " " + prose(rng.randint(0, 5))
        rows.append((i * 3 % 61, text))
    rows += [(100 + i, rows[5][1]) for i in range(5)]
    rows += [(200, None), (201, ""), (202, "x" * 49), (203, "x" * 50), (204, "x" * 300), (3, "x" * 120)]
    rows += [(7, passages[0]), (7, passages[0] + "!"), (7, passages[0]), (None, passages[0]), (None, "y" * 60), (205, "y" * 60)]
    rows += [(300, "ab" * 400), (301, "ab" * 100), (302, "\0" * 70), (303, "\0" * 70)]
    return rows


@pytest.mark.parametrize("seed,limit,gather", [(1, 1 << 24, 1 << 24), (2, 3000, 2000), (3, 200, 1 << 24)])
def test_against_every_window(spark, make, monkeypatch, seed, limit, gather):
    rows = corpus(seed)
    monkeypatch.setattr(repeats, "GATHER", gather)
    docs = make(rows).withColumn("doc", F.lit("clash")).withColumn("spans", F.lit(1))
    if limit < 1 << 24:
        # the parts of large shards, in this process
        gathered = repeats.Gathered(1)
        marks = []
        for n, (i, t) in enumerate(rows):
            gathered.add(repeats.NO_ID if i is None else i, n, (t or "").encode())
        for _, blob in gathered.blobs():
            found, at_once = repeats.unpack(blob)
            marks += [at_once, *repeats.shard_marks(found, limit=limit)]
        spans = defaultdict(list)
        for doc, n, a, b in np.concatenate(marks).tolist():
            spans[n].append((a, b))
        got = []
        for n, (i, t) in enumerate(rows):
            d, mine = (t or "").encode(), repeats.merged(spans[n])
            rest = repeats.cut(d, mine)
            got.append((i, len(d), len(d) - len(rest), len(mine), hashlib.sha256(rest).hexdigest()))
    else:
        got = [tuple(r) for r in repeats.digests(docs, shards=5).collect()]
        out = repeats.remove(docs, shards=5)
        assert out.columns == docs.columns and out.count() == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_long_text_and_no_documents(spark, make):
    rng = random.Random(8)
    base = " ".join(str(rng.randrange(10**6)) for _ in range(200_000))
    docs = make([(2, base[500_000:] + "end"), (1, base), (3, base[:60])])
    got = {r["doc_id"]: r for r in repeats.digests(docs).collect()}
    assert got[1]["n_removed"] == 0
    assert (got[2]["n_removed"], got[2]["n_spans"]) == (len(base) - 500_000, 1)
    assert got[3]["n_removed"] == 60
    assert repeats.digests(docs.where("doc_id < 0")).collect() == []
