import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkyield.llm import simhash


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(ids, fps, limit=3):
    """Component of each position by brute force."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= limit:
                parent[find(i)] = find(j)
    groups = {}
    for i, x in enumerate(ids):
        if x is not None:
            r = find(i)
            groups[r] = min(groups.get(r, x), x)
    return [groups.get(find(i)) for i in range(len(fps))]


def test_fingerprint_is_the_bit_majority():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 5, 50, 400):
        text = " ".join(rng.choice(["Ab", "c", "Éé", "x y", "\x1cz"]) for _ in range(n))
        assert simhash.fingerprint(text) == plain(text)
    assert simhash.fingerprint("\t \n") == 0
    assert simhash.fingerprint("A b\vC") == simhash.fingerprint("a  B c")


def test_anchors_meet_for_every_close_pair():
    rng = np.random.default_rng(2)
    fp = rng.integers(0, 2**64, 200, dtype=np.uint64)
    fp[:3] = [0, 2**64 - 1, 2**31]
    keys, home = simhash.anchors(fp)
    for _ in range(20):
        other = fp.copy()
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            other ^= np.uint64(1 << int(bit))
        near, _ = simhash.anchors(other)
        for a, b in zip(keys[:, home], near):
            assert any(k in b for k in a)


def close_fingerprints(n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = []
    for _ in range(n):
        x = rng.choice(centres)
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("anchor_rows", [20, 1_000_000])
def test_links_keep_every_component(spark, anchor_rows):
    fps = close_fingerprints(500, 3)
    signed = [(int(np.uint64(x).view(np.int64)),) for x in fps]
    found = simhash.links(spark.createDataFrame(signed, "fp long"), anchor_rows=anchor_rows)
    edges = [(a % 2**64, b % 2**64) for a, b in found.distinct().collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    parent = {x: x for x in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    want = roots(range(len(fps)), fps)
    got = {}
    for i, x in enumerate(fps):
        got.setdefault(find(x), i)
    assert [got[find(x)] for x in fps] == want


def test_documents_against_brute_force(spark, make):
    rng = random.Random(5)
    base = [" ".join(rng.choice("one two three four five six".split()) for _ in range(60)) for _ in range(5)]
    rows = []
    for i in range(60):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = rng.choice(["seven", "eight"])
        rows.append((i, " ".join(words)))
    rows += [(60, None), (61, ""), (62, " \n"), (63, "word"), (63, "word"), (64, "WORD"), (None, "word")]
    rows += [(65, "long words " * 30000)]
    docs = make(rows).withColumn("fp", F.lit(1)).withColumn("first", F.lit("x"))
    got = simhash.near_duplicates(docs).collect()
    fps = [plain(t) for _, t in rows]
    want = zip([r[0] for r in rows], fps, roots([r[0] for r in rows], fps))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(
        ((i, f"{f:016x}", c) for i, f, c in want), key=key
    )


def test_no_documents(spark, make):
    docs = make([(1, "a")]).where("doc_id < 0")
    assert simhash.near_duplicates(docs).collect() == []
