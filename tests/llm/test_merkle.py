import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparkyield.llm import merkle

H = lambda s: hashlib.sha256(s.encode()).hexdigest()
LOWER = {c: c + 32 for c in range(65, 91)}


def leaf(row, text):
    parts = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts))


def climb(level):
    """Last node of a list of digests, and each one's steps as (before, after)."""
    steps, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for k, a in enumerate(at):
            run = level[a // 16 * 16 : a // 16 * 16 + 16]
            steps[k].append((run[: a % 16], run[a % 16 + 1 :]))
            at[k] = a // 16
        level = [H("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
    return level[0], steps


def plain(rows, every=5):
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    low = lambda t: t if t is None else t.translate(LOWER)
    subs, inner = [], []
    for s in order:
        mine = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        sub, steps = climb([leaf(r, r["text"]) for r in mine])
        subs.append(sub)
        inner.append((mine, steps))
    if not subs:
        return []
    root, outer = climb(subs)
    out = []
    for sub, (mine, steps), top in zip(subs, inner, outer):
        for r, s in zip(mine, steps):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % every == 0
            acc = leaf(r, low(r["text"]) if hit else r["text"])
            path = s + top
            for b, a in path:
                acc = H("".join([*b, acc, *a]))
            proof = H("".join(x for b, a in path for x in [*b, *a]))
            key = r["doc_id"] is not None, r["doc_id"] or 0
            out.append((key, leaf(r, r["text"]), sub, root, proof, acc, acc == root))
    return sorted(out)


def got(df):
    return sorted(
        ((r["doc_id"] is not None, r["doc_id"] or 0), r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"])
        for r in df.collect()
    )


def table(sizes, seed=3):
    rng = random.Random(seed)
    ids = rng.sample(range(10**6), sum(sizes))
    words = ["Abc", "d", "É", "ZZ", "", " \n"]
    out = []
    for s, n in enumerate(sizes):
        for _ in range(n):
            text = rng.choice([None, "", "x" * rng.randrange(2000), " ".join(rng.choices(words, k=5))])
            out.append((ids.pop(), text, None if s == 1 else f"s{s}é"))
    return out


@pytest.mark.parametrize(
    "sizes",
    [[1], [2], [16], [17], [1, 1], [1] * 18, [700, 1, 16, 17, 257, 2], [300]],
    ids=str,
)
def test_same_as_the_plain_tree(make, sizes):
    docs = make(table(sizes))
    assert got(merkle.audit(docs)) == plain([r.asDict() for r in docs.collect()])


def test_odd_rows(make):
    rows = [(None, "A", "s"), (None, None, None), (5, "Hot", "s"), (5, "Hot", "s"), (5, "Other", "s"), (7, "Y" * 300000, "")]
    docs = make(rows).withColumn("lang", F.when(F.col("doc_id") == 7, F.col("lang")))
    docs = docs.withColumn("g", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("_pos", F.lit(2))
    assert got(merkle.audit(docs)) == plain([r.asDict() for r in docs.collect()])
    assert merkle.audit(docs.where("false")).collect() == []


def test_untampered_rows_verify(make):
    docs = make(table([60, 3]))
    assert all(r["verified"] for r in merkle.manifest(docs).collect())
