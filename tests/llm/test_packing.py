import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from sparkyield.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def naive(sizes, length):
    """Best fit decreasing by looking at every row."""
    rows, free, since, clock = [], [], [], 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [r for r in range(len(rows)) if free[r] >= sizes[i]]
        if fits:
            r = min(fits, key=lambda r: (free[r], -since[r]))
            rows[r].append(i)
        else:
            rows.append([i])
            free.append(length)
            since.append(0)
            r = len(rows) - 1
        free[r] -= sizes[i]
        clock += 1
        since[r] = clock
    return rows


@pytest.mark.parametrize("length", [1, 7, 8, 64, 100])
def test_best_fit_decreasing(length):
    rng = random.Random(length)
    for n in (0, 1, 5, 300):
        sizes = [rng.randint(1, length) for _ in range(n)]
        assert packing.best_fit(sizes, length) == naive(sizes, length)


@pytest.mark.parametrize("length,group", [(16, 100), (2048, 2_000_000)])
def test_nothing_is_lost(spark, make, length, group):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["one", "zwei", "três", "42"]) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "<|endoftext|>"), (103, "long " * 30000), (104, "x"), (104, "x"), (None, "y")]
    docs = make(rows).withColumn("docs", F.lit("clash")).withColumn("row", F.lit(0))
    packed = packing.pack(docs, PATH, length=length, group=group).collect()
    with open(PATH, "rb") as f:
        coder = packing.encoding(f.read())
    parts = {}
    for r in packed:
        ids = np.frombuffer(r["ids"], "<i4")
        places = np.frombuffer(r["positions"], "<i4")
        assert len(ids) == len(places) == length
        cuts = r["cu_seqlens"]
        assert cuts[0] == 0 and cuts[-1] == length and len(r["docs"]) == len(r["starts"])
        assert len(cuts) - 1 == len(r["docs"]) + (r["n_tokens"] < length)
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            assert list(places[a:b]) == list(range(b - a))
            if k < len(r["docs"]):
                parts.setdefault(r["docs"][k], []).append((r["starts"][k], list(ids[a:b])))
            else:
                assert a == r["n_tokens"] and set(ids[a:b]) == {packing.END}
    got = {d: [x for _, p in sorted(p) for x in p] for d, p in parts.items()}
    want = {}
    for d, t in rows:
        want.setdefault(d, []).extend(coder.encode_ordinary(t or "") + [packing.END])
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in want.items()}
    assert all(got[d] == want[d] for d in want if d != 104)
    assert len({(r["part"], r["row"]) for r in packed}) == len(packed)
    digests = packing.digests(docs, PATH, length=length, group=group).collect()
    assert [r["cu_seqlens"] for r in digests] == [r["cu_seqlens"] for r in packed]
    assert packing.matrix(packed, length).shape == (len(packed), length)


def test_written_and_empty(spark, make, tmp_path):
    docs = make([(i, "a b c") for i in range(9)])
    packing.write(packing.pack(docs, PATH, length=8), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    # four ids each, two documents a row, three documents a partition
    assert sorted(len(r["docs"]) for r in back.collect()) == [1, 1, 1, 2, 2, 2]
    assert packing.pack(docs.where("doc_id < 0"), PATH).collect() == []


def test_long_white_space():
    """Runs of white space are encoded as the coder does where it can, and beyond."""
    with open(PATH, "rb") as f:
        raw = f.read()
    short, whole = packing.Coder(raw, longest=3), packing.encoding(raw)
    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choice([" ", " ", "\n", "\t", "\u3000", "\x1c", "a", "ab", "'s", "1", "!"]) for _ in range(rng.randint(0, 40)))
        assert short.encode(text).tolist() == whole.encode_ordinary(text), repr(text)
    coder = packing.Coder(raw)
    for run in (" " * 5_000_000, "\t " * 2_500_000, "\n" * 1_000_000):
        for text in (run, "a" + run + "b"):
            ids = coder.encode(text)
            assert coder.coder.decode_bytes(ids.tolist()) == text.encode()


def test_a_long_run_does_not_end_the_job(spark, make):
    docs = make([(1, "a"), (2, "x" + " " * 1_500_000 + "y")])
    packed = packing.pack(docs, PATH).collect()
    tokens = sum(r["n_tokens"] for r in packed)
    with open(PATH, "rb") as f:
        coder = packing.Coder(f.read())
    assert tokens == len(coder.encode("a")) + len(coder.encode("x" + " " * 1_500_000 + "y")) + 2
