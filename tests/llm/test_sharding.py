import random
import zlib

import pytest
from pyspark.sql import functions as F

from sparkyield.llm import sharding


def jump(key, n):
    """The published algorithm."""
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 24, 25, 300])
def test_jump_hash_is_the_published_one(spark, n):
    rng = random.Random(n)
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *(rng.getrandbits(64) - 2**63 for _ in range(300))]
    keys += range(200)
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = df.select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()
    assert [r["s"] for r in got] == [jump(r["k"], n) for r in got]


def rows():
    rng = random.Random(7)
    out = [(rng.randrange(10**12), "é" * rng.randrange(5)) for _ in range(400)]
    out += [(5, "hot")] * 700 + [(5, "other"), (None, "x"), (None, None), (6, None), (7, "z" * 200000)]
    return out


@pytest.mark.parametrize("block_rows,copies", [(200_000, 100_000), (30, 64)])
def test_table_of_shards(spark, make, monkeypatch, block_rows, copies):
    monkeypatch.setattr(sharding, "COPIES", copies)
    docs = make(rows()).withColumn("slot", F.lit("clash")).withColumn("shard", F.lit(9))
    got = sharding.shard_table(docs, 24, block_rows=block_rows).collect()
    assert len(got) == len(rows())
    base = lambda i, t: (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=key) == sorted(
        (base(*r) for r in rows()), key=key
    )
    for r in got:
        assert r["shard"] == jump(r["doc_id"] or 0, 24) and r["law"] == "key"
        assert r["grown_shard"] in (r["shard"], 24)
    for s in range(24):
        mine = sorted((r["slot"], r["doc_id"] is not None, r["doc_id"] or 0) for r in got if r["shard"] == s)
        assert [m[0] for m in mine] == list(range(len(mine)))
        assert [m[1:] for m in mine] == sorted(m[1:] for m in mine)


def test_no_rows_and_text_keys(spark, make):
    docs = make([(1, "a")])
    assert sharding.shard_table(docs.where("doc_id < 0"), 24).collect() == []
    by_text = sharding.assign(make([(1, "a"), (2, "a"), (3, None), (4, None)]), "text", 50)
    shards = {r["doc_id"]: r["shard"] for r in by_text.collect()}
    assert shards[1] == shards[2] and shards[3] == shards[4]


def test_written_shards(make, tmp_path, spark):
    sharding.write_shards(make([(i, "t") for i in range(40)]), "doc_id", 4, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["doc_id"], r["shard"]) for r in back) == [(i, jump(i, 4)) for i in range(40)]
