import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
import corpus_pipeline
from sparkyield.llm import catalog, simhash
from llm.test_simhash import plain, roots

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_near_dedup_keeps_one_of_each_group(spark, make):
    rng = random.Random(6)
    base = [" ".join(rng.choice("one two three four five six".split()) for _ in range(60)) for _ in range(4)]
    rows = []
    for i in range(40):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = "seven"
        rows.append((100 - i, " ".join(words)))
    rows += [(1, None), (2, ""), (None, "alone"), (3, "twin"), (3, "twin"), (3, "TWIN"), (None, base[0])]
    docs = make(rows).withColumn("key", F.lit("clash")).withColumn("fp", F.lit(1))
    got = simhash.deduplicate(docs)
    assert got.columns == docs.columns
    fps = [plain(t) for _, t in rows]
    group = roots(range(len(rows)), fps)
    best = {}
    for (i, t), g in zip(rows, group):
        best.setdefault(g, []).append((i is None, i or 0, t or ""))
    kept = {(r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect()}
    assert got.count() == len(best)
    assert kept == {min(x)[:2] for x in best.values()}
    assert simhash.deduplicate(docs.where("doc_id < 0")).collect() == []


def test_stages_over_the_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, sf)
        assert docs.columns == COLUMNS, name
        rows = docs.collect()
        assert 0 < len(rows) <= before
        assert all(r["n_chars"] == len(r["text"]) for r in rows)
        docs = spark.createDataFrame(rows, docs.schema)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    library = Tokenizer.from_file(catalog.byte_bpe())
    got = entry_module.queries()["pipeline"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


@pytest.mark.parametrize("rows", [[(None, None), (1, ""), (2, "a b"), (2, "a b"), (3, "word " * 9)]])
def test_stages_on_odd_rows(spark, make, rows):
    docs = make(rows)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        docs.collect()
