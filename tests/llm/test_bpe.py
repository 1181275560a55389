import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkyield.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(1)
    return [
        "", "a", " ", "  ", "\n", "\n\n  x", " x", "x ", "a  b", "a \nb", "a\n b c ", "  a b",
        "aaaaaaaaaaaaa" * 50, "<|endoftext|>", "<|endoftext|>hi  <|endoftext|><|endoftext|> ",
        "x <|endoftext|> y", "it's we'll I'd  'S don't", "日本語テキスト 中文 字", "🙂🙂🙂é", "՘a֋ ՘",
        "\x00\x1c\x85  x \x1d", "\U0003d000 a\U0003d000 1𒑯2",
        "".join(rng.choice("abcdefgh") for _ in range(3000)),
        "".join(chr(rng.randrange(32, 0x3000)) for _ in range(3000)),
        "".join(rng.choice("ab \n\t.'s1é") for _ in range(20000)),
    ]


def check(texts, library, encoder):
    got = []
    for group in encoder.batches(iter(texts)):
        for parts in group:
            parts = list(parts)
            ids = [i for x, _ in parts for i in x.tolist()]
            assert ",".join(d for _, d in parts) == ",".join(map(str, ids))
            got.append(ids)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got == want


def test_ids_are_those_of_the_library(library, spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r[0] or "" for r in docs.select("text").collect()]
    with open(PATH, "rb") as f:
        vocabulary = bpe.Vocabulary(f.read())
    check(odd_texts() + texts, library, bpe.Encoder(vocabulary))


def test_blocks_and_forgetting_change_nothing(library, monkeypatch):
    with open(PATH, "rb") as f:
        vocabulary = bpe.Vocabulary(f.read())
    monkeypatch.setattr(bpe, "_CHARS", 300)
    monkeypatch.setattr(bpe, "_BLOCK", 7)
    monkeypatch.setattr(bpe, "_CACHE", 20)
    check(odd_texts(), library, bpe.Encoder(vocabulary))


def test_digests_encode_and_decode(spark, make, library):
    rows = list(enumerate(odd_texts())) + [(100, None), (None, "x"), (3, " x"), (3, " x")]
    docs = make(rows).withColumn("ids", F.lit("clash")).withColumn("d0", F.lit(1))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append(
            (
                i,
                len(ids),
                hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(back.encode()).hexdigest(),
            )
        )
    got = [tuple(r) for r in bpe.digests(docs, PATH).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    both = bpe.decode(bpe.encode(docs, PATH), PATH).select("doc_id", "text", "ids", "decoded", "d0")
    for r in both.collect():
        assert list(r["ids"]) == library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["decoded"] == (r["text"] or "") and r["d0"] == 1
    assert bpe.digests(docs.where("doc_id < 0"), PATH).collect() == []
