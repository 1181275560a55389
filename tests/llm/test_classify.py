import math
import zlib

import pytest
from conftest import SF
from pyspark.sql import functions as F

from sparkyield.llm import classify


def test_features_of_odd_texts():
    for text in ("", " \n", "a", "ab ab ab", "!!! ###", "é" * 10, "x " * 100000, "\x00"):
        f = classify.features(text)
        assert len(f) == len(classify.FEATURES) and all(math.isfinite(v) for v in f)
    assert classify.features("") == [0.0] * len(classify.FEATURES)
    assert classify.features("A a a b")[classify.FEATURES.index("same_as_before")] == 0.5


def test_held_out_ids(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(50), None]], "doc_id long")
    for r in ids.select("doc_id", classify.held_out().alias("h")).collect():
        text = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["h"] == (zlib.crc32(text.encode()) % 5 == 0)


def test_pairs_prefer_label_one_and_stay_few(spark):
    rows = spark.createDataFrame([([float(i), 1.0], int(i >= 40)) for i in range(400)], "f array<double>, y int")
    found = [r["x"] for r in classify.preferences(rows).collect()]
    assert found and all(x[0] > 0 and x[1] == 0 for x in found)
    assert len(found) < 3 * classify.PAIRS * 360


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet")
    got = classify.rank(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "above"]
    assert got.count() == docs.count()
    judged = got.join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in judged)
    assert len(judged) > 50 and right >= 0.95 * len(judged)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in judged)


@pytest.mark.parametrize("values", [[], [1], [None, 7]])
def test_too_few_labels_and_odd_rows(spark, make, values):
    docs = make([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "z"), (4, "long " * 50000)])
    docs = docs.withColumn("score", F.lit("clash")).withColumn("y", F.lit(1)).withColumn("f", F.lit(1))
    labels = spark.createDataFrame([(3, v) for v in values], "doc_id long, quality int")
    got = classify.rank(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert classify.rank(docs.where("doc_id < 0"), labels).collect() == []


def test_labels_decide(spark, make):
    """Turning the labels round turns the scores round; repeated labels count once."""
    rows = [(i, ("Plain words here, and more. " if i % 2 else "X## Y## Z## ") * (5 + i % 7)) for i in range(200)]
    docs = make(rows)
    for flip in (0, 1):
        labels = [(i, (i % 2) ^ flip) for i, _ in rows] + [(2, 0 ^ flip)] * 50
        got = classify.rank(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert all(r["predicted"] == (r["doc_id"] % 2) ^ flip for r in got)
