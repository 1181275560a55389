"""One pass over the values serves all pairs: right figures, and no row copied for a pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkyield.functions import sweep
from sparkyield.operators import similarity
from sparkyield.operators.evaluate import POISSON


def table(spark, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(v, f, float(x)) for v in "abcd" for f in ("f", "g") for x in rng.integers(0, 12, 15)]
    rows += [("e", "f", 1.5), ("a", "h", 2.0), ("c", "h", 2.0), (None, "f", 3.0)]
    return rows, spark.createDataFrame(rows, "variedad string, variable string, value double")


@pytest.mark.parametrize("limit", [None, 9])
def test_pairs_match_plain_figures(spark, limit, monkeypatch):
    monkeypatch.setattr(sweep, "CELLS", 20)
    rows, df = table(spark)
    counts = df.groupBy("variedad", "variable", "value").count().withColumnRenamed("count", "n")
    pairs = similarity.pair_counts(counts, ["a", "b"])
    got = {(r.variedad, r.ancla): r.distancia for r in similarity.wasserstein(pairs, limit=limit).collect()}
    tests = {(r.variedad, r.ancla, r.variable): (r.n1, r.n2, r.u) for r in similarity.mann_whitney(pairs, limit=limit).collect()}
    assert {k[0] for k in got} == {"c", "d", "e"}
    for v, a in got:
        per = []
        for f in "fgh":
            x, y = ([r[2] for r in rows if r[:2] == (s, f)] for s in (v, a))
            grid = sorted({*x, *y})
            if x and y and len(grid) > 1:
                at = lambda s, g: sum(q <= g for q in s) / len(s)
                per.append(sum(abs(at(x, g) - at(y, g)) * (h - g) for g, h in zip(grid, grid[1:])))
            if min(len(x), len(y)) >= 3:
                u = sum((p > q) + (p == q) / 2 for p in x for q in y)
                assert tests.pop((v, a, f)) == (len(x), len(y), u)
        assert got[v, a] == pytest.approx(np.mean(per), abs=1e-9)
    assert not tests


def test_no_row_is_copied_for_a_pair(spark):
    _, df = table(spark)
    counts = df.groupBy("variedad", "variable", "value").count().withColumnRenamed("count", "n")
    few, many = similarity.pair_counts(counts, ["a"]), similarity.pair_counts(counts, ["a", "b", "c"])
    assert few.counts.count() == many.counts.count() == counts.count()


def test_all_replicates_in_one_pass(spark):
    """Vectors of weights give the distances that exploded replicates give."""
    r, span = 7, 1 << 30
    rng = np.random.default_rng(4)
    rows = []
    for v, n in (("a", 1), ("b", 60), ("c", 200), ("x", 150), ("y", 90)):
        for i in range(n):
            rows.append((v, float(rng.integers(0, 4)), float(rng.normal()), 1.5, [int(d) for d in rng.integers(0, span, r)]))
    df = spark.createDataFrame(rows, "variedad string, f double, g double, h double, draws array<int>").repartition(3)
    features, anchors = ["f", "g", "h"], ["x", "y"]
    left, fixed = df.where("variedad < 'x'"), similarity.feature_counts(df.where("variedad >= 'x'"), features)
    folded = sweep.weighted_counts(left, features, r, span, POISSON)
    counts = similarity.runtime.materialize(folded.unionByName(fixed, allowMissingColumns=True))
    got = similarity.replicate_distances(similarity.pair_counts(counts, anchors), r, limit=40)

    reps = F.explode(F.sequence(F.lit(1), F.lit(r))).alias("rep")
    u = (F.element_at("draws", F.col("rep")) + 0.5) / float(span)
    w = sum((F.when(u >= c, 1).otherwise(0) for c in POISSON), F.lit(0))
    plain = similarity.feature_counts(left.select("*", reps).withColumn("w", w).where("w > 0"), features, ["rep"], "w")
    want = similarity.wasserstein(similarity.pair_counts(plain.unionByName(fixed.select("*", reps)), anchors, ["rep"]))
    key = ["rep", "variedad", "ancla"]
    a, b = (d.select(*key, "distancia").sort(*key).toPandas() for d in (got, want))
    assert 0 < len(a) < 3 * 2 * r + 1 and a[key].equals(b[key])
    np.testing.assert_allclose(a["distancia"], b["distancia"], rtol=1e-9)


def test_a_hot_value_is_one_row_for_many(spark):
    df = spark.range(3_000, numPartitions=1).select(F.lit("v").alias("variedad"), F.lit(2.0).alias("f"), F.array(F.lit(0), F.lit(9)).alias("draws"))
    (row,) = sweep.weighted_counts(df, ["f"], 2, 10, [0.5, 0.9]).collect()
    assert (row["variable"], row["value"]) == ("f", 2.0) and np.frombuffer(row["w"], "<i4").tolist() == [0, 6_000]
