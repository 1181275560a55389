"""Statistics against direct computations."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkyield.functions import distributions as dist
from sparkyield.operators import evaluate, profile, regression, series, similarity
from sparkyield.sources import writers
from sparkyield.sources.fixtures import KEY

ORDER = ["t"]


@pytest.fixture(scope="module")
def walk(spark):
    rng = np.random.default_rng(7)
    noise = rng.normal(size=400)
    x = np.zeros(400)
    for i in range(1, 400):
        x[i] = 0.6 * x[i - 1] + noise[i]
    pdf = pd.DataFrame({"g": "a", "t": range(400), "x": x + 5, "u": rng.normal(size=400), "w": rng.exponential(size=400)})
    return spark.createDataFrame(pdf).cache(), pdf


def lagged_ols(y, cols):
    X = np.column_stack([np.ones(len(y)), *cols])
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    r = y - X @ beta
    return beta, r, X


def test_known_tails():
    assert dist.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert dist.chi2_sf(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-9)
    assert dist.chi2_sf(0.5, 4) == pytest.approx(math.exp(-0.25) * 1.25, abs=1e-12)
    assert dist.kolmogorov_sf(1.3580986) == pytest.approx(0.05, abs=1e-5)
    assert dist.binomial_sf(3, 3, 0.5) == pytest.approx(0.125)


def test_pacf(walk):
    df, pdf = walk
    x = pdf["x"].to_numpy()
    got = series.pacf(df, ["g"], ORDER, "x", lags=5).orderBy("lag").toPandas()["pacf"].tolist()
    want = [1.0]
    for k in range(1, 6):
        beta, _, _ = lagged_ols(x[k:], [x[k - i : len(x) - i] for i in range(1, k + 1)])
        want.append(beta[-1])
    np.testing.assert_allclose(got, want, atol=1e-8)


def test_adf(walk):
    df, pdf = walk
    x = pdf["x"].to_numpy()
    row = series.adf(df, ["g"], ORDER, "x").first()
    top = math.ceil(12 * (len(x) / 100) ** 0.25)

    def fit(p, start):
        dx = np.diff(x)
        t = np.arange(start, len(x))
        beta, r, X = lagged_ols(dx[t - 1], [x[t - 1], *[dx[t - 1 - i] for i in range(1, p + 1)]])
        return beta, r, X

    def aic(p):
        _, r, X = fit(p, top + 1)
        n = len(r)
        return n * (math.log(2 * math.pi * (r @ r) / n) + 1) + 2 * X.shape[1]

    p = min(range(top + 1), key=aic)
    beta, r, X = fit(p, p + 1)
    se = math.sqrt((r @ r) / (len(r) - X.shape[1]) * np.linalg.inv(X.T @ X)[1, 1])
    assert row["lag_used"] == p
    assert row["statistic"] == pytest.approx(beta[1] / se, rel=1e-6)
    assert row["rejects"]


def test_kpss(walk):
    df, pdf = walk
    row = series.kpss(df, ["g"], ORDER, "x").first()
    e = pdf["x"].to_numpy() - pdf["x"].mean()
    n, k = len(e), row["lags"]
    s2 = (e @ e + 2 * sum((e[i:] @ e[: n - i]) * (1 - i / (k + 1)) for i in range(1, k + 1))) / n
    assert row["statistic"] == pytest.approx((np.cumsum(e) ** 2).sum() / n**2 / s2, rel=1e-9)


def test_anderson_darling(walk):
    df, pdf = walk
    got = {r["variable"]: r for r in profile.anderson_darling(df, ["g"], ["u", "w"]).collect()}
    for c in ("u", "w"):
        z = np.sort((pdf[c] - pdf[c].mean()) / pdf[c].std())
        cdf = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in z])
        i = np.arange(1, len(z) + 1)
        want = -len(z) - ((2 * i - 1) * (np.log(cdf) + np.log(1 - cdf[::-1]))).mean()
        assert got[c]["statistic"] == pytest.approx(want, rel=1e-6)
    assert got["w"]["rejects"] and not got["u"]["rejects"]


def test_vif(walk):
    df, pdf = walk
    cols = ["x", "u", "mix"]
    rows = df.withColumn("mix", F.col("x") + 0.1 * F.col("u") + 0.5 * F.col("w"))
    got = {r["variable"]: r["vif"] for r in profile.vif(rows, ["g"], cols).collect()}
    p = pdf.assign(mix=pdf["x"] + 0.1 * pdf["u"] + 0.5 * pdf["w"])
    want = np.diag(np.linalg.pinv(np.corrcoef(p[cols].to_numpy().T)))
    np.testing.assert_allclose([got[c] for c in cols], want, rtol=1e-6)


def test_variance_tests(walk):
    df, pdf = walk
    y, a, b = (pdf[c].to_numpy() for c in ("x", "u", "w"))
    _, r, _ = lagged_ols(y, [a, b])

    def lm(cols):
        u2 = r**2
        _, e, _ = lagged_ols(u2, cols)
        return len(y) * (1 - (e @ e) / ((u2 - u2.mean()) ** 2).sum())

    bp = regression.breusch_pagan(df, ["g"], "x", ["u", "w"]).first()
    wt = regression.white(df, ["g"], "x", ["u", "w"]).first()
    assert bp["statistic"] == pytest.approx(lm([a, b]), rel=1e-6) and bp["dof"] == 2
    assert wt["statistic"] == pytest.approx(lm([a, b, a * a, a * b, b * b]), rel=1e-6) and wt["dof"] == 5


def test_bootstrap_interval_holds_the_point(pred):
    one = pred.where("variedad = 'Brand#1'")
    r = evaluate.bootstrap_ci(one, ["variedad"], KEY, replicates=200).first()
    for m in ("mae", "mape", "r2"):
        assert r[f"{m}_low"] < r[m] < r[f"{m}_high"]
    again = evaluate.bootstrap_ci(one.repartition(7), ["variedad"], KEY, replicates=200).first()
    assert again["mae_low"] == pytest.approx(r["mae_low"])


def test_holm(spark):
    df = spark.createDataFrame([("a", 0.01), ("b", 0.02), ("c", 0.03), ("d", 0.5)], "t string, p double")
    got = {r["t"]: r for r in similarity.holm(df, [], "p", ["t"]).collect()}
    assert got["a"]["p_holm"] == pytest.approx(0.04) and got["a"]["rejects"]
    assert got["b"]["p_holm"] == pytest.approx(0.06) and not got["c"]["rejects"]


def test_permanova_separates(spark):
    rng = np.random.default_rng(1)
    pts = [(f"v{i}", f"g{i % 2}", float(rng.normal() + 10 * (i % 2)), float(rng.normal())) for i in range(16)]
    df = spark.createDataFrame(pts, "variedad string, entrena_con string, f1 double, f2 double")
    r = similarity.permanova(df, ["f1", "f2"], 199).first()
    assert r["passed"] and r["r2"] > 0.8


def test_pacf_of_short_series(spark):
    rng = np.random.default_rng(3)
    rows = [(g, i, float(v)) for g, n in (("a", 26), ("b", 60), ("c", 20)) for i, v in enumerate(rng.normal(size=n))]
    df = spark.createDataFrame(rows, "g string, i int, v double")
    got = series.pacf(df, ["g"], ["i"], "v").toPandas()
    assert set(got["g"]) == {"a", "b"}
    for name, n in (("a", 26), ("b", 60)):
        x = np.array([v for g, _, v in rows if g == name])
        mine = got[got["g"] == name].sort_values("lag")["pacf"].tolist()
        assert len(mine) == min(20, n // 2 - 1) + 1
        for k in range(1, len(mine)):
            left = np.column_stack([np.ones(n - k)] + [x[k - j : n - j] for j in range(1, k + 1)])
            want = np.linalg.lstsq(left, x[k:], rcond=None)[0][-1]
            assert abs(mine[k] - want) < 1e-6


def test_fingerprint_sees_which_values_are_null(spark):
    schema = "a long, b long"
    prints = [
        tuple(writers.fingerprint(spark.createDataFrame(r, s)).first())
        for r, s in (([(None, 5)], schema), ([(5, None)], schema), ([(5, None)], "b long, a long"))
    ]
    assert len(set(prints)) == 3


def test_grid_of_few_values_is_the_values(spark):
    from sparkyield.plans import training

    class Model:
        def score(self, df):
            return df.withColumn("y_pred", df["x"] * 2.0)

    df = spark.createDataFrame([(float(i % 3),) for i in range(30)], "x double")
    got = training.partial_dependence(Model(), df, "x").orderBy("grid").collect()
    assert [(r["grid"], r["pred_mean"]) for r in got] == [(0.0, 0.0), (1.0, 2.0), (2.0, 4.0)]


@pytest.mark.parametrize("limit", [None, 5])
def test_outliers_come_from_value_counts(spark, monkeypatch, limit):
    """Quantiles read one row per value, not per row; counts are those of every row."""
    rng = np.random.default_rng(3)
    data = {g: np.round(rng.standard_t(2, size=300) * 8) / 8 for g in "ab"}
    rows = [(g, float(v)) for g, x in data.items() for v in x] + [("a", None), ("b", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    values = sum(len(np.unique(x)) for x in data.values())
    read, real = [], profile.quantile_rows
    monkeypatch.setattr(profile, "quantile_rows", lambda df, *a, **k: read.append(df.count()) or real(df, *a, **k))
    if limit:
        monkeypatch.setattr(profile.runtime, "GROUP_ROWS", limit)
    got = {r["g"]: tuple(r)[2:] for r in profile.outlier_counts(df, ["g"], ["x"], 301).collect()}
    for g, x in data.items():
        q1, md, q3 = np.percentile(x, [25, 50, 75])
        mad = np.median(np.abs(x - md))
        iqr = (x < q1 - 1.5 * (q3 - q1)) | (x > q3 + 1.5 * (q3 - q1))
        z = np.abs((x - x.mean()) / x.std(ddof=1)) > 3
        assert got[g] == (iqr.sum(), z.sum(), (np.abs(0.6745 * (x - md) / mad) > 3.5).sum())
    assert len(read) == 2 and max(read) <= values < 602


def test_bootstrap_sums_are_those_of_the_text_hash(spark):
    import hashlib

    rows = [("a" if i % 3 else None, i, None if i == 5 else f"k{i % 4}", float(i), 2.0 * i - 7) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, i long, k string, y double, z double").repartition(3)
    got = evaluate.replicate_sums(df, ["g"], ["y", "z"], ["i", "k"], 20, 42)
    want = {}
    for g, i, k, y, z in rows:
        text = "|".join([str(i), *([k] if k else []), "42"])
        for rep in range(1, 21):
            h, j = divmod(rep - 1, evaluate.DRAWS)
            d = hashlib.md5(f"{text}|{h}".encode()).hexdigest()
            bits = (int(d[:15] if j < 3 else d[15:30], 16) >> (40 - 20 * (j % 3))) & ((1 << 20) - 1)
            w = sum((bits + 0.5) / (1 << 20) >= c for c in evaluate.POISSON)
            n, sy, sz = want.get((g, rep), (0, 0.0, 0.0))
            want[g, rep] = (n + w, sy + w * y, sz + w * z)
    assert {(r["g"], r["rep"]): (r["n"], r["y"], r["z"]) for r in got.collect()} == want
    # only sums leave the tasks: no row is copied for a replicate
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
