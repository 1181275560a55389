"""The ways for hot groups give the same rows as the plain ones."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkyield import roles, runtime
from sparkyield.functions.ordered import blocks, positioned, running_total
from sparkyield.functions.quantiles import average_ranks, quantile_rows, quantiles, value_counts
from sparkyield.operators import clean, drift, folds, lags, neighbors, profile, series, similarity
from sparkyield.sources.fixtures import KEY

V = ["variedad"]
ORDER = ["fecha", *KEY]


def rows(df, digits=6):
    from sparkyield.functions.scalar import rounded

    out = rounded(df.select(*sorted(df.columns)), digits).toPandas()
    return sorted(map(str, out.itertuples(index=False)))


def test_positions_are_a_global_order(harvest):
    p = positioned(harvest.select(*ORDER), ORDER).toPandas().sort_values("_pos")
    assert list(p["_pos"]) == list(range(len(p)))
    assert p[ORDER].apply(tuple, axis=1).is_monotonic_increasing


def test_running_total(harvest):
    base = harvest.select(*V, *ORDER, "kg_ha")
    plain = running_total(base, V, ORDER, {"s": F.col("kg_ha")})
    blocked = running_total(base, V, ORDER, {"s": F.col("kg_ha")}, limit=37)
    assert rows(plain, 3) == rows(blocked, 3)


def test_block_index(harvest):
    base = harvest.select(*V, *ORDER)
    for limit in (None, 50):
        b = blocks(base, V, ORDER, 3, limit, index=True)
        got = b.finish(b.df).groupBy(*V).agg(F.max("_idx").alias("m"), F.count("*").alias("n"), F.count_distinct("_idx").alias("k"))
        assert got.where("m <> n - 1 OR k <> n").count() == 0


def test_row_lags(harvest, monkeypatch):
    cols = ["fundo", "formato", "variedad", *ORDER, "kg_jr_h", "kg_ha"]
    base = harvest.select(*cols)
    plain = rows(lags.lag_features(base, KEY, [], simple=True))
    monkeypatch.setattr(runtime, "GROUP_ROWS", 400)
    monkeypatch.setattr(lags, "FRAME_ROWS", 10)
    assert rows(lags.lag_features(base, KEY, [], simple=True)) == plain


def test_lag_contract(harvest):
    out = lags.lag_features(harvest, KEY, V)
    assert len(lags.OUTPUTS) == 35 and set(lags.OUTPUTS) <= set(out.columns)
    first = Window.partitionBy("variedad", "fundo", "formato").orderBy(*ORDER)
    seen = out.withColumn("_n", F.row_number().over(first) - 1)
    for n in roles.LAG_WINDOWS:
        c = F.col(f"kg_jr_h_lag_ff_{n}")
        assert seen.where((F.col("_n") < 3) & (c != -1)).count() == 0
        assert seen.where((F.col("_n") >= 3) & (c == -1)).count() == 0


def test_quantiles(harvest):
    base = harvest.select(*V, "kg_jr_h", "pct_indus")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for c in ("kg_jr_h", "pct_indus"):
        assert rows(quantile_rows(base, V, c, probs)) == rows(quantile_rows(base, V, c, probs, limit=20))
    assert rows(quantiles(base, [], ["kg_jr_h", "pct_indus"], probs)) == rows(quantiles(base, [], ["kg_jr_h", "pct_indus"], probs, limit=20))


def test_nearest_quantile(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 10]], "v double")
    for limit in (None, 2):
        q = quantile_rows(df, [], "v", [0.25, 0.75, 1.0], method="nearest", limit=limit).first()["q"]
        assert q == [2.0, 4.0, 10.0]


def test_average_ranks(spark):
    df = spark.createDataFrame([(float(v),) for v in [5, 1, 5, 7, 1, 1]], "v double")
    got = dict(average_ranks(value_counts(df, [], "v"), [], "v").select("v", "rank").collect())
    assert got == {1.0: 2.0, 5.0: 4.5, 7.0: 6.0}


def test_series_tests(harvest):
    for fn in (series.acf, series.durbin_watson, series.ljung_box, series.seasonal_strength, series.pacf, series.adf, series.kpss):
        assert rows(fn(harvest, V, ORDER, "kg_jr_h"), 5) == rows(fn(harvest, V, ORDER, "kg_jr_h", limit=90), 5), fn.__name__


def test_folds(harvest):
    base = runtime.attach(harvest, folds.strat_labels(harvest, V, 5), ["variedad", "fundo", "formato"])
    a = folds.stratified_folds(base, V, KEY, 5).select(*KEY, "variedad", "label", "fold")
    b = folds.stratified_folds(base, V, KEY, 5, limit=30).select(*KEY, "variedad", "label", "fold")
    assert rows(a) == rows(b)
    sizes = a.groupBy("variedad", "label", "fold").count().groupBy("variedad", "label").agg((F.max("count") - F.min("count")).alias("gap"))
    assert sizes.where("gap > 1").count() == 0


def test_distances_and_ranks(harvest):
    counts = similarity.feature_counts(harvest, ["kg_ha", "dpc"])
    pairs = similarity.pair_counts(counts, ["Brand#1", "Brand#2"])
    assert rows(similarity.wasserstein(pairs)) == rows(similarity.wasserstein(pairs, limit=40))
    assert rows(similarity.mann_whitney(pairs)) == rows(similarity.mann_whitney(pairs, limit=40))
    values = drift.paired_values(harvest, [], ["kg_jr_h", "dpc"])
    assert rows(drift.ks(values, [])) == rows(drift.ks(values, [], limit=60))


def test_neighbours_match_all_pairs(harvest):
    base = harvest.where("variedad IN ('Brand#1', 'Brand#2')")
    dims = ["kg_ha", "pct_indus", "p_baya", "ha"]
    z = clean.apply_scale(base, clean.fit_scale(base, dims, V), dims, V, "_z")
    zs = [f"{c}_z" for c in dims]
    table, edges = neighbors.nearest(z, V, KEY, zs, 6, block_rows=25)
    pts, got = table.toPandas(), edges.toPandas()
    for name, part in pts.groupby("variedad"):
        part = part.sort_values("rid")
        x = part[zs].to_numpy(float)
        have = ~np.isnan(x)
        diff = np.nan_to_num(x)[:, None, :] - np.nan_to_num(x)[None, :, :]
        both = have[:, None, :] & have[None, :, :]
        d = np.sqrt((diff**2 * both).sum(-1) * len(zs) / both.sum(-1))
        np.fill_diagonal(d, np.inf)
        want = np.sort(d, axis=1)[:, :6]
        mine = got[got["variedad"] == name].sort_values(["rid", "rank"])
        assert len(mine) == want.size
        np.testing.assert_allclose(mine["dist"].to_numpy().reshape(want.shape), want, atol=1e-9)


def test_lof_matches_definition(harvest):
    base = harvest.where("variedad = 'Brand#1'")
    cols, k = ["kg_ha", "dpc", "kg_jr_h"], 5
    got = neighbors.lof_score(base, cols, V, KEY, k, block_rows=20)
    z = clean.apply_scale(base, clean.fit_scale(base, cols, V), cols, V, "_z").toPandas().set_index(KEY)
    x = z[[f"{c}_z" for c in cols]].to_numpy(float)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    off = d.copy()
    np.fill_diagonal(off, np.inf)
    idx = np.argsort(off, axis=1, kind="stable")[:, :k]
    kd = np.take_along_axis(off, idx, 1)[:, -1]
    lrd = 1 / (np.maximum(np.take_along_axis(off, idx, 1), kd[idx]).mean(1) + 1e-10)
    seen = np.concatenate([np.arange(len(x))[:, None], idx[:, : k - 1]], axis=1)
    lrd_x = 1 / (np.maximum(np.take_along_axis(d, seen, 1), kd[seen]).mean(1) + 1e-10)
    want = pd.Series(lrd[seen].mean(1) / lrd_x, index=z.index)
    mine = got.toPandas().set_index(KEY)["lof"].reindex(want.index)
    np.testing.assert_allclose(mine, want, rtol=1e-6)


def test_knn_outliers_drop_the_farthest(harvest):
    base = harvest.where("variedad = 'Brand#1'")
    cols = ["kg_ha", "ha"]
    left = neighbors.drop_knn_outliers(base, cols, V, KEY, k=4, contamination=0.1, block_rows=15).toPandas()
    x = base.toPandas().set_index(KEY)[cols]
    d = np.sqrt(((x.to_numpy()[:, None, :] - x.to_numpy()[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    far = np.sort(d, axis=1)[:, 3]
    keep = x.index[far <= np.quantile(far, 0.9)]
    assert set(left.set_index(KEY).index) == set(keep)


def test_lag_products_of_blocks(spark):
    """Sums and ends per block add up to those of the group, without a window per lag."""
    gen = np.random.default_rng(5)
    x = {g: gen.normal(size=n) for g, n in (("a", 230), ("b", 41), ("c", 3))}
    data = [(g, i, float(v)) for g, vs in x.items() for i, v in enumerate(vs)] + [("a", 999, None)]
    df = spark.createDataFrame(data, "g string, i int, v double").repartition(3)
    for limit in (None, 60):
        out = series.lag_products(df, ["g"], ["i"], "v", 7, limit, ends=9)
        assert "lag(" not in out._jdf.queryExecution().optimizedPlan().toString()
        got = {r["g"]: r for r in out.collect()}
        assert set(got) == set(x)
        for g, v in x.items():
            c = v - v.mean()
            assert got[g]["n"] == len(v)
            want = [float(c[k:] @ c[: len(c) - k]) if k < len(c) else 0.0 for k in range(8)]
            assert np.allclose(got[g]["products"], want, atol=1e-9)
            assert np.allclose(got[g]["head"], c[:9]) and np.allclose(got[g]["tail"], c[::-1][:9])


def test_edge_sums():
    x = np.random.default_rng(6).normal(size=40)
    e = series.Edges(40, [float(x[k:] @ x[: 40 - k]) for k in range(9)], x[:20], x[::-1][:20])
    for i in range(8):
        for j in range(i, 8):
            for start in range(j, 9):
                want = sum(x[t - i] * x[t - j] for t in range(start, 40))
                assert abs(e.sum2(i, j, start) - want) < 1e-9


def test_rank_correlations_copy_no_rows_for_pairs(spark, monkeypatch):
    """Nothing stored has more rows than the input, and ranks are those of each complete pair."""
    gen = np.random.default_rng(7)
    x = gen.normal(size=(120, 4))
    x[gen.random((120, 4)) < 0.2] = np.nan
    x[:, 3] = np.round(x[:, 3])
    data = [("u" if i % 3 else "w", *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(data, "g string, a double, b double, c double, d double")
    kept, plain = [], runtime.materialize

    def store(t):
        kept.append(plain(t))
        return kept[-1]

    monkeypatch.setattr(runtime, "materialize", store)
    got = {(r["g"], r["a"], r["b"]): r["r"] for r in profile.spearman_pairs(df, ["g"], list("abcd")).collect()}
    assert kept and all(t.count() <= 120 for t in kept)
    local = pd.DataFrame(x, columns=list("abcd")).assign(g=[r[0] for r in data])
    for (g, a, b), r in got.items():
        whole = local[local.g == g][[a, b]].dropna()
        assert abs(whole[a].rank().corr(whole[b].rank()) - r) < 1e-9
    assert len(got) == 12


def test_profile_measures_groups_once(harvest, monkeypatch):
    """The profile bounds its groups by one pass, and one table of lag products serves a column's tests."""
    from sparkyield.plans import profile as plan

    df = harvest.where("variedad IN ('Brand#11', 'Brand#12')")
    measured, made, group, products = [], [], runtime.largest_group, series.lag_products
    monkeypatch.setattr(runtime, "largest_group", lambda t, by: measured.append(by) or group(t, by))
    monkeypatch.setattr(series, "lag_products", lambda *a, **k: made.append(a[3]) or products(*a, **k))
    tables = plan.profile_dataset(df, V, ORDER, roles.NUMERIC, roles.CATEGORICAL, "kg_jr_h", "fecha", 0)
    assert made == ["kg_jr_h"]
    # the profile itself, and the quantiles of whole rows of two tables
    assert len(measured) <= 3
    monkeypatch.undo()
    for name, alone in (("acf", series.acf), ("pacf", series.pacf), ("ljung_box", series.ljung_box), ("adf", series.adf), ("kpss", series.kpss)):
        assert rows(tables[f"{name}:kg_jr_h"]) == rows(alone(df, V, ORDER, "kg_jr_h")), name
