"""Least squares from one pass of cross products, and variance tests on residuals."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkyield import runtime
from sparkyield.functions.distributions import chi2_p

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _key_schema(df: DataFrame, by: list[str]) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*by).schema)


def ols(df: DataFrame, by: list[str], y: str, xs: list[str]) -> DataFrame:
    """Per group: n, coefficients (constant first) and R2.

    Columns are centred and scaled by group first to keep precision; Spark sums the
    products and one small system per group is solved.
    """
    cols = [y, *xs]
    stats = df.groupBy(*by).agg(
        *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)],
        *[F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)).alias(f"_s{i}") for i, c in enumerate(cols)],
    )
    rows = runtime.attach(df.select(*by, *cols), stats, by, check=True)
    z = [((F.col(c) - F.col(f"_m{i}")) / F.col(f"_s{i}")) for i, c in enumerate(cols)]
    sums = [F.sum(z[i] * z[j]) for i in range(len(z)) for j in range(i, len(z))]
    agg = rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.array(*sums).alias("_gram"),
        F.array(*[F.max(f"_m{i}") for i in range(len(cols))]).alias("_mean"),
        F.array(*[F.max(f"_s{i}") for i in range(len(cols))]).alias("_scale"),
    )

    def solve(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                k = len(cols)
                g = np.zeros((k, k))
                g[np.triu_indices(k)] = r["_gram"]
                g = g + np.triu(g, 1).T
                beta = np.linalg.pinv(g[1:, 1:]) @ g[1:, 0]
                r2 = float(beta @ g[1:, 0] / g[0, 0]) if g[0, 0] > 0 else 0.0
                m, s = np.asarray(r["_mean"]), np.asarray(r["_scale"])
                coef = beta * s[0] / s[1:]
                out.append({**{q: r[q] for q in by}, "n": r["n"], "coef": [float(m[0] - coef @ m[1:]), *map(float, coef)], "r2": r2})
            yield pd.DataFrame(out, columns=[*by, "n", "coef", "r2"])

    return agg.mapInPandas(solve, _key_schema(df, by) + "n long, coef array<double>, r2 double")


def residuals(df: DataFrame, fit: DataFrame, by: list[str], y: str, xs: list[str], name: str) -> DataFrame:
    out = runtime.attach(df, fit.select(*by, "coef"), by, check=True)
    est = F.col("coef")[0]
    for i, x in enumerate(xs):
        est = est + F.col("coef")[i + 1] * F.col(x)
    return out.withColumn(name, F.col(y) - est).drop("coef")


def _lm(df: DataFrame, by: list[str], u: str, xs: list[str], least: int) -> DataFrame:
    squared = df.withColumn("_u2", F.col(u) * F.col(u))
    fit = ols(squared, by, "_u2", xs).where(F.col("n") >= least)
    out = fit.select(*by, "n", (F.col("n") * F.col("r2")).alias("statistic"), F.lit(len(xs)).alias("dof"))
    return out.withColumn("p_value", chi2_p(F.col("statistic"), F.col("dof").cast("double")))


def breusch_pagan(df: DataFrame, by: list[str], y: str, xs: list[str], least: int = 30) -> DataFrame:
    """LM test of squared least-squares residuals of y on xs against xs."""
    full = df.dropna(subset=[y, *xs]).select(*by, y, *xs)
    rows = residuals(full, ols(full, by, y, xs), by, y, xs, "_u")
    return _lm(rows, by, "_u", xs, least)


def white(df: DataFrame, by: list[str], y: str, xs: list[str], least: int = 50) -> DataFrame:
    """As Breusch-Pagan, with squares and cross products."""
    full = df.dropna(subset=[y, *xs]).select(*by, y, *xs)
    rows = residuals(full, ols(full, by, y, xs), by, y, xs, "_u")
    mean = full.groupBy(*by).agg(*[F.avg(x).alias(f"_m_{x}") for x in xs])
    # products of centred columns span the same space and keep precision
    rows = runtime.attach(rows, mean, by, check=True)
    extra = {}
    for i, a in enumerate(xs):
        for b in xs[i:]:
            extra[f"_w_{a}_{b}"] = (F.col(a) - F.col(f"_m_{a}")) * (F.col(b) - F.col(f"_m_{b}"))
    return _lm(rows.withColumns(extra), by, "_u", [*xs, *extra], least)


def breusch_pagan_single(df: DataFrame, by: list[str], resid: str, pred: str, least: int = 10) -> DataFrame:
    """Breusch-Pagan with one regressor, in built-in aggregates only."""
    full = df.dropna(subset=[resid, pred]).select(*by, F.col(resid).alias("_y"), F.col(pred).alias("_x"))
    line = full.groupBy(*by).agg(
        F.regr_slope("_y", "_x").alias("_b"), F.regr_intercept("_y", "_x").alias("_a")
    )
    rows = runtime.attach(full, line, by, check=True)
    u = F.col("_y") - F.col("_a") - F.col("_b") * F.col("_x")
    out = rows.withColumn("_u2", u * u).groupBy(*by).agg(
        F.count("*").alias("n"), (F.count("*") * F.regr_r2("_u2", "_x")).alias("statistic")
    )
    return out.where(F.col("n") >= least)
