"""Numeric and categorical profiles and associations, by report group."""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkyield import runtime
from sparkyield.functions import scalar
from sparkyield.functions.distributions import chi2_p, log_normal_sf
from sparkyield.functions.ordered import running_total
from sparkyield.functions.quantiles import long_form, quantile_rows, quantiles, value_counts

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MISSING = "__missing__"
WEAK, STRONG = 0.05, 0.3
CARDINALITY_WARN, CARDINALITY_HIGH = 50, 200


def numeric_profile(df: DataFrame, by: list[str], cols: list[str], largest: int | None = None) -> DataFrame:
    """n, missing, moments, quantiles and range per column.

    ``largest`` bounds the biggest group where the caller knows it, here and below.
    """
    long = long_form(df, by, cols)
    keys = by + ["variable"]
    n = F.col("n")
    agg = long.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.skewness("value").alias("_g1"),
        F.kurtosis("value").alias("_g2"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    q = quantile_rows(long, keys, "value", [0.01, 0.5, 0.99], largest=largest)
    total = df.groupBy(*by).agg(F.count("*").alias("_rows"))
    out = runtime.attach(runtime.attach(agg, q, keys), total, by, check=True)
    return out.select(
        *keys,
        "n",
        (F.col("_rows") - n).alias("n_missing"),
        "mean",
        F.col("q")[1].alias("median"),
        "std",
        scalar.sample_skew(n, F.col("_g1")).alias("skew"),
        scalar.sample_kurtosis(n, F.col("_g2")).alias("kurtosis"),
        F.col("q")[0].alias("p01"),
        F.col("q")[2].alias("p99"),
        "min",
        "max",
    )


def outlier_counts(df: DataFrame, by: list[str], cols: list[str], largest: int | None = None) -> DataFrame:
    """Outliers by IQR (1.5), |z| > 3 and MAD (3.5).

    Only mean and deviation are taken over the rows; the rest reads stored value counts.
    """
    long = long_form(df, by, cols)
    keys = by + ["variable"]
    counts = runtime.materialize(value_counts(long, keys, "value"))
    # a group has no more values than rows, so a bound within the limit holds for both
    largest = largest if largest is not None and largest <= runtime.GROUP_ROWS else None
    stats = long.groupBy(*keys).agg(F.avg("value").alias("mu"), F.stddev_samp("value").alias("sd"))
    quartiles = quantile_rows(counts, keys, "value", [0.25, 0.5, 0.75], weight="n", largest=largest)
    stats = runtime.attach(stats, quartiles, keys)
    rows = runtime.attach(counts, stats, keys, check=True)
    dev = rows.select(*keys, F.abs(F.col("value") - F.col("q")[1]).alias("dev"), "n")
    mad = quantile_rows(dev, keys, "dev", [0.5], weight="n", largest=largest)
    rows = runtime.attach(rows, mad.select(*keys, F.col("q")[0].alias("mad")), keys, check=True)
    v, q1, med, q3 = F.col("value"), F.col("q")[0], F.col("q")[1], F.col("q")[2]
    iqr = q3 - q1
    # fixed value: third quartile of the standard normal
    robust = 0.6745 * (v - med) / F.col("mad")
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return rows.groupBy(*keys).agg(
        count((v < q1 - 1.5 * iqr) | (v > q3 + 1.5 * iqr)).alias("n_outliers_iqr"),
        count((F.col("sd") > 0) & (F.abs((v - F.col("mu")) / F.col("sd")) > 3)).alias("n_outliers_zscore"),
        count((F.col("mad") > 0) & (F.abs(robust) > 3.5)).alias("n_outliers_mad"),
    )


LAMBDAS = [round(-2 + 0.1 * i, 1) for i in range(41)]


def boxcox(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Best Box-Cox exponent on a grid of 0.1 and the advised transformation.

    All grid variances come from one aggregation over the rows.
    """
    long = long_form(df, by, cols)
    keys = by + ["variable"]
    low = long.groupBy(*keys).agg(F.min("value").alias("_lo"))
    rows = runtime.attach(long, low, keys, check=True)
    shift = F.when(F.col("_lo") <= 0, 1.0 - F.col("_lo")).otherwise(0.0)
    rows = rows.select(*keys, (F.col("value") + shift).alias("x"))
    x = F.col("x")
    grid = [F.log(x) if lam == 0 else (F.pow(x, F.lit(lam)) - 1) / lam for lam in LAMBDAS]
    agg = rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sum(F.log(x)).alias("sl"),
        F.stddev_samp(x).alias("sd"),
        F.array(*[F.var_pop(g) for g in grid]).alias("v"),
    )
    llf = F.transform(
        F.arrays_zip(F.array(*[F.lit(v) for v in LAMBDAS]).alias("lam"), F.col("v").alias("var")),
        lambda s: F.struct(
            ((s["lam"] - 1) * F.col("sl") - F.col("n") / 2 * F.log(s["var"])).alias("llf"),
            s["lam"].alias("lam"),
        ),
    )
    lam = F.array_max(llf).getField("lam")
    out = agg.where((F.col("n") >= 20) & (F.col("sd") > 0)).select(*keys, "n", lam.alias("lambda"))
    near = lambda v: F.abs(F.col("lambda") - v) < 0.2 - 1e-9
    advice = (
        F.when(near(1.0), "none")
        .when(near(0.5), "sqrt(x)")
        .when(near(0.0), "log(x)")
        .when(near(-0.5), "1/sqrt(x)")
        .when(near(-1.0), "1/x")
        .otherwise("boxcox")
    )
    return out.withColumn("recommendation", advice)


def jarque_bera(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Statistic and p-value (chi-square with 2 degrees of freedom); n >= 20."""
    long = long_form(df, by, cols)
    agg = long.groupBy(*by, "variable").agg(
        F.count("*").alias("n"), F.skewness("value").alias("s"), F.kurtosis("value").alias("k")
    )
    stat = F.col("n") / 6 * (F.col("s") * F.col("s") + F.col("k") * F.col("k") / 4)
    out = agg.where(F.col("n") >= 20).select(*by, "variable", "n", stat.alias("statistic"))
    return out.withColumn("p_value", F.exp(-F.col("statistic") / 2))


def anderson_darling(df: DataFrame, by: list[str], cols: list[str], largest: int | None = None) -> DataFrame:
    """Normality statistic and its 5 % critical value; n >= 8.

    Works on value counts, so ties shrink the data, and on blocked running
    totals, so no group is sorted in one task.
    """
    long = long_form(df, by, cols)
    keys = by + ["variable"]
    counts = value_counts(long, keys, "value")
    stats = long.groupBy(*keys).agg(
        F.count("*").alias("total"), F.avg("value").alias("mu"), F.stddev_samp("value").alias("sd")
    )
    cum = running_total(counts, keys, ["value"], {"hi": F.col("n")}, largest=largest)
    rows = runtime.attach(cum, stats.where((F.col("total") >= 8) & (F.col("sd") > 0)), keys, "inner", check=True)
    z = (F.col("value") - F.col("mu")) / F.col("sd")
    hi, n = F.col("hi").cast("double"), F.col("total").cast("double")
    lo = hi - F.col("n")
    below = hi * hi - lo * lo
    above = F.col("n") * (2 * n + 1) - (hi * (hi + 1) - lo * (lo + 1))
    # ln of the lower tail is ln of the upper tail of -z
    term = below * log_normal_sf(-z) + above * log_normal_sf(z)
    out = rows.withColumn("_t", term).groupBy(*keys).agg(F.sum("_t").alias("s"), F.max("total").alias("n"))
    n = F.col("n")
    out = out.withColumn("statistic", -n - F.col("s") / n)
    # fixed values: 5 % point and its small-sample correction
    critical = F.round(0.787 / (1 + 4.0 / n - 25.0 / (n * n)), 3)
    return out.select(*keys, "n", "statistic", critical.alias("critical_5pct")).withColumn(
        "rejects", F.col("statistic") > F.col("critical_5pct")
    )


def category_profile(df: DataFrame, by: list[str], col: str, target: str, top_n: int = 10, min_n: int = 5) -> DataFrame:
    """Top levels with share, cumulative share and target mean and deviation."""
    levels = df.groupBy(*by, F.col(col).alias("level")).agg(
        F.count("*").alias("count"),
        F.count(target).alias("target_n"),
        F.avg(target).alias("m"),
        F.stddev_samp(target).alias("s"),
    )
    # windows over level counts, not rows
    every = Window.partitionBy(*by)
    ranked = every.orderBy(F.col("count").desc(), F.col("level").asc_nulls_last())
    out = levels.withColumns(
        {
            "rank": F.row_number().over(ranked),
            "cardinality": F.count("*").over(every),
            "n_singletons": F.sum((F.col("count") == 1).cast("long")).over(every),
            "n_missing": F.sum(F.when(F.col("level").isNull(), F.col("count")).otherwise(0)).over(every),
            "total": F.sum("count").over(every),
            "cum": F.sum("count").over(ranked.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    cover = F.sum(F.when(F.col("rank") <= 10, F.col("count")).otherwise(0)).over(every) / F.col("total")
    out = out.withColumn("coverage_top10", cover).where(F.col("rank") <= top_n)
    enough = F.col("target_n") >= min_n
    return out.select(
        *by,
        F.lit(col).alias("variable"),
        "level",
        "rank",
        "count",
        (F.col("count") / F.col("total")).alias("share"),
        (F.col("cum") / F.col("total")).alias("cum_share"),
        F.when(enough, F.col("m")).alias("target_mean"),
        F.when(enough, F.col("s")).alias("target_std"),
        "cardinality",
        "n_singletons",
        "n_missing",
        "coverage_top10",
    )


def contingency(df: DataFrame, by: list[str], pairs: list[tuple[str, str]]) -> DataFrame:
    """Cell counts ``(by, a, b, x, y, o)`` of several column pairs in one pass."""
    text = lambda c: f"coalesce(CAST(`{c}` AS STRING), '{MISSING}')"
    parts = ", ".join(f"'{a}', '{b}', {text(a)}, {text(b)}" for a, b in pairs)
    long = df.select(*by, F.expr(f"stack({len(pairs)}, {parts}) AS (a, b, x, y)"))
    return long.groupBy(*by, "a", "b", "x", "y").agg(F.count("*").alias("o"))


def chi_square(cells: DataFrame, by: list[str]) -> DataFrame:
    """Chi-square (Yates at one degree of freedom) and bias-corrected Cramer's V.

    Empty cells need no rows: the sum of (o-e)^2/e equals the sum of o^2/e - n.
    """
    keys = by + ["a", "b"]
    part = Window.partitionBy
    cells = cells.withColumns(
        {
            "rx": F.sum("o").over(part(*keys, "x")),
            "cy": F.sum("o").over(part(*keys, "y")),
            "total": F.sum("o").over(part(*keys)),
        }
    )
    e = F.col("rx") * F.col("cy") / F.col("total")
    agg = cells.groupBy(*keys).agg(
        F.max("total").alias("n"),
        F.count_distinct("x").alias("r"),
        F.count_distinct("y").alias("k"),
        (F.sum(F.col("o") * F.col("o") / e) - F.max("total")).alias("plain"),
        F.max(F.abs(F.col("o") - e)).alias("d"),
    )
    # each margin counted once: weight 1 / (number of its observed cells)
    rows = cells.select(*keys, "x", "rx").distinct().groupBy(*keys).agg(F.sum(1 / F.col("rx")).alias("sr"))
    cols = cells.select(*keys, "y", "cy").distinct().groupBy(*keys).agg(F.sum(1 / F.col("cy")).alias("sc"))
    out = runtime.attach(runtime.attach(agg, rows, keys), cols, keys)
    n, r, k = F.col("n"), F.col("r"), F.col("k")
    dof = (r - 1) * (k - 1)
    gap = F.col("d") - F.least(F.lit(0.5), F.col("d"))
    yates = gap * gap * n * F.col("sr") * F.col("sc")
    stat = F.when(dof == 1, yates).otherwise(F.greatest(F.col("plain"), F.lit(0.0)))
    out = out.where((r >= 2) & (k >= 2)).withColumns({"statistic": stat, "dof": dof})
    phi = F.greatest(F.lit(0.0), F.col("statistic") / n - (r - 1) * (k - 1) / (n - 1))
    rc, kc = r - (r - 1) * (r - 1) / (n - 1), k - (k - 1) * (k - 1) / (n - 1)
    den = F.least(rc - 1, kc - 1)
    out = out.withColumn("cramers_v", F.when(den > 0, F.sqrt(phi / den)).otherwise(0.0))
    return out.select(*keys, "n", "r", "k", "statistic", "dof", "cramers_v")


def target_association(df: DataFrame, by: list[str], cols: list[str], target: str) -> DataFrame:
    """Chi-square of each category against the median split of the target."""
    mid = quantiles(df, by, [target], [0.5]).select(*by, F.col(target)[0].alias("_mid"))
    rows = runtime.attach(df, mid, by, check=True)
    high = F.coalesce((F.col(target) >= F.col("_mid")).cast("int"), F.lit(0))
    rows = rows.withColumn("target_high", high)
    out = chi_square(contingency(rows, by, [(c, "target_high") for c in cols]), by)
    known = df.groupBy(*by).agg(F.count(target).alias("_known"))
    out = runtime.attach(out, known, by)
    ok = (F.col("_known") >= 30) & (F.col("r") <= CARDINALITY_HIGH)
    return out.where(ok).withColumnRenamed("a", "variable").drop("b", "_known")


def associations(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Cramer's V of all category pairs with its severity."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    out = chi_square(contingency(df, by, pairs), by)
    v = F.col("cramers_v")
    return out.withColumn("severity", F.when(v >= 0.5, "high").when(v >= 0.3, "watch").otherwise("ok"))


def with_p(df: DataFrame) -> DataFrame:
    return df.withColumn("p_value", chi2_p(F.col("statistic").cast("double"), F.col("dof").cast("double")))


def encoding_advice(cardinality: Column, n_valid: Column, v: Column) -> Column:
    """How to encode a category."""
    return (
        F.when(cardinality <= 1, "drop_constant")
        .when(cardinality == 2, "binary_one_hot")
        .when((cardinality > CARDINALITY_WARN) & (n_valid / cardinality < 30), "target_encoding_or_group")
        .when(v < WEAK, "weak_drop_or_group")
        .when(v >= STRONG, "strong_target_encoding")
        .otherwise("one_hot")
    )


def pearson_pairs(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations from one aggregation."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    wide = df.groupBy(*by).agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    parts = ", ".join(f"'{a}', '{b}', `_{i}`" for i, (a, b) in enumerate(pairs))
    out = wide.select(*by, F.expr(f"stack({len(pairs)}, {parts}) AS (a, b, r)"))
    return out.withColumn("r", F.coalesce("r", F.lit(0.0)))


def spearman_pairs(df: DataFrame, by: list[str], cols: list[str], largest: int | None = None) -> DataFrame:
    """Pairwise-complete rank correlations.

    A column's value counts hold one count for each other column, of the rows that have it,
    so their running totals give the value's average rank in every pair at once. Rows
    look these ranks up once for each column, and are not copied for the pairs.
    ``largest`` bounds the biggest group where the caller knows it.
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    slot = lambda a, b: [c for c in cols if c != a].index(b)
    out = runtime.materialize(df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]))
    largest = runtime.largest_group(out, by) if largest is None else largest
    known = largest if largest <= runtime.GROUP_ROWS else None
    part = lambda name, a, b: F.col(f"_{name}_{cols.index(a)}")[slot(a, b)]
    sums, rows = [], out
    for i, c in enumerate(cols):
        others = [o for o in cols if o != c]
        counts = rows.where(F.col(c).isNotNull()).groupBy(*by, c).agg(*[F.count(o).alias(f"_n{j}") for j, o in enumerate(others)])
        cum = running_total(counts, by, [c], {f"_u{j}": F.col(f"_n{j}") for j in range(len(others))}, largest=known)
        each = [(F.col(f"_n{j}"), F.col(f"_u{j}") - (F.col(f"_n{j}") - 1) / 2) for j in range(len(others))]
        ranks = cum.select(*by, c, F.array(*[r for _, r in each]).alias(f"_r_{i}"), F.array(*[n for n, _ in each]).alias("_n"))
        ranks = runtime.small(ranks)
        at = lambda j: (F.col("_n")[j], F.col(f"_r_{i}")[j])
        squares = ranks.groupBy(*by).agg(
            F.array(*[F.sum(at(j)[0]) for j in range(len(others))]).alias(f"_t_{i}"),
            F.array(*[F.sum(at(j)[0] * at(j)[1] * at(j)[1]) for j in range(len(others))]).alias(f"_s_{i}"),
        )
        squares = runtime.materialize(squares)
        sums.append(squares)
        out = runtime.attach(out, ranks.drop("_n"), [*by, c])
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    cross = out.groupBy(*by).agg(
        *[F.sum(F.when(both(a, b), part("r", a, b) * part("r", b, a))).alias(f"_x{k}") for k, (a, b) in enumerate(pairs)]
    )
    wide = reduce(lambda left, right: runtime.attach(left, right, by), sums, cross)
    fields = [
        F.struct(
            F.lit(a).alias("a"), F.lit(b).alias("b"), part("t", a, b).alias("t"), F.col(f"_x{k}").alias("sxy"),
            part("s", a, b).alias("sxx"), part("s", b, a).alias("syy"),
        )
        for k, (a, b) in enumerate(pairs)
    ]
    sums = wide.select(*by, F.inline(F.array(*fields))).where("t > 0")
    t = F.col("t")
    centre = t * (t + 1) * (t + 1) / 4
    r = (F.col("sxy") - centre) / F.sqrt((F.col("sxx") - centre) * (F.col("syy") - centre))
    return sums.select(*by, "a", "b", F.coalesce(r, F.lit(0.0)).alias("r"))


def vif(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Variance inflation from the correlation matrix of complete rows.

    Spark computes the correlations; only one k-by-k matrix per group is inverted.
    """
    full = df.dropna(subset=cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    agg = full.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.array(*[F.stddev_samp(c) for c in cols]).alias("sds"),
        F.array(*[F.coalesce(F.corr(a, b), F.lit(0.0)) for a, b in pairs]).alias("cs"),
    )

    def invert(batches):
        for pdf in batches:
            rows = []
            for rec in pdf.to_dict("records"):
                m = np.eye(len(cols))
                for (a, b), c in zip(pairs, rec["cs"]):
                    i, j = cols.index(a), cols.index(b)
                    m[i, j] = m[j, i] = c
                keep = [i for i, s in enumerate(rec["sds"]) if s is not None and s > 1e-12]
                if rec["n"] < 30 or len(keep) < 2:
                    continue
                inv = np.linalg.pinv(m[np.ix_(keep, keep)])
                for pos, i in enumerate(keep):
                    v = float(inv[pos, pos])
                    v = v if np.isfinite(v) and v >= 1.0 else float("inf")
                    level = "high" if v >= 10 else "watch" if v >= 5 else "ok"
                    rows.append({**{k: rec[k] for k in by}, "variable": cols[i], "vif": v, "severity": level})
            yield pd.DataFrame(rows, columns=[*by, "variable", "vif", "severity"])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in agg.select(*by).schema)
    schema = (head + ", " if head else "") + "variable string, vif double, severity string"
    return agg.mapInPandas(invert, schema)


def mutual_information(df: DataFrame, by: list[str], cols: list[str], target: str, bins: int = 10) -> DataFrame:
    """Information between quantile bins of each column and of the target, ranked."""
    full = df.dropna(subset=[*cols, target]).select(*by, *cols, target)
    probs = [i / bins for i in range(1, bins)]
    edges = quantiles(full, by, [*cols, target], probs).withColumnsRenamed(
        {c: f"_e_{c}" for c in [*cols, target]}
    )
    rows = runtime.attach(full, edges, by, check=True)
    code = lambda c: f"size(filter(array_distinct(`_e_{c}`), e -> e < `{c}`))"
    parts = ", ".join(f"'{c}', {code(c)}" for c in cols)
    long = rows.select(*by, F.expr(code(target)).alias("y"), F.expr(f"stack({len(cols)}, {parts}) AS (variable, x)"))
    keys = by + ["variable"]
    cells = long.groupBy(*keys, "x", "y").agg(F.count("*").alias("c"))
    part = Window.partitionBy
    cells = cells.withColumns(
        {
            "cx": F.sum("c").over(part(*keys, "x")),
            "cy": F.sum("c").over(part(*keys, "y")),
            "n": F.sum("c").over(part(*keys)),
        }
    )
    gain = F.col("c") / F.col("n") * F.log(F.col("c") * F.col("n") / (F.col("cx") * F.col("cy")))
    out = cells.groupBy(*keys).agg(F.sum(gain).alias("mi"))
    w = Window.partitionBy(*by).orderBy(F.col("mi").desc(), "variable")
    return out.withColumn("rank", F.row_number().over(w))
