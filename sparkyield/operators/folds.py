"""Sample weights, target transformation, stratified and temporal folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkyield import roles, runtime
from sparkyield.functions.ordered import running_total
from sparkyield.functions.quantiles import quantiles


def key_hash(key: list[str], seed: int) -> Column:
    """Text hash of the row key: the same on every run and in every layout."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))


def sample_weights(
    df: DataFrame, by: list[str], y: str = roles.TARGET, bins: int = 10, cap: float = 5.0
) -> DataFrame:
    """Inverse-density weights of the target with mean 1.

    Everything but the bin number of a row is computed on the table of bins.
    """
    span = df.groupBy(*by).agg(F.min(y).alias("_lo"), F.max(y).alias("_hi"))
    span = span.withColumn("_w", (F.col("_hi") - F.col("_lo")) / bins)
    rows = runtime.attach(df, span, by, check=True)
    # right-closed bins, the minimum belongs to the first
    raw = F.ceil((F.col(y) - F.col("_lo")) / F.nullif(F.col("_w"), F.lit(0.0)))
    number = F.least(F.lit(bins), F.greatest(F.lit(1), F.coalesce(raw, F.lit(1))))
    rows = rows.withColumn("_bin", F.when(F.col(y).isNull(), 0).otherwise(number))
    counts = rows.groupBy(*by, "_bin").agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*by)
    inv = F.when(F.col("_bin") == 0, 1.0).otherwise(1.0 / F.col("_c"))
    table = counts.withColumn("_inv", inv)
    mean = F.sum(F.col("_inv") * F.col("_c")).over(w) / F.sum("_c").over(w)
    table = table.withColumn("_root", F.sqrt(F.least(F.col("_inv"), cap * mean)))
    norm = F.sum("_c").over(w) / F.sum(F.col("_root") * F.col("_c")).over(w)
    table = table.select(*by, "_bin", (F.col("_root") * norm).alias("weight"))
    return runtime.attach(rows, table, by + ["_bin"], check=True).drop("_bin", "_lo", "_hi", "_w")


def fit_target_cap(df: DataFrame, by: list[str], y: str = roles.TARGET, q: float = 0.995) -> DataFrame:
    return quantiles(df, by, [y], [q]).select(*by, F.col(y)[0].alias("target_cap"))


def log_capped(df: DataFrame, fitted: DataFrame, by: list[str], y: str = roles.TARGET) -> DataFrame:
    out = runtime.attach(df, fitted, by, check=True)
    return out.withColumn("y_log", F.log1p(F.least(y, "target_cap"))).drop("target_cap")


def from_log(pred: Column) -> Column:
    return F.expm1(pred)


def strat_labels(df: DataFrame, by: list[str], min_count: int) -> DataFrame:
    """Label per (by, farm, format): the first strategy whose classes are big enough.

    Strategies: farm and format, farm, format; small classes are pooled as RARE.
    Works on the table of level counts.
    """
    cells = df.groupBy(*by, "fundo", "formato").agg(F.count("*").alias("n"))
    text = {c: F.coalesce(c, F.lit("nan")) for c in ("fundo", "formato")}
    options = F.array(
        F.struct(F.lit(1).alias("pref"), F.lit("fundo_formato").alias("strategy"), F.concat_ws("_", text["fundo"], text["formato"]).alias("raw")),
        F.struct(F.lit(2).alias("pref"), F.lit("fundo").alias("strategy"), text["fundo"].alias("raw")),
        F.struct(F.lit(3).alias("pref"), F.lit("formato").alias("strategy"), text["formato"].alias("raw")),
    )
    long = cells.select("*", F.inline(options))
    level = Window.partitionBy(*by, "pref", "raw")
    label = F.when(F.sum("n").over(level) < min_count, "RARE").otherwise(F.col("raw"))
    long = long.withColumn("label", label)
    # explicit partitions hold level counts only, never rows
    classes = long.groupBy(*by, "pref", "label").agg(F.sum("n").alias("c"))
    good = (
        classes.groupBy(*by, "pref")
        .agg(F.count("*").alias("k"), F.min("c").alias("least_c"))
        .where((F.col("k") >= 2) & (F.col("least_c") >= min_count))
        .groupBy(*by)
        .agg(F.min("pref").alias("best"))
    )
    chosen = runtime.attach(long, good, by).where(
        F.col("pref") == F.coalesce("best", F.lit(1))
    )
    return chosen.select(
        *by,
        "fundo",
        "formato",
        F.when(F.col("best").isNull(), "none").otherwise(F.col("strategy")).alias("strategy"),
        F.when(F.col("best").isNotNull(), F.col("label")).alias("label"),
    )


def stratified_folds(
    df: DataFrame, by: list[str], key: list[str], k: int, seed: int = 42, label: str = "label", limit: int | None = None
) -> DataFrame:
    """Shuffled folds balanced to one row within every label."""
    rows = df.withColumn("_h", key_hash(key, seed))
    out = running_total(rows, by + [label], ["_h"] + key, {"_rn": F.lit(1)}, limit)
    return out.withColumn("fold", ((F.col("_rn") - 1) % k).cast("long")).drop("_rn", "_h")


def kfolds(df: DataFrame, by: list[str], key: list[str], k: int, seed: int = 42, limit: int | None = None) -> DataFrame:
    """Shuffled folds without labels."""
    pooled = df.withColumn("_one", F.lit(0))
    return stratified_folds(pooled, by, key, k, seed, "_one", limit).drop("_one")


def temporal_folds(
    df: DataFrame, by: list[str], k: int = 3, min_train_years: int = 2, date: str = roles.DATE
) -> DataFrame:
    """Expanding-window folds: the last years test, all earlier years train.

    Rows appear once per fold they belong to, as ``test_year`` and ``role``.
    """
    rows = df.withColumn("_year", F.year(date))
    years = rows.groupBy(*by).agg(F.array_sort(F.collect_set("_year")).alias("_years"))
    n = F.greatest(F.lit(0), F.least(F.lit(k), F.size("_years") - min_train_years))
    tests = years.select(*by, F.slice("_years", F.size("_years") - n + 1, n).alias("_tests"))
    out = runtime.attach(rows, tests, by, check=True).withColumn("test_year", F.explode("_tests"))
    return (
        out.where(F.col("_year") <= F.col("test_year"))
        .withColumn("role", F.when(F.col("_year") < F.col("test_year"), "train").otherwise("test"))
        .drop("_year", "_tests")
    )


def fold_summary(fold_metrics: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Mean and population standard deviation over folds."""
    return fold_metrics.groupBy(*by).agg(
        *[F.avg(c).alias(f"{c}_mean") for c in cols], *[F.stddev_pop(c).alias(f"{c}_std") for c in cols]
    )


def best_fold(fold_metrics: DataFrame, by: list[str], value: str, metric: str = "mae") -> DataFrame:
    """``value`` of the fold with the smallest metric; the lowest value on ties."""
    return fold_metrics.groupBy(*by).agg(
        F.min(F.struct(metric, value)).getField(value).alias(value), F.min(metric).alias(metric)
    )


def seeded_split(df: DataFrame, key: list[str], test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Mark test rows by a hash of the key, stable under any repartitioning."""
    number = F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10).cast("long")
    return df.withColumn("is_test", number < int(test_share * (1 << 32)))


def holdout_check(df: DataFrame, by: list[str], groups: list[str], cutoff: str, excess: float = 0.20) -> DataFrame:
    """Error after the cut-off of a fit on earlier rows, against the out-of-fold error."""
    old = df.where(F.col(roles.DATE) < F.to_date(F.lit(cutoff)))
    new = df.where(F.col(roles.DATE) >= F.to_date(F.lit(cutoff)))
    fit = old.groupBy(*groups).agg(F.avg("y_true").alias("_p"))
    rows = runtime.attach(new, fit, groups, check=True)
    y = F.col("y_true")
    out = rows.where(F.col("_p").isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n_test"),
        (F.avg(F.when(y != 0, F.abs((F.col("_p") - y) / y))) * 100).alias("mape_oos"),
    )
    oof = old.groupBy(*by).agg(
        (F.avg(F.when(y != 0, F.abs((F.col("y_pred") - y) / y))) * 100).alias("mape_oof")
    )
    out = runtime.attach(out, oof, by)
    return out.withColumn("degraded", F.col("mape_oos") > F.col("mape_oof") * (1 + excess))
