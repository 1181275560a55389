"""Fit and apply cleaning steps.

A fit returns a small table keyed by ``by``; applying it joins that table back
(broadcast after a row check), so rows to score need nothing but the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkyield import runtime
from sparkyield.functions.quantiles import quantiles


def missing_flags(df: DataFrame, cols: list[str]) -> DataFrame:
    """``<col>__miss`` 0/1 columns and their sum; absent columns are skipped."""
    cols = [c for c in cols if c in df.columns]
    out = df.withColumns({f"{c}__miss": F.col(c).isNull().cast("int") for c in cols})
    return out.withColumn("n_miss_raw", sum((F.col(f"{c}__miss") for c in cols), F.lit(0)))


def fit_medians(df: DataFrame, cols: list[str], by: list[str], threshold: float = 0.30) -> DataFrame:
    """Median per column and whether its missing share asks for median filling."""
    medians = quantiles(df, by, cols, [0.5]).select(
        *by, *[F.col(c)[0].alias(f"{c}__median") for c in cols]
    )
    ratios = df.groupBy(*by).agg(
        *[(F.avg(F.col(c).isNull().cast("int")) > threshold).alias(f"{c}__fill") for c in cols]
    )
    return runtime.attach(medians, ratios, by)


def impute_medians(df: DataFrame, fitted: DataFrame, cols: list[str], by: list[str], every: bool = False) -> DataFrame:
    """Fill nulls; by default only in columns over the threshold at fit."""
    out = runtime.attach(df, fitted, by, check=True)
    for c in cols:
        fill = F.col(f"{c}__median") if every else F.when(F.col(f"{c}__fill"), F.col(f"{c}__median"))
        out = out.withColumn(c, F.coalesce(F.col(c), fill))
    return out.drop(*[f"{c}__{s}" for c in cols for s in ("median", "fill")])


def fit_scale(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """Median and interquartile range (1 where it is 0)."""
    return scale_of(quantiles(df, by, cols, [0.25, 0.5, 0.75]), cols, by)


def scale_of(q: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """The scale from the quartiles, one array column per column."""
    iqr = lambda c: F.col(c)[2] - F.col(c)[0]
    return q.select(
        *by,
        *[F.col(c)[1].alias(f"{c}__center") for c in cols],
        *[F.when(iqr(c) == 0, 1.0).otherwise(iqr(c)).alias(f"{c}__scale") for c in cols],
    )


def apply_scale(df: DataFrame, fitted: DataFrame, cols: list[str], by: list[str], suffix: str = "") -> DataFrame:
    out = runtime.attach(df, fitted, by, check=True)
    out = out.withColumns(
        {f"{c}{suffix}": (F.col(c) - F.col(f"{c}__center")) / F.col(f"{c}__scale") for c in cols}
    )
    return out.drop(*[f"{c}__{s}" for c in cols for s in ("center", "scale")])


def _bounds(df: DataFrame, by: list[str], cols: list[str], method: str, factor: float, low: float, high: float) -> DataFrame:
    if method == "iqr":
        q = quantiles(df, by, cols, [0.25, 0.75])
        step = {c: factor * (F.col(c)[1] - F.col(c)[0]) for c in cols}
        pairs = {c: (F.col(c)[0] - step[c], F.col(c)[1] + step[c]) for c in cols}
    elif method == "percentile":
        q = quantiles(df, by, cols, [low, high])
        pairs = {c: (F.col(c)[0], F.col(c)[1]) for c in cols}
    else:
        raise ValueError(f"method must be iqr or percentile, not {method!r}")
    box = F.struct(*[F.struct(lo.alias("lo"), hi.alias("hi")).alias(c) for c, (lo, hi) in pairs.items()])
    return q.select(*by, box.alias("box"))


def fit_caps(
    df: DataFrame,
    cols: list[str],
    by: list[str],
    cascade: list[str] | None = None,
    method: str = "iqr",
    factor: float = 3.0,
    low: float = 0.01,
    high: float = 0.99,
    min_group: int = 30,
) -> list[tuple[list[str], DataFrame]]:
    """Bounds per level, the most specific first, the whole of ``by`` last."""
    levels = []
    for n in range(len(cascade or []), 0, -1):
        keys = by + cascade[:n]
        big = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= min_group)
        table = _bounds(df, keys, cols, method, factor, low, high)
        levels.append((keys, runtime.attach(table, big.drop("_n"), keys, "inner")))
    levels.append((by, _bounds(df, by, cols, method, factor, low, high)))
    return levels


def apply_caps(df: DataFrame, levels: list[tuple[list[str], DataFrame]], cols: list[str]) -> DataFrame:
    """Clip to the bounds of the most specific level; both ends from one level."""
    out = df
    for i, (keys, table) in enumerate(levels):
        out = runtime.attach(out, table.withColumnRenamed("box", f"_box{i}"), keys, check=True)
    boxes = [f"_box{i}" for i in range(len(levels))]
    out = out.withColumn("_box", F.coalesce(*boxes))
    clipped = {}
    for c in cols:
        lo, hi = F.col(f"_box.{c}.lo"), F.col(f"_box.{c}.hi")
        v = F.col(c).cast("double")
        clipped[c] = F.when(v.isNotNull(), F.least(F.greatest(v, lo), hi))
    return out.withColumns(clipped).drop("_box", *boxes)


def drop_group_outliers(
    df: DataFrame, cols: list[str], by: list[str], contamination: float = 0.05, min_group: int = 5
) -> DataFrame:
    """Drop the rows of each group whose largest robust z is in the top share."""
    z = apply_scale(df, fit_scale(df, cols, by), cols, by, suffix="__z")
    worst = F.greatest(*[F.coalesce(F.abs(f"{c}__z"), F.lit(0.0)) for c in cols])
    scored = z.withColumn("_worst", worst).drop(*[f"{c}__z" for c in cols])
    limits = quantiles(scored, by, ["_worst"], [1 - contamination])
    sizes = df.groupBy(*by).agg(F.count("*").alias("_n"))
    limits = runtime.attach(limits, sizes, by).select(*by, F.col("_worst")[0].alias("_limit"), "_n")
    out = runtime.attach(scored, limits, by, check=True)
    keep = (F.col("_n") < min_group) | (F.col("_worst") <= F.col("_limit"))
    return out.where(keep).drop("_worst", "_limit", "_n")


def constant_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns without variance, from one aggregation."""
    row = df.agg(*[(F.min(c) == F.max(c)).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] is None or row[c]]


def drop_constant_features(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*constant_columns(df, cols))
