"""Exact quantiles and ranks built from value counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkyield import runtime
from sparkyield.functions.ordered import boundaries, in_ranges, running_total


def value_counts(df: DataFrame, by: list[str], value: str, weight: str | None = None) -> DataFrame:
    """Rows ``(by..., value, n)``, nulls dropped; combined map-side."""
    n = F.count("*") if weight is None else F.sum(weight)
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(n.alias("n"))


def long_form(df: DataFrame, keep: list[str], cols: list[str]) -> DataFrame:
    """Unpivot numeric ``cols`` to ``(keep..., variable, value)``, nulls dropped."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.select(
        *keep, F.expr(f"stack({len(cols)}, {pairs}) AS (variable, value)")
    ).where(F.col("value").isNotNull())


def quantile_rows(
    df: DataFrame,
    by: list[str],
    value: str,
    probs: list[float],
    weight: str | None = None,
    method: str = "linear",
    limit: int | None = None,
    largest: int | None = None,
) -> DataFrame:
    """One row per group with ``q`` = array of exact quantiles at ``probs``.

    ``method`` is ``linear`` (interpolated) or ``nearest`` (the element at
    ``round((n - 1) * p)``). Groups within ``limit`` use the built-in
    ``percentile``; beyond it the quantiles are read off the running total of
    the value counts, within the ranges of values where they fall, which never gathers
    a group in one task. ``largest`` is
    the size of the biggest group where the caller already knows it.
    """
    limit = runtime.GROUP_ROWS if limit is None else limit
    base = df.select(*by, F.col(value).alias("_v"), *([weight] if weight else []))
    base = base.where(F.col("_v").isNotNull())
    if method == "linear" and largest is None:
        largest = runtime.largest_group(base, by)
    if method == "linear" and largest <= limit:
        ps = F.array(*[F.lit(float(p)) for p in probs])
        agg = F.percentile("_v", ps, F.col(weight)) if weight else F.percentile("_v", ps)
        return base.groupBy(*by).agg(agg.alias("q"))
    counts = runtime.materialize(value_counts(base, by, "_v", weight))
    within = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    order, parts = [*by, "_v"], int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = runtime.largest_group(counts, by) <= limit
    cuts = [] if plain else boundaries(counts, order, max(parts, -(-counts.count() // limit)))
    placed = in_ranges(counts, order, cuts)
    # one row per group and range; only ranges that hold a wanted place are ordered
    per = runtime.materialize(placed.groupBy(*by, "_part").agg(F.sum("n").alias("_in")))
    upto = F.sum("_in").over(within.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranges = per.withColumns({"_to": upto, "_total": F.sum("_in").over(within)})
    last = F.col("_total") - 1
    spots = []
    for i, p in enumerate(probs):
        at = last * F.lit(float(p))
        if method == "nearest":
            spots.append(F.struct(F.lit(i).alias("i"), F.round(at).cast("long").alias("k"), F.lit(1.0).alias("w")))
        else:
            part = at - F.floor(at)
            spots.append(F.struct(F.lit(i).alias("i"), F.floor(at).cast("long").alias("k"), (1 - part).alias("w")))
            spots.append(F.struct(F.lit(i).alias("i"), F.ceil(at).cast("long").alias("k"), part.alias("w")))
    held = lambda low, high: lambda s: (s["k"] < high) & (s["k"] >= low)
    to, n = F.col("_to"), F.col("n")
    ranges = ranges.withColumn("_spots", F.filter(F.array(*spots), held(to - F.col("_in"), to)))
    ranges = ranges.where(F.size("_spots") > 0).withColumn("_from", to - F.col("_in"))
    near = runtime.attach(placed, ranges.select(*by, "_part", "_from", "_spots"), [*by, "_part"], "inner", check=True)
    upto = F.sum("n").over(Window.partitionBy(*by, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = near.withColumn("_hi", F.col("_from") + upto)
    inside = F.filter("_spots", held(F.col("_hi") - n, F.col("_hi")))
    hits = rows.select(*by, "_v", F.explode(inside).alias("s"))
    per = hits.groupBy(*by, F.col("s.i").alias("i")).agg(
        F.sum(F.col("_v") * F.col("s.w")).alias("x")
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"])
    return per.groupBy(*by).agg(ordered.alias("q"))


def quantiles(
    df: DataFrame, by: list[str], cols: list[str], probs: list[float], limit: int | None = None
) -> DataFrame:
    """Exact linear quantiles of several columns: one array column ``<col>`` each."""
    limit = runtime.GROUP_ROWS if limit is None else limit
    if runtime.largest_group(df, by) <= limit:
        ps = F.array(*[F.lit(float(p)) for p in probs])
        return df.groupBy(*by).agg(*[F.percentile(F.col(c).cast("double"), ps).alias(c) for c in cols])
    rows = quantile_rows(long_form(df, by, cols), by + ["variable"], "value", probs, limit=limit, largest=limit + 1)
    return rows.groupBy(*by).agg(
        *[F.max(F.when(F.col("variable") == c, F.col("q"))).alias(c) for c in cols]
    )


def average_ranks(counts: DataFrame, by: list[str], value: str, n: str = "n") -> DataFrame:
    """Add ``rank``, the mean rank of tied values, to a value-count table."""
    cum = running_total(counts, by, [value], {"_hi": F.col(n)})
    return cum.withColumn("rank", F.col("_hi") - (F.col(n) - 1) / 2).drop("_hi")
