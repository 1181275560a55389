"""Leakage-free lag features of the harvest table.

Row frames end on the previous row and day frames on earlier days, in the order
date, then the unique key. ``scope`` holds the columns that separate models
(normally the variety); an empty scope pools all rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sparkyield import roles, runtime
from sparkyield.functions import scalar
from sparkyield.functions.ordered import COPY, Blocks, blocks, running_total
from sparkyield.functions.quantiles import long_form, quantile_rows

GROUPS = {"ff": ["fundo", "formato"], "f": ["fundo"], "fmt": ["formato"]}
VALUES = [roles.TARGET, "kg_ha"]
#: rows of a day-range frame that may be held as one array
FRAME_ROWS = 200_000
#: bins of a group's values in :func:`binned_medians`
BINS = 32
#: rows of a block handed to one sliding-median call
ROLL_ROWS = 1_000_000

OUTPUTS = (
    [f"{v}_lag_{g}_{n}" for g in GROUPS for v in VALUES for n in roles.LAG_WINDOWS]
    + ["kg_jr_h_lag_ff_seasonal", "kg_ha_lag_ff_seasonal", "kg_ha_std_ff_30", "kg_ha_slope_ff_30"]
    + ["days_since_last_ff", "tenure_fundo_days", "kg_ha_ratio_ff_30", "kg_ha_ratio_ff_90"]
    + ["delta_kg_jr_h_30_90", "kg_ha_rel_global_30", "kg_ha_rel_formato_30"]
)
#: columns that the farm and format frames give besides medians
SPREAD = ["kg_ha_std_ff_30", "kg_ha_slope_ff_30", "days_since_last_ff"]
SIMPLE_OUTPUTS = ["kg_jr_h_lag_ff_simple_1", "kg_jr_h_lag_ff_simple_2", "kg_jr_h_diff_1_ff"]


def with_medians(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Medians of arrays without missing entries; each needs 3 of them.

    Sorted arrays are columns of their own, so that each is built once per row.
    """
    df = df.withColumns({f"_s_{k}": F.sort_array(v) for k, v in values.items()})
    out = {}
    for k in values:
        s, n = F.col(f"_s_{k}"), F.size(f"_s_{k}")
        low, high = F.floor((n + 1) / 2).cast("int"), F.floor(n / 2).cast("int") + 1
        middle = (F.element_at(s, low) + F.element_at(s, high)) / 2
        out[k] = F.when(n >= roles.LAG_MIN, middle)
    return df.withColumns(out).drop(*[f"_s_{k}" for k in values])


def group_sizes(df: DataFrame, scope: list[str]) -> dict[str, int]:
    """Largest group of every grouping and of the scope, from one pass."""
    cells = df.groupBy(*scope, *GROUPS["ff"]).agg(F.count("*").alias("ff"))
    # windows over group counts, not rows
    totals = {g: F.sum("ff").over(Window.partitionBy(F.lit(0), *scope, *c)) for g, c in GROUPS.items()}
    totals["all"] = F.sum("ff").over(Window.partitionBy(F.lit(0), *scope))
    row = cells.select(*[v.alias(f"_{k}") for k, v in totals.items()]).agg(
        *[F.max(f"_{k}").alias(k) for k in totals]
    ).first()
    return {k: row[k] or 0 for k in totals}


def rolling_medians(b: Blocks, names: dict[str, tuple[str, int]], key: list[str], extra: list[str] = ()) -> DataFrame:
    """Medians of the previous rows by ``key``; ``names`` maps output to (column, rows).

    Spark's percentile rebuilds every frame; a sliding median over Arrow columns
    of one block (bounded rows) updates it. Only the key, the values and the ``extra``
    columns travel.
    """
    least = roles.LAG_MIN
    values = list(dict.fromkeys(col for col, _ in names.values()))

    def slide(table: pa.Table) -> pa.Table:
        order = np.argsort(table["_ord"].to_numpy(), kind="stable")
        shifted = {
            c: pd.Series(table[c].to_numpy(zero_copy_only=False).astype(float)[order]).shift(1)
            for c in values
        }
        out = table.select(kept)
        for name, (c, n) in names.items():
            medians = np.empty(len(order))
            medians[order] = shifted[c].rolling(n, min_periods=least).median().to_numpy()
            out = out.append_column(name, pa.array(medians, from_pandas=True))
        return out

    kept = list(dict.fromkeys([*key, *extra, *([COPY] if COPY in b.df.columns else [])]))
    ordered = b.df.withColumn("_ord", F.row_number().over(b.window()))
    slim = ordered.select(*dict.fromkeys([*b.by, *kept, *values, "_ord"]))
    schema = StructType([*ordered.select(*kept).schema.fields, *[StructField(k, DoubleType()) for k in names]])
    return b.finish(slim.groupBy(*b.by).applyInArrow(slide, schema))


def _slim(df: DataFrame, key: list[str], scope: list[str]) -> DataFrame:
    """What the row frames need of a table."""
    return df.select(*dict.fromkeys([*key, *scope, *GROUPS["ff"], roles.DATE, *VALUES]))


def group_medians(
    df: DataFrame, key: list[str], scope: list[str], groups=None, sizes: dict[str, int] | None = None
) -> DataFrame:
    """Rolling medians of the target and of kg per hectare for each grouping.

    Every grouping starts from the few columns it needs and is joined back by ``key``,
    so whole rows are shuffled once and never leave the JVM.
    """
    sizes = sizes or group_sizes(df, scope)
    base, out = _slim(df, key, scope), df
    for g in groups or GROUPS:
        limit = min(ROLL_ROWS, runtime.GROUP_ROWS)
        b = blocks(base, scope + GROUPS[g], [roles.DATE] + key, max(roles.LAG_WINDOWS), limit, largest=sizes[g])
        extra = []
        if g == "ff":
            b, extra = Blocks(spread_and_cadence(b, b.df), b.by, b.order), SPREAD
        names = {f"{v}_lag_{g}_{n}": (v, n) for v in VALUES for n in roles.LAG_WINDOWS}
        out = runtime.attach(out, rolling_medians(b, names, key, extra), key)
    return out


def spread_and_cadence(b: Blocks, df: DataFrame) -> DataFrame:
    """Rolling standard deviation, slope and days since the previous row."""
    f30 = b.rows(30)
    n = F.count("kg_ha").over(f30)
    df = df.withColumn("_i", F.row_number().over(b.window()).cast("double"))
    return df.withColumns(
        {
            "kg_ha_std_ff_30": F.when(n >= roles.LAG_MIN, F.stddev_samp("kg_ha").over(f30)),
            "kg_ha_slope_ff_30": F.when(
                n >= roles.LAG_MIN, F.regr_slope(F.col("kg_ha"), F.col("_i")).over(f30)
            ),
            "days_since_last_ff": F.datediff("fecha", F.lag("fecha").over(b.window())).cast(
                "double"
            ),
        }
    ).drop("_i")


def volatility(df: DataFrame, key: list[str], scope: list[str]) -> DataFrame:
    b = blocks(df, scope + GROUPS["ff"], [roles.DATE] + key, 30)
    return b.finish(spread_and_cadence(b, b.df))


def simple_lags(df: DataFrame, key: list[str], scope: list[str]) -> DataFrame:
    """Target one and two rows back, and their difference."""
    b = blocks(df, scope + GROUPS["ff"], [roles.DATE] + key, 2)
    one, two = (F.lag(roles.TARGET, k).over(b.window()) for k in (1, 2))
    out = b.df.withColumns(dict(zip(SIMPLE_OUTPUTS, (one, two, one - two))))
    return b.finish(out)


def binned_medians(rows: DataFrame, days: DataFrame, by: list[str], limit: int | None = None) -> DataFrame:
    """``(by, d, variable, median)``: medians of the season before each day of ``days``.

    Order statistics on two levels. Each group's values are cut at its quantiles into
    ``BINS`` bins, and a day has one vector of bin counts; a frame's vector is the sum of
    those of its days and tells in which bin the middle lies. Only the value counts of
    that bin are then looked at, so values are not copied into the frames they are in.
    """
    keys = by + ["variable"]
    counts = long_form(rows, by + ["d"], VALUES).groupBy(*keys, "d", "value").count()
    counts = runtime.materialize(counts.withColumnRenamed("count", "n"))
    cuts = quantile_rows(counts, keys, "value", [i / BINS for i in range(1, BINS)], weight="n", limit=limit)
    cell = F.size(F.filter("q", lambda q: q < F.col("value")))
    binned = runtime.attach(counts, cuts, keys, "inner", check=True).withColumn("bin", cell).drop("q")
    binned = runtime.materialize(binned)

    entries = F.map_from_entries(F.collect_list(F.struct("bin", "n")))
    vectors = binned.groupBy(*keys, "d", "bin").agg(F.sum("n").alias("n")).groupBy(*keys, "d").agg(entries.alias("m"))
    each = days.withColumn("variable", F.explode(F.array(*[F.lit(v) for v in VALUES])))
    none = F.array_repeat(F.lit(0).cast("long"), BINS)
    dense = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.coalesce(F.col("m")[b], F.lit(0)))
    each = runtime.attach(each, vectors, keys + ["d"]).withColumn("v", F.when(F.col("m").isNotNull(), dense))
    frame = Window.partitionBy(*keys).orderBy("d").rangeBetween(-roles.SEASON_LOW, -roles.SEASON_HIGH)
    # one row for each group and day: at most 31 vectors in a frame
    total = F.aggregate(F.collect_list("v").over(frame), none, lambda a, v: F.zip_with(a, v, lambda x, y: x + y))
    upto = F.aggregate(
        "total",
        F.array().cast("array<long>"),
        lambda a, x: F.concat(a, F.array(x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)))),
    )
    sums = each.select(*keys, "d", total.alias("total")).withColumn("upto", upto)
    n = F.element_at("upto", -1)
    spots = F.array(F.floor((n + 1) / 2).cast("long"), (F.floor(n / 2) + 1).cast("long"))
    sums = sums.where(n > 0).withColumn("k", F.explode(F.array_distinct(spots)))
    at = F.size(F.filter("upto", lambda x: x < F.col("k")))
    earlier = F.when(F.col("bin") > 0, F.element_at("upto", F.col("bin"))).otherwise(0)
    wanted = sums.withColumn("bin", at).withColumn("k", F.col("k") - earlier)
    span = F.explode(F.sequence(F.col("d") - roles.SEASON_LOW, F.col("d") - roles.SEASON_HIGH))
    wanted = wanted.select(*keys, "bin", "k", F.col("d").alias("t"), span.alias("d"))

    inside = runtime.attach(binned, wanted, keys + ["bin", "d"], "inner")
    spot = keys + ["t", "bin", "k"]
    inside = inside.groupBy(*spot, "value").agg(F.sum("n").alias("n"))
    ranked = running_total(inside, spot, ["value"], {"upto": F.col("n")}, limit)
    found = ranked.where(F.col("upto") >= F.col("k")).groupBy(*spot).agg(F.min("value").alias("value"))
    return found.groupBy(*keys, F.col("t").alias("d")).agg(F.avg("value").alias("median"))


def seasonal_medians(
    df: DataFrame, scope: list[str], frame_rows: int | None = None
) -> DataFrame:
    """Median of the same season a year before, per farm, format and day.

    All rows of one day share a frame, so the work is done once per (group,
    day). Short frames are merged from arrays per day; beyond ``frame_rows`` the
    medians come from binned counts.
    """
    limit = FRAME_ROWS if frame_rows is None else frame_rows
    by = scope + GROUPS["ff"]
    rows = df.select(*by, scalar.day_number(roles.DATE).alias("d"), *VALUES)
    frame = Window.partitionBy(*by).orderBy("d").rangeBetween(-roles.SEASON_LOW, -roles.SEASON_HIGH)
    sizes = (
        rows.groupBy(*by, "d")
        .agg(
            F.count("*").alias("n"),
            *[(F.count("*") - F.count(v)).alias(f"miss_{v}") for v in VALUES],
        )
        .withColumn("frame_n", F.sum("n").over(frame))
        .withColumns({f"miss_{v}": F.sum(f"miss_{v}").over(frame) for v in VALUES})
    )
    biggest = sizes.agg(F.max("frame_n")).first()[0] or 0
    if biggest <= limit:
        # one aggregation gives both the day arrays and the guards
        days = rows.groupBy(*by, "d").agg(
            F.count("*").alias("n"),
            *[(F.count("*") - F.count(v)).alias(f"miss_{v}") for v in VALUES],
            *[F.collect_list(v).alias(f"a_{v}") for v in VALUES],
        )
        sizes = days.withColumn("frame_n", F.sum("n").over(frame)).withColumns(
            {f"miss_{v}": F.sum(f"miss_{v}").over(frame) for v in VALUES}
            | {f"m_{v}": F.flatten(F.collect_list(f"a_{v}").over(frame)) for v in VALUES}
        )
        found = with_medians(sizes, {f"m_{v}": F.col(f"m_{v}") for v in VALUES})
    else:
        medians = binned_medians(rows, sizes.select(*by, "d"), by)
        wide = medians.groupBy(*by, "d").agg(
            *[F.max(F.when(F.col("variable") == v, F.col("median"))).alias(f"m_{v}") for v in VALUES]
        )
        found = runtime.attach(sizes, wide, by + ["d"])
    enough = F.col("frame_n") >= roles.LAG_MIN
    return found.select(
        *by,
        "d",
        *[
            F.when(enough & (F.col(f"miss_{v}") == 0), F.col(f"m_{v}")).alias(f"{v}_lag_ff_seasonal")
            for v in VALUES
        ],
    )


def seasonal_lags(df: DataFrame, scope: list[str], frame_rows: int | None = None) -> DataFrame:
    by = scope + GROUPS["ff"]
    table = seasonal_medians(df, scope, frame_rows)
    keyed = df.withColumn("d", scalar.day_number(roles.DATE))
    return runtime.attach(keyed, table, by + ["d"], check=True).drop("d")


def first_seen(df: DataFrame, scope: list[str]) -> DataFrame:
    """First date of each farm."""
    return df.groupBy(*scope, "fundo").agg(F.min(roles.DATE).alias("first_seen"))


def farm_tenure(df: DataFrame, scope: list[str], fitted: DataFrame | None = None) -> DataFrame:
    """Days since the farm's first date; 0 for a farm not seen at fit."""
    known = first_seen(df, scope) if fitted is None else fitted
    out = runtime.attach(df, known, scope + ["fundo"], check=True)
    days = F.coalesce(F.datediff(roles.DATE, "first_seen").cast("double"), F.lit(0.0))
    return out.withColumn("tenure_fundo_days", days).drop("first_seen")


def own_ratios(df: DataFrame) -> DataFrame:
    """Today's kg per hectare against the own 30- and 90-row medians."""
    return df.withColumns(
        {
            f"kg_ha_ratio_ff_{n}": scalar.safe_ratio(F.col("kg_ha"), F.col(f"kg_ha_lag_ff_{n}"))
            for n in (30, 90)
        }
    )


def global_ratio(
    df: DataFrame, key: list[str], scope: list[str], largest: int | None = None
) -> DataFrame:
    """kg per hectare against the previous 30 rows of all groups."""
    limit = min(ROLL_ROWS, runtime.GROUP_ROWS)
    b = blocks(_slim(df, key, scope), scope, [roles.DATE] + key, 30, limit, largest=largest)
    out = runtime.attach(df, rolling_medians(b, {"_global": ("kg_ha", 30)}, key), key)
    ratio = scalar.safe_ratio(F.col("kg_ha"), F.col("_global"))
    return out.withColumn("kg_ha_rel_global_30", ratio).drop("_global")


def momentum(df: DataFrame) -> DataFrame:
    ratio = scalar.safe_ratio(F.col("kg_jr_h_lag_ff_30"), F.col("kg_jr_h_lag_ff_90"))
    return df.withColumn("delta_kg_jr_h_30_90", ratio)


def farm_position(df: DataFrame) -> DataFrame:
    ratio = scalar.safe_ratio(F.col("kg_ha_lag_f_30"), F.col("kg_ha_lag_fmt_30"))
    return df.withColumn("kg_ha_rel_formato_30", ratio)


def cold_start(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace missing history by the sentinel."""
    return df.withColumns({c: F.coalesce(c, F.lit(roles.COLD_START)) for c in cols})


def lag_features(
    df: DataFrame,
    key: list[str],
    scope: list[str],
    simple: bool = False,
    tenure_from: DataFrame | None = None,
) -> DataFrame:
    """All lag columns (35, or 38 with ``simple``); input rows are kept."""
    needed = ["fundo", "formato", roles.DATE, *VALUES]
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"lag_features: missing columns {missing}")
    out = seasonal_lags(df, scope)
    sizes = group_sizes(df, scope)
    out = group_medians(out, key, scope, sizes=sizes)
    if simple:
        out = simple_lags(out, key, scope)
    out = global_ratio(out, key, scope, sizes["all"])
    known = first_seen(df, scope) if tenure_from is None else tenure_from
    out = farm_tenure(out, scope, known)
    out = farm_position(momentum(own_ratios(out)))
    return cold_start(out, OUTPUTS + (SIMPLE_OUTPUTS if simple else []))


def union_history(history: DataFrame, new: DataFrame) -> DataFrame:
    """Stack history and new rows, filling absent columns with null."""
    return history.withColumn("is_new", F.lit(False)).unionByName(
        new.withColumn("is_new", F.lit(True)), allowMissingColumns=True
    )


def recent_history(history: DataFrame, since, key: list[str], scope: list[str]) -> DataFrame:
    """History rows that a frame of rows dated ``since`` or later can reach.

    The last 90 rows of a farm or format are among the last 90 of their farm
    and format pairs, so pruning by pair is exact for every grouping.
    """
    old = history.where(F.col(roles.DATE) < F.lit(since))
    w = Window.partitionBy(*scope, *GROUPS["ff"]).orderBy(
        F.col(roles.DATE).desc(), *[F.col(k).desc() for k in key]
    )
    last = (
        old.withColumn("_r", F.row_number().over(w))
        .where(F.col("_r") <= max(roles.LAG_WINDOWS))
        .drop("_r")
    )
    start = F.date_sub(F.lit(since), roles.SEASON_LOW)
    in_reach = history.where(F.col(roles.DATE) >= start)
    return in_reach.unionByName(last.where(F.col(roles.DATE) < start))


def score_lags(history: DataFrame, new: DataFrame, key: list[str], scope: list[str]) -> DataFrame:
    """Lag columns of new rows, which see history and each other, target unknown."""
    since = new.agg(F.min(roles.DATE)).first()[0]
    fitted = first_seen(history, scope)
    blank = new.withColumn(roles.TARGET, F.lit(None).cast("double"))
    rows = union_history(recent_history(history, since, key, scope), blank)
    out = lag_features(rows, key, scope, tenure_from=fitted)
    return out.where("is_new").drop("is_new")
