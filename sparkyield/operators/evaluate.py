"""Error metrics, bands, subgroup tables and report figures.

Inputs are prediction rows with ``y_true``, ``y_pred``, ``h_ef`` and ``kg_jr``.
``by`` holds the columns that separate reports (normally the variety).
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sparkyield import roles, runtime
from sparkyield.functions import scalar
from sparkyield.functions.quantiles import quantile_rows, quantiles


def out_of_fold_group_mean(
    df: DataFrame, groups: list[str], fold: str, y: str, name: str = "y_pred"
) -> DataFrame:
    """Predict each row by the mean of its group over the other folds."""
    sums = df.groupBy(*groups, fold).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
    w = Window.partitionBy(*groups)
    rest_n = F.sum("_n").over(w) - F.col("_n")
    rest = F.when(rest_n > 0, (F.sum("_s").over(w) - F.col("_s")) / rest_n)
    table = sums.select(*groups, fold, rest.alias(name))
    return runtime.attach(df, table, groups + [fold], check=True)


def metric_columns(y: Column, p: Column) -> dict[str, Column]:
    """MAE, RMSE, R2 and MAPE (rows with y = 0 left out) as aggregates."""
    e = p - y
    sse, sst = F.sum(e * e), F.var_pop(y) * F.count(e)
    return {
        "n": F.count(e),
        "mae": F.avg(F.abs(e)),
        "rmse": F.sqrt(F.avg(e * e)),
        "r2": F.when(sst > 0, 1 - sse / sst),
        "mape": F.avg(F.when(y != 0, F.abs(e / y))) * 100,
    }


def metrics(df: DataFrame, by: list[str], y: str = "y_true", p: str = "y_pred") -> DataFrame:
    both = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    cols = metric_columns(F.col(y), F.col(p))
    return both.groupBy(*by).agg(*[v.alias(k) for k, v in cols.items()])


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def business_metrics(df: DataFrame, by: list[str], scenarios: dict[str, str]) -> DataFrame:
    """Metrics in kg per worker-day for several prediction columns.

    ``scenarios`` maps a scenario name to its prediction column. Rows without a
    finite prediction, hours or real value are dropped and counted.
    """
    pairs = ", ".join(f"'{k}', CAST(`{c}` AS DOUBLE)" for k, c in scenarios.items())
    long = df.select(
        *by, "h_ef", "kg_jr", F.expr(f"stack({len(scenarios)}, {pairs}) AS (scenario, pred)")
    )
    est = F.col("pred") * F.col("h_ef")
    ok = finite(est) & finite(F.col("kg_jr"))
    long = long.select(
        *by, "scenario", F.when(ok, F.col("kg_jr")).alias("y"), F.when(ok, est).alias("p")
    )
    cols = metric_columns(F.col("y"), F.col("p"))
    return long.groupBy(*by, "scenario").agg(
        *[v.alias(k) for k, v in cols.items()],
        (F.count("*") - F.count("p")).alias("n_dropped"),
    )


def prediction_table(df: DataFrame, low: Column | None = None, high: Column | None = None) -> DataFrame:
    """Rows in business units with absolute and percentage error."""
    est = F.col("y_pred") * F.col("h_ef")
    rows = df.where(
        finite(F.col("y_pred")) & finite(F.col("h_ef")) & finite(F.col("kg_jr"))
    ).withColumn("kg_jr_estimado", est)
    err = F.abs(F.col("kg_jr_estimado") - F.col("kg_jr"))
    rows = rows.withColumn("error_abs", err).withColumn(
        "error_pct", F.when(F.col("kg_jr") != 0, F.col("error_abs") / F.abs("kg_jr") * 100)
    )
    if low is not None:
        rows = rows.withColumn("estimacion_baja", low * F.col("h_ef"))
        rows = rows.withColumn("estimacion_alta", high * F.col("h_ef"))
    return rows


def conformal_quantile(df: DataFrame, by: list[str], alpha: float = 0.05) -> DataFrame:
    """Finite-sample quantile of absolute residuals per report; 0 below 20 rows.

    The level depends on the row count, so the two neighbouring order statistics
    are read by rank.
    """
    from sparkyield.functions.ordered import running_total
    from sparkyield.functions.quantiles import value_counts

    rows = df.select(*by, F.abs(F.col("y_true") - F.col("y_pred")).alias("_r"))
    counts = value_counts(rows, by, "_r")
    cum = running_total(counts, by, ["_r"], {"_hi": F.col("n")})
    totals = counts.groupBy(*by).agg(F.sum("n").alias("_total"))
    n = F.col("_total")
    at = (n - 1) * F.least(F.lit(1.0), F.lit(1 - alpha) * (n + 1) / n)
    joined = runtime.attach(cum, totals, by, "inner", check=True).withColumn("_at", at)
    hit = lambda k: (F.col("_hi") > k) & (F.col("_hi") - F.col("n") <= k)
    lo, hi = F.floor("_at"), F.ceil("_at")
    part = F.col("_at") - lo
    share = F.when(hit(lo), 1 - part).otherwise(0.0) + F.when(
        hit(hi) & (hi > lo), part
    ).otherwise(0.0)
    return joined.groupBy(*by).agg(
        F.when(F.max(n) >= 20, F.sum(F.col("_r") * share)).otherwise(0.0).alias("q"),
        F.max(n).alias("n"),
    )


def conformal_band(df: DataFrame, by: list[str], alpha: float = 0.05) -> DataFrame:
    table = conformal_quantile(df, by, alpha).drop("n")
    out = runtime.attach(df, table, by, check=True)
    return out.withColumns(
        {"y_low": F.col("y_pred") - F.col("q"), "y_high": F.col("y_pred") + F.col("q")}
    ).drop("q")


def ensemble_band(mean: Column, std: Column) -> tuple[Column, Column]:
    return mean - 1.96 * std, mean + 1.96 * std


def subgroup_summary(table: DataFrame, by: list[str], group: str) -> DataFrame:
    """Subgroups ranked from the worst to the best percentage error."""
    agg = table.groupBy(*by, group).agg(
        F.count("*").alias("n_cosechas"),
        F.avg("kg_jr").alias("real_promedio"),
        F.avg("kg_jr_estimado").alias("estimado_promedio"),
        F.avg("error_abs").alias("mae"),
        F.avg("error_pct").alias("error_pct_promedio"),
        F.max("error_abs").alias("error_maximo"),
    )
    w = Window.partitionBy(*by).orderBy(F.col("error_pct_promedio").desc_nulls_last(), group)
    return agg.withColumn("ranking", F.row_number().over(w))


def below(col: str):
    """Predicate for array elements smaller than the column."""
    return lambda e: e < F.col(col)


def report_bins(df: DataFrame, by: list[str]) -> DataFrame:
    """Text levels for the report groupings: year, month, area and quartiles."""
    ha = F.when(F.col("ha").isNull(), None)
    for edge, label in roles.HA_EDGES:
        ha = ha.when(F.col("ha") <= edge, label)
    month = F.element_at(F.array(*[F.lit(m) for m in roles.MONTHS]), F.month("fecha"))
    out = df.withColumns(
        {
            "g_anio": F.year("fecha").cast("string"),
            "g_mes": F.concat(F.date_format("fecha", "MM"), F.lit("-"), month),
            "g_ha": ha.otherwise(roles.HA_LAST),
        }
    )
    edges = quantiles(df, by, ["kg_ha", "pct_indus"], [0.25, 0.5, 0.75]).withColumnsRenamed(
        {"kg_ha": "e_kg_ha", "pct_indus": "e_pct_indus"}
    )
    out = runtime.attach(out, edges, by, check=True)
    labels = F.array(*[F.lit(x) for x in roles.QUARTILE_LABELS])
    for c in ("kg_ha", "pct_indus"):
        above = F.size(F.filter(f"e_{c}", below(c)))
        out = out.withColumn(
            f"g_{c}", F.when(F.col(c).isNotNull(), F.element_at(labels, above + 1))
        )
    return out.drop("e_kg_ha", "e_pct_indus")


GROUPINGS = {
    "formato": "formato",
    "fundo": "fundo",
    "anio": "g_anio",
    "mes": "g_mes",
    "ha": "g_ha",
    "kgha": "g_kg_ha",
    "indus": "g_pct_indus",
}


def grouped_errors(df: DataFrame, by: list[str], groupings: dict[str, str]) -> DataFrame:
    """Long rows ``(by, grouping, level, real, err)`` for all groupings at once."""
    pairs = ", ".join(f"'{k}', CAST(`{c}` AS STRING)" for k, c in groupings.items())
    return df.select(
        *by,
        F.col("kg_jr").alias("real"),
        F.abs(F.col("y_pred") * F.col("h_ef") - F.col("kg_jr")).alias("err"),
        F.expr(f"stack({len(groupings)}, {pairs}) AS (grouping, level)"),
    ).where(F.col("level").isNotNull() & F.col("err").isNotNull())


def subgroup_errors(df: DataFrame, by: list[str], groupings: dict[str, str], min_n: int = 5) -> DataFrame:
    """n, MAE, p50, p90, MAPE, ratio to the report's MAPE and its class."""
    long = grouped_errors(df, by, groupings)
    keys = by + ["grouping", "level"]
    stats = long.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg("err").alias("mae"),
        (F.avg(F.when(F.col("real") != 0, F.col("err") / F.abs("real"))) * 100).alias("mape"),
        F.sum(F.when(F.col("real") != 0, F.col("err") / F.abs("real"))).alias("_s"),
        F.count(F.when(F.col("real") != 0, 1)).alias("_c"),
    )
    # the report's own MAPE from one grouping that covers every row
    first = next(iter(groupings))
    overall = (
        stats.where(F.col("grouping") == first)
        .groupBy(*by)
        .agg((F.sum("_s") / F.sum("_c") * 100).alias("_global"))
    )
    q = quantile_rows(long, keys, "err", [0.5, 0.9])
    out = runtime.attach(stats.where(F.col("n") >= min_n), q, keys)
    out = runtime.attach(out, overall, by, check=True)
    out = out.withColumn("ratio", scalar.safe_ratio(F.col("mape"), F.col("_global")))
    r = F.col("ratio")
    level = F.when(r < 0.85, "good").when(r <= 1.15, "neutral").when(r <= 1.5, "warn")
    return out.select(
        *keys,
        "n",
        "mae",
        F.col("q")[0].alias("p50"),
        F.col("q")[1].alias("p90"),
        "mape",
        "ratio",
        F.when(r.isNull(), "neutral").otherwise(level.otherwise("bad")).alias("ratio_class"),
    )


def box_stats(df: DataFrame, by: list[str], group: str, min_n: int = 5) -> DataFrame:
    """Quartiles, mean and n of the absolute error, ordered by the median."""
    long = grouped_errors(df, by, {"g": group})
    keys = by + ["level"]
    stats = long.groupBy(*keys).agg(F.count("*").alias("n"), F.avg("err").alias("mean"))
    q = quantile_rows(long, keys, "err", [0.0, 0.25, 0.5, 0.75, 1.0])
    out = runtime.attach(stats.where(F.col("n") >= min_n), q, keys)
    names = ["low", "q1", "median", "q3", "high"]
    out = out.select(*keys, "n", "mean", *[F.col("q")[i].alias(c) for i, c in enumerate(names)])
    w = Window.partitionBy(*by).orderBy(F.col("median").desc(), "level")
    return out.withColumn("position", F.row_number().over(w))


def group_bias(
    df: DataFrame, by: list[str], group: str, min_n: int = 10, threshold: float = 5.0
) -> DataFrame:
    """Groups whose signed error exceeds ``threshold`` percent of the real mean."""
    est = F.col("y_pred") * F.col("h_ef")
    agg = df.where(F.col(group).isNotNull() & (F.col(group) != "")).groupBy(*by, group).agg(
        F.count("*").alias("n"),
        F.avg(est - F.col("kg_jr")).alias("mean_signed_bias"),
        F.avg("kg_jr").alias("_real"),
    )
    pct = F.col("mean_signed_bias") / F.col("_real") * 100
    return (
        agg.where((F.col("n") >= min_n) & (F.abs("_real") >= 1e-9))
        .withColumn("bias_pct", pct)
        .where(F.abs("bias_pct") >= threshold)
        .withColumn("direction", F.when(F.col("bias_pct") > 0, "sobreestima").otherwise("subestima"))
        .drop("_real")
    )


def recommended_actions(df: DataFrame, by: list[str], gaps: DataFrame) -> DataFrame:
    """Rule rows per report; ``gaps`` gives ``full_mape`` and ``abs_gap`` by report."""
    per = subgroup_errors(
        df, by, {"formato": "formato", "fundo": "fundo"}, min_n=roles.SUBGROUP_MIN
    ).where(F.col("ratio") >= roles.SUBGROUP_RATIO)
    sub = per.select(
        *by,
        F.lit("warning").alias("severity"),
        F.lit("subgroup_error").alias("rule"),
        F.concat_ws("=", "grouping", "level").alias("subject"),
        F.col("ratio").alias("value"),
    )
    big = gaps.where(F.col("full_mape") > roles.MAPE_CRITICAL).select(
        *by,
        F.lit("critical").alias("severity"),
        F.lit("global_error").alias("rule"),
        F.lit("").alias("subject"),
        F.col("full_mape").alias("value"),
    )
    memo = gaps.where(F.col("abs_gap") > roles.GAP_WARN).select(
        *by,
        F.lit("warning").alias("severity"),
        F.lit("train_gap").alias("rule"),
        F.lit("").alias("subject"),
        F.col("abs_gap").alias("value"),
    )
    found = big.unionByName(memo).unionByName(sub)
    calm = gaps.select(*by).join(found.select(*by).distinct(), by, "left_anti")
    none = calm.select(
        *by,
        F.lit("info").alias("severity"),
        F.lit("no_problem").alias("rule"),
        F.lit("").alias("subject"),
        F.lit(None).cast("double").alias("value"),
    )
    return found.unionByName(none)


def graded(value: Column, high: float, medium: float, rising: bool = True) -> Column:
    good, fair = (value >= high, value >= medium) if rising else (value <= high, value <= medium)
    return F.when(value.isNull(), "—").when(good, "ALTO").when(fair, "MEDIO").otherwise("BAJO")


def kpi_rows(df: DataFrame, by: list[str]) -> DataFrame:
    """Precision, explained variance and gain over predicting the mean."""
    rows = prediction_table(df)
    q = quantiles(rows, by, ["error_abs"], [0.5, 0.8])
    m = metrics(rows, by, "kg_jr", "kg_jr_estimado")
    mean = rows.groupBy(*by).agg(F.avg("kg_jr").alias("_mean"))
    base = (
        runtime.attach(rows, mean, by, check=True)
        .groupBy(*by)
        .agg(F.avg(F.abs(F.col("kg_jr") - F.col("_mean"))).alias("_base"))
    )
    out = runtime.attach(runtime.attach(m, q, by), base, by)
    gain = F.when(
        F.col("_base") > 0, (F.col("_base") - F.col("mae")) / F.col("_base") * 100
    ).otherwise(0.0)
    out = out.withColumn("mejora_pct", gain).withColumn("r2_pct", F.col("r2") * 100)
    return out.select(
        *by,
        F.col("error_abs")[0].alias("p50"),
        F.col("error_abs")[1].alias("p80"),
        "mape",
        graded(F.col("mape"), *roles.KPI_MAPE, rising=False).alias("precision"),
        "r2_pct",
        graded(F.col("r2_pct"), *roles.KPI_R2).alias("poder"),
        "mejora_pct",
        graded(F.col("mejora_pct"), *roles.KPI_GAIN).alias("mejora"),
    )


def verdict(mape: Column, gap: Column) -> Column:
    """Strictest level whose two limits both hold."""
    out = F
    for name, max_mape, max_gap in roles.VERDICT_LEVELS:
        out = out.when((mape <= max_mape) & (gap <= max_gap), name)
    return out.otherwise(roles.VERDICT_WORST)


def traffic_light_r2(v: Column) -> Column:
    return (
        F.when(v.isNull(), "—")
        .when(v >= roles.R2_TARGET, "VERDE")
        .when(v >= roles.R2_AMBER, "AMARILLO")
        .otherwise("ROJO")
    )


def traffic_light_mae(v: Column, target: float = roles.MAE_TARGET) -> Column:
    return (
        F.when(v.isNull(), "—")
        .when(v <= target, "VERDE")
        .when(v <= roles.MAE_AMBER_RATIO * target, "AMARILLO")
        .otherwise("ROJO")
    )


#: uniform numbers of 20 bits that one text hash gives
DRAWS = 6
#: rows whose draws a task holds at once, groups whose sums it holds
DRAW_ROWS, SUM_GROUPS = 500, 500
# fixed values: cumulative Poisson(1) probabilities for counts 0..8
POISSON = [0.367879441, 0.735758882, 0.919698603, 0.981011843, 0.996340153, 0.999405815, 0.999916759, 0.999989751, 0.999998875]


def replicate_sums(rows: DataFrame, by: list[str], values: list[str], key: list[str], replicates: int, seed: int) -> DataFrame:
    """``(by..., rep, n, values...)``: sums over the rows, each taken as often as a replicate draws it.

    One text hash of the key serves ``DRAWS`` replicates, so the draws are the same on
    every run and in every engine. A task turns the hashes of some rows at once into a
    table of weights, whose product with the values are the sums; only these leave it.
    """
    turns = -(-replicates // DRAWS)
    steps = (np.arange(1 << 20) + 0.5) / float(1 << 20)
    weights = sum((steps >= c).astype(float) for c in POISSON)
    kinds = to_arrow_schema(rows.select(*by).schema)
    names, most, at_once = ["n", *values], SUM_GROUPS, DRAW_ROWS

    def out(sums: dict) -> Iterator[pa.RecordBatch]:
        for group, total in sums.items():
            keys = [pa.array([v] * replicates, kinds.field(i).type) for i, v in enumerate(group)]
            arrays = [*keys, pa.array(np.arange(1, replicates + 1, dtype="int32")), *[pa.array(c) for c in total.T.copy()]]
            yield pa.RecordBatch.from_arrays(arrays, [*by, "rep", *names])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            from _md5 import md5  # the same digests, at less cost for short texts
        except ImportError:
            from hashlib import md5
        ends, sums = [f"|{h}".encode() for h in range(turns)], {}
        for batch in batches:
            for at in range(0, batch.num_rows, at_once):
                part = batch.slice(at, at_once)
                digests = []
                for text in part["_text"].to_pylist():
                    start = md5(text.encode()).copy
                    for end in ends:
                        h = start()
                        h.update(end)
                        digests.append(h.digest())
                raw = np.frombuffer(b"".join(digests), ">u8").astype("u8").reshape(-1, turns, 2)
                halves = raw[..., 0] >> 4, ((raw[..., 0] & 15) << 56) | (raw[..., 1] >> 8)
                draws = np.stack([(half >> (40 - 20 * j)) & ((1 << 20) - 1) for half in halves for j in range(DRAWS // 2)], axis=2)
                w = weights[draws.reshape(len(raw), -1)[:, :replicates]]
                v = np.column_stack([np.ones(len(raw)), *[part[c].to_numpy(zero_copy_only=False) for c in values]])
                groups = {}
                for i, group in enumerate(zip(*[part[c].to_pylist() for c in by]) if by else [()] * len(raw)):
                    groups.setdefault(group, []).append(i)
                for group, i in groups.items():
                    total = w[i].T @ v[i]
                    sums[group] = sums[group] + total if group in sums else total
            if len(sums) > most:
                yield from out(sums)
                sums = {}
        yield from out(sums)

    texts = [F.col(k).cast("string") for k in key]
    slim = rows.select(*by, *[F.col(c).cast("double").alias(c) for c in values], F.concat_ws("|", *texts, F.lit(str(seed))).alias("_text"))
    # a row costs far more here than its way to another task
    slim = slim.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in slim.select(*by).schema)
    parts = slim.mapInArrow(work, schema + "rep int, " + ", ".join(f"`{c}` double" for c in names))
    out_cols = [F.sum("n").cast("long").alias("n"), *[F.sum(c).alias(c) for c in values]]
    return parts.groupBy(*by, "rep").agg(*out_cols)


def bootstrap_sums(df: DataFrame, by: list[str], key: list[str], replicates: int, seed: int) -> DataFrame:
    """Poisson bootstrap: weighted metrics of every replicate."""
    y, p = F.col("y_true"), F.col("y_pred")
    rows = df.where(y.isNotNull() & p.isNotNull())
    e = p - y
    rows = rows.withColumns({"_abs": F.abs(e), "_sq": e * e, "_yy": y * y, "_nz": (y != 0).cast("int")})
    rows = rows.withColumn("_ape", F.when(y != 0, F.abs(e / y)).otherwise(0.0))
    values = ["y_true", "_abs", "_sq", "_yy", "_nz", "_ape"]
    reps = replicate_sums(rows, by, values, key, replicates, seed).where("n > 0")
    n = F.col("n")
    spread = F.nullif(F.col("_yy") - F.col("y_true") * F.col("y_true") / n, F.lit(0.0))
    return reps.select(
        *by,
        "rep",
        "n",
        (F.col("_abs") / n).alias("mae"),
        (F.col("_ape") / F.nullif(F.col("_nz"), F.lit(0)) * 100).alias("mape"),
        (1 - F.col("_sq") / spread).alias("r2"),
    )


def bootstrap_ci(
    df: DataFrame, by: list[str], key: list[str], replicates: int = 1000, seed: int = 42, alpha: float = 0.05
) -> DataFrame:
    """Percentile intervals of MAE, MAPE and R2 (at most ``replicates`` rows per report)."""
    reps = bootstrap_sums(df, by, key, replicates, seed)
    ps = F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2))
    names = ["mae", "mape", "r2"]
    ci = reps.groupBy(*by).agg(*[F.percentile(m, ps).alias(f"_{m}") for m in names])
    point = metrics(df, by)
    out = runtime.attach(point, ci, by)
    cols = []
    for m in names:
        cols += [F.col(m), F.col(f"_{m}")[0].alias(f"{m}_low"), F.col(f"_{m}")[1].alias(f"{m}_high")]
    return out.select(*by, "n", *cols)


def calibration(df: DataFrame, by: list[str], n_bins: int = 10, value: str = "y_true") -> DataFrame:
    """Mean prediction and mean ``value`` per quantile bin of the prediction."""
    both = df.where(F.col("y_pred").isNotNull())
    probs = [i / n_bins for i in range(n_bins + 1)]
    edges = quantiles(both, by, ["y_pred"], probs).withColumnRenamed("y_pred", "_edges")
    sizes = both.groupBy(*by).agg(F.count("*").alias("_n"))
    edges = runtime.attach(edges, sizes.where(F.col("_n") >= 2 * n_bins), by, "inner")
    edges = edges.withColumn("_edges", F.array_distinct("_edges"))
    rows = runtime.attach(both, edges, by, "inner", check=True)
    inner = F.slice("_edges", F.lit(2), F.greatest(F.size("_edges") - 2, F.lit(0)))
    rows = rows.withColumn("bin_idx", F.size(F.filter(inner, below("y_pred"))))
    out = rows.groupBy(*by, "bin_idx").agg(
        F.avg("y_pred").alias("bin_pred_mean"),
        F.avg(value).alias("bin_real_mean"),
        F.count("*").alias("bin_count"),
    )
    diff = (F.col("bin_real_mean") - F.col("bin_pred_mean")) / F.col("bin_pred_mean") * 100
    return out.withColumn("bin_diff_pct", F.when(F.col("bin_pred_mean") != 0, diff))


def error_cards(df: DataFrame, by: list[str]) -> DataFrame:
    rows = prediction_table(df)
    q = quantiles(rows, by, ["error_abs"], [0.5, 0.9, 0.99])
    m = rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg("error_abs").alias("mae"), F.avg("error_pct").alias("mape")
    )
    names = ["p50", "p90", "p99"]
    return runtime.attach(m, q, by).select(
        *by, "n", "mae", "mape", *[F.col("error_abs")[i].alias(c) for i, c in enumerate(names)]
    )


def error_over_time(df: DataFrame, by: list[str], days: int = 30, min_obs: int = 5) -> DataFrame:
    """Trailing mean of the absolute error by day, current day included."""
    daily = prediction_table(df).groupBy(*by, "fecha").agg(
        F.sum("error_abs").alias("s"), F.count("error_abs").alias("c")
    )
    w = Window.partitionBy(*by).orderBy(scalar.day_number("fecha")).rangeBetween(1 - days, 0)
    n = F.sum("c").over(w)
    return daily.select(
        *by, "fecha", n.alias("n_obs"), F.when(n >= min_obs, F.sum("s").over(w) / n).alias("error_movil")
    )


def histogram(df: DataFrame, by: list[str], value: str, bins: int = 40) -> DataFrame:
    """Equal-width counts; the last bin is closed on both sides."""
    rows = df.where(F.col(value).isNotNull())
    span = rows.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    span = span.withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    joined = runtime.attach(rows.select(*by, value), span, by, check=True)
    pos = F.floor((F.col(value) - F.col("lo")) / F.nullif(F.col("width"), F.lit(0.0)))
    bin_ = F.least(F.coalesce(pos, F.lit(0)), F.lit(bins - 1))
    return joined.groupBy(*by, bin_.alias("bin")).agg(
        F.count("*").alias("n"),
        (F.max("lo") + F.col("bin") * F.max("width")).alias("left_edge"),
        F.max("width").alias("width"),
    )


def density(df: DataFrame, by: list[str], value: str, bins: int = 40, points: int = 200) -> DataFrame:
    """Gaussian density of the binned values on an even grid.

    Works on at most ``bins`` rows per report; bandwidth sd * n^(-1/5).
    """
    h = histogram(df, by, value, bins)
    stats = df.groupBy(*by).agg(
        F.count(value).alias("total"), F.stddev_samp(value).alias("sd"),
        F.min(value).alias("lo"), F.max(value).alias("hi"),
    ).where((F.col("sd") > 0) & (F.col("total") > 30))
    per = h.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct((F.col("left_edge") + F.col("width") / 2).alias("m"), "n"))).alias("bars")
    )
    grid = runtime.attach(per, stats, by, "inner").select(
        "*", F.posexplode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i", "_g")
    )
    x = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("i") / (points - 1)
    bw = F.col("sd") * F.pow(F.col("total"), F.lit(-0.2))
    grid = grid.withColumns({"x": x, "bw": bw})
    kernel = F.aggregate(
        "bars",
        F.lit(0.0),
        lambda acc, b: acc + b["n"] * F.exp(-F.pow((F.col("x") - b["m"]) / F.col("bw"), F.lit(2)) / 2),
    )
    norm = F.col("total") * F.col("bw") * F.sqrt(F.lit(2 * 3.141592653589793))
    return grid.select(*by, "i", "x", (kernel / norm).alias("density"))


def qq_points(df: DataFrame, by: list[str], value: str, points: int = 100) -> DataFrame:
    """Sample quantiles against normal ones at a fixed grid of probabilities."""
    probs = [(i + 0.5) / points for i in range(points)]
    z = F.array(*[F.lit(NormalDist().inv_cdf(p)) for p in probs])
    q = quantiles(df, by, [value], probs)
    return q.select(*by, F.posexplode(F.arrays_zip(F.col(value).alias("sample"), z.alias("normal"))).alias("i", "s")).select(
        *by, "i", F.col("s.normal").alias("normal"), F.col("s.sample").alias("sample")
    )


def residual_trend(df: DataFrame, by: list[str], n_bins: int = 20) -> DataFrame:
    """Mean absolute residual per quantile bin of the prediction."""
    rows = df.withColumn("_abs", F.abs(F.col("y_true") - F.col("y_pred")))
    out = calibration(rows, by, n_bins, "_abs")
    return out.select(
        *by, "bin_idx", F.col("bin_pred_mean").alias("pred_mean"),
        F.col("bin_real_mean").alias("abs_resid_mean"), F.col("bin_count").alias("n"),
    )


def worst_predictions(df: DataFrame, key: list[str], n: int = 20) -> DataFrame:
    """Largest absolute errors with their context (TakeOrdered, no full sort)."""
    rows = prediction_table(df)
    up = F.col("kg_jr_estimado") > F.col("kg_jr")
    return (
        rows.withColumn("direccion", F.when(up, "sobreestima").otherwise("subestima"))
        .orderBy(F.col("error_abs").desc(), *key)
        .limit(n)
        .select(
            *key, "fecha", "fundo", "formato", F.col("kg_jr").alias("real"),
            F.col("kg_jr_estimado").alias("estimado"), "error_abs", "error_pct", "direccion",
        )
    )


def training_context(df: DataFrame, by: list[str], n_features: int) -> DataFrame:
    """Rows, month span and farm and format counts with the first five names."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.lit(n_features).alias("n_features"),
        F.date_format(F.min("fecha"), "yyyy-MM").alias("first_month"),
        F.date_format(F.max("fecha"), "yyyy-MM").alias("last_month"),
        F.count_distinct("fundo").alias("n_fundos"),
        F.count_distinct("formato").alias("n_formatos"),
        F.array_join(F.slice(F.array_sort(F.collect_set("fundo")), 1, 5), ",").alias("fundos"),
        F.array_join(F.slice(F.array_sort(F.collect_set("formato")), 1, 5), ",").alias("formatos"),
    )
