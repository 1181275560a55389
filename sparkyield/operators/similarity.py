"""Which variety can train with which anchor variety.

Rows are reduced to value counts per (variety, feature). Pairs are variety x anchor,
both bounded by the number of varieties; one pass over a feature's values serves all
pairs, so no value is copied for a pair.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkyield import runtime
from sparkyield.functions.distributions import binomial_p, chi2_p, normal_two_sided
from sparkyield.functions.quantiles import long_form, quantile_rows, quantiles
from sparkyield.functions.sweep import area_between, pairs_won, rank_sums, replicate_areas, sweep, weighted_counts
from sparkyield.operators.clean import apply_scale, scale_of
from sparkyield.operators.evaluate import POISSON

#: share of the rows left after split, nested folds and outlier removal
REDUCTION = (1 - 0.2) * (4 / 5) * (4 / 5) * (1 - 0.02)
THRESHOLDS = {
    "conservative": math.ceil(20 * 2 / REDUCTION),
    "moderate": math.ceil(10 * 8 / REDUCTION),
    "robust": math.ceil(20 * 16 / REDUCTION),
}
GROUPED = "agrupar"


def viability(n: Column, thresholds: dict[str, int] | None = None) -> Column:
    t = thresholds or THRESHOLDS
    return (
        F.when(n >= t["robust"], "robusta")
        .when(n >= t["moderate"], "moderada")
        .when(n >= t["conservative"], "conservadora")
        .otherwise("insuficiente")
    )


def variety_sizes(df: DataFrame, anchors: list[str], thresholds: dict[str, int] | None = None) -> DataFrame:
    sizes = df.groupBy("variedad").agg(F.count("*").alias("n_filas"))
    return sizes.withColumns(
        {
            "tipo": F.when(F.col("variedad").isin(anchors), "ancla").otherwise("a asignar"),
            "zona": viability(F.col("n_filas"), thresholds),
        }
    )


def complete_rows(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    return df.select("variedad", *keep, *features).dropna(subset=features)


def fit_pooled_scale(counts: DataFrame, features: list[str]) -> DataFrame:
    """One robust scale over all varieties, a row with ``_all`` = 0, from the value counts."""
    q = quantile_rows(counts, ["variable"], "value", [0.25, 0.5, 0.75], weight="n")
    wide = q.groupBy(F.lit(0).alias("_all")).agg(*[F.max(F.when(F.col("variable") == f, F.col("q"))).alias(f) for f in features])
    return runtime.materialize(scale_of(wide, features, ["_all"]))


def scaled_counts(counts: DataFrame, scale: DataFrame, features: list[str]) -> DataFrame:
    """Value counts on the pooled scale."""
    pick = lambda part: F.coalesce(*[F.when(F.col("variable") == f, F.col(f"{f}__{part}")) for f in features])
    rows = runtime.attach(counts.withColumn("_all", F.lit(0)), scale, ["_all"], check=True)
    return rows.withColumn("value", (F.col("value") - pick("center")) / pick("scale")).select(counts.columns)


def scaled_features(df: DataFrame, features: list[str], keep: list[str], scale: DataFrame | None = None) -> DataFrame:
    """Complete rows on one robust scale over all varieties."""
    rows = complete_rows(df, features, keep)
    scale = fit_pooled_scale(runtime.materialize(feature_counts(rows, features)), features) if scale is None else scale
    return apply_scale(rows.withColumn("_all", F.lit(0)), scale, features, ["_all"]).drop("_all")


def feature_counts(df: DataFrame, features: list[str], by: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """Value counts per variety and feature."""
    keep = [*(by or []), "variedad", *([weight] if weight else [])]
    long = long_form(df, keep, features)
    n = F.sum(weight) if weight else F.count("*")
    return long.groupBy(*(by or []), "variedad", "variable", "value").agg(n.alias("n"))


@dataclass
class Pairs:
    """Every (variety, anchor) pair over one table of counts, which holds each side once."""

    counts: DataFrame
    left: list[str]
    anchors: list[str]
    by: list[str]

    @property
    def names(self) -> list[str]:
        return sorted({*self.left, *self.anchors}) or [""]

    def codes(self, names: list[str]) -> list[int]:
        return [self.names.index(x) for x in names]

    def read(self, work, limit: int | None = None) -> DataFrame:
        """Sums ``x`` and ``y`` of ``work`` with size and ends of both sides, per pair and feature."""
        series = [*self.by, "variable"]
        names = F.array(*[F.lit(x) for x in self.names])
        sums, totals = sweep(self.counts, series, self.names, work(self.codes(self.left), self.codes(self.anchors)), limit)
        side = lambda g, i: totals.select(
            *series, F.col("_g").alias(g), *[F.col(c).alias(f"{c}{i}") for c in ("n", "lo", "hi")]
        )
        out = sums.join(side("_l", 1), [*series, "_l"]).join(side("_a", 2), [*series, "_a"]).where("_l <> _a")
        return out.withColumns({"variedad": names[F.col("_l")], "ancla": names[F.col("_a")]}).drop("_l", "_a")


def pair_counts(counts: DataFrame, anchors: list[str], by: list[str] | None = None, others: Column | None = None) -> Pairs:
    """The pairs of every other variety with every anchor; no row is copied for a pair."""
    if not getattr(counts, "_is_stored", False):
        counts = runtime.materialize(counts)
    left = counts.where(~F.col("variedad").isin(anchors) if others is None else others)
    names = [r[0] for r in left.select("variedad").distinct().collect()]  # variety names only
    return Pairs(counts, sorted(names), list(dict.fromkeys(anchors)), by or [])


def wasserstein(pairs: Pairs, by: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Mean Wasserstein-1 distance over the features, per pair."""
    # a feature with one value on both sides has no distance
    rows = pairs.read(area_between, limit).where("least(lo1, lo2) < greatest(hi1, hi2)")
    return rows.groupBy(*(by or pairs.by), "variedad", "ancla").agg(F.avg("x").alias("distancia"))


def replicate_distances(pairs: Pairs, replicates: int, limit: int | None = None) -> DataFrame:
    """What :func:`wasserstein` gives by ``rep``, from counts with a vector over the replicates."""
    codes, names = pairs.codes, F.array(*[F.lit(x) for x in pairs.names])
    sums, totals = replicate_areas(pairs.counts, pairs.names, codes(pairs.left), [codes([a])[0] for a in pairs.anchors], replicates, limit)
    side = lambda g, i: totals.select("variable", "rep", F.col("_g").alias(g), *[F.col(c).alias(f"{c}{i}") for c in ("lo", "hi")])
    rows = sums.join(side("_l", 1), ["variable", "rep", "_l"]).join(side("_a", 2), ["variable", "rep", "_a"])
    rows = rows.where("least(lo1, lo2) < greatest(hi1, hi2)")
    rows = rows.withColumns({"variedad": names[F.col("_l")], "ancla": names[F.col("_a")]})
    return rows.groupBy("rep", "variedad", "ancla").agg(F.avg("x").alias("distancia"))


def nearest_anchors(distances: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Nearest anchor and runner-up."""
    by = by or []
    w = Window.partitionBy(*by, "variedad").orderBy("distancia", "ancla")
    top = distances.withColumn("r", F.row_number().over(w)).where("r <= 2")
    pick = lambda r, c: F.max(F.when(F.col("r") == r, F.col(c)))
    return top.groupBy(*by, "variedad").agg(
        pick(1, "ancla").alias("ancla_asignada"), pick(1, "distancia").alias("distancia_wass"),
        F.coalesce(pick(2, "ancla"), F.lit("-")).alias("segunda_opcion"), pick(2, "distancia").alias("dist_segunda"),
    )


def assignment(distances: DataFrame, sizes: DataFrame) -> DataFrame:
    out = runtime.attach(nearest_anchors(distances), sizes.select("variedad", "n_filas"), ["variedad"])
    return out.withColumns({c: F.round(c, 4) for c in ("distancia_wass", "dist_segunda")})


def mann_whitney(pairs: Pairs, limit: int | None = None) -> DataFrame:
    """U, tie-corrected z with continuity and asymptotic p, per pair and feature."""
    agg = pairs.read(pairs_won, limit).where("n1 >= 3 AND n2 >= 3")
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    out = agg.withColumns({"u": F.col("x"), "ties": F.col("y") - n})
    sd = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    top = F.greatest(F.col("u"), n1 * n2 - F.col("u"))
    out = out.withColumn("z", (top - n1 * n2 / 2 - 0.5) / F.nullif(sd, F.lit(0.0)))
    return out.select(*pairs.by, "variedad", "ancla", "variable", "n1", "n2", "u", "z")


def with_p(tests: DataFrame) -> DataFrame:
    return tests.withColumn("p_value", F.coalesce(normal_two_sided(F.col("z")), F.lit(1.0)))


#: |z| at which the two-sided p-value is 0.05
Z_05 = 1.959963984540054


def similarity_share(tests: DataFrame, min_pct: float = 60.0) -> DataFrame:
    """Share of features whose difference is not significant."""
    similar = F.coalesce(F.abs("z") < Z_05, F.lit(True))
    agg = tests.groupBy("variedad", "ancla").agg(
        F.sum(similar.cast("long")).alias("n_similares"), F.count("*").alias("n_total")
    )
    pct = F.col("n_similares") / F.col("n_total") * 100
    return agg.withColumn("pct_similar", pct).withColumn("ok", F.col("pct_similar") >= min_pct)


def group_summary(assigned: DataFrame, sizes: DataFrame, anchors: list[str]) -> DataFrame:
    own = sizes.where(F.col("variedad").isin(anchors)).select(
        F.col("variedad").alias("ancla"), F.col("n_filas").alias("filas_propias")
    )
    other = assigned.groupBy(F.col("ancla_asignada").alias("ancla")).agg(
        F.sum("n_filas").alias("filas_asignadas"), F.count("*").alias("n_asignadas")
    )
    out = own.join(other, "ancla", "left").fillna(0, ["filas_asignadas", "n_asignadas"])
    return out.withColumn("total", F.col("filas_propias") + F.col("filas_asignadas"))


def final_result(assigned: DataFrame, share: DataFrame, sizes: DataFrame, anchors: list[str]) -> DataFrame:
    """Anchors with their zone, then assigned varieties with the reason."""
    own = sizes.where(F.col("variedad").isin(anchors)).select(
        "variedad", "n_filas", "zona", F.col("variedad").alias("entrena_con"), F.lit(0.0).alias("distancia_wass"),
        F.concat(F.lit("zona "), "zona").alias("nota"),
    )
    s = share.select("variedad", F.col("ancla").alias("ancla_asignada"), "pct_similar")
    rows = runtime.attach(assigned, s, ["variedad", "ancla_asignada"])
    note = F.format_string(
        "Vecino más cercano: %s (dist=%.3f, similitud=%.0f%%)", "ancla_asignada", "distancia_wass",
        F.coalesce("pct_similar", F.lit(0.0)),
    )
    moved = rows.select(
        "variedad", "n_filas", F.lit(GROUPED).alias("zona"), F.col("ancla_asignada").alias("entrena_con"), "distancia_wass",
        note.alias("nota"),
    )
    return own.unionByName(moved)


def centroids(scaled: DataFrame, features: list[str], labels: DataFrame) -> DataFrame:
    """Mean per variety with its group ``entrena_con``."""
    means = scaled.groupBy("variedad").agg(*[F.avg(f).alias(f) for f in features])
    out = runtime.attach(means, labels.select("variedad", "entrena_con"), ["variedad"])
    return out.withColumn("entrena_con", F.coalesce("entrena_con", "variedad"))


def _distance(features: list[str]) -> Column:
    return F.sqrt(sum((F.pow(F.col(f) - F.col(f"o_{f}"), F.lit(2)) for f in features), F.lit(0.0)))


def silhouette(cents: DataFrame, features: list[str]) -> DataFrame:
    """Silhouette of each variety among groups of at least two.

    Compares centroids, one row per variety; the other centroids travel as one
    array per row, bounded by the number of varieties.
    """
    sized = cents.withColumn("_k", F.count("*").over(Window.partitionBy("entrena_con"))).where("_k > 1")
    fields = [F.col("variedad").alias("v"), F.col("entrena_con").alias("g"), *[F.col(f).alias(f"o_{f}") for f in features]]
    everyone = sized.groupBy(F.lit(1).alias("_j")).agg(F.collect_list(F.struct(*fields)).alias("_o"))
    rows = sized.withColumn("_j", F.lit(1)).join(F.broadcast(everyone), "_j").select(
        "variedad", "entrena_con", *features, F.inline("_o")
    )
    rows = rows.where(F.col("v") != F.col("variedad")).withColumn("d", _distance(features))
    per = rows.groupBy("variedad", "entrena_con", "g").agg(F.avg("d").alias("d"))
    own = F.max(F.when(F.col("g") == F.col("entrena_con"), F.col("d")))
    other = F.min(F.when(F.col("g") != F.col("entrena_con"), F.col("d")))
    out = per.groupBy("variedad", "entrena_con").agg(own.alias("a"), other.alias("b"))
    return out.where("b IS NOT NULL").withColumn(
        "silhouette", (F.col("b") - F.col("a")) / F.greatest("a", "b")
    )


def group_silhouette(samples: DataFrame) -> DataFrame:
    """Mean per group and, under the name ALL, overall with the pass mark 0.25."""
    rows = samples.select(F.explode(F.array("entrena_con", F.lit("ALL"))).alias("grupo"), "silhouette")
    return rows.groupBy("grupo").agg(F.avg("silhouette").alias("score")).withColumn("passed", F.col("score") > 0.25)


def intra_inter(distances: DataFrame, assigned: DataFrame) -> DataFrame:
    """Mean distance to the own anchor over the mean distance to the others."""
    rows = runtime.attach(distances, assigned.select("variedad", "ancla_asignada"), ["variedad"], "inner")
    own = F.col("ancla") == F.col("ancla_asignada")
    d = F.col("distancia")
    out = rows.agg(F.avg(F.when(own, d)).alias("mean_intra"), F.avg(F.when(~own, d)).alias("mean_inter"))
    out = out.withColumn("ratio", F.col("mean_intra") / F.col("mean_inter"))
    r = F.col("ratio")
    q = F.when(r < 0.5, "Excelente").when(r < 0.8, "Bueno").when(r < 1.0, "Aceptable").otherwise("Malo")
    return out.withColumns({"quality": q, "passed": r < 1.0})


def kruskal(df: DataFrame, features: list[str], labels: DataFrame, limit: int | None = None) -> DataFrame:
    """Tie-corrected H between groups per feature, from value counts."""
    rows = runtime.attach(df, labels.select("variedad", "entrena_con"), ["variedad"], "inner", check=True)
    rows = rows.withColumn("variedad", F.coalesce("entrena_con", F.lit("\0")))  # no label is a group too
    counts = runtime.materialize(feature_counts(rows, features))
    names = sorted(r[0] for r in counts.select("variedad").distinct().collect())  # group names only
    sums, totals = sweep(counts, ["variable"], names, rank_sums(len(names), 3), limit)
    per = sums.join(totals.where("n >= 3").withColumnRenamed("_g", "_l"), ["variable", "_l"])
    out = per.groupBy("variable").agg(
        F.sum(F.col("x") * F.col("x") / F.col("n")).alias("s"), F.count("*").alias("k"),
        F.max("y").alias("ties"), F.sum(F.col("n").cast("double")).alias("n_all"),
    ).where("k >= 2")
    n = F.col("n_all")
    h = (12 / (n * (n + 1)) * F.col("s") - 3 * (n + 1)) / (1 - F.col("ties") / (n * n * n - n))
    return out.select("variable", (F.col("k") - 1).alias("dof"), h.alias("statistic"))


def kruskal_with_p(table: DataFrame) -> DataFrame:
    return table.withColumn("p_value", chi2_p(F.col("statistic"), F.col("dof").cast("double")))


def permanova(cents: DataFrame, features: list[str], permutations: int = 999, seed: int = 42) -> DataFrame:
    """Permutation test of the centroids' groups; permutation 0 is the observed one.

    Works on centroids (one row per variety) times permutations. Labels are
    shuffled by giving the k-th variety in hash order the k-th label.
    """
    place = Window.partitionBy(F.lit(0)).orderBy("variedad")
    base = cents.withColumn("_i", F.row_number().over(place))  # one row per variety
    perms = F.explode(F.sequence(F.lit(0), F.lit(permutations))).alias("perm")
    pts = base.select("variedad", "_i", *features, perms)
    h = F.xxhash64(F.lit(seed), "perm", "variedad")
    w = Window.partitionBy("perm").orderBy(h, "variedad")
    slot = F.when(F.col("perm") == 0, F.col("_i")).otherwise(F.row_number().over(w))
    pts = pts.withColumn("_slot", slot)
    labs = base.select(F.col("_i").alias("_slot"), "entrena_con")
    rows = pts.join(runtime.small(labs), "_slot")
    ss = lambda f: F.var_pop(f) * F.count("*")
    within = rows.groupBy("perm", "entrena_con").agg(sum((ss(f) for f in features), F.lit(0.0)).alias("w"))
    within = within.groupBy("perm").agg(F.sum("w").alias("ssw"), F.count("*").alias("k"))
    total = rows.groupBy("perm").agg(sum((ss(f) for f in features), F.lit(0.0)).alias("sst"), F.count("*").alias("n"))
    f = within.join(total, "perm").withColumn(
        "f",
        (F.col("sst") - F.col("ssw")) / F.greatest(F.col("k") - 1, F.lit(1))
        / (F.col("ssw") / F.greatest(F.col("n") - F.col("k"), F.lit(1))),
    )
    observed = F.max(F.when(F.col("perm") == 0, F.col("f"))).over(Window.partitionBy(F.lit(0)))
    f = f.withColumn("f_obs", observed)  # one row per permutation
    beats = F.sum(F.when((F.col("perm") > 0) & (F.col("f") >= F.col("f_obs")), 1).otherwise(0))
    out = f.agg(
        F.max("f_obs").alias("f_obs"),
        ((beats + 1) / (permutations + 1)).alias("p_value"),
        F.max(F.when(F.col("perm") == 0, (F.col("sst") - F.col("ssw")) / F.col("sst"))).alias("r2"),
    )
    return out.withColumn("passed", F.col("p_value") < 0.05)


def bootstrap_stability(
    scaled: DataFrame, key: list[str], features: list[str], anchors: list[str], assigned: DataFrame, replicates: int = 100, seed: int = 42
) -> DataFrame:
    """Share of bootstrap replicates that repeat the assignment, and the top alternative."""
    draw = lambda rep: F.pmod(F.xxhash64(F.lit(seed), rep, *key), F.lit(1 << 30)).cast("int")
    draws = F.transform(F.sequence(F.lit(1), F.lit(replicates)), draw)
    is_anchor = F.col("variedad").isin(anchors)
    rows = scaled.where(~is_anchor).select("variedad", *features, draws.alias("draws"))
    fixed = feature_counts(scaled.where(is_anchor), features)  # anchors are not resampled
    counts = weighted_counts(rows, features, replicates, 1 << 30, POISSON).unionByName(fixed, allowMissingColumns=True)
    near = nearest_anchors(replicate_distances(pair_counts(runtime.materialize(counts), anchors), replicates), ["rep"])
    votes = near.groupBy("variedad", F.col("ancla_asignada").alias("ancla")).agg(F.count("*").alias("v"))
    rows = runtime.attach(votes, assigned.select("variedad", "ancla_asignada"), ["variedad"])
    own = F.col("ancla") == F.col("ancla_asignada")
    alt = F.max(F.when(~own, F.struct("v", "ancla")))
    return rows.groupBy("variedad").agg(
        F.first("ancla_asignada").alias("ancla_asignada"),
        (F.coalesce(F.sum(F.when(own, F.col("v"))), F.lit(0)) / replicates).alias("estabilidad"),
        F.coalesce(alt["ancla"], F.lit("-")).alias("alternativa"),
        F.coalesce(alt["v"] / replicates, F.lit(0.0)).alias("alternativa_share"),
    )


def holm(tests: DataFrame, by: list[str], p: str, tie: list[str], alpha: float = 0.05) -> DataFrame:
    """Holm step-down within ``by``: adjusted p-values and rejections."""
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # one row per test
    w = part.orderBy(p, *tie)
    m = F.count("*").over(part)
    step = F.least(F.lit(1.0), F.col(p) * (m - F.row_number().over(w) + 1))
    out = tests.withColumn("_step", step)
    adj = F.max("_step").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn("p_holm", adj).withColumn("rejects", F.col("p_holm") <= alpha).drop("_step")


def chance_test(stability: DataFrame, n_anchors: int, replicates: int) -> DataFrame:
    """Binomial tail of the stability against picking anchors at random, Holm-adjusted."""
    k = F.round(F.col("estabilidad") * replicates).cast("double")
    p = binomial_p(k, F.lit(float(replicates)), F.lit(1.0 / n_anchors))
    return holm(stability.withColumn("p_value", p), [], "p_value", ["variedad"])


def holm_similarity(tests: DataFrame, assigned: DataFrame, percentile: float = 90.0) -> DataFrame:
    """Similar share after Holm over all pairs, against the p90 of non-assigned pairs."""
    adj = holm(with_p(tests), ["variedad", "ancla"], "p_value", ["variable"])
    share = adj.groupBy("variedad", "ancla").agg((F.avg((~F.col("rejects")).cast("double")) * 100).alias("pct_holm"))
    rows = runtime.attach(share, assigned.select("variedad", "ancla_asignada"), ["variedad"], "inner")
    other = rows.where("ancla <> ancla_asignada").withColumn("_all", F.lit(0))
    cut = quantiles(other, ["_all"], ["pct_holm"], [percentile / 100]).select("_all", F.col("pct_holm")[0].alias("umbral"))
    own = rows.where("ancla = ancla_asignada").withColumn("_all", F.lit(0))
    out = runtime.attach(own, cut, ["_all"]).drop("_all", "ancla")
    return out.withColumn("supera_umbral", F.col("pct_holm") >= F.col("umbral"))


def decisions(
    result: DataFrame, share: DataFrame, stability: DataFrame, reinforced: DataFrame
) -> DataFrame:
    """Raw label from the plain tests, reinforced one from stability and Holm."""
    plain = share.select("variedad", F.col("ancla").alias("entrena_con"), "pct_similar")
    out = runtime.attach(result.select("variedad", "entrena_con", "n_filas"), plain, ["variedad", "entrena_con"])
    chance = stability.select("variedad", "estabilidad", "rejects")
    out = runtime.attach(out, chance, ["variedad"])
    out = runtime.attach(out, reinforced.select("variedad", "pct_holm", "umbral"), ["variedad"])
    own, few = F.col("variedad") == F.col("entrena_con"), F.col("n_filas") < 3
    pct = F.coalesce("pct_similar", F.lit(0.0))
    raw = (
        F.when(own, "ancla").when(few, "insuficiente")
        .when(pct >= 80, "excelente").when(pct >= 60, "aceptable").otherwise("revisar")
    )
    stable, adj = F.coalesce("estabilidad", F.lit(0.0)) * 100, F.coalesce("pct_holm", F.lit(0.0))
    high = F.coalesce("umbral", F.lit(60.0))
    relaxed = F.greatest(high * 0.66, F.lit(1.0))
    strong = (
        F.when(own, "ancla").when(few, "insuficiente")
        .when((stable >= 90) & (adj >= high) & F.coalesce("rejects", F.lit(False)), "robusto")
        .when((stable >= 70) & (adj >= relaxed), "aceptable")
        .when(stable >= 50, "revisar").otherwise("fragil")
    )
    return out.withColumns({"decision": raw, "decision_reforzada": strong}).drop("rejects")


def overall_verdict(passed: list[tuple[str, DataFrame]]) -> DataFrame:
    """Tests passed: at least 3 solid, 2 partial. Each table has one row with ``passed``."""
    rows = None
    for name, t in passed:
        one = t.select(F.lit(name).alias("test"), F.coalesce("passed", F.lit(False)).alias("passed"))
        rows = one if rows is None else rows.unionByName(one)
    out = rows.agg(F.sum(F.col("passed").cast("long")).alias("n_passed"), F.count("*").alias("n_tests"))
    n = F.col("n_passed")
    return out.withColumn("verdict", F.when(n >= 3, "solido").when(n >= 2, "parcial").otherwise("revisar"))
