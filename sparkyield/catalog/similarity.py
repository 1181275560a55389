"""K queries and J4: the variety similarity study on the harvest view."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from sparkyield import runtime
from sparkyield.catalog.registry import query
from sparkyield.operators import similarity as sim
from sparkyield.sources import writers
from sparkyield.sources.fixtures import KEY

FEATURES = ["kg_ha", "pct_indus", "dpc", "p_baya", "kg_jr_h"]
ANCHORS = [f"Brand#{i}" for i in range(1, 6)]
IN = "(" + ", ".join(f"'{a}'" for a in ANCHORS) + ")"
LIMITS = {"conservative": 2300, "moderate": 2400, "robust": 2500}

SIZES = f"""sz AS (SELECT variedad, count(*) AS n_filas, CASE WHEN variedad IN {IN} THEN 'ancla' ELSE 'a asignar' END AS tipo,
CASE WHEN count(*) >= 2500 THEN 'robusta' WHEN count(*) >= 2400 THEN 'moderada' WHEN count(*) >= 2300 THEN 'conservadora' ELSE 'insuficiente' END AS zona FROM harvest GROUP BY 1)"""
NOT_NULL = " AND ".join(f"{f} IS NOT NULL" for f in FEATURES)
SCALED = f"""full_ AS (SELECT * FROM harvest WHERE {NOT_NULL}), st AS (SELECT {', '.join(f"median({f}) AS m_{f}, CASE WHEN quantile_cont({f}, 0.75) = quantile_cont({f}, 0.25) THEN 1 ELSE quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) END AS s_{f}" for f in FEATURES)} FROM full_),
sc AS (SELECT variedad, {', '.join(f"({f} - m_{f}) / s_{f} AS {f}" for f in FEATURES)} FROM full_, st)"""


def pairs_sql(src: str, filter_null: bool) -> str:
    long = " UNION ALL ".join(
        f"SELECT variedad, '{f}' AS variable, CAST({f} AS DOUBLE) AS value FROM {src}" + (f" WHERE {f} IS NOT NULL" if filter_null else "")
        for f in FEATURES
    )
    return f"""vl AS ({long}), vc AS (SELECT variedad, variable, value, count(*) AS n FROM vl GROUP BY ALL),
pr AS (SELECT v.variedad, a.ancla FROM (SELECT DISTINCT variedad FROM vc WHERE variedad NOT IN {IN}) v, (SELECT DISTINCT variedad AS ancla FROM vc WHERE variedad IN {IN}) a),
pc AS (SELECT variedad, ancla, variable, value, sum(c1) AS c1, sum(c2) AS c2 FROM (SELECT pr.*, variable, value, n AS c1, 0 AS c2 FROM pr JOIN vc USING (variedad) UNION ALL
 SELECT pr.*, vc.variable, vc.value, 0, vc.n FROM pr JOIN vc ON vc.variedad = pr.ancla) GROUP BY ALL)"""


WASS = f"""{SCALED}, {pairs_sql('sc', False)}, cu AS (SELECT *, sum(c1) OVER o AS f1, sum(c2) OVER o AS f2, sum(c1) OVER p AS n1, sum(c2) OVER p AS n2, lead(value) OVER o - value AS gap FROM pc
 WINDOW p AS (PARTITION BY variedad, ancla, variable), o AS (PARTITION BY variedad, ancla, variable ORDER BY value)),
wf AS (SELECT variedad, ancla, variable, sum(abs(f1 / n1 - f2 / n2) * gap) AS d FROM cu GROUP BY ALL), wd AS (SELECT variedad, ancla, avg(d) AS distancia FROM wf GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY variedad ORDER BY distancia, ancla) AS r FROM wd),
asg AS (SELECT a.variedad, n_filas, a.ancla AS ancla_asignada, ROUND(a.distancia, 4) AS distancia_wass, b.ancla AS segunda_opcion, ROUND(b.distancia, 4) AS dist_segunda
 FROM rk a JOIN rk b ON a.variedad = b.variedad AND a.r = 1 AND b.r = 2 JOIN sz ON sz.variedad = a.variedad)"""
MW = f"""{pairs_sql('harvest', True)}, mc AS (SELECT *, c1 + c2 AS t, sum(c1 + c2) OVER (PARTITION BY variedad, ancla, variable ORDER BY value) AS hi FROM pc),
mu AS (SELECT variedad, ancla, variable, CAST(sum(c1) AS BIGINT) AS n1, CAST(sum(c2) AS BIGINT) AS n2, sum(c1 * (hi - (t - 1) / 2)) - sum(c1)::DOUBLE * (sum(c1) + 1) / 2 AS u, sum(t::DOUBLE * t * t - t) AS ties FROM mc GROUP BY ALL),
mz AS (SELECT variedad, ancla, variable, n1, n2, u, (greatest(u, n1::DOUBLE * n2 - u) - n1::DOUBLE * n2 / 2 - 0.5) / sqrt(n1::DOUBLE * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2)::DOUBLE * (n1 + n2 - 1)))) AS z FROM mu),
sh AS (SELECT variedad, ancla, count(*) FILTER (abs(z) < {sim.Z_05!r}) AS n_similares, count(*) AS n_total, count(*) FILTER (abs(z) < {sim.Z_05!r}) / count(*) * 100 AS pct_similar FROM mz GROUP BY ALL)"""
#: the same steps under other names, for use next to WASS
MW2 = re.sub(r"\b(vl|vc|pr|pc)\b", r"\g<1>2", MW)
LAB = f"lb AS (SELECT variedad, ancla_asignada AS entrena_con FROM asg UNION ALL SELECT variedad, variedad FROM sz WHERE variedad IN {IN})"


class Study:
    """The steps of the study on one input, each built once."""

    def __init__(self, df, keep=()):
        self.df = df
        self.sizes = sim.variety_sizes(df, ANCHORS, LIMITS)
        if keep is None:  # the tests work on the plain values
            return
        # one pass over the rows gives both the scale and the counts of scaled values
        self.counts = runtime.materialize(sim.feature_counts(sim.complete_rows(df, FEATURES, []), FEATURES))
        self.scale = sim.fit_pooled_scale(self.counts, FEATURES)
        self.scaled = sim.scaled_features(df, FEATURES, list(keep), self.scale)

    def distances(self):
        counts = runtime.materialize(sim.scaled_counts(self.counts, self.scale, FEATURES))
        return runtime.materialize(sim.wasserstein(sim.pair_counts(counts, ANCHORS)))

    def tests(self):
        counts = runtime.materialize(sim.feature_counts(self.df, FEATURES))
        return sim.mann_whitney(sim.pair_counts(counts, ANCHORS))

    def assigned(self, distances):
        return sim.assignment(distances, self.sizes)

    def result(self, distances):
        return sim.final_result(self.assigned(distances), sim.similarity_share(self.tests()), self.sizes, ANCHORS)

    def labels(self, distances):
        own = self.sizes.where(F.col("variedad").isin(ANCHORS)).select("variedad", F.col("variedad").alias("entrena_con"))
        return self.assigned(distances).select("variedad", F.col("ancla_asignada").alias("entrena_con")).unionByName(own)

    def centroids(self, distances):
        return runtime.materialize(sim.centroids(self.scaled, FEATURES, self.labels(distances)))


@query("K1", "harvest", f"{SIZES} SELECT * FROM sz")
def sizes(df):
    return sim.variety_sizes(df, ANCHORS, LIMITS)


@query("K2", "harvest", f"{SIZES}, {WASS} SELECT variedad, ancla, round(distancia, 6) AS distancia FROM wd")
def distances(df):
    return Study(df).distances()


@query("K3", "harvest", f"{SIZES}, {WASS} SELECT * FROM asg")
def assigned(df):
    s = Study(df)
    return s.assigned(s.distances())


@query("J4", "harvest", f"{SIZES}, {WASS} SELECT variedad, ancla_asignada, segunda_opcion FROM asg")
def nearest(df):
    return sim.nearest_anchors(Study(df).distances()).select("variedad", "ancla_asignada", "segunda_opcion")


@query("K4", "harvest", f"{MW} SELECT variedad, ancla, variable, n1, n2, round(u, 1) AS u, round(z, 6) AS z FROM mz")
def mann_whitney(df):
    from sparkyield.functions.scalar import cut

    return Study(df, None).tests().withColumn("u", cut("u", 1))


@query("K4_share", "harvest", f"{MW} SELECT variedad, ancla, n_similares, n_total, round(pct_similar, 6) AS pct_similar, pct_similar >= 60 AS ok FROM sh")
def share(df):
    return sim.similarity_share(Study(df, None).tests())


@query("K5", "harvest", f"""{SIZES}, {WASS}, o AS (SELECT ancla_asignada AS ancla, sum(n_filas) AS f, count(*) AS k FROM asg GROUP BY 1)
SELECT variedad AS ancla, n_filas AS filas_propias, CAST(coalesce(f, 0) AS BIGINT) AS filas_asignadas, coalesce(k, 0) AS n_asignadas, CAST(n_filas + coalesce(f, 0) AS BIGINT) AS total FROM sz LEFT JOIN o ON sz.variedad = o.ancla WHERE variedad IN {IN}""")
def summary(df):
    s = Study(df)
    return sim.group_summary(s.assigned(s.distances()), s.sizes, ANCHORS)


@query("K6", "harvest", f"""{SIZES}, {WASS}, {MW2}
SELECT variedad, n_filas, zona, variedad AS entrena_con, 0.0::DOUBLE AS distancia_wass, 'zona ' || zona AS nota FROM sz WHERE variedad IN {IN} UNION ALL
SELECT a.variedad, n_filas, 'agrupar', ancla_asignada, distancia_wass, printf('Vecino más cercano: %s (dist=%.3f, similitud=%.0f%%)', ancla_asignada, distancia_wass, coalesce(pct_similar, 0)) FROM asg a LEFT JOIN sh ON sh.variedad = a.variedad AND sh.ancla = a.ancla_asignada""")
def result(df):
    s = Study(df)
    return s.result(s.distances())


CENT = f"ce AS (SELECT variedad, entrena_con, {', '.join(f'avg({f}) AS {f}' for f in FEATURES)} FROM sc JOIN lb USING (variedad) GROUP BY 1, 2)"


@query("K7", "harvest", f"{SIZES}, {WASS}, {LAB}, {CENT} SELECT variedad, entrena_con, {', '.join(f'round({f}, 6) AS {f}' for f in FEATURES)} FROM ce")
def centroids(df):
    s = Study(df)
    return s.centroids(s.distances())


DIST = " + ".join(f"pow(x.{f} - y.{f}, 2)" for f in FEATURES)


@query("K8", "harvest", f"""{SIZES}, {WASS}, {LAB}, {CENT}, mu AS (SELECT * FROM ce WHERE entrena_con IN (SELECT entrena_con FROM ce GROUP BY 1 HAVING count(*) > 1)),
g AS (SELECT x.variedad, x.entrena_con, y.entrena_con AS g, avg(sqrt({DIST})) AS d FROM mu x JOIN mu y ON x.variedad <> y.variedad GROUP BY ALL),
ab AS (SELECT variedad, entrena_con, max(d) FILTER (g = entrena_con) AS a, min(d) FILTER (g <> entrena_con) AS b FROM g GROUP BY ALL), s AS (SELECT entrena_con, (b - a) / greatest(a, b) AS s FROM ab WHERE b IS NOT NULL)
SELECT entrena_con AS grupo, round(avg(s), 6) AS score, avg(s) > 0.25 AS passed FROM s GROUP BY 1 UNION ALL SELECT 'ALL', round(avg(s), 6), avg(s) > 0.25 FROM s HAVING count(*) > 0""")
def silhouette(df):
    s = Study(df)
    return sim.group_silhouette(sim.silhouette(s.centroids(s.distances()), FEATURES))


@query("K9", "harvest")
def row_silhouette(df):
    from sparkyield.plans.training import row_silhouette

    s = Study(df)
    return row_silhouette(s.scaled, FEATURES, s.labels(s.distances()))


@query("K10", "harvest", f"""{SIZES}, {WASS}, q AS (SELECT avg(distancia) FILTER (ancla = ancla_asignada) AS a, avg(distancia) FILTER (ancla <> ancla_asignada) AS b FROM wd JOIN asg USING (variedad))
SELECT round(a, 6) AS mean_intra, round(b, 6) AS mean_inter, round(a / b, 6) AS ratio, CASE WHEN a / b < 0.5 THEN 'Excelente' WHEN a / b < 0.8 THEN 'Bueno' WHEN a / b < 1 THEN 'Aceptable' ELSE 'Malo' END AS quality, a / b < 1 AS passed FROM q""")
def ratio(df):
    s = Study(df)
    d = s.distances()
    return sim.intra_inter(d, s.assigned(d))


KR = " UNION ALL ".join(f"SELECT entrena_con, '{f}' AS variable, CAST({f} AS DOUBLE) AS value FROM harvest JOIN lb USING (variedad) WHERE {f} IS NOT NULL" for f in FEATURES)


@query("K11", "harvest", f"""{SIZES}, {WASS}, {LAB}, kl AS ({KR}), kk AS (SELECT *, rank() OVER (PARTITION BY variable ORDER BY value) + (count(*) OVER (PARTITION BY variable, value) - 1) / 2 AS r FROM kl),
ti AS (SELECT variable, sum(t * t * t - t) AS ties, sum(t) AS n FROM (SELECT variable, value, count(*)::DOUBLE AS t FROM kl GROUP BY 1, 2) GROUP BY 1),
gr AS (SELECT variable, entrena_con, sum(r) AS r, count(*) AS n FROM kk GROUP BY 1, 2), s AS (SELECT variable, count(*) - 1 AS dof, sum(r * r / n) AS s FROM gr GROUP BY 1)
SELECT variable, dof, round((12 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - ties / (n * n * n - n)), 5) AS statistic FROM s JOIN ti USING (variable)""", digits=5)
def kruskal(df):
    s = Study(df)
    return sim.kruskal(df, FEATURES, s.labels(s.distances()))


@query("K12", "harvest")
def permanova(df):
    s = Study(df)
    return sim.permanova(s.centroids(s.distances()), FEATURES)


@query("K13", "harvest")
def k_sweep(df):
    from sparkyield.plans.training import k_sweep

    return k_sweep(Study(df).scaled, FEATURES, range(3, 16), current=len(ANCHORS))


REPLICATES = 100


def _stability(df):
    s = Study(df, KEY)
    d = s.distances()
    return s, d, sim.bootstrap_stability(s.scaled, KEY, FEATURES, ANCHORS, s.assigned(d), REPLICATES)


@query("K14", "harvest")
def stability(df):
    return _stability(df)[2]


@query("K15", "harvest")
def chance(df):
    return sim.chance_test(_stability(df)[2], len(ANCHORS), REPLICATES)


@query("K15_holm", "harvest", f"""{MW}, pz AS (SELECT *, exp(-abs(z)) AS p FROM mz), ho AS (SELECT *, least(1.0, p * (count(*) OVER (PARTITION BY variedad, ancla) - row_number() OVER (PARTITION BY variedad, ancla ORDER BY p, variable) + 1)) AS step FROM pz),
hh AS (SELECT variedad, ancla, variable, max(step) OVER (PARTITION BY variedad, ancla ORDER BY p, variable ROWS UNBOUNDED PRECEDING) AS q FROM ho) SELECT variedad, ancla, variable, round(q, 6) AS p_holm, q <= 0.05 AS rejects FROM hh""")
def holm(df):
    t = Study(df, None).tests().withColumn("p", F.exp(-F.abs("z")))
    return sim.holm(t, ["variedad", "ancla"], "p", ["variable"]).select("variedad", "ancla", "variable", "p_holm", "rejects")


@query("K16", "harvest")
def holm_share(df):
    s = Study(df)
    return sim.holm_similarity(s.tests(), s.assigned(s.distances()))


@query("K17", "harvest")
def decisions(df):
    s, d, stab = _stability(df)
    a = s.assigned(d)
    return sim.decisions(
        s.result(d), sim.similarity_share(s.tests()), sim.chance_test(stab, len(ANCHORS), REPLICATES), sim.holm_similarity(s.tests(), a)
    )


@query("K18", "harvest")
def verdict(df):
    s = Study(df)
    d = s.distances()
    c = s.centroids(d)
    h = sim.kruskal_with_p(sim.kruskal(df, FEATURES, s.labels(d)))
    return sim.overall_verdict(
        [
            ("silhouette", sim.group_silhouette(sim.silhouette(c, FEATURES)).where("grupo = 'ALL'")),
            ("intra_inter", sim.intra_inter(d, s.assigned(d))),
            ("kruskal", h.agg((F.sum((F.col("p_value") < 0.05).cast("int")) >= 3).alias("passed"))),
            ("permanova", sim.permanova(c, FEATURES)),
        ]
    )


@query("S11", "harvest", f"{SIZES}, {WASS} SELECT variedad, ancla_asignada AS entrena_con FROM asg UNION ALL SELECT variedad, variedad FROM sz WHERE variedad IN {IN}")
def export(df):
    s = Study(df)
    spark = df.sparkSession
    path = f"{runtime.shared_dir(spark)}/mapping-{uuid.uuid4().hex}"
    writers.export_mapping(s.result(s.distances()), path)
    return spark.read.schema("variedad string, entrena_con string").option("header", True).csv(f"{path}/mapping")
