"""D13 to D24: time-series tests, drift and variance tests per variety."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkyield import roles
from sparkyield.catalog.registry import query
from sparkyield.operators import drift, regression, series
from sparkyield.sources.fixtures import KEY

V = ["variedad"]
ORDER = ["fecha", *KEY]
ORD = "ORDER BY " + ", ".join(ORDER)
Y = "kg_jr_h"
NUM = [*roles.NUMERIC, Y]

C = f"c AS (SELECT *, kg_jr_h - avg(kg_jr_h) OVER (PARTITION BY variedad) AS c FROM harvest), lg AS (SELECT variedad, c, " + ", ".join(
    f"lag(c, {k}) OVER w AS l{k}" for k in range(1, 21)
) + f" FROM c WINDOW w AS (PARTITION BY variedad {ORD}))"
PROD = ", ".join(f"sum(c * l{k}) / sum(c * c) AS r{k}" for k in range(1, 21))


@query("D13", "harvest", f"""{C}, a AS (SELECT variedad, count(*) AS n, 1.0::DOUBLE AS r0, {PROD} FROM lg GROUP BY 1),
u AS (UNPIVOT a ON {', '.join(f'r{k}' for k in range(21))} INTO NAME nm VALUE r)
SELECT variedad, CAST(substr(nm, 2) AS BIGINT) AS lag, round(r, 6) AS acf, CAST(substr(nm, 2) AS BIGINT) > 0 AND abs(r) > 1.96 / sqrt(n) AS significant FROM u""")
def acf(df):
    return series.acf(df, V, ORDER, Y)


@query("D14", "harvest")
def pacf(df):
    return series.pacf(df, V, ORDER, Y)


@query("D15", "harvest", f"""s AS (SELECT variedad, kg_jr_h AS e, kg_jr_h - lag(kg_jr_h) OVER (PARTITION BY variedad {ORD}) AS st FROM harvest), d AS (SELECT variedad, count(*) AS n, sum(st * st) / sum(e * e) AS q FROM s GROUP BY 1)
SELECT variedad, n, round(q, 6) AS statistic, CASE WHEN q < 1.5 THEN 'positive' WHEN q > 2.5 THEN 'negative' ELSE 'ok' END AS verdict, q < 1.5 OR q > 2.5 AS rejects FROM d""")
def durbin_watson(df):
    return series.durbin_watson(df, V, ORDER, Y)


LB = " + ".join(f"r{k} * r{k} / (n - {k})" for k in range(1, 11))
LB_P = "exp(-q / 2) * (1 + q / 2 + pow(q / 2, 2) / 2 + pow(q / 2, 3) / 6 + pow(q / 2, 4) / 24)"


@query("D16", "harvest", f"""{C}, a AS (SELECT variedad, count(*) AS n, {PROD} FROM lg GROUP BY 1), b AS (SELECT variedad, n, n * (n + 2) * ({LB}) AS q FROM a)
SELECT variedad, n, round(q, 6) AS statistic, 10::BIGINT AS dof, round({LB_P}, 6) AS p_value FROM b""")
def ljung_box(df):
    return series.ljung_box(df, V, ORDER, Y)


@query("D17", "harvest")
def adf(df):
    return series.adf(df, V, ORDER, Y)


SP = ", ".join(f"sum(c * l{k}) AS p{k}" for k in range(1, 21))
SPEC0 = " + ".join(f"CASE WHEN m >= {k} THEN 2 * p{k} ELSE 0 END" for k in range(1, 21))
SPEC1 = " + ".join(f"CASE WHEN m >= {k} THEN {2 * k} * p{k} ELSE 0 END" for k in range(1, 21))


@query("D18", "harvest", f"""{C}, a AS (SELECT variedad, count(*) AS n, floor(pow(count(*)::DOUBLE, 2.0::DOUBLE / 9)) AS m, sum(c * c) AS p0, {SP} FROM lg GROUP BY 1),
b AS (SELECT variedad, n, p0, least(n - 1, CAST(floor(1.1447::DOUBLE * pow(pow(({SPEC1}) / (p0 + {SPEC0}), 2), 1.0::DOUBLE / 3) * pow(n::DOUBLE, 1.0::DOUBLE / 3)) AS BIGINT)) AS l FROM a),
i AS (SELECT variedad, c, row_number() OVER w AS i, sum(c) OVER (w ROWS UNBOUNDED PRECEDING) AS s FROM c WINDOW w AS (PARTITION BY variedad {ORD})),
g AS (SELECT x.variedad, y.i - x.i AS k, sum(x.c * y.c) AS q FROM i x JOIN i y ON x.variedad = y.variedad JOIN b ON b.variedad = x.variedad AND y.i - x.i BETWEEN 1 AND b.l GROUP BY 1, 2),
v AS (SELECT b.variedad, (any_value(p0) + coalesce(sum(2 * (1 - k / (l + 1.0::DOUBLE)) * q), 0)) / any_value(n) AS s2 FROM b LEFT JOIN g USING (variedad) GROUP BY 1),
e AS (SELECT b.variedad, n, l, sum(s * s) / (n * n) / any_value(s2) AS q FROM i JOIN b USING (variedad) JOIN v USING (variedad) GROUP BY 1, 2, 3),
t AS (SELECT *, CASE WHEN q <= 0.347 THEN 0.1 WHEN q < 0.463 THEN 0.1 - (q - 0.347) * 0.05 / 0.116 WHEN q < 0.574 THEN 0.05 - (q - 0.463) * 0.025 / 0.111
 WHEN q < 0.739 THEN 0.025 - (q - 0.574) * 0.015 / 0.165 ELSE 0.01 END AS p FROM e)
SELECT variedad, n, round(q, 6) AS statistic, l AS lags, round(p::DOUBLE, 6) AS p_value, p < 0.05 AS rejects FROM t WHERE n >= 30""")
def kpss(df):
    return series.kpss(df, V, ORDER, Y)


@query("D19", "harvest", f"""i AS (SELECT variedad, kg_jr_h AS x, row_number() OVER w - 1 AS i, (sum(kg_jr_h) OVER (w ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) + (lag(kg_jr_h, 6) OVER w + lead(kg_jr_h, 6) OVER w) / 2) / 12 AS t
 FROM harvest WINDOW w AS (PARTITION BY variedad {ORD})), p AS (SELECT variedad, i % 12 AS ph, avg(x - t) AS p FROM i WHERE t IS NOT NULL GROUP BY 1, 2),
s AS (SELECT variedad, ph, p - avg(p) OVER (PARTITION BY variedad) AS s FROM p),
v AS (SELECT i.variedad, var_pop(x - t - s) AS vr, var_pop(x - s) AS vt, var_pop(x - t) AS vs FROM i JOIN s ON i.variedad = s.variedad AND i.i % 12 = s.ph WHERE t IS NOT NULL GROUP BY 1), n AS (SELECT variedad, count(*) AS n FROM harvest GROUP BY 1)
SELECT variedad, n, round(greatest(0, 1 - vr / vt), 6) AS trend_strength, round(greatest(0, 1 - vr / vs), 6) AS seasonal_strength FROM v JOIN n USING (variedad)""")
def strength(df):
    return series.seasonal_strength(df, V, ORDER, Y)


LONG = "l AS (" + " UNION ALL ".join(
    f"SELECT variedad, '{c}' AS variable, year(fecha) AS y, CAST({c} AS DOUBLE) AS value FROM harvest WHERE {c} IS NOT NULL" for c in NUM
) + """), yp AS (SELECT *, lead(y) OVER (PARTITION BY variedad ORDER BY y) AS y2 FROM (SELECT DISTINCT variedad, y FROM l))"""
PSI = f"""{LONG}, ed AS (SELECT variedad, variable, y, list_sort(list_distinct(quantile_cont(value, {[i / 10 for i in range(11)]}))) AS e, count(*) AS n1 FROM l GROUP BY ALL HAVING count(*) >= 50),
na AS (SELECT variedad, variable, y AS y2, count(*) AS n2 FROM l GROUP BY ALL HAVING count(*) >= 50),
p AS (SELECT ed.variedad, ed.variable, ed.y AS y1, yp.y2, e, n1, n2 FROM ed JOIN yp ON ed.variedad = yp.variedad AND ed.y = yp.y JOIN na ON na.variedad = ed.variedad AND na.variable = ed.variable AND na.y2 = yp.y2 WHERE len(e) >= 3),
bn AS (SELECT p.variedad, p.variable, y1, p.y2, n1, n2, l.y = y1 AS early, len(list_filter(e[2:len(e) - 1], lambda z: z <= value)) AS b FROM p JOIN l ON p.variedad = l.variedad AND p.variable = l.variable AND l.y IN (y1, p.y2)),
gr AS (SELECT variedad, variable, y1, y2, n1, n2, unnest(range(len(e) - 1)) AS b FROM p),
ct AS (SELECT gr.variedad, gr.variable, gr.y1, gr.y2, gr.n1, gr.n2, gr.b, count(*) FILTER (early) AS ce, count(*) FILTER (NOT early) AS ca FROM gr LEFT JOIN bn ON gr.variedad = bn.variedad AND gr.variable = bn.variable AND gr.y1 = bn.y1 AND gr.b = bn.b GROUP BY 1, 2, 3, 4, 5, 6, 7),
cs AS (SELECT *, greatest(ce / n1, 1e-6) AS pe, greatest(ca / n2, 1e-6) AS pa FROM ct),
psi AS (SELECT variedad, variable, y1, y2, n1 AS n_expected, n2 AS n_actual, sum((pa - pe) * ln(pa / pe)) AS psi FROM cs GROUP BY ALL)"""


@query("D20", "harvest", f"{PSI} SELECT variedad, variable, y1, y2, n_expected, n_actual, round(psi, 6) AS psi FROM psi")
def psi(df):
    return drift.psi(drift.paired_values(df, V, NUM), V)


KS = """cn AS (SELECT yp.variedad, a.variable, yp.y AS y1, yp.y2, a.value, count(*) FILTER (a.y = yp.y) AS c1, count(*) FILTER (a.y = yp.y2) AS c2 FROM yp JOIN l a ON a.variedad = yp.variedad AND a.y IN (yp.y, yp.y2) WHERE yp.y2 IS NOT NULL GROUP BY ALL),
cu AS (SELECT *, sum(c1) OVER o AS f1, sum(c2) OVER o AS f2, sum(c1) OVER p AS n1, sum(c2) OVER p AS n2 FROM cn WINDOW p AS (PARTITION BY variedad, variable, y1), o AS (PARTITION BY variedad, variable, y1 ORDER BY value)),
ks AS (SELECT variedad, variable, y1, y2, CAST(any_value(n1) AS BIGINT) AS n1, CAST(any_value(n2) AS BIGINT) AS n2, max(abs(f1 / n1 - f2 / n2)) AS statistic FROM cu WHERE n1 >= 30 AND n2 >= 30 GROUP BY ALL)"""


@query("D21", "harvest", f"{LONG}, {KS} SELECT variedad, variable, y1, y2, n1, n2, round(statistic, 6) AS statistic FROM ks")
def ks(df):
    return drift.ks(drift.paired_values(df, V, NUM), V)


@query("D21_p", "harvest")
def ks_p(df):
    return drift.ks_with_p(drift.ks(drift.paired_values(df, V, NUM), V))


@query("D22", "harvest", f"""{PSI}, {KS}, r AS (SELECT variedad, variable, count(*) AS n_pairs, max(psi) AS m, max(statistic) AS k FROM psi LEFT JOIN ks USING (variedad, variable, y1, y2) GROUP BY 1, 2)
SELECT variedad, variable, n_pairs, round(m, 6) AS max_psi, round(k, 6) AS max_ks, CASE WHEN m > 0.25 THEN 'severo' WHEN m > 0.1 THEN 'moderado' ELSE 'ninguno' END AS severity FROM r""")
def drift_report(df):
    return drift.drift_severity(drift.drift_report(df, V, NUM), V)


@query("D23", "pred", """b AS (SELECT variedad, regr_slope(y_true - y_pred, y_pred) AS b, regr_intercept(y_true - y_pred, y_pred) AS a FROM pred GROUP BY 1)
SELECT variedad, count(*) AS n, round(count(*) * regr_r2(pow(y_true - y_pred - a - b * y_pred, 2), y_pred), 6) AS statistic FROM pred JOIN b USING (variedad) GROUP BY 1""")
def breusch_pagan_single(df):
    return regression.breusch_pagan_single(df.withColumn("r", F.col("y_true") - F.col("y_pred")), V, "r", "y_pred")


@query("D23_multi", "harvest")
def breusch_pagan(df):
    return regression.breusch_pagan(df, V, Y, ["kg_ha", "dpc", "ha"])


@query("D24", "harvest")
def white(df):
    return regression.white(df, V, Y, ["kg_ha", "dpc"])


@query("D25", "pred")
def residual_battery(df):
    from sparkyield.plans import profile as plan

    return plan.residual_tests(df, V, ORDER)


@query("D25_summary", "pred", """SELECT variedad, count(*) AS n, round(avg(abs(y_true - y_pred)), 6) AS mae, round(sqrt(avg(pow(y_true - y_pred, 2))), 6) AS rmse, round(avg(y_true - y_pred), 6) AS bias FROM pred GROUP BY 1""")
def residual_summary(df):
    from sparkyield.plans import profile as plan

    return plan.residual_summary(df, V)


@query("D25_findings", "pred")
def residual_findings(df):
    from sparkyield.plans import profile as plan

    return plan.residual_findings(plan.residual_tests(df, V, ORDER), V)


def _profile(df, widest):
    from sparkyield.plans import profile as plan

    return plan.profile_dataset(df, V, ORDER, roles.NUMERIC, roles.CATEGORICAL, Y, "fecha", widest)


@query("D26", "harvest")
def findings(df):
    from sparkyield.plans import profile as plan

    return plan.findings(_profile(df, 0), V, Y)


@query("D27", "harvest")
def profile_dataset(df):
    from sparkyield.plans import profile as plan

    tables = _profile(df, 3)
    return plan.stats_rows(tables, "variedad", plan.findings(tables, V, Y), "2001-01-01T00:00:00")


@query("S9", "harvest", f"""{PSI}, m AS (SELECT variedad, variable, max(psi) AS m FROM psi GROUP BY 1, 2)
SELECT variedad, '2002-01-01T00:00:00' AS eda_generated_at, round(max(m), 6) AS drift_psi_max, count(*) FILTER (m > 0.25) AS drift_severe_count,
coalesce(array_to_string(list_sort(list(variable) FILTER (m > 0.25)), ','), '') AS drift_severe_vars, 0::BIGINT AS eda_findings_high FROM m GROUP BY 1""")
def stored_stats(df):
    import uuid

    from sparkyield import runtime
    from sparkyield.sources import writers

    sev = drift.drift_severity(drift.drift_report(df, V, NUM), V)
    rows = sev.select(
        "variedad", F.lit("2002-01-01T00:00:00").alias("generated_at"), F.lit("drift").alias("section"),
        F.col("variable").alias("name"), F.lit("max_psi").alias("metric"), F.col("max_psi").alias("value"),
        F.col("severity").alias("label"),
    )
    path = f"{runtime.shared_dir(df.sparkSession)}/stats-{uuid.uuid4().hex}"
    older = rows.withColumns({"generated_at": F.lit("2001-01-01T00:00:00"), "value": F.lit(9.0)})
    writers.write_stats(older, path)
    writers.write_stats(rows, path)
    return writers.drift_summary(df.sparkSession.read.schema(writers.STATS_SCHEMA).json(path))
