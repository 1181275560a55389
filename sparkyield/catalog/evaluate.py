"""E queries, J5 and L8: evaluation tables on the out-of-fold prediction view."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from sparkyield import roles, runtime
from sparkyield.catalog.registry import query
from sparkyield.functions.scalar import cut
from sparkyield.operators import champion as ch
from sparkyield.operators import evaluate as ev
from sparkyield.sources.fixtures import KEY

KEYS = ", ".join(KEY)
V = ["variedad"]

ERR = """e AS (SELECT *, y_pred * h_ef AS kp, abs(y_pred * h_ef - kg_jr) AS ae,
 CASE WHEN kg_jr <> 0 THEN abs(y_pred * h_ef - kg_jr) / abs(kg_jr) * 100 END AS pe,
 abs(y_true - y_pred) AS ar, y_true - y_pred AS r, date_diff('day', DATE '1970-01-01', fecha) AS d FROM pred)"""


def m_sql(y: str, p: str) -> str:
    return (
        f"count(*) AS n, round(avg(abs({p} - {y})), 6) AS mae, round(sqrt(avg(({p} - {y}) * ({p} - {y}))), 6) AS rmse, "
        f"round(1 - sum(({p} - {y}) * ({p} - {y})) / (var_pop({y}) * count(*)), 6) AS r2, "
        f"round(avg(CASE WHEN {y} <> 0 THEN abs(({p} - {y}) / {y}) END) * 100, 6) AS mape"
    )


@query("E1", "pred", f"SELECT variedad, {m_sql('y_true', 'y_pred')} FROM pred GROUP BY 1")
def error_metrics(df):
    return ev.metrics(df, V)


@query("E2", "pred", f"""w AS (SELECT *, CASE WHEN fold_id = 0 THEN NULL ELSE y_pred END AS p_oof, avg(y_true) OVER (PARTITION BY fundo, formato) AS p_in FROM pred),
l AS (SELECT variedad, 'oof' AS scenario, kg_jr AS y, p_oof * h_ef AS p FROM w UNION ALL SELECT variedad, 'in_sample', kg_jr, p_in * h_ef FROM w)
SELECT variedad, scenario, {m_sql('y', 'p').replace('count(*) AS n', 'count(p) AS n')}, count(*) - count(p) AS n_dropped FROM (SELECT variedad, scenario, CASE WHEN p IS NOT NULL THEN y END AS y, p FROM l) GROUP BY 1, 2""".replace("var_pop(y) * count(*)", "var_pop(y) * count(p)"))
def business(df):
    fit = df.groupBy("fundo", "formato").agg(F.avg("y_true").alias("p_in"))
    rows = runtime.attach(df, fit, ["fundo", "formato"], check=True)
    rows = rows.withColumn("p_oof", F.when(F.col("fold_id") != 0, F.col("y_pred")))
    return ev.business_metrics(rows, V, {"oof": "p_oof", "in_sample": "p_in"})


@query("E3", "pred", f"""{ERR} SELECT {KEYS}, round(kp, 6) AS kg_jr_estimado, round(ae, 6) AS error_abs, round(pe, 6) AS error_pct FROM e""")
def prediction_table(df):
    return ev.prediction_table(df).select(*KEY, "kg_jr_estimado", "error_abs", "error_pct")


CONF = f"""{ERR}, c AS (SELECT variedad, count(*) AS n, (count(*) - 1) * least(1.0, 0.95::DOUBLE * (count(*) + 1) / count(*)) AS pos, list_sort(list(ar)) AS s FROM e GROUP BY 1),
q AS (SELECT variedad, n, CASE WHEN n >= 20 THEN s[CAST(floor(pos) AS INT) + 1] * (1 - (pos - floor(pos))) + s[CAST(ceil(pos) AS INT) + 1] * (pos - floor(pos)) ELSE 0 END AS q FROM c)"""


@query("E4", "pred", f"{CONF} SELECT {KEYS}, round(y_pred - q, 6) AS y_low, round(y_pred + q, 6) AS y_high FROM pred JOIN q USING (variedad)")
def conformal(df):
    return ev.conformal_band(df, V).select(*KEY, "y_low", "y_high")


@query("E5", "pred", f"""s AS (SELECT fundo, formato, stddev_samp(y_true) AS sd FROM pred GROUP BY 1, 2)
SELECT {KEYS}, round((y_pred - 1.96::DOUBLE * sd) * h_ef, 4) AS estimacion_baja, round((y_pred + 1.96::DOUBLE * sd) * h_ef, 4) AS estimacion_alta FROM pred JOIN s USING (fundo, formato)""")
def ensemble_band(df):
    sd = df.groupBy("fundo", "formato").agg(F.stddev_samp("y_true").alias("sd"))
    rows = runtime.attach(df, sd, ["fundo", "formato"], check=True)
    low, high = ev.ensemble_band(F.col("y_pred"), F.col("sd"))
    out = ev.prediction_table(rows, low, high)
    return out.select(*KEY, *[cut(c, 4) for c in ("estimacion_baja", "estimacion_alta")])


@query("E6", "pred", f"""{ERR}, g AS (SELECT variedad, formato, count(*) AS n_cosechas, avg(kg_jr) AS a, avg(kp) AS b, avg(ae) AS c, avg(pe) AS d1, max(ae) AS f FROM e GROUP BY 1, 2)
SELECT variedad, formato, n_cosechas, round(a, 6) AS real_promedio, round(b, 6) AS estimado_promedio, round(c, 6) AS mae, round(d1, 6) AS error_pct_promedio, round(f, 6) AS error_maximo,
row_number() OVER (PARTITION BY variedad ORDER BY d1 DESC NULLS LAST, formato) AS ranking FROM g""")
def subgroup_summary(df):
    return ev.subgroup_summary(ev.prediction_table(df), V, "formato")


BINS = f"""{ERR}, ed AS (SELECT variedad AS v, quantile_cont(kg_ha, [0.25, 0.5, 0.75]) AS k, quantile_cont(pct_indus, [0.25, 0.5, 0.75]) AS p FROM e GROUP BY 1),
b AS (SELECT e.*, CAST(year(fecha) AS VARCHAR) AS g_anio,
 strftime(fecha, '%m') || '-' || ({roles.MONTHS!r})[month(fecha)] AS g_mes,
 CASE WHEN ha <= 1 THEN '≤1 ha' WHEN ha <= 3 THEN '1-3 ha' WHEN ha <= 6 THEN '3-6 ha' ELSE '>6 ha' END AS g_ha,
 CASE WHEN kg_ha IS NOT NULL THEN ({roles.QUARTILE_LABELS!r})[len(list_filter(k, lambda x: x < kg_ha)) + 1] END AS g_kg_ha,
 CASE WHEN pct_indus IS NOT NULL THEN ({roles.QUARTILE_LABELS!r})[len(list_filter(p, lambda x: x < pct_indus)) + 1] END AS g_pct_indus
FROM e JOIN ed ON e.variedad = ed.v)"""


@query("F11", "pred", f"{BINS} SELECT {KEYS}, g_anio, g_mes, g_ha, g_kg_ha, g_pct_indus FROM b")
def report_bins(df):
    return ev.report_bins(df, V).select(*KEY, "g_anio", "g_mes", "g_ha", "g_kg_ha", "g_pct_indus")


E7_SQL = BINS + ", l AS (" + " UNION ALL ".join(
    f"SELECT variedad, '{k}' AS grouping_, CAST({c} AS VARCHAR) AS level, ae, kg_jr FROM b" for k, c in ev.GROUPINGS.items()
) + """), gl AS (SELECT variedad, avg(ae / abs(kg_jr)) * 100 AS gm FROM e GROUP BY 1),
t AS (SELECT variedad, grouping_, level, count(*) AS n, avg(ae) AS mae, quantile_cont(ae, [0.5, 0.9]) AS q, avg(ae / abs(kg_jr)) * 100 AS mape FROM l WHERE level IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 5)
SELECT variedad, grouping_, level, n, round(mae, 6) AS mae, round(q[1], 6) AS p50, round(q[2], 6) AS p90, round(mape, 6) AS mape, round(mape / gm, 6) AS ratio,
CASE WHEN mape / gm < 0.85 THEN 'good' WHEN mape / gm <= 1.15 THEN 'neutral' WHEN mape / gm <= 1.5 THEN 'warn' ELSE 'bad' END AS ratio_class FROM t JOIN gl USING (variedad)"""


@query("E7", "pred", E7_SQL)
def subgroup_errors(df):
    rows = ev.report_bins(df, V)
    return ev.subgroup_errors(rows, V, ev.GROUPINGS).withColumnRenamed("grouping", "grouping_")


@query("E8", "pred", f"""{ERR}, t AS (SELECT variedad, fundo AS level, count(*) AS n, avg(ae) AS mean, quantile_cont(ae, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM e GROUP BY 1, 2 HAVING count(*) >= 5)
SELECT variedad, level, n, round(mean, 4) AS mean, round(q[1], 4) AS low, round(q[2], 4) AS q1, round(q[3], 4) AS median, round(q[4], 4) AS q3, round(q[5], 4) AS high,
row_number() OVER (PARTITION BY variedad ORDER BY q[3] DESC, level) AS position FROM t""", digits=4)
def box_stats(df):
    return ev.box_stats(df, V, "fundo")


@query("E9", "pred", f"""{ERR}, t AS (SELECT variedad, fundo, count(*) AS n, avg(kp - kg_jr) AS b, avg(kg_jr) AS m FROM e GROUP BY 1, 2 HAVING count(*) >= 10)
SELECT variedad, fundo, n, round(b, 6) AS mean_signed_bias, round(b / m * 100, 6) AS bias_pct, CASE WHEN b / m > 0 THEN 'sobreestima' ELSE 'subestima' END AS direction FROM t WHERE abs(b / m * 100) >= 1.0""")
def group_bias(df):
    return ev.group_bias(df, V, "fundo", threshold=1.0)


GAPS = """gaps AS (SELECT variedad, avg(ae / abs(kg_jr)) * 100 AS full_mape, abs(avg(CASE WHEN fold_id = 0 THEN ar END) - avg(CASE WHEN fold_id > 0 THEN ar END)) AS abs_gap FROM e GROUP BY 1)"""


@query("E10", "pred", f"""{ERR}, {GAPS}, l AS (SELECT variedad, 'formato=' || formato AS subject, ae, kg_jr FROM e UNION ALL SELECT variedad, 'fundo=' || fundo, ae, kg_jr FROM e),
s AS (SELECT l.variedad, 'warning' AS severity, 'subgroup_error' AS rule, subject, avg(ae / abs(kg_jr)) * 100 / any_value(full_mape) AS value FROM l JOIN gaps USING (variedad) GROUP BY 1, 4 HAVING count(*) >= 10 AND avg(ae / abs(kg_jr)) * 100 / any_value(full_mape) >= 1.5),
f AS (SELECT * FROM s UNION ALL SELECT variedad, 'critical', 'global_error', '', full_mape FROM gaps WHERE full_mape > 25
UNION ALL SELECT variedad, 'warning', 'train_gap', '', abs_gap FROM gaps WHERE abs_gap > 0.2)
SELECT variedad, severity, rule, subject, round(value, 6) AS value FROM (SELECT * FROM f UNION ALL SELECT variedad, 'info', 'no_problem', '', NULL FROM gaps WHERE variedad NOT IN (SELECT variedad FROM f))""")
def actions(df):
    ar = F.abs(F.col("y_true") - F.col("y_pred"))
    ape = F.abs(F.col("y_pred") * F.col("h_ef") - F.col("kg_jr")) / F.abs("kg_jr")
    gaps = df.groupBy(*V).agg(
        (F.avg(ape) * 100).alias("full_mape"),
        F.abs(
            F.avg(F.when(F.col("fold_id") == 0, ar)) - F.avg(F.when(F.col("fold_id") > 0, ar))
        ).alias("abs_gap"),
    )
    return ev.recommended_actions(df, V, gaps)


@query("E11", "pred", f"""{ERR}, t AS (SELECT variedad, quantile_cont(ae, [0.5, 0.8]) AS q, avg(pe) AS mape, (1 - sum((kp - kg_jr) * (kp - kg_jr)) / (var_pop(kg_jr) * count(*))) * 100 AS r2p, avg(ae) AS mae, avg(kg_jr) AS m FROM e GROUP BY 1),
b AS (SELECT variedad, avg(abs(kg_jr - m)) AS base FROM e JOIN t USING (variedad) GROUP BY 1), g AS (SELECT *, (base - mae) / base * 100 AS gain FROM t JOIN b USING (variedad))
SELECT variedad, round(q[1], 6) AS p50, round(q[2], 6) AS p80, round(mape, 6) AS mape, CASE WHEN mape <= 15 THEN 'ALTO' WHEN mape <= 25 THEN 'MEDIO' ELSE 'BAJO' END AS precision,
round(r2p, 6) AS r2_pct, CASE WHEN r2p >= 80 THEN 'ALTO' WHEN r2p >= 60 THEN 'MEDIO' ELSE 'BAJO' END AS poder,
round(gain, 6) AS mejora_pct, CASE WHEN gain >= 50 THEN 'ALTO' WHEN gain >= 25 THEN 'MEDIO' ELSE 'BAJO' END AS mejora FROM g""")
def kpis(df):
    return ev.kpi_rows(df, V)


CELLS = "c AS (SELECT variedad, fundo, formato, avg(ar / y_true) * 10 AS mape, abs(avg(r)) / avg(y_true) AS gap, avg(ar) / 5000 AS mae, 1 - avg(ar) / avg(y_true) AS r2 FROM e GROUP BY 1, 2, 3)"


def _cells(df):
    r = F.col("y_true") - F.col("y_pred")
    return df.groupBy("variedad", "fundo", "formato").agg(
        (F.avg(F.abs(r) / F.col("y_true")) * 10).alias("mape"),
        (F.abs(F.avg(r)) / F.avg("y_true")).alias("gap"),
        (F.avg(F.abs(r)) / 5000).alias("mae"),
        (1 - F.avg(F.abs(r)) / F.avg("y_true")).alias("r2"),
    )


@query("E12", "pred", f"""{ERR}, {CELLS} SELECT variedad, fundo, formato, CASE WHEN mape <= 15 AND gap <= 0.10 THEN 'alta_confianza' WHEN mape <= 22 AND gap <= 0.18 THEN 'confianza_aceptable'
WHEN mape <= 35 AND gap <= 0.30 THEN 'confianza_limitada' ELSE 'no_recomendado' END AS verdict FROM c""")
def verdicts(df):
    return _cells(df).select("variedad", "fundo", "formato", ev.verdict(F.col("mape"), F.col("gap")).alias("verdict"))


@query("E13", "pred", f"""{ERR}, {CELLS} SELECT variedad, fundo, formato, CASE WHEN r2 >= 0.9 THEN 'VERDE' WHEN r2 >= 0.7 THEN 'AMARILLO' ELSE 'ROJO' END AS estado_r2,
CASE WHEN mae <= 0.2 THEN 'VERDE' WHEN mae <= 0.4 THEN 'AMARILLO' ELSE 'ROJO' END AS estado_mae FROM c""")
def lights(df):
    return _cells(df).select(
        "variedad", "fundo", "formato",
        ev.traffic_light_r2(F.col("r2")).alias("estado_r2"),
        ev.traffic_light_mae(F.col("mae")).alias("estado_mae"),
    )


PW = " + ".join(f"CAST(u >= {c} AS INT)" for c in ev.POISSON)


@query("E14", "pred", f"""h AS (SELECT variedad, y_true AS y, y_pred AS p, h, md5(concat_ws('|', {KEYS}, '42', h)) AS d FROM pred, range({-(-1000 // ev.DRAWS)}) r(h) WHERE y_true IS NOT NULL AND y_pred IS NOT NULL),
l AS (SELECT variedad, y, p, h, CAST('0x' || substr(d, 1, 15) AS BIGINT) AS a, CAST('0x' || substr(d, 16, 15) AS BIGINT) AS b FROM h),
u AS (SELECT variedad, y, p, h * {ev.DRAWS} + j + 1 AS rep, (((CASE WHEN j < 3 THEN a ELSE b END >> CAST(40 - 20 * (j % 3) AS BIGINT)) & 1048575) + 0.5::DOUBLE) / 1048576 AS u FROM l, range({ev.DRAWS}) s(j)),
w AS (SELECT variedad, y, p, rep, ({PW})::DOUBLE AS w FROM u WHERE rep <= 1000),
s AS (SELECT variedad, rep, sum(w * abs(p - y)) / sum(w) AS mae, sum(w * abs((p - y) / y)) FILTER (y <> 0) / sum(w) FILTER (y <> 0) * 100 AS mape,
 1 - sum(w * (p - y) * (p - y)) / (sum(w * y * y) - sum(w * y) * sum(w * y) / sum(w)) AS r2 FROM w WHERE w > 0 GROUP BY 1, 2),
c AS (SELECT variedad, {', '.join(f'quantile_cont({m}, 0.025) AS {m}_low, quantile_cont({m}, 0.975) AS {m}_high' for m in ('mae', 'mape', 'r2'))} FROM s GROUP BY 1),
t AS (SELECT variedad, count(*) AS n, avg(abs(y_pred - y_true)) AS mae, avg(abs((y_pred - y_true) / y_true)) FILTER (y_true <> 0) * 100 AS mape,
 1 - sum((y_pred - y_true) * (y_pred - y_true)) / (var_pop(y_true) * count(*)) AS r2 FROM pred WHERE y_pred IS NOT NULL GROUP BY 1)
SELECT variedad, n, {', '.join(f'round({m}{e}, 6) AS {m}{e}' for m in ('mae', 'mape', 'r2') for e in ('', '_low', '_high'))} FROM t JOIN c USING (variedad)""")
def bootstrap(df):
    return ev.bootstrap_ci(df, V, KEY)


CAL = """q AS (SELECT variedad, list_sort(list_distinct(quantile_cont(y_pred, {probs}))) AS ed, count(*) AS n FROM e GROUP BY 1 HAVING count(*) >= {least}),
b AS (SELECT e.*, len(list_filter(ed[2:len(ed) - 1], lambda x: x < y_pred)) AS bin_idx FROM e JOIN q USING (variedad))"""


@query("E15", "pred", f"""{ERR}, {CAL.format(probs=[i / 10 for i in range(11)], least=20)}
SELECT variedad, bin_idx, round(avg(y_pred), 6) AS bin_pred_mean, round(avg(y_true), 6) AS bin_real_mean, count(*) AS bin_count,
round((avg(y_true) - avg(y_pred)) / avg(y_pred) * 100, 6) AS bin_diff_pct FROM b GROUP BY 1, 2""")
def calibration(df):
    return ev.calibration(df, V)


@query("E16", "pred", f"""{ERR} SELECT variedad, count(*) AS n, round(avg(ae), 6) AS mae, round(avg(pe), 6) AS mape, round(quantile_cont(ae, 0.5), 6) AS p50,
round(quantile_cont(ae, 0.9), 6) AS p90, round(quantile_cont(ae, 0.99), 6) AS p99 FROM e GROUP BY 1""")
def cards(df):
    return ev.error_cards(df, V)


@query("E17", "pred", f"""{ERR}, t AS (SELECT variedad, fecha, min(d) AS d, sum(ae) AS s, count(*) AS c FROM e GROUP BY 1, 2)
SELECT variedad, fecha, CAST(sum(c) OVER w AS BIGINT) AS n_obs, CASE WHEN sum(c) OVER w >= 5 THEN round(sum(s) OVER w / sum(c) OVER w, 4) END AS error_movil FROM t
WINDOW w AS (PARTITION BY variedad ORDER BY d RANGE BETWEEN 29 PRECEDING AND CURRENT ROW)""", digits=4)
def over_time(df):
    return ev.error_over_time(df, V)


HIST_SQL = """s AS (SELECT variedad, min(kg_jr_h) AS lo, max(kg_jr_h) AS hi, count(*) AS total, stddev_samp(kg_jr_h) AS sd FROM pred GROUP BY 1),
h AS (SELECT variedad, least(39, CAST(floor((kg_jr_h - lo) / ((hi - lo) / 40)) AS BIGINT)) AS bin, count(*) AS n, max(lo) AS lo, max((hi - lo) / 40) AS width FROM pred JOIN s USING (variedad) GROUP BY 1, 2)"""


@query("E18", "pred", f"{HIST_SQL} SELECT variedad, bin, n, round(lo + bin * width, 6) AS left_edge, round(width, 6) AS width FROM h")
def histogram(df):
    return ev.histogram(df, V, "kg_jr_h")


@query("E18_density", "pred", f"""{HIST_SQL}, g AS (SELECT s.*, i, lo + (hi - lo) * i / 199 AS x, sd * pow(total, -0.2) AS bw FROM s, range(200) t(i))
SELECT g.variedad, i, round(x, 6) AS x, round(sum(n * exp(-pow((x - (h.lo + bin * width + width / 2)) / bw, 2) / 2)) / (any_value(total) * any_value(bw) * sqrt(2 * pi())), 10) AS density
FROM g JOIN h USING (variedad) GROUP BY 1, 2, 3""", digits=10)
def density(df):
    out = ev.density(df, V, "kg_jr_h")
    return out.withColumn("x", cut("x", 6))


QQ = [(i + 0.5) / 100 for i in range(100)]


@query("E19", "pred", f"""{ERR}, t AS (SELECT variedad, unnest(range(100)) AS i, unnest({[NormalDist().inv_cdf(p) for p in QQ]}) AS z, unnest(quantile_cont(r, {QQ})) AS s FROM e GROUP BY 1)
SELECT variedad, i, round(z::DOUBLE, 4) AS normal, round(s, 4) AS sample FROM t""", digits=4)
def qq(df):
    return ev.qq_points(df.withColumn("r", F.col("y_true") - F.col("y_pred")), V, "r")


@query("E20", "pred", f"""{ERR}, {CAL.format(probs=[i / 20 for i in range(21)], least=40)}
SELECT variedad, bin_idx, round(avg(y_pred), 6) AS pred_mean, round(avg(ar), 6) AS abs_resid_mean, count(*) AS n FROM b GROUP BY 1, 2""")
def residual_trend(df):
    return ev.residual_trend(df, V)


@query("J5", "pred", f"""{ERR} SELECT {KEYS}, fecha, fundo, formato, kg_jr AS real, round(kp, 6) AS estimado, round(ae, 6) AS error_abs, round(pe, 6) AS error_pct,
CASE WHEN kp > kg_jr THEN 'sobreestima' ELSE 'subestima' END AS direccion FROM e ORDER BY ae DESC, {KEYS} LIMIT 20""")
def worst(df):
    return ev.worst_predictions(df, KEY, 20)


@query("L8", "harvest", """SELECT variedad, count(*) AS n_rows, 9::BIGINT AS n_features, strftime(min(fecha), '%Y-%m') AS first_month, strftime(max(fecha), '%Y-%m') AS last_month,
count(DISTINCT fundo) AS n_fundos, count(DISTINCT formato) AS n_formatos, array_to_string(list_sort(list(DISTINCT fundo))[1:5], ',') AS fundos,
array_to_string(list_sort(list(DISTINCT formato))[1:5], ',') AS formatos FROM harvest GROUP BY 1""")
def context(df):
    return ev.training_context(df, V, len(roles.NUMERIC) + len(roles.CATEGORICAL) + 1)


# two deterministic competitors per variety, scored in and out of fold
RESULTS = """two AS (
 SELECT variedad, 'gm_ff' AS model, y_true AS y, y_pred AS p, ROUND(avg(y_true) OVER (PARTITION BY fundo, formato), 6) AS f, 2.0 AS t FROM pred UNION ALL
 SELECT variedad, 'gm_f', y_true, ROUND((sum(y_true) OVER (PARTITION BY fundo) - sum(y_true) OVER (PARTITION BY fundo, fold_id)) / (count(*) OVER (PARTITION BY fundo) - count(*) OVER (PARTITION BY fundo, fold_id)), 6),
   ROUND(avg(y_true) OVER (PARTITION BY fundo), 6), 1.0 FROM pred),
res AS (SELECT variedad, model, abs(avg(abs(y - p)) - avg(abs(y - f))) AS abs_gap, avg(abs((y - f) / y)) * 100 AS full_mape, avg(abs((y - p) / y)) * 100 AS oof_mape,
 avg(abs(y - p)) AS mae, count(*) / 1000 * any_value(t)::DOUBLE AS seconds FROM two GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY variedad ORDER BY floor(abs_gap / 0.005::DOUBLE) NULLS LAST, floor(full_mape / 0.5::DOUBLE) NULLS LAST, seconds, model) AS rank FROM res)"""


def _results(df):
    def one(groups, name, pace):
        fit = df.groupBy(*groups).agg(F.round(F.avg("y_true"), 6).alias("f"))
        rows = ev.out_of_fold_group_mean(df.drop("y_pred"), groups, "fold_id", "y_true", "p")
        rows = rows.withColumn("p", F.round("p", 6))
        rows = runtime.attach(rows, fit, groups, check=True)
        y, p, f = F.col("y_true"), F.col("p"), F.col("f")
        return rows.groupBy("variedad").agg(
            F.lit(name).alias("model"),
            F.abs(F.avg(F.abs(y - p)) - F.avg(F.abs(y - f))).alias("abs_gap"),
            (F.avg(F.abs((y - f) / y)) * 100).alias("full_mape"),
            (F.avg(F.abs((y - p) / y)) * 100).alias("oof_mape"),
            F.avg(F.abs(y - p)).alias("mae"),
            (F.count("*") / 1000 * pace).alias("seconds"),
        )

    return one(["fundo", "formato"], "gm_ff", 2.0).unionByName(one(["fundo"], "gm_f", 1.0))


@query("E21", "pred", f"{RESULTS} SELECT variedad, model, round(abs_gap, 6) AS abs_gap, round(full_mape, 6) AS full_mape, round(seconds, 6) AS seconds FROM rk WHERE rank = 1")
def champions(df):
    return ch.champions(_results(df), V).select("variedad", "model", "abs_gap", "full_mape", "seconds")


@query("E22", "pred", f"""{RESULTS} SELECT r.variedad, r.model, r.rank, CASE WHEN r.rank = 1 THEN 'campeon' WHEN r.abs_gap - c.abs_gap > 0.005 THEN 'overfitting'
WHEN r.full_mape - c.full_mape > 0.5 THEN 'menor estabilidad' WHEN r.seconds - c.seconds > 0 THEN 'eficiencia' ELSE 'empate' END AS reason
FROM rk r JOIN rk c ON r.variedad = c.variedad AND c.rank = 1""")
def reasons(df):
    return ch.reasons(_results(df), V).select("variedad", "model", "rank", "reason")


@query("E23", "pred", f"{RESULTS} SELECT variedad, model, round(oof_mape + 0.05::DOUBLE * greatest(0, abs_gap), 6) AS composite FROM res")
def composite(df):
    return _results(df).select(
        "variedad", "model",
        ch.composite_score(F.col("oof_mape"), F.col("abs_gap"), F.col("mae")).alias("composite"),
    )


@query("E24", "pred", f"""{RESULTS} SELECT variedad, model, oof_mape <= 25 AS passes, CASE WHEN oof_mape > 25 THEN 'rejected' WHEN abs_gap * 100 > 18 THEN 'warning' ELSE 'passed' END AS gate FROM rk WHERE rank = 1""")
def gate(df):
    return ch.quality_gate(ch.champions(_results(df), V)).select("variedad", "model", "passes", "gate")


@query("E25", "pred", f"""{RESULTS}, v AS (SELECT DISTINCT variedad FROM pred) SELECT v.variedad, coalesce(model, '') AS champion, round(oof_mape, 6) AS oof_mape,
CASE WHEN model IS NULL THEN 'failed' WHEN oof_mape > 25 THEN 'rejected' WHEN abs_gap * 100 > 18 THEN 'warning' ELSE 'passed' END AS status
FROM v LEFT JOIN (SELECT * FROM rk WHERE rank = 1 AND variedad <> 'Brand#11') c ON v.variedad = c.variedad""")
def run_summary(df):
    results = _results(df).where(F.col("variedad") != "Brand#11")  # one failed variety
    return ch.run_summary(results, df.select("variedad").distinct(), V)


@query("E26", "pred", f"""{RESULTS} SELECT b.variedad, round(b.abs_gap, 6) AS abs_gap_base, round(n.abs_gap, 6) AS abs_gap_new, round(b.oof_mape, 6) AS mape_base, round(n.oof_mape, 6) AS mape_new,
n.abs_gap <= b.abs_gap + 0.005 AND n.oof_mape <= b.oof_mape + 1 AS accepted FROM res b JOIN res n ON b.variedad = n.variedad AND b.model = 'gm_f' AND n.model = 'gm_ff'""")
def accept(df):
    runs = _results(df).withColumnsRenamed({"model": "run", "oof_mape": "mape"})
    return ch.accept_run(runs, V, "gm_f", "gm_ff")
