"""T and J queries over the person-day view."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkyield import runtime
from sparkyield.catalog.registry import query
from sparkyield.functions.quantiles import quantile_rows
from sparkyield.functions.scalar import cut
from sparkyield.operators import team
from sparkyield.plans.team_features import team_features
from sparkyield.sources.fixtures import KEY

LOT = ["fecha", "fundo", "formato"]
KEYS = ", ".join(KEY)

P = """p AS (
SELECT *, CASE WHEN horas <> 0 THEN kg / horas END AS kgh,
       date_diff('day', DATE '1970-01-01', fecha) AS d, year(fecha) AS anio
FROM person_day)"""

NEAREST = "list_extract(list_sort(list({v})), CAST(round((count({v}) - 1) * {q}) AS INT) + 1)"

POOL = f"""yearly AS (SELECT worker_id, anio, avg(CASE WHEN horas > 0 THEN kg / horas END) AS rate FROM p GROUP BY 1, 2),
cuts AS (SELECT anio, {NEAREST.format(v='rate', q='0.75::DOUBLE')} AS q75 FROM yearly WHERE rate IS NOT NULL GROUP BY 1),
pool AS (SELECT y.worker_id, y.anio + 1 AS anio, CAST(y.rate >= c.q75 AS BIGINT) AS bolsa_flag
         FROM yearly y LEFT JOIN cuts c ON y.anio = c.anio)"""

HIST = f"""h AS (
SELECT *, avg(kgh) OVER r30 AS havg, stddev_samp(kgh) OVER r30 AS hstd,
       CAST(d - lag(d) OVER (PARTITION BY worker_id ORDER BY d, {KEYS}) AS DOUBLE) AS gap,
       count(*) OVER r30 AS c30, count(DISTINCT fundo) OVER r30 AS nf30, min(fundo) OVER r30 AS f30,
       count(*) OVER r90 AS c90, count(DISTINCT fundo) OVER r90 AS nf90,
       min(fecha) OVER (PARTITION BY worker_id, anio) AS primer_dia_anio,
       CAST(dense_rank() OVER (PARTITION BY worker_id ORDER BY d) - 1 AS DOUBLE) AS tenure,
       CAST(anio = min(anio) OVER (PARTITION BY worker_id) AS DOUBLE) AS primer,
       avg(kgh) OVER r120 AS dow_kgh, avg(horas) OVER r120 AS dow_h,
       min(id_supervisor) OVER y1 AS sup_ayer, min(grupo_id) OVER l1 AS grupo_ayer
FROM p
WINDOW r30 AS (PARTITION BY worker_id ORDER BY d RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING),
       r90 AS (PARTITION BY worker_id ORDER BY d RANGE BETWEEN 90 PRECEDING AND 1 PRECEDING),
       r120 AS (PARTITION BY worker_id, dayofweek(fecha) ORDER BY d RANGE BETWEEN 120 PRECEDING AND 1 PRECEDING),
       y1 AS (PARTITION BY worker_id ORDER BY d RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING),
       l1 AS (PARTITION BY worker_id, fundo, formato ORDER BY d RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)),
h2 AS (SELECT *, d - date_diff('day', DATE '1970-01-01', primer_dia_anio) AS dia,
       CASE WHEN c30 = 0 THEN 0.0 WHEN nf30 = 1 AND f30 = fundo THEN 0.0 ELSE 1.0 END::DOUBLE AS rotado,
       CASE WHEN c90 > 0 THEN CAST(nf90 AS DOUBLE) END AS visitados,
       CAST(grupo_id <> grupo_ayer AS DOUBLE) AS cambio, CAST(id_supervisor = sup_ayer AS DOUBLE) AS mismo,
       kgh - havg AS residual,
       CAST(temporadas >= 3 AND havg > 0 AND kgh < 0.8 * havg AS DOUBLE) AS bajo
FROM h)"""

QCUTS = f"""qc AS (SELECT anio + 1 AS anio, {NEAREST.format(v='havg', q='0.25::DOUBLE')} AS q1,
       {NEAREST.format(v='havg', q='0.75::DOUBLE')} AS q3 FROM h2 WHERE havg IS NOT NULL GROUP BY anio),
h3 AS (SELECT h2.*, CAST(havg >= q3 AS DOUBLE) AS top_h, CAST(havg <= q1 AS DOUBLE) AS bottom_h
       FROM h2 LEFT JOIN qc ON h2.anio = qc.anio)"""

SUP = """sl AS (SELECT id_supervisor, fecha, min(d) AS d, CAST(count(DISTINCT worker_id) AS DOUBLE) AS carga,
       CAST(count(DISTINCT fundo || '|' || formato) AS DOUBLE) AS lotes, avg(kgh) AS r FROM p GROUP BY 1, 2),
sd AS (SELECT *, avg(r) OVER w AS s_avg, stddev_samp(r) OVER w AS s_std FROM sl
       WINDOW w AS (PARTITION BY id_supervisor ORDER BY d RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING))"""

CREW = """crew AS (SELECT DISTINCT fecha, fundo, formato, worker_id FROM p),
both_days AS (SELECT a.fecha, a.fundo, a.formato, count(*) AS n, count(b.worker_id) AS both_n
  FROM crew a LEFT JOIN crew b ON a.worker_id = b.worker_id AND a.fundo = b.fundo AND a.formato = b.formato
   AND b.fecha = a.fecha - INTERVAL 1 DAY GROUP BY 1, 2, 3),
cont AS (SELECT t.*, CASE WHEN y.n > 0 THEN t.both_n / t.n END AS misma,
   CASE WHEN y.n > 0 THEN (y.n - t.both_n) / y.n END AS gone
  FROM both_days t LEFT JOIN both_days y ON t.fundo = y.fundo AND t.formato = y.formato
   AND y.fecha = t.fecha - INTERVAL 1 DAY)"""

GROUPS = """gs AS (SELECT fecha, fundo, formato, grupo_id, count(*) AS size, stddev_samp(kgh) AS sd, avg(kgh) AS mu,
  stddev_samp(horas) AS sd_h FROM p GROUP BY 1, 2, 3, 4),
ga AS (SELECT fecha, fundo, formato, count(*) AS n_grupos, avg(size) AS size_avg, stddev_samp(size) AS size_std,
  avg(CASE WHEN mu > 0 THEN sd / mu END) AS cv, avg(sd_h) AS h_std FROM gs GROUP BY 1, 2, 3)"""


@query("T1", "person_day", """SELECT count(*) AS n_rows, count(DISTINCT worker_id) AS n_workers, true AS has_format, true AS has_group, true AS has_supervisor, true AS has_seasons,
true AS has_hours, true AS has_rate FROM person_day""")
def required_and_capabilities(df):
    caps = team.capabilities(df, ["worker_id", "fecha", "fundo"])
    flags = ["has_format", "has_group", "has_supervisor", "has_seasons", "has_hours", "has_rate"]
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("worker_id").alias("n_workers"),
        *[F.lit(getattr(caps, f)).alias(f) for f in flags],
    )


def _history(df, *blocks):
    return team.with_history(
        team.person_rate(df), team.person_history(team.person_lot_days(df, KEY), blocks)
    )


@query("T2", "person_day", f"""{P} SELECT {KEYS}, CAST(d - min(d) OVER (PARTITION BY worker_id, anio) AS BIGINT) AS dia_cosecha_persona FROM p""")
def day_in_season(df):
    return _history(df, "season").select(*KEY, F.col("dia_calc").alias("dia_cosecha_persona"))


@query("T3", "person_day", f"""{P}, {POOL}
SELECT {KEYS}, coalesce(bolsa_flag, 0) AS bolsa_flag FROM p LEFT JOIN pool ON p.worker_id = pool.worker_id AND p.anio = pool.anio""")
def pool_flag(df):
    return team.with_pool_flag(df).select(*KEY, "bolsa_flag")


@query("T4", "person_day", f"SELECT {KEYS}, CASE WHEN horas <> 0 THEN round(kg / horas, 8) END AS kgh FROM person_day", digits=8)
def rate(df):
    return team.person_rate(df).select(*KEY, "kgh")


@query("T5", "person_day", f"""{P}, {HIST} SELECT {KEYS}, round(havg, 6) AS hist_avg, round(hstd, 6) AS hist_std FROM h2""")
def history_30d(df):
    return _history(df, "history").select(
        *KEY,
        F.col("kg_jr_h_hist_avg_30d").alias("hist_avg"),
        cut("kg_jr_h_hist_std_30d", 6).alias("hist_std"),
    )


@query("T6", "person_day", f"{P}, {HIST} SELECT {KEYS}, gap AS dias_desde_ultimo FROM h2")
def since_last(df):
    return team.days_since_last(_history(df, "gap"), KEY).select(*KEY, "dias_desde_ultimo")


@query("T7", "person_day", f"{P}, {HIST} SELECT {KEYS}, rotado AS rotado_30d FROM h2")
def rotated(df):
    return _history(df, "farms").select(*KEY, "rotado_30d")


@query("T8", "person_day", f"{P}, {HIST} SELECT {KEYS}, visitados AS fundos_visitados_90d FROM h2")
def farms_visited(df):
    return _history(df, "farms").select(*KEY, "fundos_visitados_90d")


@query("T9", "person_day", f"""{P}, {HIST} SELECT {KEYS}, primer_dia_anio, CAST(dia <= 14 AS DOUBLE) AS nuevo_ingreso_14d FROM h2""")
def first_day_of_year(df):
    return _history(df, "season").select(*KEY, "primer_dia_anio", "nuevo_ingreso_14d")


@query("T10", "person_day", f"{P}, {HIST} SELECT {KEYS}, tenure AS tenure_lifetime FROM h2")
def tenure(df):
    return _history(df, "tenure").select(*KEY, "tenure_lifetime")


@query("T11", "person_day", f"{P}, {HIST} SELECT {KEYS}, primer AS es_primer_anio FROM h2")
def first_year(df):
    return _history(df, "tenure").select(*KEY, "es_primer_anio")


@query("T12", "person_day", f"""{P}, {HIST} SELECT {KEYS}, round(dow_kgh, 6) AS kgh_dow, round(dow_h, 6) AS horas_dow FROM h2""")
def weekday_history(df):
    return _history(df, "weekday").select(
        *KEY,
        F.col("kg_jr_h_hist_dow_avg_120d").alias("kgh_dow"),
        F.col("horas_hist_dow_avg_120d").alias("horas_dow"),
    )


@query("T13", "person_day", f"""{P}, {HIST} SELECT {KEYS}, round(residual, 6) AS kg_jr_h_residual, bajo AS veterano_bajo_baseline FROM h2""")
def residual(df):
    return team.baseline_residual(_history(df, "history")).select(
        *KEY, "kg_jr_h_residual", "veterano_bajo_baseline"
    )


@query("T14", "person_day", f"{P}, {HIST}, {QCUTS} SELECT {KEYS}, top_h AS top_hist, bottom_h AS bottom_hist FROM h3")
def quartile_flags(df):
    history = runtime.materialize(team.person_history(team.person_lot_days(df, KEY), ("history",)))
    rows = team.with_history(df, history)
    return team.with_quartile_flags(rows, team.quartile_cuts(history)).select(
        *KEY, "top_hist", "bottom_hist"
    )


@query("T15", "person_day", f"{P}, {HIST} SELECT {KEYS}, cambio AS cambio_grupo FROM h2")
def group_change(df):
    return team.group_change(_history(df, "continuity")).select(*KEY, "cambio_grupo")


@query("T16", "person_day", f"""{P}, {SUP} SELECT {KEYS}, carga AS sup_carga_hoy, lotes AS sup_lotes_hoy
FROM p JOIN sd ON p.id_supervisor = sd.id_supervisor AND p.fecha = sd.fecha""")
def supervisor_load(df):
    days = team.supervisor_days(df)
    return runtime.attach(df, days, ["id_supervisor", "fecha"]).select(
        *KEY, "sup_carga_hoy", "sup_lotes_hoy"
    )


@query("T17", "person_day", f"""{P}, {SUP} SELECT id_supervisor, fecha, round(s_avg, 6) AS hist_avg, round(s_std, 6) AS hist_std FROM sd""")
def supervisor_history(df):
    return team.supervisor_days(df).select(
        "id_supervisor",
        "fecha",
        F.col("sup_kg_jr_h_hist_avg_30d").alias("hist_avg"),
        F.col("sup_kg_jr_h_hist_std_30d").alias("hist_std"),
    )


@query("T18", "person_day", f"{P}, {HIST} SELECT {KEYS}, mismo AS mismo_supervisor_ayer FROM h2")
def same_supervisor(df):
    return team.same_supervisor(_history(df, "continuity")).select(*KEY, "mismo_supervisor_ayer")


A_SQL = """count(DISTINCT p.worker_id) AS n_cosechadores, round(avg(dia), 6) AS tenure_avg,
 median(dia)::DOUBLE AS tenure_median, round(stddev_samp(dia), 6) AS tenure_std, min(dia) AS tenure_min, max(dia) AS tenure_max,
 round(avg(CAST(dia < 30 AS DOUBLE)), 6) AS pct_novatos, round(avg(CAST(dia > 180 AS DOUBLE)), 6) AS pct_veteranos,
 round(avg(tenure), 6) AS tenure_lifetime_avg, round(avg(primer), 6) AS pct_primer_anio,
 round(avg(coalesce(bolsa_flag, 0)), 6) AS pct_bolsa, round(avg(havg), 6) AS kg_jr_h_hist_avg_30d,
 round(avg(hstd), 6) AS kg_jr_h_hist_std_30d, round(avg(top_h), 6) AS pct_top_hist, round(avg(bottom_h), 6) AS pct_bottom_hist,
 round(avg(rotado), 6) AS pct_rotados_30d, round(avg(visitados), 6) AS fundos_visitados_avg_90d,
 round(avg(CAST(dia <= 14 AS DOUBLE)), 6) AS pct_nuevos_ingresos_14d, round(avg(gap), 6) AS dias_desde_ultimo_trabajo_avg,
 round(avg(cambio), 6) AS pct_cambio_grupo, round(avg(dow_kgh), 6) AS kg_jr_h_hist_dow_avg, round(avg(residual), 6) AS kg_jr_h_residual_avg,
 round(avg(dow_h), 6) AS horas_hist_dow_avg, round(avg(CAST(horas < 6 AS DOUBLE)), 6) AS pct_jornada_parcial"""
S_SQL = """count(DISTINCT p.id_supervisor) AS n_supervisores, round(avg(carga), 6) AS sup_carga_hoy_avg, round(avg(lotes), 6) AS sup_lotes_hoy_avg,
 round(avg(mismo), 6) AS pct_mismo_supervisor_ayer, round(avg(s_avg), 6) AS sup_kg_jr_h_hist_avg, round(avg(s_std), 6) AS sup_kg_jr_h_hist_std,
 round(avg(temporadas), 6) AS temporadas_avg, round(stddev_samp(temporadas), 6) AS temporadas_std,
 round(avg(CAST(temporadas = 1 AS DOUBLE)), 6) AS pct_temporada_inicial,
 round(avg(CAST(temporadas >= 3 AS DOUBLE)), 6) AS pct_temporadas_veterano, round(avg(bajo), 6) AS pct_veteranos_bajo_baseline"""
ROWS = """FROM h3 p LEFT JOIN pool ON p.worker_id = pool.worker_id AND p.anio = pool.anio
 LEFT JOIN sd ON p.id_supervisor = sd.id_supervisor AND p.fecha = sd.fecha"""
ALL = f"{P}, {POOL}, {HIST}, {QCUTS}, {SUP}"
COMPOSITION = [
    "n_cosechadores", "tenure_avg", "tenure_median", "tenure_std", "tenure_min", "tenure_max",
    "pct_novatos", "pct_veteranos", "tenure_lifetime_avg", "pct_primer_anio", "pct_bolsa",
    "kg_jr_h_hist_avg_30d", "kg_jr_h_hist_std_30d", "pct_top_hist", "pct_bottom_hist",
    "pct_rotados_30d", "fundos_visitados_avg_90d", "pct_nuevos_ingresos_14d",
    "dias_desde_ultimo_trabajo_avg", "pct_cambio_grupo", "kg_jr_h_hist_dow_avg",
    "kg_jr_h_residual_avg", "horas_hist_dow_avg", "pct_jornada_parcial",
]
SUPERVISION = [
    "n_supervisores", "sup_carga_hoy_avg", "sup_lotes_hoy_avg", "pct_mismo_supervisor_ayer",
    "sup_kg_jr_h_hist_avg", "sup_kg_jr_h_hist_std", "temporadas_avg", "temporadas_std",
    "pct_temporada_inicial", "pct_temporadas_veterano", "pct_veteranos_bajo_baseline",
]


def _lots(df):
    out = team_features(df, KEY)
    return out.withColumn("kg_jr_h_hist_std_30d", cut("kg_jr_h_hist_std_30d", 6))


@query("T19", "person_day", f"{ALL} SELECT p.fecha, p.fundo, p.formato, {A_SQL} {ROWS} GROUP BY 1, 2, 3")
def lot_composition(df):
    return _lots(df).select(*LOT, *COMPOSITION)


@query("T20", "person_day", f"{ALL} SELECT p.fecha, p.fundo, p.formato, {S_SQL} {ROWS} GROUP BY 1, 2, 3")
def lot_supervision(df):
    return _lots(df).select(*LOT, *SUPERVISION)


@query("T21", "person_day", f"""{P} SELECT fecha, fundo, formato, round(count(DISTINCT worker_id) / count(DISTINCT id_supervisor), 6) AS ratio_cosechadores_por_supervisor,
 CAST(count(DISTINCT worker_id) / count(DISTINCT id_supervisor) > 35 AS DOUBLE) AS exceso_grupo_flag FROM p GROUP BY 1, 2, 3""")
def crew_per_supervisor(df):
    heads = df.groupBy(*LOT).agg(
        F.count_distinct("worker_id").alias("n_cosechadores"),
        F.count_distinct("id_supervisor").alias("n_supervisores"),
    )
    return team.crew_ratio(heads).drop("n_cosechadores", "n_supervisores")


@query("T22", "person_day", f"""{P}, {GROUPS} SELECT fecha, fundo, formato, n_grupos, round(size_avg, 6) AS grupo_size_avg, round(size_std, 6) AS grupo_size_std FROM ga""")
def group_sizes(df):
    return team.group_composition(df, LOT).select(*LOT, "n_grupos", "grupo_size_avg", "grupo_size_std")


@query("T23", "person_day", f"""{P}, {GROUPS} SELECT fecha, fundo, formato, round(cv, 6) AS kg_jr_h_grupo_cv_avg, round(h_std, 6) AS horas_std_grupo_avg FROM ga""")
def group_spread(df):
    return team.group_composition(df, LOT).select(*LOT, "kg_jr_h_grupo_cv_avg", "horas_std_grupo_avg")


@query("T24", "person_day", f"""{ALL}, {CREW}, {GROUPS},
agg AS (SELECT p.fecha, p.fundo, p.formato, {A_SQL}, {S_SQL} {ROWS} GROUP BY 1, 2, 3)
SELECT agg.*, round(n_cosechadores / n_supervisores, 6) AS ratio_cosechadores_por_supervisor,
 CAST(n_cosechadores / n_supervisores > 35 AS DOUBLE) AS exceso_grupo_flag,
 n_grupos, round(size_avg, 6) AS grupo_size_avg, round(size_std, 6) AS grupo_size_std,
 round(cv, 6) AS kg_jr_h_grupo_cv_avg, round(h_std, 6) AS horas_std_grupo_avg,
 round(misma, 6) AS pct_misma_dotacion_ayer, round(gone, 6) AS pct_desvinculados_ayer
FROM agg JOIN ga USING (fecha, fundo, formato) JOIN cont USING (fecha, fundo, formato)""")
def all_team_features(df):
    return _lots(df)


@query("J1", "person_day", f"{P}, {POOL} SELECT {KEYS}, round(q75, 6) AS q75 FROM p LEFT JOIN cuts ON p.anio = cuts.anio")
def small_table_join(df):
    rate = F.when(F.col("horas") > 0, F.col("kg") / F.col("horas"))
    yearly = df.groupBy("worker_id", F.year("fecha").alias("anio")).agg(F.avg(rate).alias("rate"))
    cuts = quantile_rows(yearly, ["anio"], "rate", [0.75], method="nearest")
    return (
        df.withColumn("anio", F.year("fecha"))
        .join(F.broadcast(cuts), "anio", "left")
        .select(*KEY, F.col("q")[0].alias("q75"))
    )


@query("J2", "person_day", f"""{P}, y AS (SELECT worker_id, fecha + INTERVAL 1 DAY AS manana, fundo, formato, min(grupo_id) AS grupo_ayer FROM p GROUP BY 1, 2, 3, 4)
SELECT {', '.join('p.' + k for k in KEY)}, p.grupo_id, y.grupo_ayer FROM p LEFT JOIN y
ON p.worker_id = y.worker_id AND p.fecha = y.manana AND p.fundo = y.fundo AND p.formato = y.formato""")
def yesterday_join(df):
    keys = ["worker_id", "fecha", "fundo", "formato"]
    before = (
        df.groupBy(*keys)
        .agg(F.min("grupo_id").alias("grupo_ayer"))
        .withColumn("fecha", F.date_add("fecha", 1))
    )
    return df.join(before, keys, "left").select(*KEY, "grupo_id", "grupo_ayer")


@query("J3", "person_day", f"""{P}, {CREW} SELECT fecha, fundo, formato, n AS n_cosechadores, round(misma, 6) AS pct_misma_dotacion_ayer,
 round(gone, 6) AS pct_desvinculados_ayer FROM cont""")
def continuity(df):
    history = team.person_history(team.person_lot_days(df, KEY), ("continuity",))
    return team.crew_continuity(history, LOT)


@query("J6", "person_day", f"""{P} SELECT worker_id, fecha, min(id_supervisor) AS id_supervisor, count(DISTINCT fundo) AS n_fundos FROM p GROUP BY 1, 2""")
def dedupe(df):
    return (
        df.select("worker_id", "fecha", "fundo", "id_supervisor")
        .distinct()
        .groupBy("worker_id", "fecha")
        .agg(F.min("id_supervisor").alias("id_supervisor"), F.count_distinct("fundo").alias("n_fundos"))
    )
