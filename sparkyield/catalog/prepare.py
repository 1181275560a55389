"""S, L, C, F and M queries that SQL can express, on the harvest view."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkyield import roles, runtime
from sparkyield.catalog.registry import query
from sparkyield.functions.scalar import safe_ratio
from sparkyield.operators import clean, features, folds, load
from sparkyield.operators.lags import union_history
from sparkyield.plans.team_features import team_features
from sparkyield.sources import fixtures, readers, writers
from sparkyield.sources.fixtures import KEY

KEYS = ", ".join(KEY)
V = ["variedad"]
NUM = roles.NUMERIC
CUT = "2000-07-01"


def _path(spark, name):
    return f"{runtime.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("S1", "person_day", f"SELECT {KEYS}, worker_id, fecha, fundo, round(kg, 6) AS kg, round(horas, 6) AS horas FROM person_day")
def delimited(df):
    path = _path(df.sparkSession, "persons")
    cols = [*KEY, "worker_id", "fecha", "fundo", "kg", "horas"]
    df.select(*cols).write.option("header", True).option("sep", "|").csv(path)
    schema = df.select(*cols).schema
    return readers.read_delimited(df.sparkSession, path, schema=schema)


@query("S2", "harvest", "SELECT variedad, count(*) AS n, round(sum(kg_jr), 2) AS kg FROM harvest WHERE variedad <> 'Brand#11' GROUP BY 1", digits=2)
def parquet_partitions(df):
    path = _path(df.sparkSession, "features")
    writers.write_features(df.select("variedad", "fecha", "fundo", "kg_jr"), path)
    back = df.sparkSession.read.parquet(path)
    return back.where("variedad <> 'Brand#11'").groupBy("variedad").agg(
        F.count("*").alias("n"), F.sum("kg_jr").alias("kg")
    )


HEADERS = {"worker_id": " Id Cosechador ", "fecha": "fecha", "fundo": "Fundo", "horas": "total horas"}


@query("S3", "person_day", "SELECT worker_id AS \"COSECHADOR_ID\", fecha AS \"FECHA\", fundo AS \"FUNDO\", round(horas, 6) AS \"HORAS_PERSONA\" FROM person_day")
def headers(df):
    raw = df.select(*[F.col(k).cast("string").alias(v) for k, v in HEADERS.items()])
    out = readers.normalize_headers(raw)
    return out.withColumns(
        {"COSECHADOR_ID": F.col("COSECHADOR_ID").cast("long"), "HORAS_PERSONA": F.col("HORAS_PERSONA").cast("double")}
    )


@query("S4", "person_day", "SELECT worker_id AS persona, fecha, fundo AS finca FROM person_day")
def renamed(df):
    return readers.rename_columns(df.select("worker_id", "fecha", "fundo"), "worker_id=persona, fundo=finca")


@query("S5", "person_day", f"SELECT {KEYS}, round(horas * 10.5, 6) AS kg FROM person_day")
def crates(df):
    rows = df.select(*KEY, F.col("horas").alias("total_jabas"))
    return load.derive_kg(rows, 10.5).drop("total_jabas")


@query("S6", "harvest", """SELECT trim(variedad) AS variedad, count(*) AS n_rows, count(*) >= 2400 AS kept FROM harvest GROUP BY 1""")
def split_summary(df):
    return load.variety_counts(df, min_rows=2400)


@query("S6_rows", "harvest", "SELECT variedad, count(*) AS n, min(fecha) AS first_date FROM harvest GROUP BY 1 HAVING count(*) >= 2400")
def split_rows(df):
    return load.split_by_variety(df, 2400).groupBy("variedad").agg(
        F.count("*").alias("n"), F.min("fecha").alias("first_date")
    )


@query("S7", "harvest", "SELECT variedad, count(*) AS n FROM harvest WHERE variedad IN ('Brand#1', 'Brand#2') GROUP BY 1")
def selected(df):
    names = load.list_varieties(df)
    picked = load.select_varieties(df, "Brand#1, Brand#2")
    return picked.groupBy("variedad").agg(F.count("*").alias("n")).join(names, "variedad", "left_semi")


@query("S8", "harvest", "SELECT 'run-1' AS run_id, count(*) AS n_rows, count(DISTINCT variedad) AS n_varieties FROM harvest")
def audit(df):
    path = _path(df.sparkSession, "audit")
    n, k = df.agg(F.count("*"), F.count_distinct("variedad")).first()
    writers.append_audit(df.sparkSession, {"run_id": "run-1", "n_rows": n, "n_varieties": k}, path)
    return df.sparkSession.read.schema("run_id string, n_rows long, n_varieties long").json(path)


@query("S10", "harvest")
def fingerprint(df):
    return writers.fingerprint(df)


@query("S12", "harvest", f"""SELECT {KEYS}, fecha >= DATE '{CUT}' AS is_new, CASE WHEN fecha < DATE '{CUT}' THEN round(kg_jr_h, 8) END AS kg_jr_h FROM harvest""", digits=8)
def history(df):
    cut = F.to_date(F.lit(CUT))
    old = df.where(F.col("fecha") < cut).select(*KEY, "kg_jr_h")
    return union_history(old, df.where(F.col("fecha") >= cut).select(*KEY))


@query("S13", None, f"""WITH {fixtures.HARVEST_SQL}, {fixtures.PERSON_SQL},
f AS (SELECT fecha, fundo, formato, count(DISTINCT worker_id) AS n_cosechadores, round(avg(CAST(temporadas >= 3 AS DOUBLE)), 6) AS pct_temporadas_veterano FROM person_day GROUP BY 1, 2, 3)
SELECT {KEYS}, n_cosechadores, pct_temporadas_veterano FROM harvest LEFT JOIN f USING (fecha, fundo, formato)""")
def with_team(spark, sf):
    feats = team_features(fixtures.person_day(spark, sf), KEY)
    feats = feats.select("fecha", "fundo", "formato", "n_cosechadores", "pct_temporadas_veterano")
    out = load.join_team_features(fixtures.harvest(spark, sf), feats)
    return out.select(*KEY, "n_cosechadores", "pct_temporadas_veterano")


@query("L1", "harvest", f"SELECT {KEYS} FROM harvest WHERE l_linenumber <> 3")
def null_target(df):
    holes = df.withColumn("kg_jr_h", F.when(F.col("l_linenumber") != 3, F.col("kg_jr_h")))
    return load.drop_null_target(holes).select(*KEY)


@query("L2", "harvest", "SELECT DISTINCT variedad, fecha, fundo, formato, h_ef FROM harvest")
def duplicates(df):
    return load.drop_exact_duplicates(df.select("variedad", "fecha", "fundo", "formato", "h_ef"))


@query("L3", "harvest", "SELECT variedad, fecha, round(kg_jr_h, 8) AS kg_jr_h, round(kg_ha, 8) AS kg_ha, round(pct_indus, 8) AS pct_indus, dpc, round(p_baya, 8) AS p_baya, ha, dia_cosecha, fundo, formato FROM harvest", digits=8)
def columns(df):
    return load.training_columns(df, V)


@query("L4", "harvest", f"""SELECT {KEYS}, CASE WHEN l_linenumber <> 2 THEN h_ef END AS h_ef, CASE WHEN l_linenumber <> 4 THEN fecha END AS fecha, fundo FROM harvest""")
def casts(df):
    text = df.select(
        *KEY,
        F.concat(F.when(F.col("l_linenumber") == 2, "x").otherwise(""), F.col("h_ef").cast("string")).alias("h_ef"),
        F.when(F.col("l_linenumber") == 4, "no date").otherwise(F.col("fecha").cast("string")).alias("fecha"),
        F.concat(F.lit("  "), "fundo", F.lit(" ")).alias("fundo"),
    )
    return load.typed(text, ["h_ef"], ["fecha"], ["fundo"])


@query("L5", "harvest", f"""SELECT {KEYS}, CASE WHEN count(*) OVER (PARTITION BY variedad, formato) < 150 THEN 'OTROS' ELSE formato END AS formato FROM harvest""")
def rare(df):
    return load.collapse_rare(df, "formato", V, min_count=150).select(*KEY, "formato")


@query("L6", "harvest", """t AS (SELECT h_ef, kg_ha - 500 AS kg_ha, pct_indus * 20 AS pct_indus, 1.0 AS dpc, fundo, formato FROM harvest),
i AS (SELECT 'above_range' AS issue, 'h_ef' AS column_name, count(*) FILTER (h_ef > 24) AS n FROM t UNION ALL
SELECT 'below_range', 'kg_ha', count(*) FILTER (kg_ha < 0) FROM t UNION ALL SELECT 'above_range', 'pct_indus', count(*) FILTER (pct_indus > 100) FROM t UNION ALL
SELECT 'single_value', 'dpc', CAST(min(dpc) = max(dpc) AS BIGINT) FROM t UNION ALL
SELECT 'duplicate_rows', '*', CAST(sum(c - 1) AS BIGINT) FROM (SELECT count(*) AS c FROM t GROUP BY h_ef, kg_ha, pct_indus, dpc, fundo, formato)) SELECT * FROM i WHERE n > 0""")
def validation(df):
    bad = df.select(
        "h_ef", (F.col("kg_ha") - 500).alias("kg_ha"), (F.col("pct_indus") * 20).alias("pct_indus"),
        F.lit(1.0).alias("dpc"), "fundo", "formato",
    )
    return load.validate(bad)


@query("L7", "harvest", """t AS (SELECT variedad, fecha, fundo, formato, pct_indus, p_baya, ha FROM harvest),
c AS (SELECT variedad, count(*) AS k, count(fecha) AS x FROM (SELECT DISTINCT * FROM t) GROUP BY 1)
SELECT variedad, count(*) AS n_rows, 7::BIGINT AS n_cols, count(*) - any_value(k) AS n_duplicates, CAST(count(*) * 2 - count(pct_indus) - count(p_baya) AS BIGINT) AS n_missing_total,
min(fecha) AS fecha_min, max(fecha) AS fecha_max, count(DISTINCT fundo) AS n_fundos, count(DISTINCT formato) AS n_formatos,
round((count(*) * 2 - count(pct_indus) - count(p_baya)) / (count(*) * 7), 6) AS missing_ratio FROM t JOIN c USING (variedad) GROUP BY 1""")
def quality(df):
    return load.quality_summary(df.select("variedad", "fecha", "fundo", "formato", "pct_indus", "p_baya", "ha"), V)


@query("C1", "harvest", f"""SELECT {KEYS}, CAST(pct_indus IS NULL AS BIGINT) AS pct_indus__miss, CAST(p_baya IS NULL AS BIGINT) AS p_baya__miss,
CAST(pct_indus IS NULL AS BIGINT) + CAST(p_baya IS NULL AS BIGINT) AS n_miss_raw FROM harvest""")
def flags(df):
    return clean.missing_flags(df, ["pct_indus", "p_baya", "absent"]).select(
        *KEY, "pct_indus__miss", "p_baya__miss", "n_miss_raw"
    )


@query("C2", "harvest", f"""m AS (SELECT variedad, median(p_baya) AS pm, avg(CAST(p_baya IS NULL AS INT)) AS pr, median(pct_indus) AS im, avg(CAST(pct_indus IS NULL AS INT)) AS ir FROM harvest GROUP BY 1)
SELECT {KEYS}, round(CASE WHEN pr > 0.3 THEN coalesce(p_baya, pm) ELSE p_baya END, 8) AS p_baya, round(CASE WHEN ir > 0.3 THEN coalesce(pct_indus, im) ELSE pct_indus END, 8) AS pct_indus
FROM harvest JOIN m USING (variedad)""", digits=8)
def medians(df):
    cols = ["p_baya", "pct_indus"]
    return clean.impute_medians(df, clean.fit_medians(df, cols, V), cols, V).select(*KEY, *cols)


SCALE_SQL = "sc AS (SELECT variedad, " + ", ".join(
    f"median({c}) AS {c}_m, CASE WHEN quantile_cont({c}, 0.75) = quantile_cont({c}, 0.25) THEN 1 ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS {c}_s" for c in NUM
) + " FROM harvest GROUP BY 1)"
Z_SQL = f"{SCALE_SQL}, z AS (SELECT harvest.*, " + ", ".join(f"({c} - {c}_m) / {c}_s AS {c}_z" for c in NUM) + " FROM harvest JOIN sc USING (variedad))"


@query("C4", "harvest", f"{Z_SQL} SELECT {KEYS}, " + ", ".join(f"round({c}_z, 6) AS {c}_z" for c in NUM) + " FROM z")
def scale(df):
    return clean.apply_scale(df, clean.fit_scale(df, NUM, V), NUM, V, "_z").select(*KEY, *[f"{c}_z" for c in NUM])


@query("C5", "harvest", f"""b AS (SELECT variedad, quantile_cont(kg_ha, 0.01) AS l, quantile_cont(kg_ha, 0.99) AS h, quantile_cont(kg_jr_h, 0.25) AS a, quantile_cont(kg_jr_h, 0.75) AS c FROM harvest GROUP BY 1)
SELECT {KEYS}, round(least(greatest(kg_ha, l), h), 6) AS kg_ha, round(least(greatest(kg_jr_h, a - 0.1::DOUBLE * (c - a)), c + 0.1::DOUBLE * (c - a)), 6) AS kg_jr_h FROM harvest JOIN b USING (variedad)""")
def caps(df):
    a = clean.apply_caps(df, clean.fit_caps(df, ["kg_ha"], V, method="percentile"), ["kg_ha"])
    return clean.apply_caps(a, clean.fit_caps(df, ["kg_jr_h"], V, factor=0.1), ["kg_jr_h"]).select(*KEY, "kg_ha", "kg_jr_h")


@query("C6", "harvest", f"""l AS (SELECT variedad, fundo, formato, quantile_cont(kg_jr_h, 0.25) AS a, quantile_cont(kg_jr_h, 0.75) AS c FROM harvest GROUP BY 1, 2, 3 HAVING count(*) >= 300),
m AS (SELECT variedad, fundo, quantile_cont(kg_jr_h, 0.25) AS a, quantile_cont(kg_jr_h, 0.75) AS c FROM harvest GROUP BY 1, 2 HAVING count(*) >= 800),
g AS (SELECT variedad, quantile_cont(kg_jr_h, 0.25) AS a, quantile_cont(kg_jr_h, 0.75) AS c FROM harvest GROUP BY 1),
j AS (SELECT h.*, CASE WHEN l.a IS NOT NULL THEN l.a WHEN m.a IS NOT NULL THEN m.a ELSE g.a END AS a, CASE WHEN l.a IS NOT NULL THEN l.c WHEN m.a IS NOT NULL THEN m.c ELSE g.c END AS c
FROM harvest h LEFT JOIN l USING (variedad, fundo, formato) LEFT JOIN m USING (variedad, fundo) JOIN g USING (variedad))
SELECT {KEYS}, round(least(greatest(kg_jr_h, a - 0.2::DOUBLE * (c - a)), c + 0.2::DOUBLE * (c - a)), 6) AS kg_jr_h FROM j""".replace("HAVING count(*) >= 800", "HAVING count(*) >= 300"))
def cascade(df):
    fit = clean.fit_caps(df, ["kg_jr_h"], V, ["fundo", "formato"], factor=0.2, min_group=300)
    return clean.apply_caps(df, fit, ["kg_jr_h"]).select(*KEY, "kg_jr_h")


@query("C9", "harvest", f"{Z_SQL}, w AS (SELECT *, greatest(" + ", ".join(f"coalesce(abs({c}_z), 0)" for c in NUM) + f") AS worst FROM z), q AS (SELECT variedad, quantile_cont(worst, 0.95) AS lim FROM w GROUP BY 1) SELECT {KEYS} FROM w JOIN q USING (variedad) WHERE worst <= lim")
def group_outliers(df):
    return clean.drop_group_outliers(df, NUM, V).select(*KEY)


@query("C10", "harvest", f"SELECT {KEYS}, round(kg_ha, 6) AS kg_ha, ha FROM harvest")
def constants(df):
    rows = df.select(*KEY, "kg_ha", F.lit(7.0).alias("flat"), "ha")
    return clean.drop_constant_features(rows, ["kg_ha", "flat", "ha"])


@query("F1", "harvest", f"SELECT {KEYS}, CASE WHEN pct_indus - 5 > 0 THEN round(kg_ha / (pct_indus - 5), 6) END AS ratio FROM harvest")
def ratio(df):
    return df.select(*KEY, safe_ratio(F.col("kg_ha"), F.col("pct_indus") - 5).alias("ratio"))


@query("F2", "harvest", f"""SELECT {KEYS}, round(kg_ha * ha, 6) AS kg_total, round(pct_indus * kg_ha, 6) AS indus_kg_ha,
CASE WHEN p_baya > 0 THEN round(kg_ha / p_baya, 6) END AS kg_per_baya, CASE WHEN dpc > 0 THEN round(kg_ha / dpc, 6) END AS kg_ha_per_dpc FROM harvest""")
def ratios(df):
    return features.structural_ratios(df).select(*KEY, *features.RATIOS)


@query("F3", "harvest", "SELECT " + KEYS + ", " + ", ".join(
    f"round({fn}(2 * pi() * {k} * month(fecha) / 12), 6) AS mes_{fn}{'' if k == 1 else k}" for k in (1, 2, 3) for fn in ("sin", "cos")
) + ", round(sin(2 * pi() * week(fecha) / 52), 6) AS semana_sin, round(cos(2 * pi() * week(fecha) / 52), 6) AS semana_cos FROM harvest")
def cyclic(df):
    cols = features.cyclic_dates(F.col("fecha"))
    return df.select(*KEY, *[v.alias(k) for k, v in cols.items()])


@query("F4", "harvest", f"SELECT {KEYS}, CAST(month(fecha) IN (6,7,8,9,10) AS BIGINT) AS temporada_alta, CAST(month(fecha) IN (12,1,2,3,4) AS BIGINT) AS temporada_baja, year(fecha) AS anio FROM harvest")
def seasons(df):
    return df.select(*KEY, *[v.alias(k) for k, v in features.season_flags(F.col("fecha")).items()])


@query("F5", "harvest", f"""a AS (SELECT variedad, min(fecha) AS f0 FROM harvest GROUP BY 1) SELECT {KEYS}, CAST(date_diff('day', f0, fecha) AS DOUBLE) AS t_index_days, round(date_diff('day', f0, fecha) / 365.25, 6) AS t_index_years FROM harvest JOIN a USING (variedad)""")
def trend(df):
    return features.trend_index(df, features.fit_dates(df, V), V).select(*KEY, "t_index_days", "t_index_years")


@query("F6", "harvest", f"""h2 AS (SELECT *, CASE WHEN l_linenumber <> 5 THEN fecha END AS f FROM harvest), m AS (SELECT variedad, CAST(floor(median(date_diff('day', DATE '1970-01-01', f))) AS INT) AS md FROM h2 GROUP BY 1)
SELECT {KEYS}, coalesce(f, DATE '1970-01-01' + md) AS fecha FROM h2 JOIN m USING (variedad)""")
def fill_dates(df):
    holes = df.withColumn("fecha", F.when(F.col("l_linenumber") != 5, F.col("fecha")))
    return features.fill_dates(holes, features.fit_dates(holes, V), V).select(*KEY, "fecha")


@query("F7", "harvest", f"""SELECT {KEYS}, CAST(formato = 'O' AS BIGINT) AS "formato_O", CAST(formato = 'SMALL' AS BIGINT) AS "formato_SMALL" FROM harvest""")
def dummies(df):
    # levels memorised without one level, which then is unseen
    levels = features.fit_levels(df.where(F.col("formato") != "F"), "formato")
    out = features.one_hot(df, "formato", levels, "formato")
    return out.select(*KEY, *[f"formato_{v}" for v in levels])


@query("F8", "harvest", "SELECT " + KEYS + ", " + ", ".join(
    f"CAST(fundo = '{a}' AND formato = '{b}' AS BIGINT) AS \"ff_{a}__{b}\"" for a in "ANR" for b in ("F", "O", "SMALL")) + " FROM harvest")
def pair_dummies(df):
    levels = features.fit_levels(df, features.pair("fundo", "formato"))
    out = features.one_hot(df, features.pair("fundo", "formato"), levels, "ff")
    return out.select(*KEY, *[f"ff_{v}" for v in levels])


SKEWED = {"kg_jr_h": "kg_jr_h", "cube": "pow(kg_jr_h - 100, 5)", "expo": "exp(h_ef / 3)"}
SKEW_SQL = "s AS (" + " UNION ALL ".join(
    f"SELECT variedad, '{k}' AS variable, {v} AS value FROM harvest" for k, v in SKEWED.items()
) + """), g AS (SELECT variedad, variable, count(*) AS n, stddev_samp(value) AS sd, skewness(value) AS sk, kurtosis(value) AS kt, min(value) AS lo FROM s GROUP BY 1, 2),
k AS (SELECT variedad, variable, n, round(sk, 4) AS skew, round(kt, 3) AS kurt, CASE WHEN n >= 30 AND sd > 0 AND abs(kt) > 50 THEN 'sqrt' WHEN n >= 30 AND sd > 0 AND abs(sk) > 1.5 THEN 'log1p' END AS kind, CASE WHEN lo < 0 THEN -lo ELSE 0 END AS shift FROM g)"""


def _skewed(df):
    return df.withColumns({"cube": F.pow(F.col("kg_jr_h") - 100, F.lit(5)), "expo": F.exp(F.col("h_ef") / 3)})


@query("F9", "harvest", f"{SKEW_SQL} SELECT variedad, variable, n, skew, kurt, kind FROM k", digits=4)
def skew_fit(df):
    from sparkyield.functions.scalar import cut

    return features.fit_skew(_skewed(df), list(SKEWED), V).select("variedad", "variable", "n", "skew", cut("kurt", 3), "kind")


@query("F10", "harvest", f"""{SKEW_SQL}, j AS (SELECT h.*, k.kind, k.shift FROM harvest h JOIN k ON h.variedad = k.variedad AND k.variable = 'expo')
SELECT {KEYS}, CASE kind WHEN 'log1p' THEN round(ln(1 + greatest(exp(h_ef / 3) + shift, 0)), 6) WHEN 'sqrt' THEN round(sqrt(greatest(exp(h_ef / 3) + shift, 0)), 6) END AS expo_skew FROM j""")
def skew_apply(df):
    rows = _skewed(df)
    return features.apply_skew(rows, features.fit_skew(rows, ["expo"], V), ["expo"], V).select(*KEY, "expo_skew")


@query("M1", "harvest", f"""s AS (SELECT variedad, min(kg_jr_h) AS lo, (max(kg_jr_h) - min(kg_jr_h)) / 10 AS w FROM harvest GROUP BY 1),
b AS (SELECT harvest.*, least(10, greatest(1, CAST(ceil((kg_jr_h - lo) / w) AS BIGINT))) AS bin FROM harvest JOIN s USING (variedad)),
c AS (SELECT *, 1.0::DOUBLE / count(*) OVER (PARTITION BY variedad, bin) AS iw FROM b), d AS (SELECT *, sqrt(least(iw, 5 * avg(iw) OVER (PARTITION BY variedad))) AS r FROM c)
SELECT {KEYS}, round(r / avg(r) OVER (PARTITION BY variedad), 6) AS weight FROM d""")
def weights(df):
    return folds.sample_weights(df, V).select(*KEY, "weight")


@query("M2", "harvest", f"""c AS (SELECT variedad, quantile_cont(kg_jr_h, 0.995) AS cap FROM harvest GROUP BY 1)
SELECT {KEYS}, round(ln(1 + least(kg_jr_h, cap)), 6) AS y_log, round(least(kg_jr_h, cap), 4) AS y_back FROM harvest JOIN c USING (variedad)""")
def log_target(df):
    from sparkyield.functions.scalar import cut

    out = folds.log_capped(df, folds.fit_target_cap(df, V), V)
    out = out.withColumn("y_back", folds.from_log(F.col("y_log")))
    return out.select(*KEY, "y_log", cut("y_back", 4))


STRAT = """n1 AS (SELECT *, count(*) OVER (PARTITION BY variedad, fundo, formato) AS c1, count(*) OVER (PARTITION BY variedad, fundo) AS c2, count(*) OVER (PARTITION BY variedad, formato) AS c3 FROM harvest),
l1 AS (SELECT *, CASE WHEN c1 < {m} THEN 'RARE' ELSE fundo || '_' || formato END AS a, CASE WHEN c2 < {m} THEN 'RARE' ELSE fundo END AS b, CASE WHEN c3 < {m} THEN 'RARE' ELSE formato END AS c FROM n1),
o1 AS (SELECT variedad, count(*) >= 2 AND min(n) >= {m} AS ok1 FROM (SELECT variedad, a, count(*) AS n FROM l1 GROUP BY 1, 2) GROUP BY 1),
o2 AS (SELECT variedad, count(*) >= 2 AND min(n) >= {m} AS ok2 FROM (SELECT variedad, b, count(*) AS n FROM l1 GROUP BY 1, 2) GROUP BY 1),
o3 AS (SELECT variedad, count(*) >= 2 AND min(n) >= {m} AS ok3 FROM (SELECT variedad, c, count(*) AS n FROM l1 GROUP BY 1, 2) GROUP BY 1),
lab AS (SELECT l1.*, CASE WHEN ok1 THEN a WHEN ok2 THEN b WHEN ok3 THEN c END AS label, CASE WHEN ok1 THEN 'fundo_formato' WHEN ok2 THEN 'fundo' WHEN ok3 THEN 'formato' ELSE 'none' END AS strategy
 FROM l1 JOIN o1 USING (variedad) JOIN o2 USING (variedad) JOIN o3 USING (variedad))"""


@query("M3", "harvest", f"{STRAT.format(m=150)} SELECT DISTINCT variedad, fundo, formato, strategy, label FROM lab")
def strat_label(df):
    return folds.strat_labels(df, V, 150)


@query("M4", "harvest", f"""{STRAT.format(m=5)} SELECT {KEYS}, CAST((row_number() OVER (PARTITION BY variedad, label ORDER BY md5(concat_ws('|', {KEYS}, '42')), {KEYS}) - 1) % 5 AS BIGINT) AS fold FROM lab""")
def stratified(df):
    rows = runtime.attach(df, folds.strat_labels(df, V, 5), ["variedad", "fundo", "formato"], check=True)
    return folds.stratified_folds(rows, V, KEY, 5).select(*KEY, "fold")


@query("M4_kfold", "harvest", f"""SELECT {KEYS}, CAST((row_number() OVER (PARTITION BY variedad ORDER BY md5(concat_ws('|', {KEYS}, '42')), {KEYS}) - 1) % 5 AS BIGINT) AS fold FROM harvest""")
def kfold(df):
    return folds.kfolds(df, V, KEY, 5).select(*KEY, "fold")


@query("M5", "harvest", f"""y AS (SELECT *, dense_rank() OVER (PARTITION BY variedad ORDER BY yr DESC) AS back, dense_rank() OVER (PARTITION BY variedad ORDER BY yr) AS fwd FROM (SELECT DISTINCT variedad, year(fecha) AS yr FROM harvest))
SELECT {', '.join('h.' + k for k in KEY)}, y.yr AS test_year, CASE WHEN year(h.fecha) < y.yr THEN 'train' ELSE 'test' END AS role FROM harvest h JOIN y ON h.variedad = y.variedad AND y.back <= 3 AND y.fwd > 2 AND year(h.fecha) <= y.yr""")
def temporal(df):
    return folds.temporal_folds(df, V).select(*KEY, "test_year", "role")


FM = "fm AS (SELECT variedad, fold_id, avg(abs(y_true - y_pred)) AS mae, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse FROM pred GROUP BY 1, 2)"


def _fold_metrics(df):
    e = F.col("y_true") - F.col("y_pred")
    return df.groupBy("variedad", "fold_id").agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"))


@query("M7", "pred", f"{FM} SELECT variedad, round(avg(mae), 6) AS mae_mean, round(avg(rmse), 6) AS rmse_mean, round(stddev_pop(mae), 6) AS mae_std, round(stddev_pop(rmse), 6) AS rmse_std FROM fm GROUP BY 1")
def fold_summary(df):
    return folds.fold_summary(_fold_metrics(df), V, ["mae", "rmse"])


@query("M9", "pred", f"{FM} SELECT variedad, arg_min(fold_id, mae) AS fold_id, round(min(mae), 6) AS mae FROM fm GROUP BY 1")
def best_params(df):
    return folds.best_fold(_fold_metrics(df), V, "fold_id")


@query("M14", "pred", f"SELECT {KEYS}, fold_id, round(y_true, 6) AS y_true, y_pred FROM pred")
def oof_mean(df):
    return df.select(*KEY, "fold_id", "y_true", "y_pred")


@query("M15", "harvest", f"SELECT {KEYS}, CAST('0x' || substr(md5(concat_ws('|', {KEYS}, '42')), 1, 8) AS BIGINT) < {int(0.2 * (1 << 32))} AS is_test FROM harvest")
def split(df):
    return folds.seeded_split(df, KEY).select(*KEY, "is_test")


@query("M16", "pred", f"""f AS (SELECT fundo, formato, avg(y_true) AS p FROM pred WHERE fecha < DATE '{CUT}' GROUP BY 1, 2),
o AS (SELECT variedad, avg(abs((y_pred - y_true) / y_true)) * 100 AS b FROM pred WHERE fecha < DATE '{CUT}' GROUP BY 1),
n AS (SELECT variedad, count(*) AS n_test, avg(abs((p - y_true) / y_true)) * 100 AS a FROM pred JOIN f USING (fundo, formato) WHERE fecha >= DATE '{CUT}' GROUP BY 1)
SELECT variedad, n_test, round(a, 6) AS mape_oos, round(b, 6) AS mape_oof, a > b * 1.2 AS degraded FROM n JOIN o USING (variedad)""")
def holdout(df):
    return folds.holdout_check(df, V, ["fundo", "formato"], CUT)
