"""Person-day histories, supervisor load and lot-day crew features.

Rows are first combined per (worker, day, farm, format). All person windows run
on that table: its size per worker is bounded by calendar days times lots
visited, however many raw rows a worker has. Frames end on the day before, so no
feature sees its own day.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkyield import roles, runtime
from sparkyield.functions import scalar
from sparkyield.functions.quantiles import quantile_rows


@dataclass(frozen=True)
class Capabilities:
    """Which optional blocks the input columns allow."""

    has_format: bool
    has_group: bool
    has_supervisor: bool
    has_seasons: bool
    has_hours: bool
    has_rate: bool
    lot: list[str] = field(default_factory=list)


def capabilities(df: DataFrame, required: list[str] | None = None) -> Capabilities:
    """Check the required columns and derive the capabilities."""
    required = ["worker_id", "fecha", "fundo"] if required is None else required
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; found {df.columns}")
    has = set(df.columns).__contains__
    fmt = has("formato")
    return Capabilities(
        has_format=fmt,
        has_group=has("grupo_id"),
        has_supervisor=has("id_supervisor"),
        has_seasons=has("temporadas"),
        has_hours=has("horas"),
        has_rate=has("kg") and has("horas"),
        lot=["fecha", "fundo"] + (["formato"] if fmt else []),
    )


def person_rate(df: DataFrame) -> DataFrame:
    """Kilograms per hour of the row; null without hours."""
    if "kg" in df.columns and "horas" in df.columns:
        rate = F.when(F.col("horas") != 0, F.col("kg") / F.col("horas"))
    else:
        rate = F.lit(None).cast("double")
    return df.withColumn("kgh", rate)


def person_lot_days(df: DataFrame, key: list[str]) -> DataFrame:
    """Partial sums per (worker, day, farm, format)."""
    caps = capabilities(df)
    df = person_rate(df)
    hours = F.col("horas") if caps.has_hours else F.lit(None).cast("double")
    aggs = [
        F.count("*").alias("n_rows"),
        F.count("kgh").alias("n_kgh"),
        F.sum("kgh").alias("s_kgh"),
        (F.var_pop("kgh") * F.count("kgh")).alias("m2_kgh"),
        F.count(hours).alias("n_hours"),
        F.sum(hours).alias("s_hours"),
        F.min(F.struct(*key)).alias("first_key"),
    ]
    if caps.has_group:
        aggs.append(F.min("grupo_id").alias("lot_group"))
    if caps.has_supervisor:
        aggs.append(F.min("id_supervisor").alias("lot_sup"))
    return (
        df.groupBy("worker_id", *caps.lot)
        .agg(*aggs)
        .withColumn("d", scalar.day_number("fecha"))
        .withColumn("anio", F.year("fecha"))
    )


def person_history(lots: DataFrame, blocks: tuple[str, ...] = ("all",)) -> DataFrame:
    """Histories strictly before the day, on the table of :func:`person_lot_days`.

    ``blocks`` limits the work to the named feature blocks.
    """
    every = "all" in blocks
    want = lambda b: every or b in blocks
    by_day = Window.partitionBy("worker_id").orderBy("d")
    r30 = by_day.rangeBetween(-roles.HISTORY_DAYS, -1)
    r90 = by_day.rangeBetween(-roles.FARMS_DAYS, -1)
    past = by_day.rangeBetween(Window.unboundedPreceding, -1)
    yesterday = by_day.rangeBetween(-1, -1)
    year = Window.partitionBy("worker_id", "anio")
    same_lot = [c for c in ("fundo", "formato") if c in lots.columns]
    out = lots
    if want("history"):
        # squares are taken around the worker's mean, so they do not cancel
        centre = F.avg(F.col("s_kgh") / F.nullif(F.col("n_kgh"), F.lit(0))).over(Window.partitionBy("worker_id"))
        apart = F.col("s_kgh") - F.col("n_kgh") * F.col("_centre")
        squares = F.col("m2_kgh") + apart * apart / F.nullif(F.col("n_kgh"), F.lit(0))
        out = out.withColumn("_centre", centre).withColumns({"_apart": apart, "_squares": squares})
        n, s1, a1, a2 = (F.sum(c).over(r30) for c in ("n_kgh", "s_kgh", "_apart", "_squares"))
        out = out.withColumns(
            {
                "kg_jr_h_hist_avg_30d": s1 / F.nullif(n, F.lit(0)),
                "kg_jr_h_hist_std_30d": scalar.sample_std(n, a1, a2),
            }
        ).drop("_centre", "_apart", "_squares")
    if want("gap"):
        day = Window.partitionBy("worker_id", "d")
        out = out.withColumns(
            {
                "day_gap": F.col("d") - F.max("d").over(past),
                "day_first_key": F.min("first_key").over(day),
            }
        )
    if want("farms"):
        seen30, seen90 = F.collect_set("fundo").over(r30), F.collect_set("fundo").over(r90)
        out = out.withColumns({"_f30": seen30, "_f90": seen90})
        only_today = (F.size("_f30") == 1) & F.array_contains("_f30", F.col("fundo"))
        out = out.withColumns(
            {
                "rotado_30d": F.when((F.size("_f30") == 0) | only_today, 0.0).otherwise(1.0),
                "fundos_visitados_90d": F.when(F.size("_f90") > 0, F.size("_f90").cast("double")),
            }
        ).drop("_f30", "_f90")
    if want("season"):
        out = out.withColumn("primer_dia_anio", F.min("fecha").over(year))
        out = out.withColumn("dia_calc", F.datediff("fecha", "primer_dia_anio").cast("long"))
        out = out.withColumn(
            "nuevo_ingreso_14d", scalar.flag(F.col("dia_calc") <= roles.NEW_ENTRANT_DAYS)
        )
    if want("tenure"):
        out = out.withColumns(
            {
                "tenure_lifetime": (F.dense_rank().over(by_day) - 1).cast("double"),
                "es_primer_anio": scalar.flag(
                    F.col("anio") == F.min("anio").over(Window.partitionBy("worker_id"))
                ),
            }
        )
    if want("weekday"):
        out = out.withColumn("dow", F.dayofweek("fecha"))
        dow = (
            Window.partitionBy("worker_id", "dow")
            .orderBy("d")
            .rangeBetween(-roles.WEEKDAY_DAYS, -1)
        )
        out = out.withColumns(
            {
                "kg_jr_h_hist_dow_avg_120d": F.sum("s_kgh").over(dow)
                / F.nullif(F.sum("n_kgh").over(dow), F.lit(0)),
                "horas_hist_dow_avg_120d": F.sum("s_hours").over(dow)
                / F.nullif(F.sum("n_hours").over(dow), F.lit(0)),
            }
        ).drop("dow")
    if want("continuity"):
        lot_yesterday = (
            Window.partitionBy("worker_id", *same_lot).orderBy("d").rangeBetween(-1, -1)
        )
        cols = {"was_here": F.count("*").over(lot_yesterday) > 0}
        if "lot_group" in lots.columns:
            cols["group_yesterday"] = F.min("lot_group").over(lot_yesterday)
        if "lot_sup" in lots.columns:
            cols["sup_yesterday"] = F.min("lot_sup").over(yesterday)
        out = out.withColumns(cols)
    return out


def with_history(df: DataFrame, history: DataFrame) -> DataFrame:
    """Attach the histories to the person-day rows (one shuffle of the rows)."""
    keys = ["worker_id"] + [c for c in ("fecha", "fundo", "formato") if c in df.columns]
    sums = ["n_rows", "n_kgh", "s_kgh", "m2_kgh", "n_hours", "s_hours", "first_key"]
    extra = [c for c in history.columns if c not in keys and c in df.columns]
    return runtime.attach(df, history.drop(*sums, "lot_group", "lot_sup", *extra), keys)


def days_since_last(df: DataFrame, key: list[str]) -> DataFrame:
    """Days since the person's previous row; later rows of a day give 0."""
    first = F.struct(*key) == F.col("day_first_key")
    return df.withColumn(
        "dias_desde_ultimo", F.when(first, F.col("day_gap")).otherwise(0).cast("double")
    ).drop("day_gap", "day_first_key")


def pool_flags(df: DataFrame) -> DataFrame:
    """(worker, year) pool flag earned in the year before."""
    rate = F.when(F.col("horas") > 0, F.col("kg") / F.col("horas"))
    yearly = df.groupBy("worker_id", F.year("fecha").alias("anio")).agg(F.avg(rate).alias("rate"))
    yearly = runtime.materialize(yearly)
    cuts = quantile_rows(yearly, ["anio"], "rate", [0.75], method="nearest")
    joined = yearly.join(F.broadcast(cuts), "anio", "left")
    return joined.select(
        "worker_id",
        (F.col("anio") + 1).alias("anio"),
        (F.col("rate") >= F.col("q")[0]).cast("long").alias("bolsa_flag"),
    )


def with_pool_flag(df: DataFrame) -> DataFrame:
    """Add ``bolsa_flag``; 0 for people without a year before."""
    if "bolsa_flag" in df.columns:
        return df
    if not ("kg" in df.columns and "horas" in df.columns):
        return df.withColumn("bolsa_flag", F.lit(0).cast("long"))
    out = df.withColumn("_anio", F.year("fecha"))
    flags = pool_flags(df).withColumnRenamed("anio", "_anio")
    return runtime.attach(out, flags, ["worker_id", "_anio"], check=True).withColumn(
        "bolsa_flag", F.coalesce("bolsa_flag", F.lit(0))
    ).drop("_anio")


def quartile_cuts(history: DataFrame) -> DataFrame:
    """Quartiles of the 30-day history per year, keyed by the following year.

    Every person-day row counts, through the row weight of the combined table.
    """
    cuts = quantile_rows(
        history, ["anio"], "kg_jr_h_hist_avg_30d", [0.25, 0.75], weight="n_rows", method="nearest"
    )
    return cuts.select(
        (F.col("anio") + 1).alias("anio"), F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3")
    )


def with_quartile_flags(df: DataFrame, cuts: DataFrame) -> DataFrame:
    """Top and bottom quartile against last year's cuts (one row per year)."""
    hist = F.col("kg_jr_h_hist_avg_30d")
    return (
        df.join(F.broadcast(cuts), "anio", "left")
        .withColumns(
            {
                "top_hist": scalar.flag(hist >= F.col("q3")),
                "bottom_hist": scalar.flag(hist <= F.col("q1")),
            }
        )
        .drop("q1", "q3")
    )


def baseline_residual(df: DataFrame) -> DataFrame:
    """Today's rate against the own baseline."""
    hist, rate = F.col("kg_jr_h_hist_avg_30d"), F.col("kgh")
    df = df.withColumn("kg_jr_h_residual", rate - hist)
    if "temporadas" not in df.columns:
        return df
    low = (
        (F.col("temporadas") >= roles.VETERAN_SEASONS)
        & (hist > 0)
        & (rate < roles.LOW_BASELINE * hist)
    )
    return df.withColumn("veterano_bajo_baseline", scalar.flag(low))


def group_change(df: DataFrame) -> DataFrame:
    """1 if the group differs from yesterday's in the same lot, null if absent."""
    return df.withColumn(
        "cambio_grupo", scalar.flag(F.col("grupo_id") != F.col("group_yesterday"))
    ).drop("group_yesterday")


def same_supervisor(df: DataFrame) -> DataFrame:
    """1 if the supervisor is yesterday's, null if absent yesterday."""
    return df.withColumn(
        "mismo_supervisor_ayer", scalar.flag(F.col("id_supervisor") == F.col("sup_yesterday"))
    ).drop("sup_yesterday")


def supervisor_days(df: DataFrame) -> DataFrame:
    """Load, lots and 30-day history per (supervisor, day)."""
    caps = capabilities(df)
    lot = [c for c in caps.lot if c != "fecha"]
    crew = (
        person_rate(df)
        .groupBy("id_supervisor", "fecha", "worker_id", *lot)
        .agg(F.sum("kgh").alias("s"), F.count("kgh").alias("n"))
    )
    days = crew.groupBy("id_supervisor", "fecha").agg(
        F.count_distinct("worker_id").cast("double").alias("sup_carga_hoy"),
        F.count_distinct(F.struct(*lot)).cast("double").alias("sup_lotes_hoy"),
        (F.sum("s") / F.nullif(F.sum("n"), F.lit(0))).alias("day_rate"),
    )
    w = (
        Window.partitionBy("id_supervisor")
        .orderBy(scalar.day_number("fecha"))
        .rangeBetween(-roles.HISTORY_DAYS, -1)
    )
    return days.withColumns(
        {
            "sup_kg_jr_h_hist_avg_30d": F.avg("day_rate").over(w),
            "sup_kg_jr_h_hist_std_30d": F.stddev_samp("day_rate").over(w),
        }
    ).drop("day_rate")


def crew_continuity(history: DataFrame, lot: list[str]) -> DataFrame:
    """Head count, share of the crew present yesterday, share of yesterday's gone."""
    daily = history.groupBy(*lot).agg(
        F.count("worker_id").alias("n_cosechadores"),
        F.sum(F.col("was_here").cast("long")).alias("_both"),
    )
    where = [c for c in lot if c != "fecha"]
    w = Window.partitionBy(*where).orderBy(scalar.day_number("fecha")).rangeBetween(-1, -1)
    before = F.max("n_cosechadores").over(w)
    return daily.withColumn("_before", before).select(
        *lot,
        "n_cosechadores",
        F.when(F.col("_before") > 0, F.col("_both") / F.col("n_cosechadores")).alias(
            "pct_misma_dotacion_ayer"
        ),
        F.when(
            F.col("_before") > 0, (F.col("_before") - F.col("_both")) / F.col("_before")
        ).alias("pct_desvinculados_ayer"),
    )


def group_composition(df: DataFrame, lot: list[str]) -> DataFrame:
    """Groups per lot, their size and their inner spread."""
    df = person_rate(df)
    aggs = [F.count("*").alias("size")]
    out = [
        F.count("*").alias("n_grupos"),
        F.avg("size").alias("grupo_size_avg"),
        F.stddev_samp("size").alias("grupo_size_std"),
    ]
    if "horas" in df.columns:
        aggs.append(F.stddev_samp("horas").alias("sd_h"))
        out.append(F.avg("sd_h").alias("horas_std_grupo_avg"))
        if "kg" in df.columns:
            aggs += [F.stddev_samp("kgh").alias("sd"), F.avg("kgh").alias("mu")]
            cv = scalar.safe_ratio(F.col("sd"), F.col("mu"))
            out.append(F.avg(cv).alias("kg_jr_h_grupo_cv_avg"))
    return df.groupBy(*lot, "grupo_id").agg(*aggs).groupBy(*lot).agg(*out)


def lot_experience(enriched: DataFrame, lot: list[str]) -> DataFrame:
    """Crew composition per lot-day; every share skips null conditions."""
    has = set(enriched.columns).__contains__
    d = F.col("dia_cosecha_persona")
    aggs = {
        "tenure_avg": F.avg(d),
        "tenure_median": F.percentile(d, 0.5),  # at most 366 distinct values
        "tenure_std": F.stddev_samp(d),
        "tenure_min": F.min(d),
        "tenure_max": F.max(d),
        "pct_novatos": scalar.share(d < roles.NOVICE_DAYS),
        "pct_veteranos": scalar.share(d > roles.VETERAN_DAYS),
    }
    means = {
        "tenure_lifetime_avg": "tenure_lifetime",
        "pct_primer_anio": "es_primer_anio",
        "pct_bolsa": "bolsa_flag",
        "kg_jr_h_hist_avg_30d": "kg_jr_h_hist_avg_30d",
        "kg_jr_h_hist_std_30d": "kg_jr_h_hist_std_30d",
        "pct_top_hist": "top_hist",
        "pct_bottom_hist": "bottom_hist",
        "pct_rotados_30d": "rotado_30d",
        "fundos_visitados_avg_90d": "fundos_visitados_90d",
        "pct_nuevos_ingresos_14d": "nuevo_ingreso_14d",
        "dias_desde_ultimo_trabajo_avg": "dias_desde_ultimo",
        "pct_cambio_grupo": "cambio_grupo",
        "kg_jr_h_hist_dow_avg": "kg_jr_h_hist_dow_avg_120d",
        "kg_jr_h_residual_avg": "kg_jr_h_residual",
        "horas_hist_dow_avg": "horas_hist_dow_avg_120d",
        "pct_veteranos_bajo_baseline": "veterano_bajo_baseline",
        "sup_carga_hoy_avg": "sup_carga_hoy",
        "sup_lotes_hoy_avg": "sup_lotes_hoy",
        "pct_mismo_supervisor_ayer": "mismo_supervisor_ayer",
        "sup_kg_jr_h_hist_avg": "sup_kg_jr_h_hist_avg_30d",
        "sup_kg_jr_h_hist_std": "sup_kg_jr_h_hist_std_30d",
    }
    aggs |= {k: F.avg(v) for k, v in means.items() if has(v)}
    if has("horas"):
        aggs["pct_jornada_parcial"] = scalar.share(F.col("horas") < roles.SHORT_DAY_HOURS)
    if has("temporadas"):
        t = F.col("temporadas")
        aggs |= {
            "temporadas_avg": F.avg(t),
            "temporadas_std": F.stddev_samp(t),
            "pct_temporada_inicial": scalar.share(t == 1),
            "pct_temporadas_veterano": scalar.share(t >= roles.VETERAN_SEASONS),
        }
    return enriched.groupBy(*lot).agg(*[v.alias(k) for k, v in aggs.items()])


def supervisors_per_lot(df: DataFrame, lot: list[str]) -> DataFrame:
    return df.groupBy(*lot).agg(F.count_distinct("id_supervisor").alias("n_supervisores"))


def crew_ratio(lots: DataFrame) -> DataFrame:
    """Workers per supervisor and the over-size flag."""
    ratio = scalar.safe_ratio(
        F.col("n_cosechadores").cast("double"), F.col("n_supervisores").cast("double")
    )
    return lots.withColumn("ratio_cosechadores_por_supervisor", ratio).withColumn(
        "exceso_grupo_flag",
        scalar.flag(F.col("ratio_cosechadores_por_supervisor") > roles.MAX_CREW),
    )
