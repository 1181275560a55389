"""Choice between trained models, quality gate and run summaries.

Input is one row per (variety, model): ``abs_gap``, ``full_mape``, ``oof_mape``,
``seconds``, ``mae``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkyield import roles


def decision_order() -> list[Column]:
    """Bucketed gap, bucketed MAPE (unknown last), time, then name."""
    mape = F.floor(F.col("full_mape") / roles.MAPE_TIE)
    return [
        F.floor(F.col("abs_gap") / roles.GAP_TIE).asc_nulls_last(),
        mape.asc_nulls_last(),
        F.col("seconds").asc_nulls_last(),
        F.col("model"),
    ]


def ranked(results: DataFrame, by: list[str]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*decision_order())
    return results.withColumn("rank", F.row_number().over(w)).withColumn(
        "is_champion", F.col("rank") == 1
    )


def champions(results: DataFrame, by: list[str]) -> DataFrame:
    return ranked(results, by).where("is_champion")


def reasons(results: DataFrame, by: list[str]) -> DataFrame:
    """Why each rival lost against the champion of its variety."""
    table = ranked(results, by)
    w = Window.partitionBy(*by).orderBy("rank")
    best = {c: F.first(c).over(w) for c in ("abs_gap", "full_mape", "seconds")}
    d = {c: F.col(c) - v for c, v in best.items()}
    reason = (
        F.when(F.col("rank") == 1, "campeon")
        .when(d["abs_gap"] > roles.GAP_TIE, "overfitting")
        .when(d["full_mape"] > roles.MAPE_TIE, "menor estabilidad")
        .when(d["seconds"] > 0, "eficiencia")
        .otherwise("empate")
    )
    return table.withColumn("reason", reason)


def composite_score(mape: Column, gap: Column, mae: Column, gap_weight: float = 0.05) -> Column:
    """Auxiliary score, lower is better; falls back to MAE without a MAPE."""
    over = F.greatest(F.lit(0.0), F.coalesce(gap, F.lit(0.0)))
    return F.when(mape.isNotNull(), mape + gap_weight * over).otherwise(mae + 0.5 * over)


def quality_gate(best: DataFrame) -> DataFrame:
    """Block on the out-of-fold MAPE; a wide gap only warns."""
    ok = F.coalesce(F.col("oof_mape") <= roles.GATE_MAPE, F.lit(False))
    wide = F.col("abs_gap") * 100 > roles.GATE_GAP
    return best.withColumns(
        {
            "passes": ok,
            "gate": F.when(~ok, "rejected").when(wide, "warning").otherwise("passed"),
        }
    )


def run_summary(results: DataFrame, varieties: DataFrame, by: list[str]) -> DataFrame:
    """Champion per variety; varieties without a result are failures."""
    best = quality_gate(champions(results, by))
    out = varieties.join(best.select(*by, "model", "oof_mape", "gate"), by, "left")
    return out.select(
        *by,
        F.coalesce("model", F.lit("")).alias("champion"),
        "oof_mape",
        F.coalesce("gate", F.lit("failed")).alias("status"),
    )


def accept_run(runs: DataFrame, by: list[str], baseline: str, candidate: str) -> DataFrame:
    """Accept if gap <= base + 0.005 and MAPE <= base + 1 point."""
    pick = lambda c, run: F.max(F.when(F.col("run") == run, F.col(c)))
    wide = runs.groupBy(*by).agg(
        *[pick(c, r).alias(f"{c}_{n}") for c in ("abs_gap", "mape") for r, n in ((baseline, "base"), (candidate, "new"))]
    )
    ok = (F.col("abs_gap_new") <= F.col("abs_gap_base") + 0.005) & (
        F.col("mape_new") <= F.col("mape_base") + 1.0
    )
    return wide.withColumn("accepted", F.coalesce(ok, F.lit(False)))
