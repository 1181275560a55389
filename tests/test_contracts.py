"""Leakage, scoring, sources and training contracts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkyield import runtime
from sparkyield.operators import champion, folds, lags, load, team
from sparkyield.plans import training
from sparkyield.plans.team_features import person_features
from sparkyield.sources import readers, writers
from sparkyield.sources.fixtures import KEY

V = ["variedad"]
CUT = dt.date(1999, 6, 1)


def pick(df, cols):
    return sorted(map(str, df.select(*cols).collect()))


def test_lags_do_not_see_later_rows(harvest):
    changed = harvest.withColumn("kg_jr_h", F.when(F.col("fecha") >= CUT, F.col("kg_jr_h") * 7).otherwise(F.col("kg_jr_h")))
    cols = [*KEY, *lags.OUTPUTS]
    early = F.col("fecha") < CUT
    a = lags.lag_features(harvest, KEY, V).where(early)
    b = lags.lag_features(changed.repartition(5), KEY, V).where(early)
    assert pick(a, cols) == pick(b, cols)


def test_person_history_does_not_see_its_day(person_day):
    changed = person_day.withColumn("kg", F.when(F.col("fecha") >= CUT, F.col("kg") * 3).otherwise(F.col("kg")))
    cols = [*KEY, "kg_jr_h_hist_avg_30d", "kg_jr_h_hist_dow_avg_120d", "rotado_30d", "bolsa_flag", "sup_kg_jr_h_hist_avg_30d"]
    a, _ = person_features(person_day, KEY)
    b, _ = person_features(changed, KEY)
    upto = F.col("fecha") <= CUT
    digits = [F.round(c, 4).alias(c) if c not in KEY else F.col(c) for c in cols]
    assert pick(a.where(upto), digits) == pick(b.where(upto), digits)


def test_scoring_equals_fit_on_the_same_prefix(harvest):
    old, new = harvest.where(F.col("fecha") < CUT), harvest.where(F.col("fecha") == CUT)
    scored = lags.score_lags(old, new, KEY, V)
    both = lags.lag_features(harvest.where(F.col("fecha") <= CUT), KEY, V).where(F.col("fecha") == CUT)
    cols = [*KEY, "kg_ha_lag_ff_90", "kg_ha_lag_fmt_30", "kg_ha_lag_ff_seasonal", "kg_ha_rel_global_30"]
    assert pick(scored, cols) == pick(both, cols)


def test_weights_have_mean_one(harvest):
    got = folds.sample_weights(harvest, V).groupBy("variedad").agg(F.avg("weight").alias("m"))
    assert got.where(F.abs(F.col("m") - 1) > 1e-9).count() == 0


def test_missing_columns_raise(harvest, person_day):
    with pytest.raises(ValueError):
        load.training_columns(harvest.drop("dpc"), [])
    with pytest.raises(ValueError):
        team.capabilities(person_day.drop("fundo"))
    with pytest.raises(ValueError):
        lags.lag_features(harvest.drop("kg_ha"), KEY, V)
    with pytest.raises(ValueError):
        load.select_varieties(harvest, "Brand#1,absent")


def test_optional_columns_switch_blocks(person_day):
    from sparkyield.plans.team_features import team_features

    slim = person_day.drop("grupo_id", "id_supervisor", "temporadas", "kg", "horas", "formato")
    out = team_features(slim, KEY)
    assert "n_cosechadores" in out.columns and "n_grupos" not in out.columns
    assert out.count() == slim.select("fecha", "fundo").distinct().count()


def test_delimited_sources(spark, tmp_path):
    p = tmp_path / "x.txt"
    p.write_text("Id Cosechador;Fecha;Fundo\n7;2001-02-03;A\n")
    df = readers.normalize_headers(readers.read_delimited(spark, str(p)), {"ID_COSECHADOR": "COSECHADOR_ID"})
    assert df.first().asDict() == {"COSECHADOR_ID": "7", "FECHA": dt.date(2001, 2, 3), "FUNDO": "A"}
    assert readers.to_roles(df).columns == ["worker_id", "fecha", "fundo"]
    (tmp_path / "y.txt").write_text("one\n")
    with pytest.raises(ValueError):
        readers.read_delimited(spark, str(tmp_path / "y.txt"))
    with pytest.raises(ValueError):
        readers.rename_columns(df, "NOPE=x")


def test_fingerprint_ignores_order(harvest):
    cols = harvest.select("variedad", "kg_ha")
    a, b = writers.fingerprint(cols).first(), writers.fingerprint(cols.repartition(9)).first()
    assert a == b and writers.fingerprint(cols.limit(10)).first() != a


def test_champion_order(spark):
    rows = [("v", "a", 0.101, 10.0, 9.0, 5.0), ("v", "b", 0.104, 10.2, 9.0, 1.0), ("v", "c", 0.05, None, None, 9.0)]
    df = spark.createDataFrame(rows, "variedad string, model string, abs_gap double, full_mape double, oof_mape double, seconds double")
    got = [(r["model"], r["reason"]) for r in champion.reasons(df, V).orderBy("rank").collect()]
    assert [m for m, _ in got] == ["c", "b", "a"] and got[0][1] == "campeon" and got[1][1] == "overfitting"


def test_temporal_folds_train_on_the_past(harvest):
    out = folds.temporal_folds(harvest, V, k=2)
    late = out.where((F.col("role") == "train") & (F.year("fecha") >= F.col("test_year")))
    assert late.count() == 0 and out.select("test_year").distinct().count() == 2


def test_training_round_trip(harvest):
    one = harvest.where("variedad = 'Brand#1'")
    feats = ["kg_ha", "dpc", "h_ef"]
    preds, table, params = training.nested_cv(one, KEY, feats, "kg_jr_h", "rf", outer=2, inner=2, trials=1)
    assert preds.count() == one.count() and preds.where("y_pred IS NULL").count() == 0
    assert table.count() == 2 and "numTrees" in params
    models = training.ensemble(one, KEY, feats, "kg_jr_h", "rf", {"maxDepth": 3, "numTrees": 3}, k=2)
    out = training.score_ensemble(models, one)
    assert out.where("y_std < 0 OR y_pred IS NULL").count() == 0
    assert pick(out, [*KEY, "kg_ha"]) == pick(one, [*KEY, "kg_ha"])


def test_plans_have_no_single_task_sort_for_hot_groups(harvest):
    from sparkyield.functions.ordered import blocks

    b = blocks(harvest.select("fecha", *KEY, "kg_ha"), [], ["fecha", *KEY], 30, limit=500)
    out = b.finish(b.df.withColumn("m", F.max("kg_ha").over(b.rows(30))))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_block" in plan


def test_small_tables_are_broadcast_only_after_a_check(harvest):
    assert runtime.rows_up_to(harvest, 10) is False
    assert runtime.rows_up_to(harvest.limit(5), 10) is True
