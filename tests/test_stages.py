"""The training pipeline: stored in one session, used in another, fitted on its own rows only."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparkyield import roles
from sparkyield.operators import lags
from sparkyield.plans import stages
from sparkyield.sources.fixtures import KEY

ROOT = Path(__file__).resolve().parents[1]
V = ["variedad"]
NUM = roles.NUMERIC
SMALL = {"maxDepth": 3, "numTrees": 4}

OTHER = """
import sys
sys.path[:0] = [{root!r}, {root!r} + "/tests"]
from oracle import session
from pyspark.ml import PipelineModel
spark = session("2")
model = PipelineModel.load({model!r})
model.transform(spark.read.parquet({rows!r})).select("l_orderkey", "l_linenumber", "y_pred").write.parquet({out!r})
"""


@pytest.fixture(scope="module")
def parts(harvest):
    rows = harvest.where("variedad IN ('Brand#1', 'Brand#2')").drop("kg_jr", "h_ef", "fold_id").cache()
    cut = F.col("fecha") < F.to_date(F.lit("2000-07-01"))
    return rows.where(cut), rows.where(~cut)


def test_a_stored_pipeline_scores_in_another_session(parts, tmp_path):
    fitted = stages.harvest_pipeline(KEY, V, NUM, "rf", SMALL, model_by=["variedad"]).fit(parts[0])
    path, rows, out = (str(tmp_path / n) for n in ("model", "rows", "out"))
    fitted.save(path)
    # unknown levels get a prediction, a variety that was not fitted gets none
    odd = parts[1].limit(3).withColumn("l_linenumber", F.lit(90).cast("long"))
    odd = odd.withColumn("fundo", F.lit("new farm")).withColumn("formato", F.lit(None).cast("string"))
    lost = odd.withColumn("l_linenumber", F.lit(91).cast("long")).withColumn("variedad", F.lit("no such"))
    odd, lost = (d.select(*parts[1].columns).withColumn("l_linenumber", F.col("l_linenumber").cast(parts[1].schema["l_linenumber"].dataType)) for d in (odd, lost))
    asked = parts[1].unionByName(odd).unionByName(lost)
    asked.drop("kg_jr_h").write.parquet(rows)
    code = OTHER.format(root=str(ROOT), model=path, rows=rows, out=out)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=600)
    spark = parts[1].sparkSession
    there = spark.read.parquet(out).sort("l_orderkey", "l_linenumber").collect()
    # the target of new rows is there now, and must not matter
    here = fitted.transform(asked).select("l_orderkey", "l_linenumber", "y_pred")
    assert there == here.sort("l_orderkey", "l_linenumber").collect()
    assert len(there) == parts[1].count() + 6
    assert all((r["y_pred"] is None) == (r["l_linenumber"] == 91) for r in there)


def test_lags_of_fitted_rows_are_those_of_training(parts):
    model = stages.LagFeatures(key=KEY, by=V).fit(parts[0])
    want = lags.lag_features(parts[0], KEY, V).select(*KEY, *lags.OUTPUTS).sort(*KEY).collect()
    assert model.transform(parts[0]).select(*KEY, *lags.OUTPUTS).sort(*KEY).collect() == want


def test_validation_rows_do_not_change_the_fit(parts):
    from sparkyield.plans import training

    rows = parts[0].withColumn("inner_fold", F.pmod(F.xxhash64(*KEY), F.lit(2)).cast("int"))
    spoilt = rows.withColumn("kg_ha", F.when(F.col("inner_fold") == 1, F.col("kg_ha") * 1e6).otherwise(F.col("kg_ha")))
    a, b = (
        training.fold_models(r, KEY, V, NUM, 1, "inner_fold", "rf", [SMALL], prepare=lambda: stages.light_preparation(V, NUM))[0] for r in (rows, spoilt)
    )
    train = rows.where("inner_fold = 0")
    names = [*KEY, "y_pred"]
    assert a.transform(train).select(*names).sort(*KEY).collect() == b.transform(train).select(*names).sort(*KEY).collect()
