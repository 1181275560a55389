"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from sparkyield import roles  # noqa: E402
from sparkyield.catalog.similarity import Study  # noqa: E402
from sparkyield.operators import clean, drift, evaluate, folds, lags, profile  # noqa: E402
from sparkyield.plans.team_features import team_features  # noqa: E402
from sparkyield.sources import fixtures  # noqa: E402
from sparkyield.sources.fixtures import KEY  # noqa: E402

V = ["variedad"]
NUM = [*roles.NUMERIC, roles.TARGET]


def cases(spark: SparkSession, sf: str):
    harvest = lambda: fixtures.harvest(spark, sf)
    return {
        "T24_team_features": lambda: team_features(fixtures.person_day(spark, sf), KEY),
        "W13_lag_features": lambda: lags.lag_features(harvest(), KEY, V),
        "D22_drift_report": lambda: drift.drift_severity(drift.drift_report(harvest(), V, NUM), V),
        "K2_distribution_distances": lambda: Study(harvest()).distances(),
        "E7_subgroup_errors": lambda: evaluate.subgroup_errors(
            evaluate.report_bins(fixtures.pred(spark, sf), V), V, evaluate.GROUPINGS
        ),
        "C6_cascade_caps": lambda: clean.apply_caps(
            harvest(), clean.fit_caps(harvest(), NUM, V, ["fundo", "formato"]), NUM
        ),
        "M1_sample_weights": lambda: folds.sample_weights(harvest(), V),
        "D1_numeric_profile": lambda: profile.numeric_profile(harvest(), V, NUM),
    }


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sparkyield-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    fixtures.harvest(spark, sf).count()  # start-up is not measured
    times = {}
    for name, build in cases(spark, sf).items():
        start = time.time()
        build().write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    rows = fixtures.table(spark, sf, "lineitem").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_second": {k: round(rows / t) for k, t in times.items()},
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
