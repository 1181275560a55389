"""Writing feature tables, audit rows, statistics and mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkyield import roles


def write_features(df: DataFrame, path: str, by: str | None = roles.VARIETY) -> None:
    """Parquet, one folder per variety where the table has one.

    A big variety is written by many tasks; nothing is gathered per folder.
    """
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by in df.columns else writer).parquet(path)


def append_audit(spark: SparkSession, row: dict, path: str) -> None:
    """Append one JSON line describing a run."""
    spark.createDataFrame([row]).coalesce(1).write.mode("append").json(path)


def write_stats(stats: DataFrame, path: str) -> None:
    """Append long statistics rows ``(variedad, generated_at, section, name, metric, value)``."""
    stats.write.mode("append").json(path)


STATS_SCHEMA = "variedad string, generated_at string, section string, name string, metric string, value double, label string"


def drift_summary(stats: DataFrame) -> DataFrame:
    """Summary of each variety's newest statistics: worst PSI, severe drift, findings."""
    newest = stats.groupBy("variedad").agg(F.max("generated_at").alias("generated_at"))
    rows = stats.join(newest, ["variedad", "generated_at"], "left_semi")
    severe = (F.col("section") == "drift") & (F.col("label") == "severo")
    return rows.groupBy("variedad").agg(
        F.max("generated_at").alias("eda_generated_at"),
        F.coalesce(
            F.max(F.when((F.col("section") == "drift") & (F.col("metric") == "max_psi"), F.col("value"))),
            F.lit(0.0),
        ).alias("drift_psi_max"),
        F.count(F.when(severe, 1)).alias("drift_severe_count"),
        F.array_join(F.array_sort(F.collect_set(F.when(severe, F.col("name")))), ",").alias("drift_severe_vars"),
        F.count(F.when((F.col("section") == "finding") & (F.col("label") == "high"), 1)).alias("eda_findings_high"),
    )


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive content hash and row count.

    The hash skips nulls, so which values are null is hashed with them, and so are the
    names and types of the columns.
    """
    schema = F.lit(",".join(f"{n}:{t}" for n, t in df.dtypes))
    values = [F.col(f"`{c}`") for c in df.columns]
    row = F.xxhash64(schema, *[x for v in values for x in (v.isNull(), v)])
    return df.agg(
        F.bit_xor(row).alias("content_xor"),
        F.sum(F.pmod(row, F.lit(1_000_003))).alias("content_sum"),
        F.count("*").alias("n_rows"),
    )


def export_mapping(result: DataFrame, path: str) -> None:
    """Assignment table and the variety-to-model mapping as CSV folders."""
    cols = ["variedad", "n_filas", "zona", "entrena_con", "distancia_wass", "nota"]
    result.select(*cols).write.mode("overwrite").option("header", True).csv(f"{path}/assignment")
    result.select("variedad", "entrena_con").write.mode("overwrite").option("header", True).csv(f"{path}/mapping")
