"""Harvest, person-day and prediction views over the test tables.

Each view exists twice: as DataFrame code for Spark and as SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]

HARVEST_SQL = """harvest AS (
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
       p.p_brand AS variedad, CAST(l_shipdate AS DATE) AS fecha,
       l_returnflag AS fundo,
       CASE WHEN l_suppkey % 20 = 0 THEN 'SMALL' ELSE l_linestatus END AS formato,
       l_extendedprice / l_quantity AS kg_jr_h, l_extendedprice AS kg_jr,
       l_quantity AS h_ef, l_quantity * p_size AS kg_ha,
       NULLIF(l_discount, 0) * 100 AS pct_indus,
       CASE WHEN l_tax < 0.035 THEN NULL ELSE l_tax END AS p_baya,
       CAST(p_size AS DOUBLE) AS dpc, CAST(l_linenumber AS DOUBLE) AS ha,
       CAST(EXTRACT(DOY FROM l_shipdate) AS DOUBLE) AS dia_cosecha,
       l_orderkey % 5 AS fold_id
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

PERSON_SQL = """person_day AS (
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
       l_suppkey AS worker_id, CAST(l_shipdate AS DATE) AS fecha,
       l_returnflag AS fundo, l_linestatus AS formato,
       l_partkey % 7 AS grupo_id, l_linenumber AS id_supervisor,
       1 + l_suppkey % 5 AS temporadas, l_extendedprice AS kg,
       CASE WHEN l_discount = 0 THEN 0.0 ELSE l_quantity / 5 END AS horas
FROM lineitem)"""

PRED_SQL = HARVEST_SQL + """, pred AS (
SELECT h.*, kg_jr_h AS y_true,
       round((SUM(kg_jr_h) OVER g - SUM(kg_jr_h) OVER f) / (COUNT(*) OVER g - COUNT(*) OVER f), 6) AS y_pred
FROM harvest h
WINDOW g AS (PARTITION BY fundo, formato), f AS (PARTITION BY fundo, formato, fold_id))"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per harvest, with the unique key of the source rows."""
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    rows = line.join(part, line["l_partkey"] == part["p_partkey"])
    return rows.select(
        *KEY,
        F.col("p_brand").alias("variedad"),
        F.to_date("l_shipdate").alias("fecha"),
        F.col("l_returnflag").alias("fundo"),
        F.when(F.col("l_suppkey") % 20 == 0, "SMALL").otherwise(F.col("l_linestatus")).alias("formato"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("kg_jr_h"),
        F.col("l_extendedprice").alias("kg_jr"),
        F.col("l_quantity").alias("h_ef"),
        (F.col("l_quantity") * F.col("p_size")).alias("kg_ha"),
        (F.nullif(F.col("l_discount"), F.lit(0.0)) * 100).alias("pct_indus"),
        F.when(F.col("l_tax") >= 0.035, F.col("l_tax")).alias("p_baya"),
        F.col("p_size").cast("double").alias("dpc"),
        F.col("l_linenumber").cast("double").alias("ha"),
        F.dayofyear("l_shipdate").cast("double").alias("dia_cosecha"),
        (F.col("l_orderkey") % 5).alias("fold_id"),
    )


def person_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per person, day and task."""
    return table(spark, sf_dir, "lineitem").select(
        *KEY,
        F.col("l_suppkey").alias("worker_id"),
        F.to_date("l_shipdate").alias("fecha"),
        F.col("l_returnflag").alias("fundo"),
        F.col("l_linestatus").alias("formato"),
        (F.col("l_partkey") % 7).alias("grupo_id"),
        F.col("l_linenumber").alias("id_supervisor"),
        (1 + F.col("l_suppkey") % 5).alias("temporadas"),
        F.col("l_extendedprice").alias("kg"),
        F.when(F.col("l_discount") == 0, 0.0).otherwise(F.col("l_quantity") / 5).alias("horas"),
    )


def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harvest rows with an out-of-fold group-mean prediction."""
    from sparkyield.operators.evaluate import out_of_fold_group_mean

    rows = harvest(spark, sf_dir).withColumn("y_true", F.col("kg_jr_h"))
    out = out_of_fold_group_mean(rows, ["fundo", "formato"], "fold_id", "y_true")
    # the sums differ in the last bits between engines
    return out.withColumn("y_pred", F.round("y_pred", 6))
