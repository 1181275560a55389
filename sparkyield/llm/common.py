"""What the operators of this subpackage share: input, stored steps, components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkyield.runtime import materialize


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def texts(column: pa.Array | pa.ChunkedArray) -> Iterator[str]:
    """The texts of an Arrow column one at a time, null as the empty text."""
    for value in column:
        yield value.as_py() or ""


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut, written to the shared checkpoint folder."""
    return materialize(df)


#: edges of which one task may hold all; more are joined, so that Spark can split a hub
HUB_ROWS = 2_000_000


def _stars(edges: DataFrame, splittable: bool) -> DataFrame:
    """``edges (u, v)`` with ``m``, the smallest ``v`` of their ``u``."""
    if not splittable:
        return edges.withColumn("m", F.min("v").over(Window.partitionBy("u")))
    low = checkpointed(edges.groupBy("u").agg(F.min("v").alias("m")))
    return edges.join(low, "u")


def _step(edges: DataFrame, splittable: bool) -> DataFrame:
    """One round of large-star and small-star over edges ``(u, v)`` with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _stars(both, splittable).where("v > u")
    large = large.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
    if splittable:
        large = checkpointed(large)
    small = _stars(large, splittable)
    end = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    small = small.select(end.alias("u"), F.col("m").alias("v"))
    return checkpointed(small.distinct())


def components(edges: DataFrame, hub_rows: int = HUB_ROWS) -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges (a, b)`` of longs.

    ``root`` is the smallest node of the connected component. Rounds of large-star
    and small-star shorten all paths at once, so their number grows with the
    logarithm of the longest path. Each round is written to the shared folder; only
    a count and a checksum of the edges reach the driver. Edges with a null end and
    loops are left out. Up to ``hub_rows`` edges a window finds the smallest neighbour of
    each node; beyond, a join does, whose hot keys Spark splits. The results are equal.
    """
    edges = edges.where("a <> b")
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = checkpointed(now.distinct())
    mark = None
    while True:
        row = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if row == mark or not row[0]:
            break
        mark = row
        now = _step(now, row[0] > hub_rows)
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
