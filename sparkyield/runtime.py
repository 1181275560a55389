"""Session-level services: shared storage, materialised tables and size checks.

Every decision that depends on data volume (broadcast or shuffle, plain window
or blocked window) goes through this module, so that no operator hard-codes an
assumption about how big a table or a group is.
"""

from __future__ import annotations

import atexit
import json
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: rows of one group that a single task may sort in a window
GROUP_ROWS = int(os.environ.get("SPARKYIELD_GROUP_ROWS", 5_000_000))
#: rows of a table that may be broadcast
BROADCAST_ROWS = 500_000

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read, taken from ``spark.checkpoint.dir``.

    A private temporary folder is made only in local mode, where driver and
    executors are one process; it goes with that process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.sparkContext.getCheckpointDir()
    )
    if configured:
        return configured
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="sparkyield-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and pins values that depend on row placement, so that a
    lost executor re-reads the same rows instead of recomputing other ones.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._is_stored = True
    return stored


def rows_up_to(df: DataFrame, limit: int) -> bool:
    """True if ``df`` has at most ``limit`` rows (reads no more than needed)."""
    return df.select(F.lit(1)).limit(limit + 1).count() <= limit


def largest_group(df: DataFrame, by: list[str]) -> int:
    """Row count of the biggest group; one partially aggregated pass."""
    if not by:
        return df.count()
    row = df.groupBy(*by).count().agg(F.max("count")).first()
    return row[0] or 0


def at_once(stored: DataFrame, jobs: int) -> int:
    """How many of ``jobs`` over a stored table run together: several only where one leaves cores idle."""
    files = max(1, len(stored.inputFiles()))
    return max(1, min(jobs, stored.sparkSession.sparkContext.defaultParallelism // files))


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Store a derived table once and mark it for broadcast if its row count allows it.

    Counting a lazy table would compute it twice; the stored copy is counted from
    file metadata and serves both the check and the join.
    """
    stored = materialize(df)
    return F.broadcast(stored) if rows_up_to(stored, limit) else stored


def attach(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", check: bool = False
) -> DataFrame:
    """Join on ``keys`` treating nulls as equal and keep one copy of the keys.

    Without keys ``right`` is a single row, read as a scalar subquery.
    """
    if not keys and how == "left":
        row = right.select(F.struct(*right.columns)).scalar()
        return left.select("*", row.alias("__row")).select(*left.columns, "__row.*")
    if check:
        right = small(right)
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def save_tables(spark: SparkSession, path: str, tables: dict[str, DataFrame], settings: dict) -> None:
    """Write fitted ``tables`` and ``settings`` below ``path``, a folder every executor can reach."""
    for name, table in tables.items():
        table.write.parquet(f"{path}/{name}")
    text = json.dumps({"settings": settings, "tables": list(tables)})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/settings")


def load_tables(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], dict]:
    """What :func:`save_tables` wrote; the tables are read where they lie."""
    kept = json.loads(spark.read.text(f"{path}/settings").first()[0])
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in kept["tables"]}
    for table in tables.values():
        table._is_stored = True
    return tables, kept["settings"]
