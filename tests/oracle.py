"""Compare registered queries with their SQL on DuckDB."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def session(cores: str = "*") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sparkyield-check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def kind(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return "bool"
    if hasattr(v, "dtype"):
        v = v.item()
    if isinstance(v, (int, float)):
        return type(v).__name__
    return "other"


def norm(v):
    k = kind(v)
    if k == "null":
        return ""
    if k == "bool":
        return str(bool(v))
    if k in ("int", "float"):
        return repr(float(v))
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return "[" + ",".join(norm(x) for x in v) + "]"
    s = str(v)
    return s[:10] if s.endswith(" 00:00:00") else s


def frame_rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    data = [[norm(v) for v in pdf[c].astype(object)] for c in cols]
    return sorted(zip(*data)) if cols else []


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None if equal, otherwise a short description of the difference."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    for c in got.columns:
        gk = {kind(v) for v in got[c].head(500)} - {"null"}
        wk = {kind(v) for v in want[c].head(500)} - {"null"}
        gi, wi = str(got[c].dtype), str(want[c].dtype)
        loose = got[c].isna().any() and {gk.__repr__(), wk.__repr__()} <= {"{'int'}", "{'float'}"}
        if gi != wi and gk and wk and gk != wk and not loose:
            return f"type of {c}: {gi} {gk} vs {wi} {wk}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    a, b = frame_rows(got), frame_rows(want)
    if a == b:
        return None
    cols = sorted(got.columns)
    sa, sb = set(a), set(b)
    only_a, only_b = sorted(sa - sb), sorted(sb - sa)
    detail = ""
    if only_a and only_b:
        x, y = only_a[0], only_b[0]
        detail = "; ".join(f"{c}: {p} vs {q}" for c, p, q in zip(cols, x, y) if p != q)
    return f"{len(only_a)} rows differ; first: {detail} (row {only_a[:1]})"


def check(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    got = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    if sql is None:
        return len(got), t1 - t0, 0.0, "rows-only"
    want = con.execute(sql).df()
    t2 = time.time()
    return len(got), t1 - t0, t2 - t1, compare(got, want) or "ok"


def main(argv: list[str]) -> None:
    import __spark_entry__ as e

    sf_dir = f"/root/testdata/{argv[0]}"
    names = argv[1:]
    spark, con = session(), connect(sf_dir)
    q, s = e.queries(), e.oracle_sql()
    bad = 0
    for name in names or q:
        for full in [k for k in q if k == name or (name.endswith("*") and k.startswith(name[:-1]))]:
            try:
                n, ts, td, res = check(spark, con, sf_dir, full, q[full], s.get(full))
            except Exception as exc:  # noqa: BLE001 - report and go on
                n, ts, td, res = -1, 0, 0, f"ERROR {type(exc).__name__}: {str(exc)[:600]}"
            bad += res not in ("ok", "rows-only")
            print(f"{full:6s} rows={n:<7d} spark={ts:6.2f}s duck={td:5.2f}s {res}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
