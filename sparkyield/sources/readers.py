"""Reading delimited and Parquet tables, header normalisation and renaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkyield import roles

SEPARATORS = ["\t", ",", "|", ";"]


def sniff_separator(spark: SparkSession, path: str) -> str:
    """Most frequent separator of the first line."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        raise ValueError(f"{path} is empty")
    counts = {s: first[0][0].count(s) for s in SEPARATORS}
    best = max(SEPARATORS, key=counts.get)
    if counts[best] == 0:
        raise ValueError(f"no separator among tab , | ; in the header of {path}")
    return best


def read_delimited(spark: SparkSession, path: str, sep: str | None = None, schema=None) -> DataFrame:
    """Read a delimited table with a header; text columns unless ``schema`` is given."""
    if sep is None:
        sep = "," if path.rstrip("/").endswith(".csv") else sniff_separator(spark, path)
    reader = spark.read.option("header", True).option("sep", sep)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_table(spark: SparkSession, path: str, sep: str | None = None, schema=None) -> DataFrame:
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return read_delimited(spark, path, sep, schema)


def normalize_headers(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Trim and upper-case headers, join words by ``_``, resolve aliases, cast the date."""
    aliases = roles.PERSON_ALIASES if aliases is None else aliases
    names = [c.strip().upper().replace(" ", "_") for c in df.columns]
    taken = set(names)
    names = [aliases[n] if n in aliases and aliases[n] not in taken else n for n in names]
    out = df.toDF(*names)
    return out.withColumn("FECHA", F.col("FECHA").try_cast("date")) if "FECHA" in names else out


def rename_columns(df: DataFrame, mapping: str) -> DataFrame:
    """Apply ``"OLD=NEW,OLD2=NEW2"``; an unknown source column raises."""
    pairs = {}
    for item in filter(None, (p.strip() for p in mapping.split(","))):
        old, eq, new = (x.strip() for x in item.partition("="))
        if not (eq and old and new):
            raise ValueError(f"expected OLD=NEW, found {item!r}")
        if old not in df.columns:
            raise ValueError(f"unknown column {old!r}; found {df.columns}")
        pairs[old] = new
    return df.withColumnsRenamed(pairs)


def to_roles(df: DataFrame) -> DataFrame:
    """Normalised person-day headers to the role names the operators use."""
    return df.withColumnsRenamed({k: v for k, v in roles.PERSON_ROLES.items() if k in df.columns})
