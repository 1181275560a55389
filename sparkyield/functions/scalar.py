"""Column expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``; null unless the denominator is positive."""
    return F.when(den > 0, num / den)


def day_number(col: str | Column) -> Column:
    """Days since 1970-01-01 as an integer, usable in range frames."""
    return F.unix_date(F.to_date(col))


def flag(cond: Column) -> Column:
    """0/1 double; null where the condition is null."""
    return cond.cast("double")


def share(cond: Column) -> Column:
    """Mean of a condition, rows with a null condition left out."""
    return F.avg(flag(cond))


def sample_skew(n: Column, g1: Column) -> Column:
    """Bias-corrected skewness from the population one."""
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(n: Column, g2: Column) -> Column:
    """Bias-corrected excess kurtosis from the population one."""
    return F.when(n > 3, ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)))


def sample_std(n: Column, s1: Column, s2: Column) -> Column:
    """Sample standard deviation from count, sum and sum of squares."""
    return F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), (s2 - s1 * s1 / n) / (n - 1))))


def tie_shift(digits: int) -> float:
    """A step far below the last digit that moves a value off a rounding tie."""
    return 1.3e-3 * 10.0**-digits


def cut(col: str, digits: int) -> Column:
    """The column rounded as in :func:`rounded`, under its own name."""
    return F.round(F.col(col) + tie_shift(digits), digits).alias(col)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles and widen integers, the form used for result comparison."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind in ("double", "float") or kind.startswith("decimal"):
            # adding zero turns a rounded -0.0 into 0.0
            c = F.round(c.cast("double") + tie_shift(digits), digits) + F.lit(0.0)
        elif kind in ("integer", "short", "byte"):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)
