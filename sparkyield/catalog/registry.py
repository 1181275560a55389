"""Registered queries: name, Spark callable and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkyield.functions.scalar import rounded, tie_shift
from sparkyield.sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

VIEWS = {
    "harvest": (fixtures.harvest, fixtures.HARVEST_SQL),
    "person_day": (fixtures.person_day, fixtures.PERSON_SQL),
    "pred": (fixtures.pred, fixtures.PRED_SQL),
}


def off_ties(sql: str) -> str:
    """Shift every ``round(x, d)`` of the text off exact ties, as ``rounded`` does.

    Engines break a tie at the last digit differently. ``ROUND`` is left alone.
    """
    out, i = "", 0
    while (j := sql.find("round(", i)) >= 0:
        k, depth, comma = j + 6, 1, -1
        while depth:
            c = sql[k]
            depth += (c in "([{") - (c in ")]}")
            if c == "," and depth == 1:
                comma = k
            k += 1
        inner = sql[j + 6 : k - 1]
        if comma < 0:
            out += sql[i:j] + "round(" + off_ties(inner) + ")"
        else:
            value, digits = sql[j + 6 : comma], sql[comma + 1 : k - 1].strip()
            out += f"{sql[i:j]}round(({off_ties(value)}) + {tie_shift(int(digits))!r}::DOUBLE, {digits})"
        i = k
    return out + sql[i:]


def query(name: str, view: str | None = None, sql: str | None = None, digits: int = 6):
    """Register a query.

    With ``view`` the function takes that view as a DataFrame, and the SQL text
    (starting after the view's definition) may refer to it by name.
    """

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(VIEWS[view][0](spark, sf_dir)) if view else fn(spark, sf_dir)
            return rounded(df, digits)

        run.__name__ = f"run_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            body = off_ties(sql.strip())
            if view:
                joiner = "\n" if body.upper().startswith("SELECT") else ",\n"
                body = f"WITH {VIEWS[view][1]}{joiner}{body}"
            SQL[name] = body
        return fn

    return add
