"""The number of a row's range: right for every kind of value, and compiled."""

from bisect import bisect_right

import pytest

from sparkyield.functions.ordered import in_ranges


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 21])
def test_ranges_match_bisection(spark, n):
    values = [(s, float(v)) for s in "abc" for v in range(-5, 6)]
    cuts = values[:: max(1, len(values) // n)][:n] if n else []
    df = spark.createDataFrame([*values, (None, 1.0), ("a", None), ("c", float("nan")), ("z", 0.0)], "s string, v double")
    for r in in_ranges(df, ["s", "v"], cuts).collect():
        # null is below and NaN above every number
        low = lambda x: (x is not None, x is not None and x != x, x or 0.0 if x == x else 0.0)
        key = ((r.s is not None, r.s or ""), low(r.v))
        assert r["_part"] == bisect_right([((True, s), low(v)) for s, v in cuts], key)


def test_ranges_are_compiled(spark):
    df = spark.range(100).selectExpr("cast(id as double) AS v")
    out = in_ranges(df, ["v"], [(float(i),) for i in range(1, 90, 3)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan  # a higher-order function is interpreted row by row
    assert [r["_part"] for r in out.orderBy("v").collect()] == [min(30, (i + 2) // 3) for i in range(100)]
