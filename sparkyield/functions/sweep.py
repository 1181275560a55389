"""Value counts of many groups, read in one ascending pass.

All groups share the axis, so a comparison of groups needs no copy of a group's values
for each other group. The counts are cut into ranges of (series, value); the counts below
a range come from the sums of the ranges before it, one row per range and group.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkyield import runtime
from sparkyield.functions.ordered import boundaries, in_ranges

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: count rows a task reads for one range
RANGE_ROWS = 200_000
#: cells of the dense (value, group) arrays a task holds
CELLS = 500_000
#: rows whose weights are summed at once, rows with a vector of weights that a task reads for one range
FOLD_ROWS, VECTOR_ROWS = 50_000, 50_000


def spans(value: np.ndarray, group: np.ndarray, n: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ascending values and their counts per group, a bounded number of values at a time."""
    order = np.argsort(value, kind="stable")
    value, group, n = value[order], group[order], n[order]
    starts = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
    slot = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(value)]))
    size = max(1, CELLS // k)
    for a in range(0, len(starts), size):
        m = min(size, len(starts) - a)
        lo, hi = starts[a], starts[a + m] if a + m < len(starts) else len(value)
        cell = (slot[lo:hi] - a) * k + group[lo:hi]
        yield value[starts[a : a + m]], np.bincount(cell, n[lo:hi], m * k).reshape(m, k)


def sweep(counts: DataFrame, series: list[str], names: list[str], work: Callable, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Partial results and totals over ``counts``, stored rows ``(series..., value, variedad, n)``.

    ``work(chunks, before, total, last)`` gets the chunks of one series within one range,
    the counts per name below the range and over all, and the value before the range
    (None for the first); it returns arrays ``(l, a, x, y)``. The first table has their
    sums per ``(series..., _l, _a)``, the second ``n``, ``lo`` and ``hi`` per series and name.
    """
    spark, limit, names = counts.sparkSession, RANGE_ROWS if limit is None else limit, names or [""]
    total = counts.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(-(-total // limit), min(parts, -(-total // 10_000)))
    order = [*series, "value"]
    cuts = boundaries(counts, order, ranges)
    code = (F.array_position(F.array(*[F.lit(x) for x in names]), F.col("variedad")) - 1).cast("int")
    placed = in_ranges(counts.where(F.col("variedad").isin(names)), order, cuts).select(
        "_part", *series, "value", code.alias("_g"), F.col("n").cast("double").alias("_n")
    )
    here = ["_part", *series]
    per = runtime.materialize(
        placed.groupBy(*here, "_g").agg(F.sum("_n").alias("_n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    )
    # one row per range and name
    cells = per.groupBy(*here).agg(F.max("hi").alias("_top"))
    cells = cells.withColumn("_last", F.lag("_top").over(Window.partitionBy(*series).orderBy("_part")))
    cells = cells.withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))))
    cells = cells.join(per.select(*here, "_g", "_n"), [*here, "_g"], "left")
    whole = Window.partitionBy(*series, "_g")
    past = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        *here, "_last", "_g", F.coalesce(F.sum("_n").over(past), F.lit(0.0)).alias("b"), F.coalesce(F.sum("_n").over(whole), F.lit(0.0)).alias("t")
    )
    state = F.array_sort(F.collect_list(F.struct("_g", "b", "t")))
    heads = runtime.materialize(
        cells.groupBy(*here, "_last").agg(state.alias("_s")).select(*here, "_last", F.col("_s.b").alias("_before"), F.col("_s.t").alias("_total"))
    )
    k = len(names)

    def run(rows: pd.DataFrame, heads: pd.DataFrame) -> pd.DataFrame:
        out = []
        groups = {key: g for key, g in rows.groupby(series, sort=False)}
        for head in heads.itertuples(index=False):
            head = dict(zip(heads.columns, head))
            key = tuple(head[c] for c in series)
            g = groups[key]
            chunks = spans(g["value"].to_numpy(), g["_g"].to_numpy(), g["_n"].to_numpy(), k)
            last = None if pd.isna(head["_last"]) else head["_last"]
            l, a, x, y = work(chunks, np.asarray(head["_before"]), np.asarray(head["_total"]), last)
            out.append(pd.DataFrame({**dict(zip(series, key)), "_l": l, "_a": a, "x": x, "y": y}))
        return pd.concat(out) if out else pd.DataFrame(columns=[*series, "_l", "_a", "x", "y"])

    kinds = ", ".join(f"`{c}` {counts.schema[c].dataType.simpleString()}" for c in series)
    swept = placed.groupBy("_part").cogroup(heads.groupBy("_part")).applyInPandas(run, f"{kinds}, _l int, _a int, x double, y double")
    sums = swept.groupBy(*series, "_l", "_a").agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    totals = per.groupBy(*series, "_g").agg(F.sum("_n").cast("long").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return sums, totals


def _pairs(left: list[int], right: list[int], x: np.ndarray, y: np.ndarray) -> tuple:
    return np.repeat(left, len(right)), np.tile(right, len(left)), x.ravel(), y.ravel()


def area_between(left: list[int], right: list[int]) -> Callable:
    """Area between the distribution functions of each left and right name."""

    def work(chunks, before, total, last):
        area = np.zeros((len(left), len(right)))
        share = np.where(total > 0, total, 1.0)
        for value, n in chunks:
            upto = before + np.cumsum(n, axis=0)
            p = np.vstack([before, upto[:-1]]) / share
            gap = np.diff(value, prepend=value[0] if last is None else last)
            wild = not np.isfinite(gap).all()
            for i, l in enumerate(left):
                apart = np.abs(p[:, [l]] - p[:, right])
                if wild:  # a gap without length counts only where the functions differ
                    area[i] += np.where(apart > 0, apart * gap[:, None], 0.0).sum(axis=0)
                else:
                    area[i] += gap @ apart
            before, last = upto[-1], value[-1]
        return _pairs(left, right, area, np.zeros_like(area))

    return work


def pairs_won(left: list[int], right: list[int]) -> Callable:
    """For each left and right name: U of the left one, and sum of t^3 over their common values' counts t."""

    def work(chunks, before, total, last):
        u = np.zeros((len(left), len(right)))
        cubes = np.zeros_like(u)
        for _, n in chunks:
            upto = before + np.cumsum(n, axis=0)
            one, two = n[:, left], n[:, right]
            u += one.T @ ((upto - n)[:, right] + two / 2)
            cubes += 3 * ((one * one).T @ two + one.T @ (two * two))
            cubes += (one**3).sum(axis=0)[:, None] + (two**3).sum(axis=0)[None, :]
            before = upto[-1]
        return _pairs(left, right, u, cubes)

    return work


def rank_sums(k: int, least: int) -> Callable:
    """Rank sum of each name among all names with ``least`` rows, and the sum of t^3 - t."""

    def work(chunks, before, total, last):
        keep = total >= least
        r, ties, below = np.zeros(k), 0.0, before[keep].sum()
        for _, n in chunks:
            n = n * keep
            t = n.sum(axis=1)
            r += ((below + np.cumsum(t) - t) + (t + 1) / 2) @ n
            ties += (t**3 - t).sum()
            below += t.sum()
        return np.arange(k), np.full(k, -1), r, np.full(k, ties)

    return work


def _vectors(column: pa.ChunkedArray, kind: str, size: int) -> np.ndarray:
    """Binary values of ``size`` numbers each as one array."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, size)


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of an array as binary values."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    ends = pa.array(np.arange(len(rows) + 1, dtype="int32") * width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, ends.buffers()[1], pa.py_buffer(rows.tobytes())])


def weighted_counts(rows: DataFrame, features: list[str], replicates: int, span: int, steps: list[float]) -> DataFrame:
    """``(variedad, variable, value, w)`` of rows with ``draws``, a number below ``span`` for each replicate.

    A row's weight is how many of ``steps`` its draw, as a share of ``span``, reaches. ``w``
    are the sums of weights, 32-bit numbers one after the other. A value comes once for
    every ``FOLD_ROWS`` rows of a task, however many rows have it.
    """
    fold_rows = FOLD_ROWS

    def fold(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables(parts)
        name = table["variedad"].combine_chunks().dictionary_encode()
        code, names = name.indices.to_numpy(), name.dictionary
        draws = table["draws"].combine_chunks().flatten().to_numpy().reshape(-1, replicates)
        w = np.searchsorted(steps, (draws + 0.5) / float(span), side="right").astype("int8")
        for f in features:
            value = table[f].to_numpy()
            order = np.lexsort((value, code))
            c, v = code[order], value[order]
            starts = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (v[1:] != v[:-1])])
            sums = np.add.reduceat(w[order], starts, axis=0, dtype="int32")
            arrays = [names.take(pa.array(c[starts])), pa.array([f] * len(starts)), pa.array(v[starts]), _binary(sums)]
            yield pa.RecordBatch.from_arrays(arrays, ["variedad", "variable", "value", "w"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append(pa.Table.from_batches([batch]))
                n += batch.num_rows
            if n >= fold_rows:
                yield from fold(parts)
                parts, n = [], 0
        if parts:
            yield from fold(parts)

    slim = rows.select("variedad", *[F.col(f).cast("double").alias(f) for f in features], "draws")
    return slim.mapInArrow(work, "variedad string, variable string, value double, w binary")


def replicate_areas(
    counts: DataFrame, names: list[str], left: list[int], right: list[int], replicates: int, limit: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """:func:`sweep` with :func:`area_between` for all replicates at once, ``(variable, _l, _a, rep, x)``, and totals.

    ``counts`` are stored rows ``(variable, value, variedad, n, w)``: names on the left have
    ``w``, their counts in each replicate, those on the right ``n``, the same in all. The
    totals are ``(variable, _g, rep, n, lo, hi)``, of names and replicates that have any row.
    """
    spark, limit, k, r = counts.sparkSession, VECTOR_ROWS if limit is None else limit, len(names), replicates
    total = counts.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = boundaries(counts, ["variable", "value"], max(-(-total // limit), min(parts, -(-total // 10_000))))
    code = (F.array_position(F.array(*[F.lit(x) for x in names]), F.col("variedad")) - 1).cast("int")
    placed = in_ranges(counts.where(F.col("variedad").isin(names)), ["variable", "value"], cuts)
    placed = placed.select("_part", "variable", "value", code.alias("_g"), F.col("n").cast("double").alias("_n"), "w")
    is_left = np.isin(np.arange(k), left)
    cells = CELLS

    def weights(table: pa.Table) -> np.ndarray:
        out = np.empty((table.num_rows, r))
        g = table["_g"].to_numpy()
        mine = is_left[g]
        rows = np.flatnonzero(mine)
        out[rows] = _vectors(table["w"].take(pa.array(rows)), "<i4", r)
        out[~mine] = table["_n"].to_numpy()[~mine][:, None]
        return out

    def of_variables(table: pa.Table):
        for variable in table["variable"].unique().to_pylist():
            some = table.filter(pc.equal(table["variable"], variable))
            yield variable, some.take(pc.sort_indices(some, [("value", "ascending")]))

    def measure(table: pa.Table) -> pa.Table:
        """For each name in a range, per replicate: rows, lowest and highest value."""
        out = []
        for variable, some in of_variables(table):
            w, value, g = weights(some), some["value"].to_numpy(), some["_g"].to_numpy()
            for i in np.unique(g):
                here = g == i
                has, v = w[here] > 0, value[here]
                lo = np.where(has.any(axis=0), v[has.argmax(axis=0)], np.inf)
                hi = np.where(has.any(axis=0), v[::-1][has[::-1].argmax(axis=0)], -np.inf)
                out.append((table["_part"][0].as_py(), variable, int(i), float(v[-1]), w[here].sum(axis=0).tobytes(), lo.tobytes(), hi.tobytes()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), PER)], names=per_names)

    PER = [pa.int32(), pa.string(), pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
    per_names = ["_part", "variable", "_g", "_top", "n", "lo", "hi"]
    per = placed.groupBy("_part").applyInArrow(measure, "_part int, variable string, _g int, _top double, n binary, lo binary, hi binary")
    per = runtime.materialize(per)

    def heads(table: pa.Table) -> pa.Table:
        """For each range of one variable: counts below it, all counts, and the value before it."""
        table = table.take(pc.sort_indices(table, [("_part", "ascending")]))
        part, g, top, n = table["_part"].to_numpy(), table["_g"].to_numpy(), table["_top"].to_numpy(), _vectors(table["n"], "<f8", r)
        before, whole, last, out = np.zeros((k, r)), np.zeros((k, r)), None, []
        np.add.at(whole, g, n)
        for p in np.unique(part):
            here = part == p
            out.append((int(p), table["variable"][0].as_py(), last, before.tobytes()))
            before[g[here]] += n[here]
            last = float(top[here].max())
        cols = [pa.array(c, t) for c, t in zip(zip(*out), [pa.int32(), pa.string(), pa.float64(), pa.binary()])]
        return pa.table([*cols, pa.array([whole.tobytes()] * len(out), pa.binary())], names=["_part", "variable", "_last", "_before", "_total"])

    def ends(table: pa.Table) -> pa.Table:
        out = []
        n, lo, hi = (_vectors(table[c], "<f8", r) for c in ("n", "lo", "hi"))
        g = table["_g"].to_numpy()
        for i in np.unique(g):
            here = g == i
            for j, (a, b, c) in enumerate(zip(n[here].sum(axis=0), lo[here].min(axis=0), hi[here].max(axis=0))):
                if a > 0:
                    out.append((table["variable"][0].as_py(), int(i), j + 1, int(a), b, c))
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64()]
        cols = list(zip(*out)) or [()] * len(kinds)
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], names=["variable", "_g", "rep", "n", "lo", "hi"])

    per_range = per.groupBy("variable").applyInArrow(heads, "_part int, variable string, _last double, _before binary, _total binary")
    totals = per.groupBy("variable").applyInArrow(ends, "variable string, _g int, rep int, n long, lo double, hi double")

    def run(table: pa.Table, tops: pa.Table) -> pa.Table:
        states = {h["variable"]: h for h in tops.to_pylist()}
        out = []
        for variable, some in of_variables(table):
            head = states[variable]
            before, whole = (np.frombuffer(head[c]).reshape(k, r) for c in ("_before", "_total"))
            share = np.where(whole > 0, whole, 1.0)
            w, value, g = weights(some), some["value"].to_numpy(), some["_g"].to_numpy()
            starts = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
            slot = np.cumsum(np.r_[False, value[1:] != value[:-1]])
            values, bounds = value[starts], np.r_[starts, len(value)]
            area, last = np.zeros((len(left), len(right), r)), head["_last"]
            size = max(1, cells // (k * r))
            for a in range(0, len(values), size):
                b = min(a + size, len(values))
                rows = slice(bounds[a], bounds[b])
                n = np.zeros((b - a, k, r))
                np.add.at(n, (slot[rows] - a, g[rows]), w[rows])
                upto = before + np.cumsum(n, axis=0)
                p = np.concatenate([before[None], upto[:-1]]) / share
                gap = np.diff(values[a:b], prepend=values[a] if last is None else last)
                wild = not np.isfinite(gap).all()
                for j, x in enumerate(right):
                    apart = np.abs(p[:, left] - p[:, [x]])
                    if wild:  # a gap without length counts only where the functions differ
                        area[:, j] += np.where(apart > 0, apart * gap[:, None, None], 0.0).sum(axis=0)
                    else:
                        area[:, j] += np.tensordot(gap, apart, axes=1)
                before, last = upto[-1], values[b - 1]
            out.append((variable, area))
        cells_each = len(left) * len(right) * r
        l, a, j = (i.ravel().astype("int32") for i in np.meshgrid(left, right, np.arange(1, r + 1), indexing="ij"))
        one = lambda variable, area: pa.table(
            [pa.array([variable] * cells_each), pa.array(l), pa.array(a), pa.array(j), pa.array(area.ravel())], names=["variable", "_l", "_a", "rep", "x"]
        )
        return pa.concat_tables([one(*o) for o in out])

    swept = placed.groupBy("_part").cogroup(runtime.materialize(per_range).groupBy("_part"))
    swept = swept.applyInArrow(run, "variable string, _l int, _a int, rep int, x double")
    return swept.groupBy("variable", "_l", "_a", "rep").agg(F.sum("x").alias("x")), totals
