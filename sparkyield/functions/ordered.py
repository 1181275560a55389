"""Ordered computations that survive hot groups.

A window partitioned by a key sorts one key's rows in one task. When a key may
hold a third of the table this does not scale, so the helpers here first measure
the largest group. Small groups use the ordinary window. Large ones get an exact
global position from ranges of their full order key and are cut into equal
blocks; the last ``halo`` rows of a block are copied to the next one,
so that a frame of up to ``halo`` preceding rows sees the same rows as before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkyield import runtime

POS = "_pos"
IDX = "_idx"
BLOCK = "_block"
COPY = "_copy"


@dataclass
class Blocks:
    """Rows ready for a frame over at most ``halo`` preceding rows."""

    df: DataFrame
    by: list[str]
    order: list[str]

    def window(self):
        return Window.partitionBy(*self.by).orderBy(*self.order)

    def rows(self, n: int):
        """The previous ``n`` rows, current row excluded."""
        return self.window().rowsBetween(-n, -1)

    def finish(self, df: DataFrame) -> DataFrame:
        """Drop the copied rows and the helper columns."""
        if COPY in df.columns:
            df = df.where(~F.col(COPY))
        return df.drop(COPY, BLOCK)


def boundaries(df: DataFrame, order: list[str], ranges: int) -> list[tuple]:
    """At most ``ranges`` - 1 values of ``order`` that cut ``df`` into near equal parts.

    They come from the rows whose hash of ``order`` falls into a share of the hash
    space, about a hundred for each range; the same rows give the same boundaries.
    """
    keys = df.select(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    total = keys.count()
    if ranges < 2 or not total:
        return []
    share = max(1, total // (ranges * 100))
    names = keys.columns
    mark = F.pmod(F.xxhash64(*names), F.lit(share)) == 0
    sample = keys.where(mark).distinct().orderBy(*names).collect()
    step = max(1, -(-len(sample) // ranges))
    return [tuple(r) for r in sample[step::step]]


def in_ranges(df: DataFrame, order: list[str], cuts: list[tuple], name: str = "_part") -> DataFrame:
    """Add ``name``: how many of the ascending ``cuts`` are not above the row; null is low.

    A binary search with one projection for each halving, so that it is compiled; a
    higher-order function would be interpreted for every row.
    """
    if not cuts:
        return df.withColumn(name, F.lit(0))
    kinds = [df.schema[c].dataType for c in order]
    field = lambda v, i: F.lit(v).cast(kinds[i]).alias(f"o{i}")
    table = F.array(*[F.struct(*[field(v, i) for i, v in enumerate(cut)]) for cut in cuts])
    row = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    out = df.select("*", row.alias("_row"), F.lit(0).alias("_at"))
    for bit in range(len(cuts).bit_length() - 1, -1, -1):
        reached = F.col("_at") + (1 << bit)
        passed = (reached <= len(cuts)) & (F.get(table, reached - 1) <= F.col("_row"))
        out = out.withColumn("_at", F.when(passed, reached).otherwise(F.col("_at")))
    return out.withColumn(name, F.col("_at")).drop("_row", "_at")


def positioned(df: DataFrame, order: list[str]) -> DataFrame:
    """Add ``_pos``, the exact 0-based global position in ``order``.

    It follows from the order columns alone: fixed boundaries cut the rows into
    ranges, each range is ordered by one task, and the row counts of the ranges (one
    row each, hence bounded) give the offsets. Nothing is stored, and a task that
    runs again gives the same positions as long as ``order`` is unique.
    """
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    cuts = boundaries(df, order, parts)
    placed = in_ranges(df, order, cuts)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        placed.withColumn("_slot", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "_part")
        .withColumn(POS, F.col("_offset") + F.col("_slot"))
        .drop("_part", "_slot", "_offset")
    )


def blocks(
    df: DataFrame,
    by: list[str],
    order: list[str],
    halo: int,
    limit: int | None = None,
    largest: int | None = None,
    index: bool = False,
) -> Blocks:
    """Prepare ``df`` for row frames of up to ``halo`` rows within ``by``.

    ``largest`` bounds the biggest group where the caller knows it.
    ``index`` adds ``_idx``, the 0-based position within the group.
    """
    limit = runtime.GROUP_ROWS if limit is None else limit
    if (runtime.largest_group(df, by) if largest is None else largest) <= limit:
        if not by:
            df, by = df.withColumn(BLOCK, F.lit(0)), [BLOCK]
        if index:
            w = Window.partitionBy(*by).orderBy(*order)
            df = df.withColumn(IDX, (F.row_number().over(w) - 1).cast("long"))
        return Blocks(df, by, order)
    size = max(limit, 2 * halo)
    block = F.floor(F.col(POS) / size).cast("long")
    near_end = F.col(POS) % size >= size - halo
    placed = positioned(df, by + order)
    if index:
        starts = placed.groupBy(*by).agg(F.min(POS).alias("_start"))
        placed = runtime.attach(placed, starts, by, check=True)
        placed = placed.withColumn(IDX, F.col(POS) - F.col("_start")).drop("_start")
    cut = (
        placed.withColumn(
            "_targets",
            F.when(near_end, F.array(block, block + 1)).otherwise(F.array(block)),
        )
        .withColumn("_home", block)
        .withColumn(BLOCK, F.explode("_targets"))
        .withColumn(COPY, F.col(BLOCK) != F.col("_home"))
        .drop("_targets", "_home")
    )
    return Blocks(cut.drop(POS), [BLOCK] + by, order)


def running_total(
    df: DataFrame,
    by: list[str],
    order: list[str],
    values: dict[str, Column],
    limit: int | None = None,
    largest: int | None = None,
) -> DataFrame:
    """Inclusive running sums of ``values`` within ``by`` in ``order``.

    ``values`` maps output names to expressions. ``by + order`` must be unique.
    ``largest`` bounds the biggest group where the caller knows it.
    """
    limit = runtime.GROUP_ROWS if limit is None else limit
    upto = Window.unboundedPreceding, Window.currentRow
    if (runtime.largest_group(df, by) if largest is None else largest) <= limit:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(*upto)
        return df.withColumns({k: F.sum(v).over(w) for k, v in values.items()})
    cut = positioned(df, by + order).withColumn(BLOCK, F.floor(F.col(POS) / limit).cast("long"))
    w = Window.partitionBy(BLOCK, *by).orderBy(POS).rowsBetween(*upto)
    inside = cut.withColumns({k: F.sum(v).over(w) for k, v in values.items()})
    # one row per (group, block): groups are cut into at most rows/limit blocks
    wb = Window.partitionBy(*by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy(*by, BLOCK)
        .agg(*[F.sum(v).alias(f"_c_{k}") for k, v in values.items()])
        .withColumns({f"_c_{k}": F.sum(f"_c_{k}").over(wb) for k in values})
    )
    out = runtime.attach(inside, carried, by + [BLOCK], check=True)
    for k in values:
        out = out.withColumn(k, F.col(k) + F.coalesce(F.col(f"_c_{k}"), F.lit(0)))
    return out.drop(POS, BLOCK, *[f"_c_{k}" for k in values])
