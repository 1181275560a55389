"""Shards by jump consistent hashing, with column expressions only.

The jump walk draws from a 64-bit linear congruential generator. Spark's long product
raises on overflow, so the state is kept as two 32-bit halves and multiplied in limbs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkyield.llm.common import checkpointed

# Fixed value: multiplier of the generator of jump consistent hashing.
MULTIPLIER = 2862933555777941757
_LOW, _HIGH = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32
_MASK = 0xFFFFFFFF
#: rows of a shard that one task puts in order
BLOCK_ROWS = 200_000
#: copies of a row that one array holds while they get their slots
COPIES = 100_000


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """State * MULTIPLIER + 1 modulo 2**64, in halves; no step exceeds 2**63."""
    low0, low1 = low.bitwiseAND(F.lit(0xFFFF)), F.shiftright(low, 16)
    part0, part1 = low0 * _LOW, low1 * _LOW
    total = part0 + F.shiftleft(part1.bitwiseAND(F.lit(0xFFFF)), 16) + 1
    # high * _LOW and low * _HIGH are needed modulo 2**32 only
    crossed = lambda x, c: (
        x.bitwiseAND(F.lit(0xFFFF)) * c
        + F.shiftleft((F.shiftright(x, 16) * c).bitwiseAND(F.lit(0xFFFF)), 16)
    )
    up = F.shiftright(part1, 16) + F.shiftright(total, 32) + crossed(high, _LOW) + crossed(low, _HIGH)
    return up.bitwiseAND(F.lit(_MASK)), total.bitwiseAND(F.lit(_MASK))


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of a long ``key``; a further shard takes keys only into itself.

    The walk jumps to ever higher shards, so it ends after at most ``shards`` jumps
    (about their logarithm on average); the rest of the fold does nothing.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(F.lit(_MASK)).alias("low"),
        F.lit(-1).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("jump"),
    )

    def jump(now: Column, _: Column) -> Column:
        high, low = _next(now["high"], now["low"])
        # (2**31) / ((state >> 33) + 1)
        draw = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double")
        target = F.floor((now["jump"] + 1).cast("double") * draw)
        going = now["jump"] < shards
        return F.when(
            going,
            F.struct(
                high.alias("high"),
                low.alias("low"),
                now["jump"].alias("shard"),
                target.alias("jump"),
            ),
        ).otherwise(now)

    walk = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump)
    return walk["shard"].cast("int")


def assign(docs: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """Add the shard of every row; rows are not moved.

    Longs are hashed as they are, other keys by their 64-bit hash; equal keys, null
    included, meet in one shard. A column called ``name`` is replaced.
    """
    column = F.col(f"`{key}`")
    if docs.schema[key].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        column = F.xxhash64(column)
    return docs.withColumn(name, jump_hash(F.coalesce(column.cast("long"), F.lit(0)), shards))


def slots(rows: DataFrame, shard: str, order: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``slot``, gapless from 0 within each shard in the order of the column ``order``.

    Equal rows are counted first, so many copies of one row cost no more than one. The
    order column is cut into ranges, each shard and range is ordered by one task, and
    the ranges' totals give the offsets. Rows that ``order`` leaves equal are ordered
    by all other columns; a null comes first.
    """
    names = [c for c in rows.columns if c != "slot"]
    groups = checkpointed(rows.groupBy(*names).agg(F.count("*").alias("_copies")))
    low, high, total = groups.agg(F.min(order), F.max(order), F.sum("_copies")).first()
    blocks = max(1, (total or 0) // block_rows)
    width = ((high - low) // blocks + 1) if low is not None else 1
    step = F.floor((F.col(order).cast("double") - F.lit(float(low or 0))) / F.lit(float(width)))
    block = F.coalesce(step, F.lit(-1))
    groups = groups.withColumn("_block", block)
    inside = Window.partitionBy(shard, "_block").orderBy(order, *[c for c in names if c != order])
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.withColumn("_inside", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
    earlier = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        groups.groupBy(shard, "_block")
        .agg(F.sum("_copies").alias("_n"))
        .select(shard, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    first = placed.join(offsets, [shard, "_block"]).withColumn(
        "_first", F.col("_offset") + F.col("_inside")
    )
    last = F.col("_first") + F.col("_copies") - 1
    pieces = first.withColumn("_piece", F.explode(F.sequence("_first", last, F.lit(COPIES).cast("long"))))
    upto = F.least("_last", F.col("_piece") + COPIES - 1)
    return (
        pieces.withColumn("_last", last)
        .withColumn("slot", F.explode(F.sequence("_piece", upto)))
        .select(*names, "slot")
    )


def shard_table(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Where every document goes: shard by ``key``, place in the shard, and size.

    ``size`` is the UTF-8 length of the text plus 8 bytes for the id, ``text_crc32`` its
    checksum (null texts count as empty), ``grown_shard`` the shard if there were one
    more. Every row is kept, repeated ones too; a null key is a key like any other and
    hashes as 0. The result is ordered within a shard by ``key``, which must be a long.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    light = docs.select(
        F.col(key),
        (F.octet_length(value) + 8).cast("long").alias("size"),
        F.crc32(value).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    light = assign(assign(light, key, shards), key, shards + 1, "grown_shard")
    return slots(light, "shard", key, block_rows)


def write_shards(docs: DataFrame, key: str, shards: int, path: str) -> None:
    """Write ``docs`` as Parquet, one folder for each shard."""
    assign(docs, key, shards).write.partitionBy("shard").parquet(path)
