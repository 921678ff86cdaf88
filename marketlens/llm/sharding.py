"""Sharding (native): jump consistent hashing of stable integer keys.

The published algorithm steps a 64-bit linear congruential generator and jumps
from shard to shard until the next jump passes the shard count; no ring table
is kept, and with one more shard a key either stays or moves into the new one.
Spark's `bigint` product raises on overflow, so the generator's state is held
as four 16-bit limbs.

Cases: a null key is placed as key -1; a null text has size 8 and CRC 0; of a
very long text only these two numbers are shuffled; repeated rows share a shard and get different slots; an empty table gives no
rows; other columns pass through, and a result column replaces one of its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, free_name

# Fixed value: the multiplier of the generator in the published algorithm.
MULTIPLIER = 2862933555777941757
LIMBS = [(MULTIPLIER >> s) & 0xFFFF for s in (0, 16, 32, 48)]


def jump_hash(key: Column, shards: int) -> Column:
    """Shard in [0, shards) of a bigint `key`; at most `shards` jumps exist."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    m = [F.lit(x).cast("long") for x in LIMBS]
    k = F.coalesce(key.cast("long"), F.lit(-1).cast("long"))
    low = F.lit(0xFFFF).cast("long")
    start = F.struct(
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
        *[F.shiftrightunsigned(k, s).bitwiseAND(low).alias(f"k{i}")
          for i, s in enumerate((0, 16, 32, 48))])

    def step(acc: Column, _: Column) -> Column:
        x = [acc[f"k{i}"] for i in range(4)]
        # One limb after another of key * MULTIPLIER + 1 modulo 2**64.
        p0 = x[0] * m[0] + 1
        p1 = x[0] * m[1] + x[1] * m[0] + F.shiftright(p0, 16)
        p2 = x[0] * m[2] + x[1] * m[1] + x[2] * m[0] + F.shiftright(p1, 16)
        p3 = x[0] * m[3] + x[1] * m[2] + x[2] * m[1] + x[3] * m[0] + F.shiftright(p2, 16)
        low2, low3 = p2.bitwiseAND(low), p3.bitwiseAND(low)
        top31 = F.shiftleft(low3, 15) + F.shiftright(low2, 1)
        jump = (acc["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (top31 + 1).cast("double"))
        moved = F.struct(acc["j"].alias("b"), F.floor(jump).cast("long").alias("j"),
                         p0.bitwiseAND(low).alias("k0"), p1.bitwiseAND(low).alias("k1"),
                         low2.alias("k2"), low3.alias("k3"))
        return F.when(acc["j"] < shards, moved).otherwise(acc)

    steps = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(steps, start, step, lambda acc: acc["b"]).cast("int")


def assign_shards(df: DataFrame, key: str, shards: int, shard_col: str = "shard",
                  grown_col: str | None = "grown_shard") -> DataFrame:
    """Add each row's shard and, unless `grown_col` is None, its shard with one
    more shard.  A narrow projection: no shuffle, all columns kept."""
    out = df.withColumn(shard_col, jump_hash(F.col(f"`{key}`"), shards))
    if grown_col:
        out = out.withColumn(grown_col, jump_hash(F.col(f"`{key}`"), shards + 1))
    return out


def number_slots(df: DataFrame, shard_col: str = "shard", slot_col: str = "slot",
                 blocks: int | None = None) -> DataFrame:
    """Number the rows of each shard 0, 1, 2, ... without holding a shard in
    one task.

    Rows that are equal in all columns are counted first, then every shard is
    cut into `blocks` hashed blocks (default: the session's shuffle partitions,
    so blocks grow with the cluster's setting).  Block sizes give block
    offsets, a window numbers the rows inside a block, and counts of equal rows
    are expanded last, in chunks, so repeated rows never meet in one task.
    """
    blocks = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.drop(slot_col)
    cols = df.columns
    count, block, first, base, chunk = (free_name(df, n) for n in ("copies", "block", "first", "base", "chunk"))
    size = 65536
    rows = (df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias(count))
            .withColumn(block, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), F.lit(blocks))))
    rows = cut_lineage(rows)  # read twice: for the blocks' sizes and for the numbers
    in_block = Window.partitionBy(shard_col, block).orderBy(*[F.col(f"`{c}`") for c in cols])
    rows = rows.withColumn(first, F.sum(count).over(
        in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(count))
    before = Window.partitionBy(shard_col).orderBy(block)
    bases = (rows.groupBy(shard_col, block).agg(F.sum(count).alias(count))
             .withColumn(base, F.sum(count).over(
                 before.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(count))
             .drop(count))
    placed = rows.join(bases, [shard_col, block]).withColumn(first, F.col(first) + F.col(base))
    chunks = placed.withColumn(chunk, F.explode(
        F.sequence(F.lit(0).cast("long"), F.col(count) - 1, F.lit(size).cast("long"))))
    return chunks.select(
        *[F.col(f"`{c}`") for c in cols],
        F.explode(F.sequence(F.col(first) + F.col(chunk),
                             F.col(first) + F.least(F.col(chunk) + size, F.col(count)) - 1)).alias(slot_col))
