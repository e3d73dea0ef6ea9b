"""Sharding by jump consistent hashing, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARDS = 24
#: Rows of a numbering block, about: a block is one window partition.
BLOCK_ROWS = 50_000
#: Slots go by turn: doc_id times SPREAD modulo the prime TURNS, so ids far apart or close by fill blocks alike.
TURNS, SPREAD = (1 << 31) - 1, 48271
#: Fixed values of the published algorithm's generator.
MULTIPLIER, MODULUS, HIGH = 2862933555777941757, 1 << 64, 1 << 33


def jump_path(key: Column, shards: int) -> Column:
    """The last jump below `shards` and the last one below `shards + 1`, as a struct (now, grown).

    The jumps of a key do not depend on the number of shards, so one walk gives both. Arithmetic
    modulo 2**64 is done in decimals, as longs would overflow.
    """
    start = F.struct(
        F.pmod(key.cast("decimal(20,0)"), F.lit(str(MODULUS)).cast("decimal(20,0)")).cast("decimal(20,0)").alias("k"),
        F.lit(0).cast("long").alias("now"),
        F.lit(0).cast("long").alias("grown"),
        F.lit(0).cast("long").alias("j"),
    )

    def step(s: Column, _: Column) -> Column:
        k = F.pmod(s["k"] * F.lit(str(MULTIPLIER)).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)"), F.lit(str(MODULUS)).cast("decimal(20,0)")).cast("decimal(20,0)")
        high = F.floor(k / F.lit(HIGH).cast("decimal(20,0)")).cast("double")
        j = F.floor((s["j"] + 1).cast("double") * (F.lit(2147483648.0) / (high + 1))).cast("long")
        now = F.when(s["j"] < shards, s["j"]).otherwise(s["now"])
        moved = F.struct(k.alias("k"), now.alias("now"), s["j"].alias("grown"), j.alias("j"))
        return F.when(s["j"] > shards, s).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(0), F.lit(shards + 1)), start, step, lambda s: F.struct(s["now"].cast("int").alias("now"), s["grown"].cast("int").alias("grown")))


def consistent_shards(docs: DataFrame, shards: int = SHARDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row for each document: doc_id, size, text_crc32, law `key`, shard, slot, grown_shard.

    Only doc_id and the number of shards decide the shard; with one more, rows move into the new shard
    alone. A null doc_id counts as -1 for that. size is the text's UTF-8 bytes (null: none) plus 8, and the
    crc32 of a null text is that of an empty one. Slots count from 0 in each shard by the id's turn
    (doc_id * SPREAD modulo TURNS; null counts as -1), then doc_id, size and crc32: blocks of turns are numbered
    apart and offset by the counts of the blocks before, so that no task holds a shard. Equal rows get
    any order among themselves. No text is shuffled. Other columns are not read; an empty table gives an
    empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    jumps = jump_path(F.coalesce(F.col("doc_id"), F.lit(-1)), shards)
    rows = rows.withColumn("_jump", jumps).select("*", F.col("_jump.now").alias("shard"), F.col("_jump.grown").alias("grown_shard")).drop("_jump")
    turns = F.lit(TURNS).cast("long")
    rows = rows.withColumn("turn", F.pmod(F.pmod(F.coalesce(F.col("doc_id"), F.lit(-1)), turns) * SPREAD, turns))
    counted = docs.agg(F.ceil(F.count(F.lit(1)) / (shards * block_rows)).alias("blocks"))  # one row
    rows = rows.crossJoin(F.broadcast(counted)).withColumn("block", F.floor(F.col("turn") * F.col("blocks") / turns).cast("long")).drop("blocks")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n")).select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "block").orderBy("turn", "doc_id", "size", "text_crc32")
    return (
        rows.withColumn("_n", F.row_number().over(within))
        .join(offsets, ["shard", "block"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("offset") + F.col("_n") - 1).cast("long").alias("slot"), "grown_shard")
    )
