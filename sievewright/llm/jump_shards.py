"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in DataFrame functions alone.

A key jumps from shard to shard: from shard b to the floor of (b + 1) / u, with u drawn anew
for each jump, and stays where the next jump would leave the shards there are. Draws are
hashes of the key and the number of the jump, so the jumps don't depend on how many shards
there are, and one more shard takes only the keys that jump right onto it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.common import table, write_once

#: Stands for a null key.
NULL_KEY = -(2**63)
#: Values of a draw's integer.
DRAWS = 1 << 52


def drawn(key: Column, jump: Column) -> Column:
    """Above 0 and at most 1."""
    return (F.shiftrightunsigned(F.xxhash64(key, jump), 12) + 1) / F.lit(float(DRAWS))


def jumped(key: Column, shards: int) -> Column:
    """A struct: ``at``, the shard of ``key``, and ``ahead``, where its next jump would lead. Most keys jump about ln(shards) times; none more than ``shards`` times."""
    far = F.lit(shards).cast("long")

    def step(state: Column, i: Column) -> Column:
        # A jump far beyond the shards leads to the same place as one just beyond them.
        ahead = F.least(F.floor((state["ahead"] + 1) / drawn(key, i)), far + 1)
        return F.when(state["ahead"] < far, F.struct(state["ahead"].alias("at"), ahead.alias("ahead"))).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), F.struct(F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("ahead")), step)


def jump_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs`` (doc_id, text).

    ``shard`` depends on doc_id and ``shards`` alone; ``grown_shard`` is the shard among one
    more, which differs from ``shard`` only where it is the new one. ``size``: UTF-8 bytes
    and 16; a null text has no bytes and checksum 0, as the empty one; long texts are read
    where they lie and never moved. Repeated doc_ids share a shard and have slots of their
    own; a null doc_id is a key like any other. Equal rows are told apart by their place, so
    no tie is left open. No rows come of an empty table. Other columns are left out,
    whatever their names.

    Slots are numbered without gaps and without bringing a shard's rows together: rows are
    ranked by shard within the tasks that placed them, and the counts (tasks times shards)
    give each task its start. The rows, some 40 bytes each, are written once, since the
    passes must see the same tasks.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), jumped(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)), shards).alias("to"))
    placed = write_once(rows.select(
        "doc_id", "size", "text_crc32", F.col("to.at").cast("int").alias("shard"), F.when(F.col("to.ahead") == shards, shards).otherwise(F.col("to.at")).cast("int").alias("grown_shard"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "shards")
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("held"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    ranked = placed.withColumn("rank", F.row_number().over(Window.partitionBy("shard", "part").orderBy("place")) - 1)
    return ranked.join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("rank")).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write whole rows of ``docs`` into one folder per shard (doc_id must be unique)."""
    docs.join(placed.select("doc_id", "shard", "slot"), "doc_id").write.partitionBy("shard").parquet(path)


def query(spark, sf_dir):
    return jump_shards(table(spark, sf_dir, "documents"))
