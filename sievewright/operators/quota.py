"""Quota allocation in closed form, and filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def allocate(rooms: DataFrame, base: int, lo: int, hi: int) -> DataFrame:
    """``slots`` for each row of ``rooms`` (room, priority, angles).

    A room starts with ``base`` slots, or its angles if fewer. Below ``lo`` in all, further
    slots are granted in rounds, by (round, priority, room), up to a room's angles; above
    ``hi``, slots go by (priority from the last, round, room), down to one. Units of either
    kind are numbered in that order, so a cut of the numbers is the whole loop. Rooms times
    slots are numbered in one task; items never are.
    """
    sized = rooms.select("room", "priority", F.col("angles").cast("int").alias("angles")).withColumn("base", F.least(F.lit(base), "angles"))

    def granted(units: DataFrame, order: list, room_for) -> DataFrame:
        ranked = units.withColumn("unit", F.row_number().over(Window.orderBy(*order)))
        return ranked.join(F.broadcast(room_for), F.col("unit") <= F.col("free")).groupBy("room").agg(F.count("*").cast("int").alias("moved"))

    missing = sized.agg(F.greatest(F.lit(0), F.lit(lo) - F.sum("base")).alias("free"))
    units = sized.where("angles > base").select("room", "priority", F.explode(F.sequence(F.lit(1), F.col("angles") - F.col("base"))).alias("turn"))
    grown = sized.join(granted(units, ["turn", "priority", "room"], missing), "room", "left").withColumn("slots", F.col("base") + F.coalesce("moved", F.lit(0))).drop("moved")
    excess = grown.agg(F.greatest(F.lit(0), F.sum("slots") - F.lit(hi)).alias("free"))
    units = grown.where("slots > 1").select("room", "priority", F.explode(F.sequence(F.lit(1), F.col("slots") - 1)).alias("turn"))
    cut = granted(units, [F.desc("priority"), "turn", "room"], excess)
    return grown.join(cut, "room", "left").select("room", "priority", "angles", (F.col("slots") - F.coalesce("moved", F.lit(0))).alias("slots"))


def fill(leaders: DataFrame, slots: DataFrame, order: list) -> DataFrame:
    """Unflagged cluster leaders (room, flags, ...) in ``order`` within a room, up to its slots, with ``pick_rank``. Cut by the most slots of any room first, so that each task keeps only its best."""
    most = slots.agg(F.coalesce(F.max("slots"), F.lit(0))).first()[0]
    ranked = leaders.where("flags = 0").withColumn("pick_rank", F.row_number().over(Window.partitionBy("room").orderBy(*order))).where(F.col("pick_rank") <= most)
    return ranked.join(slots.select("room", "slots"), "room").where("pick_rank <= slots")


def batches(items: DataFrame, order: list, size: int, room: str | None = None) -> DataFrame:
    """``batch`` for each item of a room: dealt round robin into as few batches as ``size`` allows, so each gets strong and weak ones.

    Ranks are within a room: for the contenders of a contest, not for items of a corpus.
    """
    within = Window.partitionBy(room) if room else Window.partitionBy()
    placed = items.withColumns({"place": F.row_number().over(within.orderBy(*order)) - 1, "n_batches": F.ceil(F.count("*").over(within) / size).cast("int")})
    return placed.withColumn("batch", (F.col("place") % F.col("n_batches")).cast("int"))


def tournament(items: DataFrame, room: str, slots: int, size: int, seed: list, order: list) -> DataFrame:
    """Each room's first ``slots`` items, ranked by ``order`` in the last heat alone.

    While a room has more than ``size`` left, they are dealt into heats by ``seed`` and each
    heat keeps its first ``slots`` by ``order``; rooms with fewer wait for the final. It ends
    where nothing is thrown out any more; the final then takes the first ``size`` by ``seed``.
    Both orders need a unique last key. The driver knows how many are left, never which.
    """
    left, before = items, None
    while True:
        n = F.count("*").over(Window.partitionBy(room))
        total, most = left.withColumn("__n", n).agg(F.count("*"), F.max("__n")).first()
        if not total or most <= size or total == before:
            break
        before = total
        dealt = batches(left.withColumn("__n", n), seed, size, room)
        heat = F.row_number().over(Window.partitionBy(room, "batch").orderBy(*order))
        left = dealt.withColumn("__heat", heat).where((F.col("__n") <= size) | (F.col("__heat") <= slots)).select(items.columns)
    final = left.withColumn("__seed", F.row_number().over(Window.partitionBy(room).orderBy(*seed))).where(F.col("__seed") <= size)
    return final.withColumn("rank", F.row_number().over(Window.partitionBy(room).orderBy(*order))).where(F.col("rank") <= slots).drop("__seed")
