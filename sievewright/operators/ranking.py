"""Ranking, voting, naming and precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(items: DataFrame, within: list, order: list, name: str = "place") -> DataFrame:
    """Row numbers in ``order``; its last key must be unique, so that no tie is left to chance."""
    return items.withColumn(name, F.row_number().over(Window.partitionBy(*within).orderBy(*order)))


def votes(items: DataFrame, voter: str, choice: str, order: str) -> DataFrame:
    """For each voter: ``majority`` (ties to the choice seen first) and ``mode`` (ties to the later in the alphabet), with the votes for the majority and in all."""
    counts = items.groupBy(voter, choice).agg(F.count("*").alias("n"), F.min(order).alias("seen"))
    return counts.groupBy(voter).agg(
        F.max_by(choice, F.struct("n", (-F.col("seen")).alias("seen"))).alias("majority"), F.max_by(choice, F.struct("n", choice)).alias("mode"), F.max("n").alias("votes"), F.sum("n").alias("asked"))


def strays(items: DataFrame, voter: str, choice: str, winner: DataFrame) -> DataFrame:
    """Votes against the majority, and whether they are few enough (half at most) to be believed."""
    n = items.join(winner.select(voter, "majority"), voter).groupBy(voter).agg(F.count_if(F.col(choice) != F.col("majority")).alias("strays"), F.count("*").alias("asked"))
    return n.withColumn("believed", F.col("strays") * 2 <= F.col("asked"))


def cluster_order(items: DataFrame, room: str, cluster: str, name: str) -> DataFrame:
    """``place`` of each cluster (room, cluster) in its room, by the least name in it. Clusters are ranked, never their items."""
    firsts = items.groupBy(room, cluster).agg(F.min(name).alias("first"))
    return ranked(firsts, [room], ["first", cluster])


def precedence(*answers: tuple[Column, Column]) -> Column:
    """The first answer whose condition holds and that isn't null."""
    return F.coalesce(*(F.when(c, a) for c, a in answers))


def numbered(rooms: DataFrame, kind: str, walk: list) -> DataFrame:
    """``room_no`` along the walk within a kind, and ``kind_no``, the kinds by first appearance. A walk holds rooms, not items."""
    steps = rooms.withColumn("step", F.row_number().over(Window.orderBy(*walk)))
    firsts = steps.withColumn("room_no", F.row_number().over(Window.partitionBy(kind).orderBy("step"))).withColumn("__first", F.min("step").over(Window.partitionBy(kind)))
    return firsts.withColumn("kind_no", F.dense_rank().over(Window.orderBy("__first"))).drop("__first")


def composed_name(kind: Column, room: Column, number: Column) -> Column:
    """KIND_RR_NNNN; null where a number needs more digits, since such a name couldn't be read back."""
    return F.when((room < 100) & (number < 10000), F.format_string("%s_%02d_%04d", kind, room.cast("int"), number.cast("int")))


def parsed_name(name: Column) -> list[Column]:
    """Kind, room and number of a name, without a result's ending; nulls for other names."""
    pattern = "^([A-Z][A-Z_]*)_([0-9]{2})_([0-9]{4})(?:(?:_edit|_final|_enhanced)(?:_[0-9]+)?)?$"
    good = name.rlike(pattern)
    part = lambda i: F.when(good, F.regexp_extract(name, pattern, i))
    return [part(1), part(2).cast("int"), part(3).cast("int")]


def section(name: Column) -> Column:
    """The kind and the room (KIND_RR) under which a name is shown; names that can't be read have a section of their own."""
    kind, room, _ = parsed_name(name)
    return F.struct(F.coalesce(kind, F.lit("SEM_AMBIENTE")).alias("kind"), F.when(kind.isNotNull(), F.format_string("%s_%02d", kind, room)).otherwise("—").alias("room"))


def sort_key(name: Column) -> Column:
    """Sorts names by kind, room and number; those that can't be read come after, by themselves."""
    kind, room, number = parsed_name(name)
    return F.struct(kind.isNull().alias("odd"), F.coalesce(kind, name).alias("kind"), F.coalesce(room, F.lit(0)).alias("room"), F.coalesce(number, F.lit(0)).alias("number"))
