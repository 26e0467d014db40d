"""Gaps and number sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Numbers of a group that are sorted together; the stretches are then joined at their ends.
STRETCH = 1 << 20


def followed(numbers: DataFrame, group: str, number: str, stretch: int = STRETCH) -> DataFrame:
    """Distinct numbers of each group with ``next``, the one that follows, null for the last.

    Numbers are sorted within stretches of a fixed width, so a group of any size is dealt over
    many tasks; only the first number of each stretch meets those of others.
    """
    once = numbers.select(group, number).where(F.col(number).isNotNull()).distinct().withColumn("__at", F.floor(F.col(number) / stretch))
    own = once.withColumn("__lead", F.lead(number).over(Window.partitionBy(group, "__at").orderBy(number)))
    firsts = once.groupBy(group, "__at").agg(F.min(number).alias("__first"))
    edges = firsts.select(group, "__at", F.lead("__first").over(Window.partitionBy(group).orderBy("__at")).alias("__beyond"))
    return own.join(edges, [group, "__at"]).select(group, number, F.coalesce("__lead", "__beyond").alias("next"))


def sequence_gaps(numbers: DataFrame, group: str, number: str, least: int = 5, alarm: int = 12) -> DataFrame:
    """For each group of ``least`` distinct numbers or more: first, last, present, missing, longest missing run, alarm. The range itself is never listed."""
    hole = F.coalesce(F.col("next") - F.col(number) - 1, F.lit(0))
    found = followed(numbers.where(F.col(group).isNotNull()), group, number).withColumn("hole", hole).groupBy(group).agg(
        F.min(number).alias("first"), F.max(number).alias("last"), F.count("*").alias("present"), F.sum("hole").alias("missing"), F.max("hole").alias("longest"), F.count_if(F.col("hole") > 0).alias("holes"))
    return found.where(F.col("present") >= least).withColumn("alarm", F.col("longest") >= alarm)


def part_holes(parts: DataFrame, group: str, number: str, size: str) -> DataFrame:
    """Missing part numbers, and whether the last part is as large as the mean of the others (0.95): then more may follow. Sizes are summed by number first, so a group's parts never meet in one task. Null groups are one; null numbers belong to no part."""
    each = parts.groupBy(group, number).agg(F.sum(size).alias("s"), F.count(size).alias("n"), F.max(size).alias("most"))
    last = F.max_by(F.struct("s", "n", "most"), number)
    own = each.groupBy(group).agg(F.max(number).alias("last"), (F.max(number) - F.min(number) + 1 - F.count(number)).alias("missing"), last.alias("l"), *(F.sum(F.when(F.col(number).isNotNull(), F.col(c))).alias(c) for c in ("s", "n")))
    others = (F.col("s") - F.coalesce("l.s", F.lit(0))) / F.nullif(F.col("n") - F.col("l.n"), F.lit(0))
    return own.select(group, "last", "missing", F.coalesce(F.col("l.most") >= 0.95 * others, F.lit(False)).alias("may_go_on"))
