"""What kind of delivery a set of files is, from headers and names alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.functions.scalars import first_of
from sievewright.operators.quantiles import quantiles
from sievewright.stages import paired


@dataclass(frozen=True)
class Bounds:
    """Shares that make a delivery raw, bracketed and named, and the sizes of one that was chosen already."""

    raw: float = 0.5
    bracketed: float = 0.2
    named: float = 0.6
    files: int = 60
    per_room: float = 3.0


def rooms(files: DataFrame, delivery: str) -> DataFrame:
    """The histogram of a delivery's rooms: files by (delivery, room), of files that name one."""
    return files.where("room is not null").groupBy(delivery, "room").agg(F.count("*").alias("files"))


def profile(files: DataFrame, delivery: str, bounds: Bounds = Bounds()) -> DataFrame:
    """files, shares of raw, dated, labelled and bracketed ones, rooms, median_per_room and kind of each delivery of ``files`` (raw, dated, bracketed, room).

    D and E: raw files, with or without brackets. A: chosen already, as it has few files and
    few a room, or few files and no names at all. B: files name their rooms. C: they don't, or
    all bear one name. Null flags are false; an empty table gives no rows. Counts are partial
    before they are shuffled, and the median is that of quantiles.
    """
    share = lambda c: (F.count_if(c) / F.count("*")).alias
    shares = files.groupBy(delivery).agg(
        F.count("*").alias("files"), share(F.col("raw"))("raw_share"), share(F.col("dated"))("dated_share"), share(F.col("room").isNotNull())("labelled_share"), share(F.col("bracketed"))("bracket_share"))
    counts = rooms(files, delivery)
    named = paired(counts.groupBy(delivery).agg(F.count("*").alias("rooms")), quantiles(counts, [delivery], "files", {"median_per_room": 0.5}), [delivery])
    out = paired(shares, named, [delivery]).withColumn("rooms", F.coalesce("rooms", F.lit(0)))
    few, raw, named_well = F.col("files") <= bounds.files, F.col("raw_share") >= bounds.raw, F.col("labelled_share") >= bounds.named
    kind = first_of(
        (raw & (F.col("bracket_share") >= bounds.bracketed), "D"), (raw, "E"), (few & (F.col("rooms") > 0) & (F.col("median_per_room") <= bounds.per_room), "A"), (few & (F.col("rooms") == 0), "A"),
        (named_well & (F.col("rooms") == 1), "C"), (named_well, "B"), default="C")
    return out.withColumn("kind", kind)
