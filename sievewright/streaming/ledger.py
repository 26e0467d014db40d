"""Streaming views: a landing folder, windowed event counts with late data, latest state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.operators.quantiles import quantiles
from sievewright.stages import paired

#: Fixed values.
EVENTS = ("entered", "run", "gate", "left", "stopped")


def landing(spark: SparkSession, path: str, schema, done: str | None = None) -> DataFrame:
    """New Parquet files of a folder; with ``done`` they are moved there once they are processed."""
    reader = spark.readStream.schema(schema)
    if done:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", done)
    return reader.parquet(path)


def event_counts(events: DataFrame, at: str, kind: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by window and kind. In a stream, rows later than ``late`` are dropped and windows close; a batch counts all."""
    timed = events.withWatermark(at, late) if events.isStreaming else events
    return timed.groupBy(F.window(at, window), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")


def latest_state(events: DataFrame, key: str, at: str, kind: str, order: str) -> DataFrame:
    """The last event of each key, ties by ``order``, and how many there were."""
    return events.groupBy(key).agg(F.max_by(kind, F.struct(at, order)).alias("state"), F.count("*").alias("n"))


def checked(events: DataFrame, kind: str) -> DataFrame:
    """Fails on an event whose first word isn't of the closed vocabulary (``run 1`` is ``run``) when it is reached; others pass."""
    bad = ~F.coalesce(F.split_part(F.trim(kind), F.lit(" "), F.lit(1)).isin(*EVENTS), F.lit(False))
    return events.withColumn(kind, F.when(bad, F.raise_error(F.concat(F.lit("unknown event: "), F.coalesce(kind, F.lit("null"))))).otherwise(F.col(kind)))


def funnel(events: DataFrame, key: str, at: str, kind: str, steps: list[str]) -> DataFrame:
    """For each step the keys that reached it and all before it, in time order, and the median seconds since the step before.

    First times are kept by key and step, so a key's events never meet in a list.
    """
    firsts = events.groupBy(key).agg(*(F.min(F.when(F.col(kind) == s, F.col(at))).alias(f"__{i}") for i, s in enumerate(steps)))
    reached, rows = F.lit(True), []
    for i, s in enumerate(steps):
        reached = reached & F.col(f"__{i}").isNotNull() & (F.col(f"__{i}") >= F.col(f"__{i - 1}") if i else F.lit(True))
        took = F.timestamp_diff("SECOND", F.col(f"__{i - 1}"), F.col(f"__{i}")) if i else F.lit(None).cast("long")
        rows.append(F.struct(F.lit(i + 1).alias("place"), F.lit(s).alias("step"), F.coalesce(reached, F.lit(False)).alias("reached"), took.alias("seconds")))
    each = firsts.select(F.inline(F.array(*rows))).where("reached")
    middle = quantiles(each, ["place"], "seconds", {"seconds": 0.5})
    return paired(each.groupBy("place", "step").agg(F.count("*").alias("keys")), middle, ["place"])
