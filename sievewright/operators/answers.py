"""Answers of a scorer as columns: shapes, votes, splits, and an offline scorer.

A scorer answers in text, so what it says is parsed, checked and matched to what was offered
like any other input; one that can't be used leaves an ``error`` in its row and stops nothing.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.functions.scalars import clamped_score
from sievewright.operators import gates
from sievewright.sources.lines import json_object

UNKNOWN = "NAO_IDENTIFICADO"
#: Photos that are shown at once, and that a split compares.
TOGETHER = 12


class Scorer(Protocol):
    """Answers for rows of candidates, as text."""

    def ranking(self, candidates: DataFrame) -> DataFrame:
        """candidates (room, file, flags, score) -> (room, answer): a JSON object with ``picks``."""

    def naming(self, candidates: DataFrame) -> DataFrame:
        """candidates (room, file, guess) -> (room, answer): a JSON object with ``ambiente``."""

    def splitting(self, candidates: DataFrame) -> DataFrame:
        """candidates (room, file, group) -> (room, answer): a JSON object with ``comodos``."""


class Offline:
    """Answers from measures alone: the fewest flags, then the best score; the most frequent guess; groups as they are known."""

    def ranking(self, candidates: DataFrame) -> DataFrame:
        order = Window.partitionBy("room").orderBy("flags", F.desc("score"), "file")
        listed = candidates.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= TOGETHER)
        each = F.struct(F.col("__place").alias("place"), F.struct("file", F.lit("measured").alias("reason"), F.greatest(F.lit(0), 10 - F.col("flags")).alias("purpose")).alias("pick"))
        picks = listed.groupBy("room").agg(F.transform(F.array_sort(F.collect_list(each)), lambda x: x["pick"]).alias("picks"))
        return picks.select("room", F.to_json(F.struct("picks")).alias("answer"))

    def naming(self, candidates: DataFrame) -> DataFrame:
        counts = candidates.where("guess is not null").groupBy("room", "guess").agg(F.count("*").alias("n"))
        best = counts.groupBy("room").agg(F.max_by("guess", F.struct("n", "guess")).alias("ambiente"))
        return candidates.select("room").distinct().join(best, "room", "left").select("room", F.to_json(F.struct(F.coalesce("ambiente", F.lit(UNKNOWN)).alias("ambiente"))).alias("answer"))

    def splitting(self, candidates: DataFrame) -> DataFrame:
        groups = candidates.groupBy("room", "group").agg(F.array_sort(F.collect_list("file")).alias("files"))
        return groups.groupBy("room").agg(F.to_json(F.struct(F.collect_list("files").alias("comodos"))).alias("answer"))


def ranking(answer: Column) -> Column:
    """A struct: ``picks`` (file, reason, purpose, staging; scores 0 to 10 or null) in the answer's order, and ``error``."""
    got = json_object(answer, "picks array<struct<file: string, reason: string, purpose: string, staging: string>>")
    picks = F.transform(F.filter(got["picks"], lambda p: F.coalesce(p["file"], F.lit("")) != ""), lambda p: F.struct(p["file"].alias("file"), F.trim(F.coalesce(p["reason"], F.lit(""))).alias("reason"), clamped_score(p["purpose"]).alias("purpose"), clamped_score(p["staging"]).alias("staging")))
    return F.struct(picks.alias("picks"), F.when(got["picks"].isNull(), "no picks in the answer").alias("error"))


def naming(answer: Column) -> Column:
    """A struct: ``ambiente``, ``strays`` (file, ambiente, why) and ``error``."""
    got = json_object(answer, "ambiente string, estranhos array<struct<file: string, ambiente: string, why: string>>")
    return F.struct(got["ambiente"].alias("ambiente"), F.coalesce(got["estranhos"], F.array().cast("array<struct<file: string, ambiente: string, why: string>>")).alias("strays"), F.when(got["ambiente"].isNull(), "no kind in the answer").alias("error"))


def splitting(answer: Column) -> Column:
    """A struct: ``rooms``, lists of files, and ``error``."""
    got = json_object(answer, "comodos array<array<string>>")
    return F.struct(got["comodos"].alias("rooms"), F.when(F.coalesce(F.size(got["comodos"]), F.lit(0)) < 1, "no rooms in the answer").alias("error"))


def retried(first: Column, second: Column, parse) -> Column:
    """The first answer parsed, or the second where the first has an error: asked again once, never more."""
    return F.when(parse(first)["error"].isNull(), parse(first)).otherwise(parse(second))


def chosen(answers: DataFrame, offered: DataFrame, slots: DataFrame, room: str, file: str) -> DataFrame:
    """The picks (room, file, reason, purpose, rank) of parsed answers (room, picks) that were offered, once each, up to the room's slots."""
    claims = answers.select(room, F.posexplode("picks").alias("__at", "__pick")).select(room, "__at", F.col("__pick.file").alias("claim"), "__pick.reason", "__pick.purpose", "__pick.staging")
    found = gates.matched(claims, offered, room, "claim", file).where("match is not null")
    once = found.groupBy(room, "match").agg(F.min_by(F.struct("reason", "purpose", "staging"), "__at").alias("p"), F.min("__at").alias("__at"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy(room).orderBy("__at")))
    return ranked.join(slots.select(room, "slots"), room).where("rank <= slots").select(room, F.col("match").alias(file), "rank", "p.*")


def confirmed(votes: DataFrame, room: str, order: str) -> DataFrame:
    """A labelled room's answers by batch (room, ``order``, mapped, ambiente): the majority's, of equal ones the first; the label's where none can be used; ``corrected`` if it differs, ``split`` if batches disagree."""
    counts = votes.where("ambiente is not null").groupBy(room, "ambiente").agg(F.count("*").alias("n"), F.min(order).alias("first"))
    best = counts.groupBy(room).agg(F.max_by("ambiente", F.struct("n", (-F.col("first")).alias("first"))).alias("answer"), (F.count("*") > 1).alias("split"))
    labels = votes.groupBy(room).agg(F.min("mapped").alias("mapped"))
    out = labels.join(best, room, "left")
    return out.select(room, "mapped", F.coalesce("answer", "mapped").alias("ambiente"), F.coalesce(F.col("answer") != F.col("mapped"), F.lit(False)).alias("corrected"), F.coalesce("split", F.lit(False)).alias("split"))


def dispatched(photos: DataFrame, label: str, order: list[str], room: str = "room", size: int = TOGETHER) -> tuple[DataFrame, DataFrame]:
    """What is asked about: photos of rooms with a label in batches of ``size`` (room, batch), to confirm it, and the others each by itself; a folder is no evidence of what they show."""
    known, unknown = photos.where(F.col(label).isNotNull()), photos.where(F.col(label).isNull())
    place = F.row_number().over(Window.partitionBy(room).orderBy(*order)) - 1
    return known.withColumn("batch", F.floor(place / size).cast("int")), unknown


def named(photos: DataFrame, guess: str) -> DataFrame:
    """Photos without a label, each by its own answer; one that has none is unknown and never takes its neighbours' name."""
    return photos.withColumn("ambiente", F.coalesce(F.col(guess), F.lit(UNKNOWN))).withColumn("failed", F.col(guess).isNull())


def split(claims: DataFrame, photos: DataFrame, room: str, file: str, most: int = TOGETHER) -> DataFrame:
    """photos (room, file) with ``part``, numbered from the largest part on: claims (room, part, file) as offered names. Any doubt leaves one room: a photo unnamed, or more photos than can be compared."""
    told = claims.groupBy(room, file).agg(F.min("part").alias("__part"))
    sized = photos.join(told, [room, file], "left")
    own = Window.partitionBy(room)
    whole = (F.count("*").over(own) <= most) & (F.count("__part").over(own) == F.count("*").over(own))
    sized = sized.withColumn("__part", F.when(whole, F.col("__part")).otherwise(0))
    parts = sized.groupBy(room, "__part").agg(F.count("*").alias("__n"), F.min(file).alias("__first"))
    placed = parts.withColumn("part", F.row_number().over(Window.partitionBy(room).orderBy(F.desc("__n"), "__first")))
    return sized.join(placed.select(room, "__part", "part"), [room, "__part"]).select(*photos.columns, "part")
