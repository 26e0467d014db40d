"""A contest of a room's items before a scorer, in written rounds."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.operators import answers, gates, quota
from sievewright.sources.lines import json_object
from sievewright.stages import Stages

#: Fixed value: items that are shown at once.
TOGETHER = answers.TOGETHER
#: Heats that one task asks about, unless a round has more of them than its most tasks so can ask; and the number of the last round.
HEATS, TASKS, LAST = 8, 256, 10**6
#: What an answer lists, by kind.
KINDS = {"pick": "parsed.picks", "rejected": "down.rejected", "not room": "down.nao_pertence"}
#: Asks a scorer about (room, slots, items), the items as shown: dicts of file and what else the contenders have. Returns its answer, or raises.
Ask = Callable[[str, int, list[dict]], str]
DISMISSED = "rejected array<struct<file: string, why: string>>, nao_pertence array<struct<file: string, why: string>>"


@dataclass
class Verdicts:
    """What a contest came to, as tables by room and file."""

    #: room, file, rank, reason, purpose, staging: the last round alone decides.
    picks: DataFrame
    #: room, file, why: the first reason for which a file was turned down; picks are none.
    rejected: DataFrame
    #: room, file, why: the first reason for which a file was called foreign to its room. Picks stay: a contradiction is worth seeing.
    not_room: DataFrame
    #: room, claim: what picks named and nobody offered.
    unmatched: DataFrame
    #: room, calls, error: a room with an error has no picks.
    rooms: DataFrame


def _asking(ask: Ask, usable: Callable[[str], bool]):
    """An Arrow function: each heat is asked, and once more where the first answer can't be used or doesn't come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = []
            for heat in batch.to_pylist():
                answer = error = None
                for tries in (1, 2):
                    try:
                        answer, error = ask(heat["room"], min(heat["slots"], len(heat["items"])), heat["items"]), None
                        if usable(answer):
                            break
                        answer, error = None, "the answer can't be used"
                    except Exception as e:  # noqa: BLE001  whatever a scorer raises concerns its heat alone
                        answer, error = None, f"{type(e).__name__}: {e}"
                told.append((heat["heat"], answer, error, tries))
            heat, answer, error, tries = zip(*told) if told else ((),) * 4
            kept = batch.select(["room", "round", "batch", "slots", "items"])
            columns = [*kept.columns, pa.array(heat, pa.string()), pa.array(answer, pa.string()), pa.array(error, pa.string()), pa.array(tries, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [*kept.schema.names, "heat", "answer", "error", "tries"])

    return run


def usable(answer: str) -> bool:
    """Whether there is an object in it."""
    start, end = (answer or "").find("{"), (answer or "").rfind("}")
    try:
        return isinstance(json.loads(answer[start : end + 1]), dict) if 0 <= start < end else False
    except ValueError:
        return False


def contest(items: DataFrame, slots: DataFrame, seed: list, ask: Ask, size: int = TOGETHER, tasks: int = TASKS) -> Verdicts:
    """The best of each room's ``items`` (room, file, ...), as many as its ``slots`` (room, slots) say, by a scorer that sees ``size`` at once.

    While a room has more than ``size`` left, they are dealt into heats by ``seed`` (columns
    with a unique last one) and those that a heat picks go on; a room that makes no progress
    is judged as it stands. The last round shows the first ``size`` of what is left, in the
    order in which they were picked, and its order is the rank.

    A round's heats are rows, asked by tasks of HEATS each, or of more where that would make
    more than ``tasks`` (give more of them to a slow scorer on many cores), and its answers are written before anything is made of them: a lost task asks again for its own heats alone, and no
    later fault asks again at all. A heat that fails twice leaves its error with its room,
    which goes no further. Rooms with no items or no slots aren't asked. A file that is
    there twice is one. The driver knows how many rooms go on, never which.
    """
    spark = items.sparkSession
    stages = Stages(spark, "contest")
    shown = [c for c in items.columns if c != "room"]
    order = [F.expr(o) if isinstance(o, str) else o for o in seed]
    entered = items.dropDuplicates(["room", "file"]).join(slots.where("slots > 0").select("room", F.col("slots").cast("int").alias("slots")), "room")
    left = stages.write("left", entered.withColumns({"place": F.row_number().over(Window.partitionBy("room").orderBy(*order)).cast("long"), "done": F.lit(False)}))
    #: All rounds' answers and what they name, a folder for each; they stay, as the verdicts read them.
    answered: list[DataFrame] = []
    named: list[DataFrame] = []

    def asked(items: DataFrame, heats: int, last: bool) -> tuple[DataFrame, DataFrame]:
        """The answers of a round, and what they name: kind, room, round, batch, at, slots, claim, match, and what is said of it."""
        rows = items.groupBy("room", "slots", "batch").agg(F.array_sort(F.collect_list(F.struct(F.col("at"), F.struct(*shown).alias("item")))).alias("items"))
        rows = rows.withColumns({"items": F.transform("items", lambda x: x["item"]), "round": F.lit(LAST if last else len(answered))}).withColumn("heat", F.to_json(F.struct("room", "round", "batch")))
        rows = rows.select("room", "round", "batch", "slots", "items", "heat")
        schema = rows.schema.add("answer", "string").add("error", "string").add("tries", "integer")
        told = stages.write(f"answers{len(answered)}", rows.repartition(max(1, min(-(-heats // HEATS), tasks)), "room", "batch").mapInArrow(_asking(ask, usable), schema))
        answered.append(told)
        told = told.where("error is null").withColumn("parsed", answers.ranking(F.col("answer"))).withColumn("down", json_object(F.col("answer"), DISMISSED))
        key = ["room", "round", "batch", "heat", "slots"]

        def said(kind: str, field: str):
            scores = lambda x: ((x[c] if kind == "pick" else F.lit(None)).cast("int").alias(c) for c in ("purpose", "staging"))
            return F.transform(field, lambda x, at: F.struct(F.lit(kind).alias("kind"), at.alias("at"), F.coalesce(x["file"], F.lit("")).alias("claim"), F.trim(F.coalesce(x["reason" if kind == "pick" else "why"], F.lit(""))).alias("why"), *scores(x)))

        claims = told.select(*key, F.inline(F.flatten(F.array_compact(F.array(*(said(*k) for k in KINDS.items()))))))
        offered = answered[-1].select("heat", F.explode("items.file").alias("file"))
        named.append(stages.write(f"named{len(named)}", gates.matched(claims, offered, "heat", "claim", "file", bounded=True)))
        return answered[-1], named[-1]

    def picked(named: DataFrame) -> DataFrame:
        """The picks of a round (room, batch, file, rank, why, purpose, staging), once each and as many as slots."""
        first = named.where("kind = 'pick' and match is not null").groupBy("room", "batch", "slots", F.col("match").alias("file")).agg(F.min_by(F.struct("at", "why", "purpose", "staging"), "at").alias("p"))
        ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("room", "batch").orderBy("p.at"))).where("rank <= slots")
        return ranked.select("room", "batch", "file", "rank", "p.why", "p.purpose", "p.staging")

    while True:
        counts = left.groupBy("room").agg(F.count("*").alias("n"), F.max("done").alias("stays"))
        large = counts.where((F.col("n") > size) & ~F.col("stays"))
        heats = large.agg(F.sum(F.ceil(F.col("n") / size))).first()[0]
        if not heats:
            break
        more = left.join(large.select("room", "n"), "room")
        dealt = quota.batches(more, order, size, "room").withColumn("at", F.row_number().over(Window.partitionBy("room", "batch").orderBy(*order)))
        told, claims = asked(dealt, heats, False)
        failed = told.where("error is not null").select("room").distinct()
        survivors = picked(claims).withColumn("next", F.row_number().over(Window.partitionBy("room").orderBy("batch", "rank")).cast("long"))
        survived = survivors.groupBy("room").agg(F.count("*").alias("survived"))
        # Without progress a room stays as it is, and is done; with a failure it is out.
        state = large.join(survived, "room", "left").join(failed, "room", "left_anti").select("room", (F.coalesce("survived", F.lit(0)).between(1, F.col("n") - 1)).alias("goes_on"))
        moved = more.join(state, "room").join(survivors.select("room", "file", "next"), ["room", "file"], "left").where("not goes_on or next is not null")
        moved = moved.withColumns({"place": F.when(F.col("goes_on"), F.col("next")).otherwise(F.col("place")), "done": ~F.col("goes_on")}).select(left.columns)
        left = stages.write("left", left.join(large.select("room"), "room", "left_anti").select(left.columns).unionByName(moved))

    first = left.withColumn("at", F.row_number().over(Window.partitionBy("room").orderBy("place"))).where(F.col("at") <= size).withColumn("batch", F.lit(0))
    _, claims = asked(first, left.select("room").distinct().count(), True)
    picks = stages.write("picks", picked(claims).select("room", "file", "rank", F.col("why").alias("reason"), "purpose", "staging"))
    told, claims = answered[0], named[0]
    for a, n in zip(answered[1:], named[1:]):
        told, claims = told.unionByName(a), claims.unionByName(n)

    def dismissed(kind: str) -> DataFrame:
        found = claims.where((F.col("kind") == kind) & F.col("match").isNotNull())
        return found.groupBy("room", F.col("match").alias("file")).agg(F.min_by("why", F.struct("round", "batch", "at")).alias("why"))

    rooms = told.groupBy("room").agg(F.count("*").alias("calls"), F.min_by("error", F.struct("round", "batch")).alias("error"))
    unmatched = claims.where("kind = 'pick' and match is null").select("room", F.substring("claim", 1, 60).alias("claim")).distinct()
    return Verdicts(picks, dismissed("rejected").join(picks.select("room", "file"), ["room", "file"], "left_anti"), dismissed("not room"), unmatched, rooms)
