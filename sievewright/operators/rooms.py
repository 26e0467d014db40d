"""Rooms, their keys and answers: catalogue rows, hints, settled rooms, picks, delivery kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.operators import sequences

UNKNOWN = "NAO_IDENTIFICADO"
#: Fixed value: where rooms and areas without a number stand.
LAST = 99


def first_hit(scenes: DataFrame, scene: str, frames: str, catalog: DataFrame, key: str) -> DataFrame:
    """Each scene with the catalogue's row of the first of its ``frames`` (an array of keys) that has one, under ``row``; null without.

    Frames are joined by key and only the best place is kept, so a scene of many frames is never listed anew.
    """
    asked = scenes.select(scene, F.posexplode(frames).alias("__place", key))
    known = catalog.select(key, F.struct(*[c for c in catalog.columns if c != key]).alias("row"))
    hits = asked.join(known, key).groupBy(scene).agg(F.min_by("row", "__place").alias("row"))
    return scenes.join(hits, scene, "left")


def last_row(catalog: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with one key the last: what stands lower in the file holds."""
    return catalog.groupBy(key).agg(F.max_by(F.struct(*[c for c in catalog.columns if c != key]), order).alias("__row")).select(key, "__row.*")


def edited(answer: Column, seen: Column) -> Column:
    """A person changed the answer away from what the check saw."""
    return (F.coalesce(seen, F.lit("")) != "") & (answer != seen)


def applied(scenes: DataFrame, only_edited: bool) -> DataFrame:
    """Scenes (ambiente, seen, source, note, row) with the row's answer: of any row, or only of edited ones. What the check saw is the row's."""
    row = F.col("row")
    hand = edited(row["ambiente"], row["seen"])
    use = row.isNotNull() & (hand if only_edited else F.lit(True))
    return scenes.withColumns({
        "ambiente": F.when(use, row["ambiente"]).otherwise(F.col("ambiente")), "seen": F.when(use, row["seen"]).otherwise(F.col("seen")),
        "source": F.when(use, F.when(hand, "manual").otherwise(row["source"])).otherwise(F.col("source")), "note": F.when(use, row["note"]).otherwise(F.col("note")), "landed": use})


def room_hint(ambiente: Column, row: Column, hint: Column) -> Column:
    """The number of a room among those of its kind: the row's while it isn't edited and its kind still holds, else the hint, else 1."""
    valid = row.isNotNull() & ~edited(row["ambiente"], row["seen"]) & row["ambiente"].eqNullSafe(ambiente)
    return F.coalesce(F.when(valid, row["room_no"]), hint, F.lit(1))


def settled(frames: DataFrame, room: str) -> DataFrame:
    """``settled`` for each room: every frame (ambiente, seen; null where it has no row) was edited by hand, and all to one answer."""
    hand = F.coalesce(edited(F.col("ambiente"), F.col("seen")), F.lit(False))
    out = frames.groupBy(room).agg(F.bool_and(hand).alias("__all"), F.count_distinct(F.when(hand, F.col("ambiente"))).alias("__answers"), F.min(F.when(hand, F.col("ambiente"))).alias("answer"))
    return out.select(room, (F.col("__all") & (F.col("__answers") == 1)).alias("settled"), F.when(F.col("__all") & (F.col("__answers") == 1), F.col("answer")).alias("answer"))


def distinguished(scenes: DataFrame) -> DataFrame:
    """(area, ambiente) whose labels, null and empty ones aside, name more than one room."""
    label = F.when(F.coalesce("room", F.lit("")) != "", F.struct(F.coalesce("room_order", F.lit(-1)), "room"))
    own = scenes.groupBy(F.coalesce("area", F.lit("")).alias("area"), F.coalesce("ambiente", F.lit("")).alias("ambiente")).agg(F.count_distinct(label).alias("labels"))
    return own.where("labels > 1")


def keyed(scenes: DataFrame, hint: Column) -> DataFrame:
    """Scenes with ``room_key``, a struct that sorts as the walk: the label counts only where labels distinguish rooms."""
    own = distinguished(scenes).select(F.col("area").alias("__area"), F.col("ambiente").alias("__ambiente"), F.lit(True).alias("__split"))
    area, kind = F.coalesce("area", F.lit("")), F.coalesce("ambiente", F.lit(""))
    joined = scenes.join(own, (area == F.col("__area")) & (kind == F.col("__ambiente")), "left")
    split = F.coalesce("__split", F.lit(False))
    key = F.struct(
        F.coalesce("area_order", F.lit(LAST)).alias("area_order"), area.alias("area"), F.when(split, F.coalesce("room_order", F.lit(LAST))).otherwise(LAST).alias("room_order"),
        F.when(split, F.when(F.coalesce("room", F.lit("")) == "", "unlabelled").otherwise(F.col("room"))).otherwise("").alias("room"), kind.alias("ambiente"), hint.alias("hint"))
    return joined.withColumn("room_key", key).drop("__area", "__ambiente", "__split")


def walked(scenes: DataFrame) -> DataFrame:
    """One row for each ``room_key``: scenes, ``room_no`` among its kind along the walk, ``kind_no`` by first appearance. Rooms are few: their walk is numbered in one task."""
    rooms = scenes.groupBy("room_key").agg(F.count("*").alias("scenes"))
    kind = F.when(F.col("room_key.ambiente") == "", UNKNOWN).otherwise(F.col("room_key.ambiente"))
    steps = rooms.withColumn("kind", kind).withColumn("step", F.row_number().over(Window.orderBy("room_key")))
    firsts = steps.withColumns({"room_no": F.row_number().over(Window.partitionBy("kind").orderBy("step")), "__first": F.min("step").over(Window.partitionBy("kind"))})
    return firsts.withColumn("kind_no", F.dense_rank().over(Window.orderBy("__first"))).drop("__first")


def split_order(groups: DataFrame, kind: str, size: str, name: str) -> DataFrame:
    """``room_no`` of rooms that one kind was split into: the largest first, then by the least name."""
    return groups.withColumn("room_no", F.row_number().over(Window.partitionBy(kind).orderBy(F.desc(size), name)))


def next_free(used: DataFrame, kind: str, number: str) -> DataFrame:
    """The least number from 1 that each kind doesn't use. Numbers are sorted in stretches, so that a kind of any size is dealt over many tasks."""
    kinds = used.select(kind).distinct()
    # With 0 before them all, the first number that isn't followed by the next one is the one before the gap.
    own = used.where(F.col(number) >= 1).select(kind, F.col(number).cast("long").alias("__n")).unionByName(kinds.select(kind, F.lit(0).cast("long").alias("__n")))
    gaps = sequences.followed(own, kind, "__n").where("next is null or next > __n + 1").groupBy(kind).agg((F.min("__n") + 1).alias("__free"))
    return kinds.join(gaps, kind, "left").select(kind, F.coalesce("__free", F.lit(1)).cast("int").alias("free"))


def next_number(rows: DataFrame, key: str, number: str) -> DataFrame:
    """One more than the greatest number of each key; 1 where none is known."""
    return rows.groupBy(key).agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("next"))


def picked(scenes: DataFrame, first_frame: str, picks: DataFrame, key: str) -> DataFrame:
    """``chosen`` by the picks alone, noes included, with their note; without any pick as it was (a column ``chosen``)."""
    if picks.isEmpty():
        return scenes.withColumn("pick_note", F.lit(None).cast("string"))
    known = picks.groupBy(F.col(key).alias(first_frame)).agg(F.min("note").alias("__note")).withColumn("__hit", F.lit(True))
    out = scenes.join(known, first_frame, "left")
    return out.withColumns({"chosen": F.coalesce("__hit", F.lit(False)), "pick_note": F.col("__note")}).drop("__hit", "__note")


def delivery_kind(files: Column, raw: Column, bracket: Column, labelled: Column, rooms: Column, median: Column, raw_least: float = 0.5, bracket_least: float = 0.2, few: int = 60, few_per_room: int = 3, labelled_least: float = 0.6) -> Column:
    """A to E by the first rule that holds; the order is part of the meaning."""
    out = F.when((raw >= raw_least) & (bracket >= bracket_least), "D").when(raw >= raw_least, "E")
    out = out.when((files <= few) & (rooms > 0) & (median <= few_per_room), "A").when((files <= few) & (rooms == 0), "A")
    return out.when((labelled >= labelled_least) & (rooms == 1), "C").when(labelled >= labelled_least, "B").otherwise("C")


def revised_kind(kind: Column, rooms: Column, forced: Column, scenes: Column, groups: Column, few_per_room: int = 3) -> Column:
    """A finished selection that turns out to hold too many scenes a room is a shoot, unless its kind was told or its names gave rooms."""
    return F.when((kind == "A") & (rooms == 0) & forced.isNull() & (scenes / F.greatest(F.lit(1), groups) > few_per_room), "C").otherwise(F.coalesce(forced, kind))


def quota_of(kind: Column, slots: Column, angles: Column) -> Column:
    """A finished selection has no quota: it keeps all its angles."""
    return F.when(kind == "A", angles).otherwise(slots)


def typology(rooms: Column, bands: list[tuple[int, str, int, int]], lo: int, hi: int) -> Column:
    """The band (most rooms, name, least, most photos) of a property whose photos ``lo`` to ``hi`` don't suit; null if they do, or there is no band."""
    out = F.lit(None).cast("string")
    for most, name, least, greatest in sorted(bands, reverse=True):
        out = F.when(rooms <= most, F.lit(None if least <= lo and hi <= greatest + 15 else name).cast("string")).otherwise(out)
    return out


def identities(files: DataFrame, job: str, name: Column) -> DataFrame:
    """Photographs of each job, counted by what their names say without a result's ending."""
    return files.groupBy(job).agg(F.count_distinct(name).alias("photos"))


def listed(items: DataFrame, key: str, name: str, most: int) -> DataFrame:
    """The first ``most`` names of each key as one text, and how many more there are. Names are ranked before they are gathered, so no list grows with its group."""
    ranked = items.select(key, name).distinct().withColumn("__place", F.row_number().over(Window.partitionBy(key).orderBy(name)))
    out = ranked.groupBy(key).agg(F.count("*").alias("__n"), F.array_sort(F.collect_list(F.when(F.col("__place") <= most, F.col(name)))).alias("__names"))
    more = F.when(F.col("__n") > most, F.format_string(" … %d more", F.col("__n") - most)).otherwise("")
    return out.select(key, F.concat(F.array_join("__names", ", "), more).alias("names"))
