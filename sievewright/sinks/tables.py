"""Results as tables: profiles, reports, catalogues, selections, rounds, events, records. Each is one committed write."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.functions.scalars import table_cell
from sievewright.operators.matching import all_or_nothing
from sievewright.streaming import ledger


def write_profile(profile: DataFrame, path: str) -> None:
    """One row a delivery: kind, shares, rooms. A new run takes the place of the last."""
    profile.write.mode("overwrite").parquet(path)


def delivery_report(files: DataFrame, inventory: DataFrame, gaps: DataFrame, removed: DataFrame, path: str) -> DataFrame:
    """What a report counts, as (part, name, n): files by ending, the inventory by status, duplicates removed, missing frames by prefix, alarms."""
    ending = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    parts = [
        files.groupBy(ending.alias("name")).agg(F.count("*").alias("n")).select(F.lit("files").alias("part"), "name", "n"),
        inventory.groupBy(F.col("status").alias("name")).agg(F.count("*").alias("n")).select(F.lit("inventory").alias("part"), "name", "n"),
        removed.agg(F.count("*").alias("n")).select(F.lit("removed").alias("part"), F.lit("copies").alias("name"), "n"),
        gaps.select(F.lit("missing").alias("part"), F.col("prefix").alias("name"), F.col("missing").cast("long").alias("n")),
        gaps.where("alarm").select(F.lit("alarm").alias("part"), F.col("prefix").alias("name"), F.col("longest").cast("long").alias("n"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Names that a report lists by status.
LISTED = {"missing": 60, "deduped": 20, "extra": 20}


def delivery_lists(inventory: DataFrame, runs: DataFrame, parts: DataFrame) -> DataFrame:
    """What a report names, as (part, rank, text): the first files by status and how many more there are, runs of missing frames (prefix, first, last, size), and alarming part sets (set, holes, last_is_full, alarm)."""
    named = inventory.where(F.col("status").isin(*LISTED))
    place = F.row_number().over(Window.partitionBy("status").orderBy(F.coalesce("path", "key")))
    most = F.coalesce(*(F.when(F.col("status") == s, n) for s, n in LISTED.items()))
    first = named.select(F.col("status").alias("part"), place.alias("rank"), F.coalesce("path", "key").alias("text"), most.alias("__most")).where(F.col("rank") <= F.col("__most")).drop("__most")
    more = named.groupBy("status").agg((F.count("*") - F.first(most)).alias("n")).where("n > 0").select(F.col("status").alias("part"), F.lit(1 + max(LISTED.values())).alias("rank"), F.format_string("%d more", "n").alias("text"))
    gap = F.when(F.col("size") == 1, F.format_string("%s%04d", "prefix", "first")).otherwise(F.format_string("%s%04d to %04d, %d frames", "prefix", "first", "last", "size"))
    gaps = runs.select(F.lit("gap").alias("part"), F.row_number().over(Window.partitionBy("prefix").orderBy("first")).alias("rank"), gap.alias("text"))
    what = F.concat_ws("; ", F.when(F.size("holes") > 0, F.concat(F.lit("part "), F.array_join(F.transform("holes", lambda h: h.cast("string")), ", "), F.lit(" is missing"))), F.when(F.col("last_is_full"), "the last is as large as the others: more may follow"))
    sets = parts.where("alarm").select(F.lit("set").alias("part"), F.lit(1).alias("rank"), F.concat(F.col("set"), F.lit(": "), what).alias("text"))
    return first.unionByName(more).unionByName(gaps).unionByName(sets)


def arrived(files: DataFrame, inventory: DataFrame | None = None, expected: int | None = None) -> DataFrame:
    """One row: whether all arrived, by the strongest evidence there is: names, else a count, else nothing (``unverified``); with what was expected, came and is missing."""
    if inventory is not None:
        counts = inventory.agg(F.count_if(F.col("status") != "extra").alias("expected"), F.count_if(F.col("status") == "arrived").alias("came"), F.count_if(F.col("status") == "missing").alias("missing"))
        return counts.select(F.when(F.col("missing") == 0, "confirmed by name").otherwise("files are missing").alias("verdict"), "expected", "came", "missing")
    counts = files.agg(F.count("*").alias("came")).select(F.lit(expected).cast("long").alias("expected"), "came")
    missing = F.when(F.col("expected").isNotNull(), F.greatest(F.lit(0), F.col("expected") - F.col("came")))
    verdict = F.when(F.col("expected").isNull(), "unverified").when(F.col("came") == F.col("expected"), "confirmed by count").when(F.col("came") < F.col("expected"), "files are missing").otherwise("more than expected")
    return counts.select(verdict.alias("verdict"), "expected", "came", missing.alias("missing"))


def append_run(lines: DataFrame, path: str) -> None:
    """Append what a run says (job, at, place, text), a row for each line, safe within a table of bars."""
    lines.select("job", "at", "place", table_cell(F.col("text")).alias("text")).write.mode("append").parquet(path)


def write_catalog(frames: DataFrame, path: str, delivery: str) -> None:
    """Catalogue rows, one for each frame, in a folder for each delivery; only deliveries that are written are replaced."""
    frames.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(delivery).parquet(path)


def selection(picks: DataFrame, passed_over: DataFrame, room: str, comment: str, most: int = 5) -> DataFrame:
    """Picks in order and, behind them, at most ``most`` comments on what was passed over in each room, once each by their first 60 characters."""
    key = F.lower(F.substring(comment, 1, 60))
    once = passed_over.where(F.coalesce(comment, F.lit("")) != "").groupBy(room, key.alias("__key")).agg(F.min(comment).alias(comment))
    some = once.withColumn("rank", F.row_number().over(Window.partitionBy(room).orderBy("__key"))).where(F.col("rank") <= most)
    return picks.select(room, "rank", F.lit("pick").alias("part"), F.col("name").alias("text")).unionByName(some.select(room, "rank", F.lit("passed over").alias("part"), F.col(comment).alias("text")))


def flagged(items: DataFrame, room: str, name: str, flags: str, order: list, most: int = 40) -> DataFrame:
    """The first ``most`` items with flags (an array of texts) in ``order``, and a last row for how many more there are: rank, room, text."""
    own = items.where(F.size(flags) > 0)
    first = own.orderBy(*order).limit(most).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    listed = first.select("rank", F.col(room).alias("room"), F.concat(F.col(name), F.lit(" — "), F.array_join(flags, "; ")).alias("text"))
    more = own.agg((F.count("*") - most).alias("n")).where("n > 0")
    return listed.unionByName(more.select(F.lit(most + 1).alias("rank"), F.lit(None).cast("string").alias("room"), F.format_string("%d more", "n").alias("text")))


def append_round(marks: DataFrame, recorded: DataFrame | None, path: str) -> None:
    """Append a gate round (job, stage, photo, back, comment); its number is one more than the job's last at that stage."""
    last = recorded.groupBy("job", "stage").agg(F.max("n").alias("__last")) if recorded is not None else None
    out = marks.join(last, ["job", "stage"], "left") if last is not None else marks.withColumn("__last", F.lit(None).cast("int"))
    out.withColumns({"n": (F.coalesce("__last", F.lit(0)) + 1).cast("int"), "comment": table_cell(F.coalesce("comment", F.lit("")))}).drop("__last").write.mode("append").parquet(path)


def append_events(events: DataFrame, path: str) -> None:
    """Append ledger events (at, job, event, photos, detail); one outside the vocabulary fails the whole write."""
    safe = ledger.checked(events, "event")
    safe.withColumns({c: table_cell(F.col(c)) for c in ("job", "event", "detail")}).write.mode("append").parquet(path)


def originals(sources: DataFrame, picks: DataFrame, key: str) -> DataFrame:
    """Every source with the name it was delivered under, or ``not chosen``."""
    out = sources.join(picks.select(key, F.col("name").alias("__name")), key, "left")
    return out.withColumn("fate", F.coalesce("__name", F.lit("not chosen"))).drop("__name")


def write_job(named: DataFrame, path: str) -> None:
    """A job's rows, all or none: a pick without a name stops the write before it begins."""
    all_or_nothing(named, "picks", "name").write.mode("errorifexists").parquet(path)


def write_record(facts: DataFrame, path: str) -> None:
    """One row a photo of what was decided about it."""
    facts.write.mode("overwrite").parquet(path)
