"""Deliveries as tables of file names: inventories, sequences, sets, results, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.functions import names
from sievewright.operators import rooms, sequences


def inventory(expected: DataFrame, arrived: DataFrame, path: str) -> DataFrame:
    """``status`` of each file by its folded name, wherever it lies: arrived, missing, extra, or deduped, if only a copy is wanted whose original is here."""
    key = names.same_name(names.basename(F.col(path)))
    wanted = expected.select(key.alias("key"), F.col(path).alias("__path")).groupBy("key").agg(F.max("__path").alias("path"))
    wanted = wanted.withColumn("twin", names.same_name(names.without_copy_mark(F.col("key"))))
    have = arrived.select(key.alias("key")).distinct().withColumn("__here", F.lit(True))
    both = wanted.join(have, "key", "full_outer")
    twins = have.select(F.col("key").alias("twin"), F.lit(True).alias("__twin"))
    out = both.join(twins, "twin", "left")
    status = (F.when(F.col("path").isNull(), "extra").when(F.col("__here"), "arrived")
              .when(F.col("__twin") & (F.col("twin") != F.col("key")), "deduped").otherwise("missing"))
    return out.select("key", "path", status.alias("status"))


def frame_gaps(files: DataFrame, path: str, least: int = 5, alarm: int = 12) -> DataFrame:
    """``sequence_gaps`` of the frame counters that the names end in, by their prefix."""
    prefix, number = names.counter(F.col(path))
    return sequences.sequence_gaps(files.select(prefix.alias("prefix"), number.alias("number")).where("prefix is not null"), "prefix", "number", least, alarm)


def missing_runs(numbers: DataFrame, group: str, number: str) -> DataFrame:
    """The runs of numbers that are missing between a group's first and last: first, last, size."""
    runs = sequences.followed(numbers, group, number).where(F.col("next") > F.col(number) + 1)
    return runs.select(group, (F.col(number) + 1).alias("first"), (F.col("next") - 1).alias("last"), (F.col("next") - F.col(number) - 1).alias("size"))


def part_report(archives: DataFrame, path: str, size: str) -> DataFrame:
    """Sets of numbered archives of two parts or more: parts, highest, holes by number, whether the last is as large as the rest, and whether either alarms."""
    named = archives.select(F.col(path).alias("path"), F.col(size).alias("size"), names.stem(F.col(path)).alias("stem")).where(F.col("stem").rlike(names.PART))
    folder = F.regexp_extract("path", "^(.*/)?", 0)
    own = named.select(F.concat(folder, F.regexp_extract("stem", names.PART, 1), F.lit("|"), F.lower(names.suffix(F.col("path")))).alias("set"), F.regexp_extract("stem", names.PART, 2).cast("int").alias("number"), "size")
    each = own.groupBy("set", "number").agg(F.count("*").alias("parts"), F.sum("size").alias("s"), F.count("size").alias("n"), F.max("size").alias("most"))
    sums = each.groupBy("set").agg(
        F.sum("parts").alias("parts"), F.max("number").alias("highest"), F.min("number").alias("__first"), F.collect_set("number").alias("__have"), F.max_by(F.struct("s", "n", "most"), "number").alias("l"), F.sum("s").alias("s"), F.sum("n").alias("n")).where("parts > 1")
    rest = (F.col("s") - F.coalesce("l.s", F.lit(0))) / F.nullif(F.col("n") - F.col("l.n"), F.lit(0))
    sums = sums.withColumn("last_is_full", F.coalesce(F.col("l.most") >= 0.95 * rest, F.lit(False)))
    # A number has three digits, so a set has a thousand at most.
    holes = F.array_sort(F.array_except(F.sequence("__first", "highest"), "__have"))
    return sums.select("set", "parts", "highest", holes.alias("holes"), "last_is_full", ((F.size(holes) > 0) | F.col("last_is_full")).alias("alarm"))


def results(photos: DataFrame, made: DataFrame, job: str, stem: str, name: str, ending: str) -> DataFrame:
    """Photos (job, stem) with ``result``: the file named after the stem and ``ending``, else the first of several; null without one."""
    wanted = photos.select(job, stem, F.posexplode(F.array(F.concat(stem, F.lit(f"{ending}.jpg")), F.concat(stem, F.lit(f"{ending}_1.jpg")))).alias("__place", name))
    hits = wanted.join(made.select(job, name).distinct(), [job, name]).groupBy(job, stem).agg(F.min_by(name, "__place").alias("result"))
    return photos.join(hits, [job, stem], "left")


def to_run(photos: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Photos that have no result yet: work that is done is skipped."""
    return photos.join(done.select(*keys).distinct(), keys, "left_anti")


def is_stale(result_at: Column, *sources: Column) -> Column:
    """Missing, or older than the newest of its sources; without its first source there is nothing to make it from."""
    newest = F.greatest(*sources) if len(sources) > 1 else sources[0]
    return F.when(result_at.isNull(), True).when(sources[0].isNull(), False).otherwise(F.coalesce(result_at < newest, F.lit(False)))


def rest(files: DataFrame, picked: DataFrame, path: str) -> DataFrame:
    """Files that weren't picked, each with an output ``name`` of its own: its stem, and with the folder in front for all but the first of equal stems."""
    left = files.join(picked.select(path).distinct(), path, "left_anti").withColumn("__stem", names.stem(F.col(path)))
    place = F.row_number().over(Window.partitionBy("__stem").orderBy(path))
    folder = F.replace(F.regexp_replace(F.regexp_extract(F.col(path), "^(.*)/", 1), "^/+", ""), F.lit("/"), F.lit("_"))
    name = F.when(place == 1, F.col("__stem")).otherwise(F.when(folder == "", F.concat(F.col("__stem"), F.lit("_"), place.cast("string"))).otherwise(F.concat(folder, F.lit("_"), F.col("__stem"))))
    return left.withColumn("name", name).drop("__stem")


def jobs(places: DataFrame, job: str, stage: str, order: list[str]) -> DataFrame:
    """Each job once, in the first of the stages (by ``order``) that holds it, and whether others do too."""
    rank = F.coalesce(*(F.when(F.col(stage) == s, i) for i, s in enumerate(order)))
    known = places.where(rank.isNotNull() & F.col(job).rlike("^Job_[0-9]+$"))
    return known.groupBy(job).agg(F.min_by(stage, rank).alias(stage), (F.count_distinct(stage) > 1).alias("clash"))


def versions(shelved: DataFrame, stem: str, name: str) -> DataFrame:
    """By stem the ``newest`` of the versions put aside (``_rN`` at the end of a name), and the next free N: the least that no name has."""
    number = F.regexp_extract(names.stem(F.col(name)), "_r([0-9]+)$", 1).try_cast("int")
    own = shelved.select(stem, name, number.alias("n")).where("n is not null")
    free = rooms.next_free(own, stem, "n").withColumnRenamed("free", "next")
    return own.groupBy(stem).agg(F.max_by(name, F.struct("n", name)).alias("newest")).join(free, stem)
