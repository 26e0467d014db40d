"""Marks, rounds and checks of a gate; answers matched to what was offered; texts that contradict themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.functions import names
from sievewright.stages import joined

#: Fixed value: characters of a prefix that a match needs.
PREFIX = 8


def marks_on(marks: DataFrame, photos: DataFrame, job: str, key: str) -> DataFrame:
    """Marks with ``stem``, the photo they name by stem, file, result or path, and ``known``, whether the job has it."""
    own = marks.withColumn("stem", names.strip_result(names.stem(F.col(key))))
    return own.join(photos.select(job, "stem").distinct().withColumn("__known", F.lit(True)), [job, "stem"], "left").withColumn("known", F.coalesce("__known", F.lit(False))).drop("__known")


def repeats(marks: DataFrame, rounds: DataFrame, keys: list[str]) -> DataFrame:
    """Marks sent back (``back``) whose photo an earlier round sent back already."""
    return marks.where("back").join(rounds.where("back").select(*keys).distinct(), keys, "left_semi")


def asked(logs: DataFrame, rounds: DataFrame, key: str) -> DataFrame:
    """All that was asked of a photo: what its log holds (key, n, text, at, previous), and the rounds' notes (key, n, text, at, back) that no log repeats word for word."""
    have = logs.where(F.coalesce("text", F.lit("")) != "")
    noted = rounds.where(F.coalesce("text", F.lit("")) != "")
    first = noted.groupBy(key, "text").agg(F.min_by(F.struct("n", "at", "back"), F.struct("n", "at")).alias("r")).join(have.select(key, "text").distinct(), [key, "text"], "left_anti")
    logged = have.select(key, F.format_string("retouch %d", "n").alias("label"), "text", "at", "previous", F.lit("done").alias("kind"))
    return logged.unionByName(first.select(key, F.format_string("round %d", "r.n").alias("label"), "text", "r.at", F.lit(None).cast("string").alias("previous"), F.when(F.col("r.back"), "failed").otherwise("kept").alias("kind")))


def approvals(photos: DataFrame, marks: DataFrame, job: str) -> DataFrame:
    """Per job why it can't be approved: photos (job, stem, result) without a result, known marks that still send back. ``sound`` where there is neither."""
    missing = photos.groupBy(job).agg(F.count("*").alias("photos"), F.count_if(F.col("result").isNull()).alias("missing"))
    back = marks.where("known and back").groupBy(job).agg(F.count_distinct("stem").alias("back"))
    out = missing.join(back, job, "left").withColumn("back", F.coalesce("back", F.lit(0)))
    return out.withColumn("sound", (F.col("missing") == 0) & (F.col("back") == 0))


def reworks(marks: DataFrame, job: str) -> DataFrame:
    """Per job what a rework says: ``refused`` for no known mark, none that sends back, or one without a comment; else null."""
    silent = F.col("known") & F.col("back") & (F.trim(F.coalesce("comment", F.lit(""))) == "")
    out = marks.groupBy(job).agg(F.count_if("known").alias("known"), F.count_if(F.col("known") & F.col("back")).alias("back"), F.count_if(silent).alias("silent"), F.count_if(~F.col("known")).alias("unknown"))
    return out.withColumn("refused", F.when(F.col("known") == 0, "nothing marked").when(F.col("back") == 0, "nothing sent back").when(F.col("silent") > 0, "no comment"))


def to_rework(photos: DataFrame, marks: DataFrame, job: str) -> DataFrame:
    """The photos that known marks send back, with their comment, whether they have a result or not."""
    back = marks.where("known and back").groupBy(job, "stem").agg(F.min("comment").alias("comment"))
    return photos.join(back, [job, "stem"])


def moves(entered: DataFrame, job: str, stage: str) -> DataFrame:
    """Moves (job, stage) that would put a job where it is already: refused, the others pass."""
    return entered.groupBy(job, stage).agg(F.count("*").alias("n")).withColumn("refused", F.col("n") > 1)


def admitted(writes: DataFrame, current: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Writes (key, generation) with ``refused``: ``unknown`` where ``current`` (key, generation) has no such page, ``stale`` where the page has moved on since it was read, else null.

    Of several writes to one generation the first in ``order`` is taken, which moves the page
    on: the others are stale. The first is found by partial minima, so a page that all write to is spread.
    """
    known = writes.join(current.select(F.col(key).alias("__key"), F.col("generation").alias("__now")), F.col(key) == F.col("__key"), "left")
    fresh = known.where("generation = __now")
    first = fresh.groupBy(F.col(key).alias("__won")).agg(F.min(F.struct(*order)).alias("__first"))
    out = known.join(first, F.col(key) == F.col("__won"), "left")
    late = ~F.coalesce((F.col("generation") == F.col("__now")) & (F.struct(*order) == F.col("__first")), F.lit(False))
    return out.withColumn("refused", F.when(F.col("__key").isNull(), "unknown").when(late, "stale")).select(*writes.columns, "refused")


def matched(claims: DataFrame, offered: DataFrame, group: str, claim: str, name: str, bounded: bool = False) -> DataFrame:
    """Claims with ``match``, the offered name of their group that is meant: equal, by base name, by a stem or a prefix that only one has. Null where that is open.

    Names that fold alike are one, the least. Claims that equal a name are decided by that; only for groups with others is more listed.
    A name is listed under its own prefixes of just the lengths that those claims ask
    for, and what is listed under one key is one row (how many, and the least), so names that
    begin alike don't meet. The lengths of a group are at most those of its longest name.
    Where all groups are small (``bounded``), however many, names and lengths meet by a plain join.
    """
    asked = claims.select(F.col(group).alias("__group"), F.col(claim).alias("__claim"), names.fold_name(F.col(claim)).alias("__whole"), names.fold_name(names.basename(F.col(claim))).alias("__base"), names.fold_name(names.stem(F.col(claim))).alias("__stem"))
    own = offered.select(F.col(group).alias("__group"), F.col(name).alias("__named"), names.fold_name(F.col(name)).alias("__name"), names.fold_name(names.stem(F.col(name))).alias("__own"))
    # Grouped by columns that come of the functions, not under them: what is folded stays out of the grouping.
    one = _once(own).groupBy("__group", "__name", "__own").agg(F.min("__named").alias("__named"))
    equal = one.groupBy(F.col("__group").alias("__of"), "__name").agg(F.min("__named").alias("__equal"))
    asked = _once(asked).join(equal, (F.col("__group") == F.col("__of")) & (F.col("__whole") == F.col("__name")), "left").drop("__of", "__name")
    rest = asked.where("__equal is null").withColumn("__prefix", F.substr("__base", F.lit(1), F.greatest(F.lit(PREFIX), F.length("__base") - 4)))
    pair = lambda rank, key: F.struct(F.lit(rank).alias("rank"), key.alias("key"))
    tries = rest.select("__group", "__claim", F.inline(F.array(pair(2, F.col("__base")), pair(3, F.col("__stem")), pair(4, F.col("__prefix")))))
    lengths = rest.groupBy("__group").agg(F.collect_set(F.length("__prefix")).alias("__lengths"))
    starts = F.transform(F.filter("__lengths", lambda n: n <= F.length("__name")), lambda n: pair(4, F.substr("__name", F.lit(1), n)))
    met = one.join(lengths, "__group") if bounded else joined(one, lengths, ["__group"])
    listed = met.select("__group", "__named", F.inline(F.concat(F.array(pair(2, F.col("__name")), pair(3, F.col("__own"))), starts)))
    known = listed.groupBy("__group", "rank", "key").agg(F.count("*").alias("__n"), F.min("__named").alias("__match"))
    hits = tries.join(known, ["__group", "rank", "key"]).where("__n = 1 or rank < 3")
    best = hits.groupBy(F.col("__group").alias("__of"), F.col("__claim").alias("__for")).agg(F.min_by("__match", "rank").alias("__best"))
    told = asked.join(best, (F.col("__group") == F.col("__of")) & (F.col("__claim") == F.col("__for")), "left").select("__group", "__claim", F.coalesce("__equal", "__best").alias("match"))
    return claims.join(told, [F.col(group) == F.col("__group"), F.col(claim) == F.col("__claim")], "left").drop("__group", "__claim")


def _once(rows: DataFrame) -> DataFrame:
    """Distinct rows; the columns are made before, as a function over Arrow batches can't be part of the grouping."""
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("__copies")).drop("__copies")


def singular(word: Column) -> Column:
    return (F.when(word.endswith("ies") & (F.length(word) > 4), F.concat(F.substr(word, F.lit(1), F.length(word) - 3), F.lit("y"))).when(word.rlike("(s|x|z|ch|sh)es$"), F.substr(word, F.lit(1), F.length(word) - 2))
            .when(word.endswith("s") & ~word.endswith("ss"), F.substr(word, F.lit(1), F.length(word) - 1)).otherwise(word))


#: What says that a thing goes, and that it stays.
GOES, STAYS = r"(?i)\b(take[sn]? off|remove[sd]?|erase[sd]?|goes|go)\b", r"(?i)\b(stays?|keeps?|leave|left in place|remain[s]?)\b"


def contradictions(texts: DataFrame, key: str, text: str, ignored: list[str] = [], goes: str = GOES, stays: str = STAYS, least: int = 3) -> DataFrame:
    """Words that one sentence of a text removes and another keeps, with the first sentence of either kind. A sentence that does both agrees with itself. Words whose singular has fewer than ``least`` letters are left out."""
    parts = texts.select(key, F.posexplode(F.split(text, r"(?<=[.!])\s+")).alias("__at", "__sentence")).where(F.trim("__sentence") != "")
    parts = parts.select(key, "__at", F.trim("__sentence").alias("sentence"), F.col("__sentence").rlike(goes).alias("__goes"), F.col("__sentence").rlike(stays).alias("__stays")).where("__goes != __stays")
    words = F.array_distinct(F.filter(F.regexp_extract_all(F.lower("sentence"), F.lit("[a-z]{4,}"), F.lit(0)), lambda w: ~w.isin(*ignored) if ignored else F.lit(True)))
    roots = F.array_distinct(F.filter(F.transform(words, singular), lambda w: (F.length(w) >= least) & (~w.isin(*ignored) if ignored else F.lit(True))))
    named = parts.select(key, "__at", "sentence", "__goes", F.explode(roots).alias("word"))
    sides = named.groupBy(key, "word").agg(
        F.min_by(F.when(F.col("__goes"), F.col("sentence")), F.when(F.col("__goes"), F.col("__at"))).alias("removed"), F.min_by(F.when(~F.col("__goes"), F.col("sentence")), F.when(~F.col("__goes"), F.col("__at"))).alias("kept"))
    return sides.where("removed is not null and kept is not null")


def one_cause(errors: DataFrame, key: str, text: str) -> DataFrame:
    """Per key the errors, and ``cause`` where two or more all begin with one kind (what stands before the colon): then it is no fault of the items."""
    kind = F.trim(F.substring_index(F.col(text), ":", 1))
    return errors.groupBy(key).agg(F.count("*").alias("errors"), F.when((F.count("*") >= 2) & (F.count_distinct(kind) == 1), F.min(kind)).alias("cause"))
