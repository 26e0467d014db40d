"""Keyword and key matching, inventories, measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.functions import names
from sievewright.sources import lines


def keyword_of(items: DataFrame, key: str, label: Column, keywords: list[tuple[str, str]], codes: list[str] = []) -> DataFrame:
    """``slug`` of the keyword that comes first in the label; of several there the longest, then the first listed.

    Labels are folded (case and accents) and freed of references (``codes``) first, and so are
    keywords, so ``WC-00660 sala`` is no ``wc``. ``keywords`` (keyword, slug) is a dimension of
    a few hundred rows at most, held in the expression, so each row is matched where it lies.
    """
    bare = F.when(label.isNotNull(), names.strip_codes(label, codes))
    known = [(lines.plain_fold(k), s) for k, s in keywords]
    places = F.transform(F.array(bare), lambda own: F.array_min(F.filter(F.array(*(
        F.struct(F.instr(own, k).alias("at"), F.lit(-len(k)).alias("short"), F.lit(i).alias("listed"), F.lit(s).alias("slug")) for i, (k, s) in enumerate(known))), lambda p: p["at"] > 0)))
    return items.withColumn("slug", places[0]["slug"])


def resolved(asked: DataFrame, name: str, keys: list[Column], index: DataFrame, index_key: str, value: str) -> DataFrame:
    """``value`` by the first of ``keys`` that the index knows, and its ``rank``; of equal index keys the least value holds.

    One join for each key, of the rows that none has found so far; nothing is listed anew.
    """
    known = index.groupBy(F.col(index_key).alias("__key")).agg(F.min(value).alias("__value"))
    out = asked.select(name, *(k.alias(f"__k{i}") for i, k in enumerate(keys))).withColumns({value: F.lit(None).cast(index.schema[value].dataType), "rank": F.lit(None).cast("int")})
    for i in range(len(keys)):
        hit = out.join(known, (F.col("rank").isNull()) & (F.col(f"__k{i}") == F.col("__key")), "left")
        out = hit.withColumns({value: F.coalesce(value, "__value"), "rank": F.coalesce("rank", F.when(F.col("__key").isNotNull(), i))}).drop("__key", "__value")
    return out.groupBy(name).agg(F.min_by(value, "rank").alias(value), F.min("rank").alias("rank"))


def all_or_nothing(found: DataFrame, name: str, value: str) -> DataFrame:
    """``found`` if every row has its ``value``; else it fails with how many have none, before anything is written."""
    missing = found.where(F.col(value).isNull()).count()
    if missing:
        raise ValueError(f"{missing} of {name} can't be resolved")
    return found


def inventory(expected: DataFrame, arrived: DataFrame, key: str) -> DataFrame:
    """``status`` of each key: arrived, missing or extra. For file names see ``files.inventory``."""
    a, b = expected.select(key).distinct().withColumn("__e", F.lit(True)), arrived.select(key).distinct().withColumn("__a", F.lit(True))
    return a.join(b, key, "full_outer").select(key, F.when(F.col("__e").isNull(), "extra").when(F.col("__a").isNull(), "missing").otherwise("arrived").alias("status"))


def weighted(items: DataFrame, group: str, value: str, weight: str) -> DataFrame:
    """Weighted mean and standard deviation, from moments, in one pass."""
    w, x = F.col(weight), F.col(value)
    sums = items.groupBy(group).agg(F.sum(w).alias("w"), F.sum(w * x).alias("wx"), F.sum(w * x * x).alias("wxx"))
    mean = F.col("wx") / F.col("w")
    return sums.where("w > 0").select(group, mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), F.col("wxx") / F.col("w") - mean * mean)).alias("std"))


def theil_sen(points: DataFrame, group: str, x: str, y: str, most: int = 40, least_dx: float = 0.0) -> DataFrame:
    """Median of pairwise slopes and of residuals. Of more than ``most`` points, ``most`` evenly spaced ones are paired, so pairs are bounded."""
    order = Window.partitionBy(group).orderBy(x, y)
    placed = points.withColumn("i", F.row_number().over(order) - 1).withColumn("n", F.count("*").over(Window.partitionBy(group)))
    k = F.ceil(F.col("i") * (most - 1) / (F.col("n") - 1))
    some = placed.where((F.col("n") <= most) | (F.floor(k * (F.col("n") - 1) / (most - 1)) == F.col("i"))).select(group, "i", x, y)
    a, b = some.alias("a"), some.alias("b")
    pairs = a.join(b, (F.col(f"a.{group}") == F.col(f"b.{group}")) & (F.col("a.i") < F.col("b.i"))).where(F.abs(F.col(f"b.{x}") - F.col(f"a.{x}")) > least_dx)
    slopes = pairs.groupBy(F.col(f"a.{group}").alias(group)).agg(F.median((F.col(f"b.{y}") - F.col(f"a.{y}")) / (F.col(f"b.{x}") - F.col(f"a.{x}"))).alias("slope"), F.count("*").alias("pairs"))
    fit = some.join(slopes.where("pairs >= 3"), group)
    return fit.groupBy(group, "slope", "pairs").agg(F.median(F.col(y) - F.col("slope") * F.col(x)).alias("intercept"))
