"""Exact quantiles of groups of any size, by counts over leading bits."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewright import stages as stage
from sievewright.stages import Stages, joined

#: Bits that a pass narrows by, and rows of a bucket that are sorted at last.
WIDTH, SMALL = 16, 1 << 16


@F.pandas_udf(T.LongType())
def _bits(values: pd.Series) -> pd.Series:
    """Doubles as integers in the same order: those of negative ones turned round; not a number is the greatest, and there is one zero."""
    x = np.where(np.isnan(values.to_numpy()), np.nan, values.to_numpy()) + 0.0
    own = x.view(np.int64)
    return pd.Series(np.where(own < 0, own ^ np.int64(2**63 - 1), own))


def ordered(values: Column, kind: T.DataType) -> Column:
    """64 bits in the order of the values."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(values)
    if isinstance(kind, T.IntegralType):
        return values.cast("long")
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return _bits(values.cast("double"))
    raise TypeError(f"no quantiles of {kind.simpleString()}")


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """``keys`` and a column for each of ``shares``: the value below which that share lies, between two values in proportion (double).

    Null values don't count, and a group without others gives no row; null keys are a group.
    Not a number is greater than all numbers. An empty table gives no rows.

    The first pass counts values by their first WIDTH bits; the bucket of a rank is then
    counted by the next bits, until it holds at most SMALL rows or is one value. Counts are
    partial before they are shuffled, and a task holds at most 2^WIDTH counts or SMALL values
    of a group, however large it is.
    """
    stages = Stages(rows.sparkSession, "quantiles")
    kind = rows.schema[value].dataType
    names = {k: f"k{i}" for i, k in enumerate(keys)}
    own = [F.col(k).alias(n) for k, n in names.items()]
    ks = list(names.values())
    v = rows.select(*own, F.col(value).alias("value")).where("value is not null").withColumn("bits", ordered(F.col("value"), kind))
    asked = F.array(*(F.struct(F.lit(i).alias("share"), F.lit(up).alias("up"), F.lit(float(q)).alias("q")) for i, q in enumerate(shares.values()) for up in (False, True)))

    def prefix(done: int) -> Column:
        return F.shiftright("bits", 64 - done)

    done = WIDTH
    counted = v.groupBy(*ks, prefix(done).alias("prefix")).agg(F.count("*").alias("n"))
    inside = Window.partitionBy(*ks).orderBy("prefix")
    group = Window.partitionBy(*ks)
    counted = counted.withColumns({"before": F.sum("n").over(inside) - F.col("n"), "total": F.sum("n").over(group)})
    # Ranks from 0: those on both sides of the place of each share.
    at = lambda a: a["q"] * (F.col("total") - 1)
    ranks = F.transform(asked, lambda a: F.struct(a["share"].alias("share"), a["up"].alias("up"), (at(a) - F.floor(at(a))).alias("part"), F.when(a["up"], F.ceil(at(a))).otherwise(F.floor(at(a))).alias("rank")))
    held = F.filter(ranks, lambda r: (r["rank"] >= F.col("before")) & (r["rank"] < F.col("before") + F.col("n")))

    def kept(df: DataFrame) -> tuple[DataFrame, int, int]:
        """The targets, how many there are, and the most rows of a bucket; written if they are more than may be broadcast."""
        some = df.limit(stage.BROADCAST_ROWS + 1).collect()
        if len(some) <= stage.BROADCAST_ROWS:
            return rows.sparkSession.createDataFrame(some, df.schema), len(some), max((r["n"] for r in some), default=0)
        df = stages.write("targets", df)
        return df, *df.agg(F.count("*"), F.max("n")).first()

    targets, asking, most = kept(counted.withColumn("r", F.explode(held)).select(*ks, "prefix", "n", "r.share", "r.up", "r.part", (F.col("r.rank") - F.col("before")).alias("rank")))

    def picked(by: DataFrame) -> DataFrame:
        """Targets with the part (``finer``, ``n``) of their bucket that holds their rank."""
        within = Window.partitionBy(*ks, "prefix").orderBy("finer")
        parts = by.withColumn("before", F.sum("n").over(within) - F.col("n"))
        same = [F.col(f"t.{k}").eqNullSafe(F.col(f"p.{k}")) for k in [*ks, "prefix"]]
        found = targets.drop("n").alias("t").join(parts.alias("p"), [*same, F.col("rank") >= F.col("before"), F.col("rank") < F.col("before") + F.col("n")])
        return found.select(*(F.col(f"t.{k}").alias(k) for k in ks), "finer", "n", "share", "up", "part", (F.col("rank") - F.col("before")).alias("rank"), *(["least"] if "least" in by.columns else []))

    def candidates() -> DataFrame:
        return joined(v.withColumn("prefix", prefix(done)), targets.select(*ks, "prefix").distinct(), [*ks, "prefix"], known=asking)

    while done < 64 and most > SMALL:
        finer = candidates().groupBy(*ks, "prefix", prefix(done + WIDTH).alias("finer")).agg(F.count("*").alias("n"))
        targets, asking, most = kept(picked(finer).withColumnRenamed("finer", "prefix"))
        done += WIDTH
    last = picked(candidates().groupBy(*ks, "prefix", F.col("bits").alias("finer")).agg(F.count("*").alias("n"), F.min("value").alias("least")))
    number = F.unix_micros("least") / 1e6 if isinstance(kind, T.TimestampType) else F.col("least").cast("double")
    ends = last.withColumn("least", number).groupBy(*ks, "share").agg(F.max(F.when(~F.col("up"), F.col("least"))).alias("low"), F.max(F.when(F.col("up"), F.col("least"))).alias("high"), F.max("part").alias("part"))
    between = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise((1 - F.col("part")) * F.col("low") + F.col("part") * F.col("high"))
    wide = ends.groupBy(*ks).agg(*(F.max(F.when(F.col("share") == i, between)).alias(name) for i, name in enumerate(shares)))
    return wide.select(*(F.col(n).alias(k) for k, n in names.items()), *shares)
