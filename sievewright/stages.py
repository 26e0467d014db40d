"""Stages between passes: tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.shipping import ship


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Only a local session may go without; it gets one of its own."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir is not set: stages need a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="sievewright-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


class Stages:
    """Written stages of one operator; ``drop`` removes what no later pass reads."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths, self.name = spark, label, {}, uuid.uuid4().hex
        ship(spark)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` and read it again: cuts its lineage and fixes how rows fell into tasks. A stage of the same name is removed once this one is there."""
        path = f"{shared_dir(self.spark)}/{self.label}-{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        before, self.paths[name] = self.paths.get(name), path
        if before:
            self._delete(before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(self.paths.pop(name))

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


#: Rows that may be broadcast, once counted; beyond them a side is dealt by salt.
BROADCAST_ROWS, SALTS = 50_000, 64


def paired(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Two tables that have each of ``keys`` once, side by side; null keys are equal."""
    named = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    return left.join(named, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], how).drop(*(f"__{k}" for k in keys))


def joined(rows: DataFrame, few: DataFrame, keys: list[str], how: str = "inner", known: int | None = None) -> DataFrame:
    """``rows`` joined with ``few``, which has each of ``keys`` once and no other column of ``rows``; null keys are equal.

    ``few`` is counted, if its rows aren't ``known``: it is broadcast if it has at most
    BROADCAST_ROWS of them. Otherwise it is repeated for every salt, and rows of one key are dealt over the salts.
    """
    named = few.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    drop = [f"__{k}" for k in keys]
    if (few.limit(BROADCAST_ROWS + 1).count() if known is None else known) <= BROADCAST_ROWS:
        found = rows.join(F.broadcast(named), same, how)
    else:
        salted = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
        found = salted.join(named.withColumn("__salts", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>"))), [*same, F.col("__salt") == F.col("__salts")], how).drop("__salt", "__salts")
    return found.drop(*drop)
