"""A training corpus from ``documents``: toxicity, near-dedup, decontamination, PII, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievewright.llm import decontamination, near_dedup, packing, pii, toxicity
from sievewright.llm.common import discard, fresh_path, table

#: Each takes (spark, docs, sf_dir). All but the last return the columns of ``documents``.
STAGES = [
    ("toxicity", toxicity.stage),
    ("near_dedup", near_dedup.stage),
    ("decontamination", decontamination.stage),
    ("pii", pii.stage),
    ("packing", packing.stage),
]

#: Trained scores and signatures have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder as Parquet and read again, after which the one before is removed.

    Rows with null or empty texts pass every stage and are packed as an end of document; of
    repeated rows one is left by near_dedup; an empty table gives no rows.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
