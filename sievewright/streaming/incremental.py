"""Work on what is new: batches of a stream, each written under its own number and joined against what is done."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Where a row was made: the stream, known by its checkpoint, and the batch.
PLACE = ["run", "batch"]


def done(spark: SparkSession, out: str) -> DataFrame | None:
    """All rows that ``incremental`` has written to ``out``; None before the first."""
    where = spark._jvm.org.apache.hadoop.fs.Path(out)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return spark.read.option("basePath", out).parquet(f"{out}/run=*/batch=*")


def incremental(items: DataFrame, keys: list[str], step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Run ``step`` over the rows of a stream that aren't done, each of ``keys`` once; its result keeps ``keys``.

    A batch goes to the folder of its stream and number and replaces what is there, so a batch
    that is repeated after a failure changes nothing. Rows whose keys another batch, or another
    stream to the same ``out``, has written are left out; so are repeats within the batch. A
    source that may change has its time among the keys: then a changed one is new. Null keys
    are a key. ``trigger`` is that of ``writeStream`` (availableNow unless it is given).
    """

    def batch(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        # The stream's own id, which it keeps in its checkpoint.
        run = json.loads(session.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        fresh, before = rows.dropDuplicates(keys), done(session, out)
        if before is not None:
            others = before.where(~((F.col("run") == run) & (F.col("batch") == number))).select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
            fresh = fresh.join(others, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_anti")
        step(fresh).write.mode("overwrite").parquet(f"{out}/run={run}/batch={number}")

    writer = items.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    return writer.start()
