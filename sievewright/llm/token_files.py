"""Token ids in ORC: integer run-length encoding, stripes, row indexes, Bloom filters on doc_id.

Rows go into ranges of ascending ``doc_id``; each range is encoded where it is written, so
only texts are shuffled, once. ``place`` counts the ids before a document within its file;
a file's own start is the sum of the files before it, known from one row per file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievewright.llm.common import by_bytes, fresh_path, table
from sievewright.llm.tokens import WIDTH, encoder, vocabulary

END_OF_DOCUMENT = 2
FILE_SCHEMA = "doc_id long, file int, place long, n_tokens long, ids array<int>"


def _encode(path: str, end_id: int, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, place = TaskContext.get().partitionId(), 0
        for batch in by_bytes(batches, "text", batch_bytes):
            ids, edges = encoder(path, end_id).encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.full(len(batch), file, dtype=np.int32)), pa.array(place + edges[:-1]), pa.array(np.diff(edges)),
                pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids.view(np.int32)))], ["doc_id", "file", "place", "n_tokens", "ids"])
            place += int(edges[-1])

    return run


def write_token_files(docs: DataFrame, path: str, vocabulary_path: str, end_id: int = END_OF_DOCUMENT, stripe_bytes: int = 16 << 20, index_rows: int = 1000, batch_bytes: int = 4 << 20, files: int | None = None) -> None:
    """Write the ids of ``docs`` (doc_id, text) under ``path``, ascending by doc_id over files and rows.

    Null and empty texts hold ``end_id`` alone. A null doc_id comes first. Rows with equal
    doc_id are all kept, ordered by a hash of the text. ``files``: ranges, by default as many as shuffle
    partitions. An empty table gives files without rows; very long texts are encoded whole, in
    a batch of their own. Other columns of ``docs`` are left out, whatever their names.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Only the keys of the ranges are sampled to the driver, never texts.
    keys = (F.col("doc_id"), F.xxhash64("text"))
    ranged = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    encoded = ranged.sortWithinPartitions(*keys).mapInArrow(_encode(vocabulary_path, end_id, batch_bytes), FILE_SCHEMA)
    encoded.write.options(**{"compression": "zstd", "orc.stripe.size": stripe_bytes, "orc.row.index.stride": index_rows, "orc.create.index": "true", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids before the document in all files), n_tokens, ids.

    Stripes are read in parallel. A filter on doc_id prunes files and stripes by statistics
    and Bloom filters, as it is pushed below the join with the files' starts (one row each).
    """
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    ends = rows.groupBy("file").agg(F.sum("n_tokens").alias("held"))
    # One row per written file: bounded by the number of tasks of one stage.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("file", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("file_start"))
    return rows.join(F.broadcast(starts), "file").select("doc_id", (F.col("file_start") + F.col("place")).alias("start"), "n_tokens", "ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False))).cast("B")
        edges = ids.offsets.to_pylist()
        sums = [zlib.crc32(raw[a * WIDTH : b * WIDTH]) for a, b in zip(edges, edges[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def query(spark, sf_dir):
    path = fresh_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, vocabulary())
    return read_token_files(spark, path).mapInArrow(_checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")
