"""What the operators share: inputs, the shared folder, written stages, byte-bounded batches."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from sievewright.shipping import ship

#: Words of the near-duplicate, decontamination and toxicity operators: ASCII digits and
#: letters and everything beyond ASCII, in UTF-8, after ASCII lower-casing.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


#: What empties the caches that operators keep in a Python worker.
CACHES: list = []


#: Bytes of a batch that goes to a Python worker: it is held on both sides, by every task.
BATCH_BYTES = 4 << 20
#: Fixed values of glibc's mallopt: the parameters M_TRIM_THRESHOLD and M_MMAP_THRESHOLD.
TRIM_THRESHOLD, MMAP_THRESHOLD = -1, -3


@lru_cache(maxsize=1)
def _libc():
    """The C library, told to give back arrays of a megabyte or more as they are freed; None where it can't be told."""
    try:
        found = ctypes.CDLL(None)
        found.mallopt(TRIM_THRESHOLD, 1 << 20)
        found.mallopt(MMAP_THRESHOLD, 1 << 20)
        found.malloc_trim
    except (AttributeError, OSError):
        return None
    return found


def release(keep=None) -> None:
    """Give back what other operators left in this Python worker, which serves many stages; what ``keep`` would clear stays."""
    for clear in CACHES:
        if clear != keep:
            clear()
    trim()


def trim() -> None:
    """Give back freed memory; caches stay."""
    pa.default_memory_pool().release_unused()
    if libc := _libc():
        libc.malloc_trim(0)


def give_back() -> None:
    """``trim`` for workers that use arrays of the same sizes again: the C library keeps its own thresholds."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def ready(spark: SparkSession) -> None:
    """Executors have this package, and no batch for Python is larger than BATCH_BYTES (or one row).

    The session keeps that setting, as results are lazy and run after this; it never makes a
    batch larger than the caller had it. Python workers that run these operators also tell
    the C library to give freed memory back (``release``).
    """
    ship(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = re.fullmatch(r"(\d+)b?", spark.conf.get(name))
    if not held or int(held[1]) <= 0 or int(held[1]) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session may go without; it gets one of its own."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: stages need a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="sievewright-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Executions in here remove their shuffle files when they end: their results are written or on the driver. The session's setting comes back."""
    name, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", None
    try:
        before = spark.conf.get(name)
        spark.conf.set(name, "true")
        yield
    finally:
        if before is not None:
            spark.conf.set(name, before)


def discard(spark: SparkSession, path: str) -> None:
    """Remove what this package wrote under the shared folder and nothing will read again."""
    if not path.startswith(f"{shared_dir(spark)}/"):
        raise ValueError(f"{path} is not in the shared folder")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_once(df: DataFrame, label: str) -> DataFrame:
    """Write a stage to the shared folder and read it again.

    Cuts the lineage, and fixes what depends on how rows fell into partitions: later passes
    see the same rows, and a lost executor costs tasks of one stage only.
    """
    return write_at(df, fresh_path(df.sparkSession, label))


def write_at(df: DataFrame, path: str) -> DataFrame:
    """``write_once`` at a place that the caller may ``discard``."""
    spark = df.sparkSession
    ready(spark)
    with tidy(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slice Arrow batches so that each holds about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)


def distinct(values: np.ndarray) -> np.ndarray:
    """Ascending; by a sort, which is many times faster here than a table of hashes."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))[: len(values)]]


def ranks(keys: np.ndarray) -> np.ndarray:
    """For each element, how many equal ones come before it."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    starts = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] - 1))
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = np.arange(len(keys)) - np.repeat(starts, np.diff(starts, append=len(keys)))
    return out


def bytes_of(column: pa.Array) -> list[bytes]:
    """Texts in UTF-8 with A-Z lower-cased, null as empty."""
    return [(x or b"").lower() for x in column.cast(pa.binary()).to_pylist()]


#: A word's bytes stay, A-Z in lower case; others become spaces.
SPACED = bytes(c if WORD.match(bytes([c])) else 32 for c in bytes(range(256)).lower())


def spaced(column: pa.Array) -> list[bytes]:
    """Texts in UTF-8 whose words, those of WORD, stand between spaces; null as empty."""
    return [(x or b"").translate(SPACED) for x in column.cast(pa.binary()).to_pylist()]


def words_of(column: pa.Array) -> list[list[bytes]]:
    return [x.split() for x in spaced(column)]
