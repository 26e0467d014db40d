"""Best-fit packing with large-item matching.

Lengths are integers of at most the capacity, so a histogram (capacity rows) is all that
planning needs, whatever the corpus holds. Items above a third of the capacity go at most
two to a bin: each, largest first, is matched with the largest other that fits. Smaller
items then go, largest first, into the tightest gap. Bins that are filled alike are one
run of the plan; a length that ends splits at most one run, so the plan has no more runs
than about three times the capacity. An item finds its bin by its rank among its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievewright.llm.common import by_bytes, ranks, ready, table, trim, write_once
from sievewright.llm.tokens import WIDTH, encoder, vocabulary

END_OF_DOCUMENT = 2
#: Pieces of texts whose ids a worker keeps: fewer than elsewhere, as packing follows other stages.
PIECES_KEPT = 200_000


class Bins:
    """Runs of bins, each run (how many, contents, gap), found by gap."""

    def __init__(self):
        self.gaps: list[int] = []
        self.by_gap: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def add(self, bins: int, contents: list[tuple[int, int]], gap: int) -> None:
        if bins:
            if gap not in self.by_gap:
                insort(self.gaps, gap)
                self.by_gap[gap] = []
            self.by_gap[gap].append((bins, contents))

    def tightest(self, size: int):
        """Take the run of the smallest gap that ``size`` fits."""
        i = bisect_left(self.gaps, size)
        if i == len(self.gaps):
            return None
        gap = self.gaps[i]
        run = self.by_gap[gap].pop()
        if not self.by_gap[gap]:
            del self.by_gap[gap], self.gaps[i]
        return *run, gap

    def runs(self):
        return [run for gap in self.gaps for run in self.by_gap[gap]]


def matched(counts: dict[int, int], capacity: int, bins: Bins) -> None:
    """Pair the items above a third of ``capacity``: the largest left with the largest that fits beside it."""
    left = {s: n for s, n in counts.items() if 3 * s > capacity and n}
    sizes = sorted(left)
    while sizes:
        size = sizes[-1]
        i = bisect_left(sizes, capacity - size + 1) - 1
        mate = sizes[i] if i >= 0 else None
        if mate is None:
            bins.add(left.pop(size), [(size, 1)], capacity - size)
            sizes.pop()
        elif mate == size:
            bins.add(left[size] // 2, [(size, 2)], capacity - 2 * size)
            left[size] %= 2
            if not left[size]:
                sizes.pop()
            else:  # one of this length: its mate is a shorter one, or none
                j = i - 1
                bins.add(1, [(size, 1), *([(sizes[j], 1)] if j >= 0 else [])], capacity - size - (sizes[j] if j >= 0 else 0))
                sizes.pop()
                if j >= 0:
                    left[sizes[j]] -= 1
                    if not left[sizes[j]]:
                        del sizes[j]
        else:
            n = min(left[size], left[mate])
            bins.add(n, [(size, 1), (mate, 1)], capacity - size - mate)
            for x in (size, mate):
                left[x] -= n
                if not left[x]:
                    sizes.remove(x)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Runs (bins, [(length, how many a bin)]) that hold ``counts`` items of each length."""
    bins = Bins()
    matched(counts, capacity, bins)
    for size in sorted((s for s, n in counts.items() if 3 * s <= capacity and n), reverse=True):
        n = counts[size]
        while n:
            many, contents, gap = bins.tightest(size) or (-(-n // (capacity // size)), [], capacity)
            each = gap // size
            full = min(many, n // each)
            bins.add(full, [*contents, (size, each)], gap - each * size)
            n -= full * each
            if full < many:
                if n:
                    bins.add(1, [*contents, (size, n)], gap - n * size)
                    full, n = full + 1, 0
                bins.add(many - full, contents, gap)
    return [run for run in bins.runs() if run[1]]


def places(runs: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, how many a bin, first bin, offset in the bin), ascending by rank."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    held: dict[int, int] = {}
    first = 0
    for bins, contents in runs:
        offset = 0
        for size, each in contents:
            rows.setdefault(size, []).append((held.get(size, 0), each, first, offset))
            held[size] = held.get(size, 0) + bins * each
            offset += size * each
        first += bins
    return {size: np.array(x, dtype=np.int64) for size, x in rows.items()}


def _pieces(path: str, capacity: int, end_id: int, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        part, held = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in by_bytes(batches, "text", batch_bytes):
            ids, edges = encoder(path, end_id, PIECES_KEPT).encode(batch.column("text"))
            tokens = np.diff(edges)
            many = -(-tokens // capacity)
            row = np.repeat(np.arange(len(tokens)), many)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            first = (tokens - 1) % capacity + 1  # what full pieces leave
            start = np.where(piece > 0, first[row] + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, first[row])
            raw, at = memoryview(ids).cast("B"), edges[row] + start
            sums = [zlib.crc32(raw[a * WIDTH : b * WIDTH]) for a, b in zip(at.tolist(), (at + length).tolist())]
            rank = held[length] + ranks(length)
            held += np.bincount(length, minlength=capacity + 1)
            columns = [batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(sums, pa.int64()), pa.array(np.full(len(row), part, dtype=np.int32)), pa.array(rank)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    return run


def _bins(by_length: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            bins, offset = np.empty(len(rank), dtype=np.int64), np.empty(len(rank), dtype=np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(rows):
                    size = int(length[rows[0]])
                    runs = by_length[size]
                    first, each, base, at = runs[np.searchsorted(runs[:, 0], rank[rows], side="right") - 1].T
                    within = rank[rows] - first
                    bins[rows], offset[rows] = base + within // each, at + within % each * size
            columns = [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(bins), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, vocabulary_path: str, capacity: int = 1024, end_id: int = END_OF_DOCUMENT, batch_bytes: int = 2 << 20) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and ``end_id``; a longer one than ``capacity`` is cut into full
    pieces behind a first piece that holds the rest. A null or empty text is ``end_id``
    alone. Repeated rows are packed each; a null doc_id stays null; an empty table gives no
    rows; a very long text is encoded whole, in a batch of its own. Ties of length fall as the
    tasks come. Other columns are left out, whatever their names.

    Pieces are written once. Each task ranks its own pieces by length, the counts by task
    and length give each task its start, so no length's pieces ever meet in one task.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = rows.mapInArrow(_pieces(vocabulary_path, capacity, end_id, batch_bytes), "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long")
    pieces = write_once(cut, "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("held"))
    # At most ``capacity`` rows reach the driver.
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("held")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(starts, ["length", "part"]).withColumn("rank", F.col("first") + F.col("rank"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        _bins(places(plan(histogram, capacity))), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def sequences(docs: DataFrame, packed: DataFrame, vocabulary_path: str, end_id: int = END_OF_DOCUMENT) -> DataFrame:
    """The packed training rows: sequence_id and its ids in order. ``doc_id`` must be unique in ``docs``."""

    def ids(batches):
        for batch in by_bytes(batches, "text", 4 << 20):
            values, edges = encoder(vocabulary_path, end_id).encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values.view(np.int32)))], ["doc_id", "ids"])

    encoded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(ids, "doc_id long, ids array<int>")
    parts = packed.join(encoded, "doc_id").select("sequence_id", F.struct("offset", F.expr("slice(ids, cast(start + 1 as int), cast(length as int))").alias("ids")).alias("part"))
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["ids"])).alias("ids"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of ``docs``; odd rows as in ``pack``."""
    ready(spark)
    return pack(docs, vocabulary())


def query(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), vocabulary())
