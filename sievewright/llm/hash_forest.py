"""Approximate nearest neighbours by a hash-prefix forest (LSH Forest; Bawa, Condie and Ganesan, 2005).

Rows are dealt into parts of a bounded size. In each part every tree is one sorted array of
hash strings, signs of random hyperplanes. A query descends to its longest common prefix in
each tree and then the trees ascend together, a bit at a time and within a bit tree by tree,
until their subtrees hold enough candidates; these are scored exactly. Equal strings are
never cut apart. Equal vectors are one candidate with all their ids, so a much copied one
can't stand for enough.

For largest inner products a coordinate is added that gives all rows the same norm, after
which the nearest by distance, and so by angle, are those of the largest inner product.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.common import table, write_once

TREES, BITS, PART_ROWS, QUERY_ROWS, SEED = 128, 32, 8192, 8192, 17
#: Rows and queries on which the candidates to ask for are fitted, and the recall asked for there.
FIT_ROWS, FIT_QUERIES, FIT_RECALL, FIT_STEP = 8192, 512, 0.95, 1.1
#: The recall asked for of the half of those queries that is worse served.
FIT_WORSE_HALF = 0.9


def _distinct(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that stand for equal ones, each the first of them, and for each row the place of its own among these."""
    whole = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
    _, first, own = np.unique(whole, return_index=True, return_inverse=True)
    order = np.argsort(first)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return first[order], place[own]


class Forest:
    """The sorted arrays of one part."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, space: "Space"):
        order = np.argsort(ids, kind="stable")
        first, own = _distinct(vectors[order])
        self.vectors = vectors[order][first]
        # The ids of each vector, ascending and once each.
        by = np.argsort(own, kind="stable")
        own, ids = own[by], ids[order][by]
        new = np.concatenate(([True], (own[1:] != own[:-1]) | (ids[1:] != ids[:-1])))[: len(ids)]
        self.ids = ids[new]
        self.edges = np.concatenate(([0], np.cumsum(np.bincount(own[new], minlength=len(first)))))
        strings = space.strings(space.lifted(self.vectors))
        self.order = np.argsort(strings, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(strings, self.order, axis=0)

    def candidates(self, strings: np.ndarray, least: int) -> Iterator[np.ndarray]:
        """For each query's strings (one per tree), the rows that the trees hold when they have ascended just so far that they hold ``least`` together."""
        n, trees = strings.shape

        def ranges(level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            free = ((np.uint64(1) << (BITS - level).astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
            lo, hi = np.empty((n, trees), dtype=np.int64), np.empty((n, trees), dtype=np.int64)
            for t in range(trees):
                lo[:, t] = np.searchsorted(self.sorted[:, t], strings[:, t] & ~free, side="left")
                hi[:, t] = np.searchsorted(self.sorted[:, t], strings[:, t] | free, side="right")
            return lo, hi

        deep, shallow = np.full(n, BITS), np.zeros(n, dtype=np.int64)  # the level lies between; level 0 holds every row
        while (open_ := shallow < deep).any():
            middle = (shallow + deep + 1) // 2
            lo, hi = ranges(middle)
            enough = (hi - lo).sum(axis=1) >= least
            shallow = np.where(open_ & enough, middle, shallow)
            deep = np.where(open_ & ~enough, middle - 1, deep)
        (lo, hi), (low, high) = ranges(shallow), ranges(np.minimum(shallow + 1, BITS))
        # One level deeper they hold too little: only the first trees take the last step.
        wide, narrow = hi - lo, high - low
        held = np.cumsum(wide, axis=1) + narrow.sum(axis=1, keepdims=True) - np.cumsum(narrow, axis=1)
        stay = np.concatenate([np.zeros((n, 1), dtype=bool), held[:, :-1] >= least], axis=1)
        lo, hi = np.where(stay, low, lo), np.where(stay, high, hi)
        flat, base = self.order.ravel(order="F"), np.arange(trees) * len(self.order)
        for i in range(n):
            size = hi[i] - lo[i]
            seen = np.zeros(len(self.vectors), dtype=bool)
            seen[flat[np.arange(size.sum()) + np.repeat(lo[i] + base - (np.cumsum(size) - size), size)]] = True
            yield np.flatnonzero(seen)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, strings: np.ndarray, k: int, least: int):
        """(query, id, score) of the ``k`` best candidates of each query, ties to the smaller id."""
        exact = self.vectors.astype(np.float64)
        single, least_id = np.diff(self.edges) == 1, self.ids[self.edges[:-1]]
        out = []
        for i, rows in enumerate(self.candidates(strings, least)):
            rows = rows[~single[rows] | (least_id[rows] != query_ids[i])]
            scores = np.einsum("ij,j->i", exact[rows], queries[i].astype(np.float64))  # the same in any company
            if len(rows) > k:
                good = scores >= np.partition(scores, -k)[-k]
                rows, scores = rows[good], scores[good]
            # Of equal vectors no more than k ids, and the query's own, can matter.
            ids = [self.ids[self.edges[r] : min(self.edges[r + 1], self.edges[r] + k + 1)] for r in rows]
            scores = np.repeat(scores, [len(x) for x in ids])
            ids = np.concatenate([np.empty(0, dtype=np.int64), *ids])
            other = ids != query_ids[i]
            ids, scores = ids[other], scores[other]
            best = np.lexsort((ids, -scores))[:k]
            out.append((np.full(len(best), i, dtype=np.int64), ids[best], scores[best]))
        return out


@lru_cache(maxsize=2)
def hyperplanes(size: int, trees: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, trees * BITS)).astype(np.float32)


class Space:
    """The hyperplanes, through the mean of the lifted rows."""

    def __init__(self, sample: np.ndarray, norm: float, trees: int):
        self.norm, self.trees = norm, trees
        self.middle = self.lifted(sample).mean(axis=0)

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        scaled = rows.astype(np.float64) / self.norm
        rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1, keepdims=True)))
        return np.concatenate([scaled, rest], axis=1).astype(np.float32)

    def aimed(self, queries: np.ndarray) -> np.ndarray:
        """Queries at norm 1 in the lifted space: their length doesn't change what is nearest."""
        q = queries.astype(np.float64)
        q = q / np.sqrt((q * q).sum(axis=1, keepdims=True))
        return np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32)

    def strings(self, lifted: np.ndarray) -> np.ndarray:
        bits = ((lifted - self.middle) @ hyperplanes(lifted.shape[1], self.trees) > 0).reshape(len(lifted), self.trees, BITS // 8, 8)
        return np.packbits(bits, axis=3).reshape(len(lifted), self.trees, BITS // 8).copy().view(">u4").reshape(len(lifted), self.trees).astype(np.uint32)


def fitted(sample: np.ndarray, space: Space, k: int, total: int) -> float:
    """The share of a part's distinct vectors to ask for as candidates, counted with repeats over trees, that finds FIT_RECALL of the sample's nearest.

    The sample's nearest are as far as the whole table's k-th when as many of them are taken
    as fall into the sample. Each of the sample's distinct vectors asks once, for exactly so
    many others, and recall is the mean of theirs: no group of copies answers for the rest.
    """
    few = max(1, -(-k * len(sample) // max(1, total)))
    sample = sample[_distinct(sample)[0]]
    few, asked = min(few, len(sample) - 1), min(FIT_QUERIES, len(sample))
    if few < 1:
        return float(space.trees)
    forest = Forest(np.arange(len(sample)), sample, space)
    truth = sample[:asked].astype(np.float64) @ sample.astype(np.float64).T
    truth[np.arange(asked), np.arange(asked)] = -np.inf
    nearest = np.argsort(-truth, axis=1, kind="stable")[:, :few]
    strings = space.strings(space.aimed(sample[:asked]))
    share = 0.05
    while share < space.trees:
        found = forest.candidates(strings, int(np.ceil(share * len(sample))))
        recall = np.sort([np.isin(near, rows).mean() for near, rows in zip(nearest, found)])
        if recall.mean() >= FIT_RECALL and recall[: -(-asked // 2)].mean() >= FIT_WORSE_HALF:
            return share
        share *= FIT_STEP
    return float(space.trees)


def _matrix(rows: pa.Table) -> np.ndarray:
    return rows.column("embedding").combine_chunks().flatten().to_numpy().reshape(len(rows), -1)


def _part_search(space: Space, k: int, share: float):
    def search(part: pa.Table, asked: pa.Table) -> pa.Table:
        found = [(np.empty(0, dtype=np.int64),) * 2 + (np.empty(0),)]
        if len(part) and len(asked):
            forest = Forest(part.column("vec_id").to_numpy(), _matrix(part), space)
            ids, queries = asked.column("vec_id").to_numpy(), _matrix(asked)
            least = int(np.ceil(share * len(forest.vectors)))
            for at in range(0, len(ids), 1024):
                some = slice(at, at + 1024)
                found += [(ids[some][q], v, s) for q, v, s in forest.search(ids[some], queries[some], space.strings(space.aimed(queries[some])), k, least)]
        query, near, score = (np.concatenate(x) for x in zip(*found))
        return pa.table({"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(near, pa.int64()), "score": pa.array(score, pa.float64())})

    return search


def _product_search(k: int):
    """``_part_search`` without trees: every row of the part is a candidate, by tiles of one product; the best are scored again one by one, so that scores are the same in any company."""

    def search(part: pa.Table, asked: pa.Table) -> pa.Table:
        found = [(np.empty(0, dtype=np.int64),) * 2 + (np.empty(0),)]
        if len(part) and len(asked):
            ids, rows = part.column("vec_id").to_numpy(), _matrix(part).astype(np.float64)
            queries, vectors = asked.column("vec_id").to_numpy(), _matrix(asked).astype(np.float64)
            for at in range(0, len(queries), 256):
                some = vectors[at : at + 256] @ rows.T
                some[queries[at : at + 256, None] == ids] = -np.inf
                # What rounding may do to a sum of products.
                slack = 1e-12 * np.sqrt((vectors[at : at + 256] ** 2).sum(1).max() * (rows**2).sum(1).max())
                least = np.partition(some, -k, axis=1)[:, -k] if some.shape[1] > k else np.full(len(some), -np.inf)
                for i, (line, low) in enumerate(zip(some, least)):
                    good = np.flatnonzero((line >= low - slack) & (line > -np.inf))
                    score = np.einsum("ij,j->i", rows[good], vectors[at + i])
                    order = np.lexsort((ids[good], -score))
                    # Repeated rows are one.
                    good, score = good[order], score[order]
                    once = np.unique(ids[good], return_index=True)[1]
                    best = np.sort(once)[:k] if len(once) < len(good) else np.arange(min(k, len(good)))
                    found.append((np.full(len(best), queries[at + i]), ids[good[best]], score[best]))
        query, near, score = (np.concatenate(x) for x in zip(*found))
        return pa.table({"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(near, pa.int64()), "score": pa.array(score, pa.float64())})

    return search


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, trees: int = TREES, part_rows: int = PART_ROWS, exact: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of the rows whose vec_id ``every`` divides.

    ``vectors`` (vec_id, embedding). Rows that are null, zero, or hold null or non-finite
    components take no part, nor do those of another dimension than most; so no rows come
    of an empty table. Fewer candidates than ``k`` are all returned. A row is no neighbour
    of a query with its vec_id, so repeated rows neither find nor push out each other.

    Other columns are left out, whatever their names. Vectors are of any length; very long
    ones want a smaller ``part_rows``. With ``exact`` there are no trees: all rows are
    candidates, which on evenly spread vectors costs less than pruning them.

    Each part meets each block of QUERY_ROWS queries in a group of its own, so a task holds
    a part and a block, and the driver only the rows on which the share is fitted.
    """
    spark = vectors.sparkSession
    # Floats stay floats; other numbers become doubles, so scores are those of the vectors as they are.
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding")).where("vec_id is not null")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm2 = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = rows.where(F.col("embedding").isNotNull() & ~bad).withColumn("norm2", norm2).where("norm2 > 0")
    sound = write_once(rows.withColumn("size", F.size("embedding")), "vectors")
    common = sound.groupBy("size").agg(F.count("*").alias("n"), F.max("norm2").alias("most"), F.count_if(F.col("vec_id") % every == 0).alias("asked")).orderBy(F.desc("n"), "size").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sound = sound.where(F.col("size") == common["size"]).select("vec_id", "embedding")
    if exact:
        search = _product_search(k)
    else:
        sample = _matrix(sound.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).toArrow())
        space = Space(sample, float(np.sqrt(common["most"])) * (1 + 1e-6), trees)
        search = _part_search(space, k, fitted(sample, space, k, common["n"]))
    parts, blocks = -(-common["n"] // part_rows), max(1, -(-common["asked"] // QUERY_ROWS))

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        # Equal rows go one by one, so that no id fills a part.
        place = F.pmod(F.xxhash64("vec_id", F.lit(SEED), F.monotonically_increasing_id()), F.lit(n)).cast("int")
        return df.withColumn(own, place).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    rows = dealt(sound, "part", parts, "block", blocks).groupBy("part", "block")
    asked = dealt(sound.where(F.col("vec_id") % every == 0).dropDuplicates(), "block", blocks, "part", parts).groupBy("part", "block")
    found = rows.cogroup(asked).applyInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"))
