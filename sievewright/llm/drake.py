"""Centroid clustering with adaptive bounds (Drake and Hamerly, 2012), exact over integers.

Every vector keeps an upper bound of the distance to its own centroid, lower bounds of those
to its several next nearest, and one bound for all that remain. When centroids move, bounds
move with them. A vector whose own centroid is nearer than all bounds stays; one whose bounds
fail up to some place is compared with the centroids up to that place alone; one whose last
bound fails is compared with all. How many bounds are kept follows from how many were needed.

Vectors and centroids are integers and their squared distances exact; bounds are rounded
outwards, so they only ever cost a comparison more and no tie is left to them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import discard, fresh_path, table, write_at

CLUSTERS, ROUNDS, DIMENSION, SCALE, SALT = 16, 3, 64, 64, "1"
#: Bounds are drawn apart by this share, far more than doubles lose.
SLACK = 1e-12
STATE = "vec_id long, v array<int>, cluster int, was int, distance long, upper double, near array<int>, low array<double>, rest double, needed int"


def limit(dimension: int) -> int:
    """Components beyond it either way could give a squared distance that a long doesn't hold."""
    return int((2**62 / dimension) ** 0.5 / 2)


def _distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``v`` to all of ``c``, exact: in doubles where each sum fits their 53 bits."""
    most = max(int(np.abs(v).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * v.shape[1] * most * most < 2**53:
        x, y = v.astype(np.float64), c.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)).astype(np.int64)
    return np.stack([((v - one) ** 2).sum(1) for one in c], 1)


def _own(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to rows."""
    return ((v - c) ** 2).sum(-1)


class Bounds:
    """What a batch of vectors knows: the arrays of STATE but ids and vectors. ``upper`` is above, ``low`` and ``rest`` below the true distances."""

    def __init__(self, n: int, b: int):
        self.cluster, self.distance, self.upper = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
        self.near, self.low, self.rest, self.needed = np.zeros((n, b), np.int64), np.zeros((n, b)), np.full(n, np.inf), np.zeros(n, np.int64)

    def scan(self, rows: np.ndarray, v: np.ndarray, c: np.ndarray) -> None:
        """Compare ``rows`` with all centroids: the nearest, of equal ones the least number, the next as bounds, and the one behind them."""
        d, b = _distances(v[rows], c), self.near.shape[1]
        order = np.argsort(d, axis=1, kind="stable")
        d = np.take_along_axis(d, order, 1)
        far = np.sqrt(d.astype(np.float64)) * (1 - SLACK)
        self.cluster[rows], self.distance[rows], self.upper[rows] = order[:, 0], d[:, 0], np.sqrt(d[:, 0]) * (1 + SLACK)
        self.near[rows], self.low[rows], self.needed[rows] = order[:, 1 : b + 1], far[:, 1 : b + 1], b
        self.rest[rows] = far[:, b + 1] if len(c) > b + 1 else np.inf

    def move(self, moved: np.ndarray) -> None:
        """Centroids went as far as ``moved`` says."""
        self.upper = (self.upper + moved[self.cluster]) * (1 + SLACK)
        self.low = self.low * (1 - SLACK) - moved[self.near] * (1 + SLACK)
        self.rest = self.rest * (1 - SLACK) - moved.max(initial=0) * (1 + SLACK)

    def narrow(self, b: int) -> None:
        """Keep ``b`` bounds; the others join the last."""
        if b < self.near.shape[1]:
            self.rest = np.minimum(self.rest, self.low[:, b:].min(1))
            self.near, self.low = self.near[:, :b], self.low[:, :b]

    def places(self) -> np.ndarray:
        """For each row how many of ``near`` must be looked at: beyond them all bounds are above ``upper``. One more than there are where the last bound fails."""
        behind = np.concatenate([self.low, self.rest[:, None]], 1)
        behind = np.minimum.accumulate(behind[:, ::-1], axis=1)[:, ::-1]
        return (behind <= self.upper[:, None]).sum(1)

    def settle(self, v: np.ndarray, c: np.ndarray, exact: bool) -> None:
        """Find the nearest centroid of every row, comparing where bounds don't tell; with ``exact``, distances of all rows are made."""
        b = self.near.shape[1]
        rows = np.arange(len(v)) if exact else np.flatnonzero(self.places() > 0)
        self.distance[rows] = _own(v[rows], c[self.cluster[rows]])
        self.upper[rows] = np.sqrt(self.distance[rows].astype(np.float64)) * (1 + SLACK)
        z = self.places()
        self.needed = np.minimum(z, b)
        self.scan(np.flatnonzero(z > b), v, c)
        for most in range(1, b + 1):
            rows = np.flatnonzero(z == most)
            ids = np.concatenate([self.cluster[rows, None], self.near[rows, :most]], 1)
            d = _own(v[rows, None, :], c[ids])
            order = np.lexsort((ids, d), axis=1)
            ids, d = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
            far = np.sqrt(d.astype(np.float64))
            self.cluster[rows], self.distance[rows], self.upper[rows] = ids[:, 0], d[:, 0], far[:, 0] * (1 + SLACK)
            self.near[rows, :most], self.low[rows, :most] = ids[:, 1:], far[:, 1:] * (1 - SLACK)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, b = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * b + 1, b) if b else np.zeros(n + 1), pa.int32()), pa.array(values.ravel(), kind))


def _matrix(column: pa.Array, n: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(n, -1)


def _assigned(centroids: np.ndarray, moved: np.ndarray | None, b: int, exact: bool):
    """An Arrow function over (vec_id, v) or, with ``moved``, over the state of the round before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            v = _matrix(batch.column("v"), n, np.int64)
            know = Bounds(n, b)
            if moved is None:
                was = np.full(n, -1)
                know.scan(np.arange(n), v, centroids)
            else:
                one = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
                was, know.upper, know.rest = one("cluster").astype(np.int64), one("upper").copy(), one("rest").copy()
                know.cluster, know.near, know.low = was.copy(), _matrix(batch.column("near"), n, np.int64), _matrix(batch.column("low"), n, np.float64)
                know.move(moved)
                know.narrow(b)
                know.settle(v, centroids, exact)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("v"), pa.array(know.cluster, pa.int32()), pa.array(was, pa.int32()), pa.array(know.distance), pa.array(know.upper), _lists(know.near, pa.int32()),
                _lists(know.low, pa.float64()), pa.array(know.rest), pa.array(know.needed, pa.int32())], ["vec_id", "v", "cluster", "was", "distance", "upper", "near", "low", "rest", "needed"])

    return run


def _changes(k: int):
    """An Arrow function: what each task's vectors add to the centroids that they went to, and take from those that they left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), None
        for batch in batches:
            if n := batch.num_rows:
                v = _matrix(batch.column("v"), n, np.int64)
                total = np.zeros((k, v.shape[1]), np.int64) if total is None else total
                for name, sign in (("cluster", 1), ("was", -1)):
                    at = batch.column(name).to_numpy(zero_copy_only=False)
                    for j in np.unique(at[at >= 0]):
                        count[j] += sign * int((at == j).sum())
                        total[j] += sign * v[at == j].sum(0)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k), pa.int32()), pa.array(count), _lists(total, pa.int64())], ["cluster", "n", "total"])

    return run


def _add(state: DataFrame, count: list[int], total: list[list[int]]) -> None:
    """Bring counts and sums up to date from the rows that changed; the driver gets ``k`` times the dimension of numbers, whatever the table's size."""
    changed = state.where("cluster <> was").select("v", "cluster", "was").mapInArrow(_changes(len(count)), "cluster int, n long, total array<long>")
    wide = changed.select("cluster", F.posexplode(F.concat(F.array("n"), "total")).alias("at", "x"))
    for r in wide.groupBy("cluster", "at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).toLocalIterator():
        if r["at"] == 0:
            count[r["cluster"]] += int(r["x"])
        else:
            total[r["cluster"]][r["at"] - 1] += int(r["x"])


def clustered(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimension: int = DIMENSION, scale: int = SCALE, salt: str = SALT) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every kept vector of ``vectors`` (vec_id, embedding).

    Kept are vectors of ``dimension`` components, none null or not finite; a component x
    becomes the integer floor(scale * x). Those whose integers are beyond ``limit`` have
    distances that no long holds, and are left out too. The ``k`` kept vectors whose
    sha256 of ``salt:vec_id`` is least, or all if fewer, are the first centroids; each of ``rounds``
    rounds assigns every vector to its nearest (squared Euclidean distance, ties to the
    smaller number) and moves every centroid that has vectors to the floor of their mean;
    then vectors are assigned once more.

    Repeated rows count each by itself; of equal vec_ids the smaller vector is the earlier
    centroid; a null vec_id is the last to become one. An empty table gives no rows. Other
    columns are left out, whatever their names. The state of a round is written to the
    shared folder and takes the place of the one before; sums are kept up from the vectors
    that changed their centroid alone.
    """
    spark = vectors.sparkSession
    x = F.col("embedding")
    whole = F.when(F.size(x) == dimension, F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(F.floor(e.cast("double") * scale).cast("double")) <= limit(dimension))))
    points = vectors.where(whole).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("int")).alias("v"))
    first = points.orderBy(F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "v").limit(k).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.array([r["v"] for r in first], dtype=np.int64)
    k = len(centroids)
    least, b = min(k - 1, -(-k // 8)), min(k - 1, -(-k // 4))
    count, total = [0] * k, [[0] * dimension for _ in range(k)]
    at = fresh_path(spark, "clusters")
    state = write_at(points.mapInArrow(_assigned(centroids, None, b, True), STATE), at)
    for done in range(1, rounds + 1):
        _add(state, count, total)
        if done > 1:
            b = max(least, min(b, state.agg(F.max("needed")).first()[0]))
        new = np.array([[s // n for s in t] if n else c for n, t, c in zip(count, total, centroids.tolist())], dtype=np.int64)
        moved = np.sqrt(_own(new, centroids).astype(np.float64)) * (1 + SLACK)
        before, at, centroids = at, fresh_path(spark, "clusters"), new
        state = write_at(state.mapInArrow(_assigned(centroids, moved, b, done == rounds), STATE), at)
        discard(spark, before)
    sums = {r["cluster"]: r["s"] for r in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    # At most k rows.
    known = spark.createDataFrame([(j, s, sum(sums.values()), digest(centroids[j].tolist())) for j, s in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    squared = "list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    said = [f"""WITH kept AS (
  SELECT vec_id, row_number() OVER () AS place, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {DIMENSION} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT (row_number() OVER (ORDER BY sha256('{SALT}:' || vec_id)) - 1)::INTEGER AS cluster, v FROM kept QUALIFY cluster < {CLUSTERS}
)"""]
    for i in range(ROUNDS + 1):
        said.append(f"""a{i} AS (
  SELECT p.place, any_value(p.vec_id) AS vec_id, any_value(p.v) AS v, min({{'d': {squared}, 'cluster': c.cluster}}) AS best FROM kept p, c{i} c GROUP BY p.place
)""")
        if i < ROUNDS:
            said.append(f"""s{i} AS (
  SELECT best.cluster AS cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT best, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i}) GROUP BY ALL
), c{i + 1} AS (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} c
  LEFT JOIN (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM s{i} GROUP BY cluster) m ON m.cluster = c.cluster
)""")
    return ", ".join(said) + f"""
SELECT a.vec_id, a.best.cluster AS cluster, a.best.d AS distance, (sum(a.best.d) OVER (PARTITION BY a.best.cluster))::BIGINT AS cluster_inertia, (sum(a.best.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.cluster = a.best.cluster"""


ORACLE_SQL = _oracle()


def query(spark, sf_dir):
    return clustered(table(spark, sf_dir, "embeddings"))
