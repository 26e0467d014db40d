"""Exact duplicates, Hamming links and their classes."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sievewright.functions.scalars import hamming
from sievewright.shipping import ship
from sievewright.stages import Stages, joined

BANDS, CHUNKS, NEAR = 13, 4, 3
#: Hashes of a block: two blocks are compared in one task.
BLOCK = 2048


def dedupe(files: DataFrame, size: str, digest, order: list, name: str) -> DataFrame:
    """``kept_as`` for each file: the first in ``order`` of those with its size and digest.

    Digests are made where the rows lie and only they travel, never what they are made of. The
    first of a group is found by partial minima and joined back, so a group of any number of
    copies is neither sorted nor held in one task. Null sizes and digests are equal.
    """
    needed = [c for c in files.columns if c == name or c == size or any(c == str(o) for o in order)]
    sorted_by = {f"__o{i}": F.expr(o) if isinstance(o, str) else o for i, o in enumerate(order)}
    slim = files.withColumn("__digest", digest).withColumns(sorted_by).select(*dict.fromkeys([*needed, name, size]), "__digest", *sorted_by)
    firsts = slim.groupBy(F.col(size).alias("__size"), F.col("__digest").alias("__own")).agg(F.min_by(name, F.struct(*sorted_by)).alias("kept_as"))
    same = F.col(size).eqNullSafe(F.col("__size")) & F.col("__digest").eqNullSafe(F.col("__own"))
    return slim.join(firsts, same).drop("__digest", "__size", "__own", *sorted_by)


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Places of links (a, b) among ``n`` nodes that keep together what all of them do; at most two for each node."""
    label, kept = np.arange(n), []
    while True:
        x, y = label[a], label[b]
        open_ = np.flatnonzero(x != y)
        if not len(open_):
            return np.unique(np.concatenate(kept)) if kept else open_
        # Each class takes one link that leaves it, and the classes on both sides their least number.
        both, place = np.concatenate([x[open_], y[open_]]), np.concatenate([open_, open_])
        _, first = np.unique(both, return_index=True)
        chosen = np.unique(place[first])
        kept.append(chosen)
        low, high = np.minimum(label[a[chosen]], label[b[chosen]]), np.maximum(label[a[chosen]], label[b[chosen]])
        root = np.arange(n)
        while (root[low] != root[high]).any():
            np.minimum.at(root, np.maximum(root[low], root[high]), np.minimum(root[low], root[high]))
            root = root[root]
        label = root[label]


def _near(kind: pa.DataType, most: int, bands: int, spanning: bool):
    """An Arrow function: two blocks of hashes, or one with itself, to their links; those of an earlier band are left to it."""

    def run(group: pa.Table) -> pa.Table:
        one = lambda name: group.column(name).combine_chunks()
        bits = one("high").to_numpy().astype(np.uint64) << np.uint64(32) | one("low").to_numpy().astype(np.uint64)
        own, i, j = one("own").to_numpy(), group.column("i")[0].as_py(), group.column("j")[0].as_py()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        found = []
        for at in range(0, len(left), 256):
            rows = left[at : at + 256]
            x, y = np.nonzero(np.bitwise_count(bits[rows, None] ^ bits[None, right]) <= most)
            x, y = rows[x], right[y]
            wanted = x < y if i == j else np.ones(len(x), bool)
            if bands and not spanning:
                band, differ = group.column("band")[0].as_py(), bits[x] ^ bits[y]
                for earlier in range(band):
                    wanted &= (differ >> np.uint64(_shift(earlier)) & np.uint64(_mask(earlier))) != 0
            found.append((x[wanted], y[wanted]))
        x, y = (np.concatenate(s) for s in zip(*found)) if found else (np.zeros(0, int),) * 2
        if spanning:
            kept = _spanning(x, y, len(bits))
            x, y = x[kept], y[kept]
        nodes = one("node")
        return pa.table({"a": nodes.take(pa.array(x)).cast(kind), "b": nodes.take(pa.array(y)).cast(kind), "distance": pa.array(np.bitwise_count(bits[x] ^ bits[y]).astype(np.int32))})

    return run


def _shift(band: int) -> int:
    """Bands are of five bits from the highest on; the last has four."""
    return max(0, 59 - 5 * band)


def _mask(band: int) -> int:
    return 0b11111 if band < BANDS - 1 else 0b1111


def _band(band: int) -> Column:
    """The band's bits of (high, low)."""
    shift = _shift(band)
    whole = F.shiftleft(F.col("high"), 32).bitwiseOR(F.col("low"))
    return F.shiftrightunsigned(whole, shift).bitwiseAND(F.lit(_mask(band)).cast("long"))


def _blocks(nodes: DataFrame, keys: list[str], most: int, spanning: bool, block: int) -> DataFrame:
    """Links within groups of ``keys``: a group's nodes are dealt into blocks, and each pair of blocks is a task's group."""
    ship(nodes.sparkSession)
    large = nodes.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > block).select(*keys, F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    sized = joined(nodes, large, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = sized.withColumn("own", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    kind = nodes.schema["node"].dataType
    return paired.groupBy(*keys, "i", "j").applyInArrow(_near(to_arrow_type(kind), most, int("band" in keys), spanning), f"a {kind.simpleString()}, b {kind.simpleString()}, distance int")


def hamming_links(items: DataFrame, bucket: str, name: str, high: str, low: str, most: int, spanning: bool = False, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b, distance), a < b, within a bucket whose 64 bits, in two halves, differ in at most ``most`` places; with ``spanning`` only links that keep together what all pairs do.

    Equal hashes are one node, which goes by their least name: the others are linked to it
    alone (distance 0), and nodes to each other. All pairs are made of that at last, as many
    as there are; with ``spanning`` it is the result, n equal items have n - 1 links, and two
    blocks at most two for each of their hashes. Null halves and buckets link nothing; an
    item that is there twice is one.

    Up to 12 differing bits leave one of 13 bands equal, so nodes meet by band. Up to 15, one
    of four chunks of 16 bits differs in at most three places (multi-index search): each node
    asks for the 697 values that near in each chunk. Beyond that a bucket's nodes are all
    compared. Groups that are compared are dealt into blocks, whose pairs are spread over
    tasks: a task compares two blocks' packed hashes.
    """
    own = items.where(F.col(high).isNotNull() & F.col(low).isNotNull() & F.col(bucket).isNotNull()).select(F.col(bucket).alias("bucket"), F.col(name).alias("name"), F.col(high).cast("long").alias("high"), F.col(low).cast("long").alias("low"))
    nodes = own.groupBy("bucket", "high", "low").agg(F.min("name").alias("node"))
    copies = own.join(nodes, ["bucket", "high", "low"]).where("name <> node").select(F.col("node").alias("a"), F.col("name").alias("b"), F.lit(0).alias("distance")).distinct()
    if most < BANDS:
        banded = nodes.withColumn("x", F.explode(F.array(*(F.struct(F.lit(i).alias("band"), _band(i).alias("bits")) for i in range(BANDS))))).select("node", "high", "low", "bucket", "x.band", "x.bits")
        near = _blocks(banded, ["bucket", "band", "bits"], most, spanning, block)
        near = near.distinct() if spanning else near
    elif most // CHUNKS <= NEAR:
        chunk = [F.shiftright(F.col(c), s).bitwiseAND(F.lit(0xFFFF)) for c in ("high", "low") for s in (16, 0)]
        flips = [sum(1 << i for i in some) for n in range(most // CHUNKS + 1) for some in itertools.combinations(range(16), n)]
        place = lambda i, c: F.lit(i << 16).cast("long") + c.cast("long")
        right = nodes.withColumn("band", F.explode(F.array(*(place(i, c) for i, c in enumerate(chunk)))))

        def around(i: int, c):
            return F.transform(F.array(*map(F.lit, flips)), lambda f: place(i, c.bitwiseXOR(f.cast("long"))))

        left = nodes.withColumn("band", F.explode(F.flatten(F.array(*(around(i, c) for i, c in enumerate(chunk))))))
        distance = hamming(F.col("a.high"), F.col("b.high")) + hamming(F.col("a.low"), F.col("b.low"))
        pairs = left.alias("a").join(right.alias("b"), [F.col("a.bucket") == F.col("b.bucket"), F.col("a.band") == F.col("b.band"), F.col("a.node") < F.col("b.node")]).where(distance <= most)
        near = pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), distance.cast("int").alias("distance")).distinct()
    else:
        near = _blocks(nodes, ["bucket"], most, spanning, block)
    near = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "distance")
    if spanning:
        return near.unionByName(copies)
    members = copies.select(F.col("a").alias("node"), F.col("b").alias("item")).unionByName(nodes.select("node", F.col("node").alias("item")))
    return _expanded(near, members)


def _expanded(once: DataFrame, members: DataFrame) -> DataFrame:
    """All pairs of items (node, item) by the links of their nodes."""
    own = members.alias("x").join(members.alias("y"), [F.col("x.node") == F.col("y.node"), F.col("x.item") < F.col("y.item")]).select(F.col("x.item").alias("a"), F.col("y.item").alias("b"), F.lit(0).alias("distance"))
    first = once.join(members.select(F.col("node").alias("a"), F.col("item").alias("x")), "a").join(members.select(F.col("node").alias("b"), F.col("item").alias("y")), "b")
    return own.unionByName(first.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "distance"))


def classes(items: DataFrame, name: str, links: DataFrame) -> DataFrame:
    """(name, class): the least name that links lead to; items without links are their own.

    Only linked items are passed over again and again; a pass is written once and takes the
    place of the one before. Labels halve their way to the root in each pass.
    """
    stages = Stages(items.sparkSession, "classes")
    # Once: another evaluation may choose other links of a class, and each is needed in both directions.
    links = stages.write("links", links.select("a", "b"))
    both = stages.write("both", links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    stages.drop("links")
    labels = stages.write("labels", both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("class")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("class").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("class").alias("old"), F.least("class", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("class").alias("far"))
        passed = stages.write("labels", hooked.join(jump, "mid").select("node", "old", F.least("mid", "far").alias("class")))
        labels = passed.select("node", "class")
        if passed.where("class != old").isEmpty():
            break
    stages.drop("both")
    return items.select(F.col(name).alias("node")).distinct().join(labels, "node", "left").select(F.col("node").alias(name), F.coalesce("class", "node").alias("class"))
