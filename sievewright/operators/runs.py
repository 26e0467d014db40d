"""Bracket runs of frames, found in stretches of a fixed length.

Where a run that begins at a frame ends depends on the next few frames alone: ``hop`` leads
to the first frame of the next run. A stretch of frames is therefore a map from the place of
its first new run, one of ``most``, to that of the next stretch. Hops and maps are made for
all stretches at once, maps are composed in their order, and then every stretch is walked
through from the place that is now known. Stretches cut through keys and bursts alike, so
neither a key nor a burst needs a task of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.stages import Stages

#: Frames of a stretch, and maps that are composed in one task.
STRETCH, FAN = 1 << 16, 4096
MAP = "stretch long, leaves array<int>, holds array<boolean>, counts array<long>, keyed boolean"
#: The place of the first new run, whether the run that is open there holds together, and the key's runs so far.
ENTRY = "stretch long, first int, open boolean, runs long"


def hops(at: np.ndarray, value: np.ndarray, known: np.ndarray, fresh: np.ndarray, gap: float, most: int, spread: float) -> tuple[np.ndarray, np.ndarray]:
    """For each frame, as if a run began there: how many frames it has, and whether it holds together.

    ``known``: there is a value; ``fresh``: the frame is another key's, or it or the one
    before has no time. Of the last ``most`` frames only those that are given count.
    """
    n = len(at)
    with np.errstate(invalid="ignore"):
        cut = fresh | ~(np.diff(at, prepend=at[:1]) <= gap)
    same = np.full(n, -1)
    for d in range(min(most, n) - 1, 0, -1):
        equal = known[d:] & known[:-d] & ((value[d:] == value[:-d]) | (np.isnan(value[d:]) & np.isnan(value[:-d])))
        same[d:] = np.where(equal, np.arange(n - d), same[d:])
    hop = np.minimum(most, n - np.arange(n))
    for d in range(min(most, n) - 1, 0, -1):
        stop = cut[d:] | (same[d:] >= np.arange(n - d))
        hop[: n - d] = np.where(stop, d, hop[: n - d])
    low, high, whole = value.copy(), value.copy(), known.copy()
    for d in range(1, min(most, n)):
        within = np.flatnonzero(hop[: n - d] > d)
        low[within], high[within], whole[within] = np.minimum(low[within], value[within + d]), np.maximum(high[within], value[within + d]), whole[within] & known[within + d]
    # Not a number is beyond all numbers.
    return hop, (hop > 1) & whole & ~(high - low < spread)


def stretch_map(hop: np.ndarray, holds: np.ndarray, keyed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of the first ``most`` frames, if a run begins there: where the first run begins in the next stretch, whether the last one here holds, and how many runs begin here from then on, those of earlier keys left out.

    A run that doesn't hold is as many runs as it has frames.
    """
    n = len(hop)
    to = np.arange(n) + hop
    begins = int(np.flatnonzero(keyed)[-1]) if keyed.any() else 0
    count = np.append(np.where(np.arange(n) < begins, 0, np.where(holds, 1, np.minimum(hop, n - np.arange(n)))), 0)
    last, step = np.where(to < n, to, np.arange(n)), np.append(np.minimum(to, n), n)
    for _ in range(max(1, int(n).bit_length())):
        last, count, step = last[last], count + count[step], step[step]
    out = np.zeros(most, int), np.ones(most, bool), np.zeros(most, int)
    some = min(most, n)
    for o, x in zip(out, (to[last] - n, holds[last], count)):
        o[:some] = x[:some]
    return out


def walked(hop: np.ndarray, holds: np.ndarray, keyed: np.ndarray, first: int, held: bool, runs: int) -> tuple[np.ndarray, np.ndarray]:
    """The run of each frame within its key, from 1, and whether it holds; the stretch is entered with ``first``, ``held`` and ``runs``."""
    n = len(hop)
    begins, at, to = np.zeros(n, bool), first, hop.tolist()
    starts = []
    while at < n:
        starts.append(at)
        at += to[at]
    begins[starts] = True
    own = np.cumsum(begins)
    committed = np.append(held, holds[starts])[own]
    new = begins | ~committed
    run = np.cumsum(new)
    key = np.cumsum(keyed)
    before = np.append(-runs, run[keyed] - new[keyed])
    return run - before[key], committed


def _one(table: pa.Table, name: str) -> pa.Array:
    x = table.column(name)
    return x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return _one(table, name).to_numpy(zero_copy_only=False)


def _hopped(length: int, gap: float, most: int, spread: float):
    """An Arrow function: a stretch with the frame before it and those after it to its frames with their hops; its first frame carries the map."""

    def run(frames: pa.Table) -> pa.Table:
        frames = frames.take(pa.array(np.argsort(_numbers(frames, "g"), kind="stable")))
        stretch, g = _numbers(frames, "stretch")[0], _numbers(frames, "g")
        own = slice(*np.searchsorted(g, [stretch * length, (stretch + 1) * length]))
        key = _one(frames, "key").dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        keyed = np.append(True, key[1:] != key[:-1])
        dated = _one(frames, "at").is_valid().to_numpy(zero_copy_only=False)
        known = _one(frames, "value").is_valid().to_numpy(zero_copy_only=False)
        fresh = keyed | ~dated | ~np.append(True, dated[:-1])
        hop, holds = hops(_numbers(frames, "at").astype(float), _numbers(frames, "value").astype(float), known, fresh, gap, most, spread)
        hop, holds, keyed, n = hop[own], holds[own], keyed[own], own.stop - own.start
        leaves, open_, counts = stretch_map(hop, holds, keyed, most) if n else (np.zeros(0, int),) * 3
        blank = [None] * max(0, n - 1)
        out = frames.slice(own.start, n).select(["stretch", "g", "key", "name"])
        carried = {
            "hop": pa.array(hop, pa.int32()), "own_holds": pa.array(holds, pa.bool_()), "own_keyed": pa.array(keyed, pa.bool_()), "leaves": pa.array([leaves.tolist(), *blank][:n], pa.list_(pa.int32())),
            "holds": pa.array([open_.tolist(), *blank][:n], pa.list_(pa.bool_())), "counts": pa.array([counts.tolist(), *blank][:n], pa.list_(pa.int64())), "keyed": pa.array([bool(keyed.any()), *blank][:n], pa.bool_())}
        for name, column in carried.items():
            out = out.append_column(name, column)
        return out

    return run


def _ordered(maps: pa.Table):
    at = np.argsort(_numbers(maps, "stretch"))
    square = lambda name: np.array(_one(maps, name).to_pylist())[at]
    return at, square("stretch"), square("leaves"), square("holds"), square("counts"), square("keyed")


def _composed(maps: pa.Table) -> pa.Table:
    """The maps of stretches that follow each other as one map."""
    at, _, leaves, holds, counts, keyed = _ordered(maps)
    place, held, count, any_key = leaves[0], holds[0], counts[0], keyed[0]
    for i in range(1, len(at)):
        count = counts[i][place] + (0 if keyed[i] else count + np.where(held, 0, place))
        place, held, any_key = leaves[i][place], holds[i][place], any_key or keyed[i]
    return pa.table({
        "stretch": pa.array([_numbers(maps, "block")[0]], pa.int64()), "leaves": pa.array([place.tolist()], pa.list_(pa.int32())), "holds": pa.array([held.tolist()], pa.list_(pa.bool_())),
        "counts": pa.array([count.tolist()], pa.list_(pa.int64())), "keyed": pa.array([bool(any_key)])})


def _entered(maps: pa.Table) -> pa.Table:
    """The entries of stretches that follow each other, from that of the first."""
    at, stretch, leaves, holds, counts, keyed = _ordered(maps)
    place, held, runs = (_one(maps, x)[0].as_py() for x in ("first", "open", "runs"))
    out = []
    for i in range(len(at)):
        out.append((place, held, runs))
        runs = int(counts[i][place]) + (0 if keyed[i] else runs + (0 if held else place))
        place, held = int(leaves[i][place]), bool(holds[i][place])
    first, open_, runs = zip(*out)
    return pa.table({"stretch": pa.array(stretch, pa.int64()), "first": pa.array(first, pa.int32()), "open": pa.array(open_), "runs": pa.array(runs, pa.int64())})


def _entries(stages: Stages, maps: DataFrame, fan: int, level: int = 0) -> DataFrame:
    """The entry of every stretch: blocks of ``fan`` maps are composed, the blocks entered in the same way, and each block's maps walked from there."""
    blocked = maps.withColumn("block", F.floor(F.col("stretch") / fan))
    if maps.agg(F.max("stretch")).first()[0] < fan:
        start = blocked.select("*", F.lit(0).alias("first"), F.lit(True).alias("open"), F.lit(0).cast("long").alias("runs"))
    else:
        blocks = stages.write(f"blocks{level}", blocked.groupBy("block").applyInArrow(_composed, MAP))
        start = blocked.join(_entries(stages, blocks, fan, level + 1).withColumnRenamed("stretch", "block"), "block")
    return start.groupBy("block").applyInArrow(_entered, ENTRY)


def _placed(frames: pa.Table, entry: pa.Table) -> pa.Table:
    frames = frames.take(pa.array(np.argsort(_numbers(frames, "g"))))
    run, committed = walked(*(_numbers(frames, c) for c in ("hop", "own_holds", "own_keyed")), *(_one(entry, x)[0].as_py() for x in ("first", "open", "runs")))
    return frames.select(["key", "name"]).append_column("run", pa.array(run, pa.int64())).append_column("committed", pa.array(committed, pa.bool_()))


def numbered(rows: DataFrame, stages: Stages, *order: Column) -> DataFrame:
    """``rows`` with ``g``, their place from 0 in ``order``, without gaps.

    Ranges of ``order`` are sorted and written; a row's place is that in its task and the
    rows of the tasks before, of which there are as many counts as tasks.
    """
    tie = rows.withColumn("__tie", F.monotonically_increasing_id())
    at = F.monotonically_increasing_id()
    ranged = tie.repartitionByRange(*order, F.col("__tie")).sortWithinPartitions(*order, F.col("__tie")).drop("__tie")
    ranged = stages.write("ranged", ranged.withColumns({"__part": F.shiftright(at, 33), "__at": at.bitwiseAND(F.lit((1 << 33) - 1))}))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("__part").agg(F.count("*").alias("n")).select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    return ranged.join(F.broadcast(starts), "__part").withColumn("g", F.col("__start") + F.col("__at")).drop("__part", "__at", "__start")


def bracket_runs(frames: DataFrame, key: str, at: str, value: str, name: str, gap: float, most: int = 9, spread: float = 0.5, stretch: int = STRETCH, fan: int = FAN) -> DataFrame:
    """``run`` for each frame, its place among the key's runs, and ``committed``, whether that run holds together.

    In order of (``at`` in seconds, ``name``) a run goes on while the next frame comes within
    ``gap`` and its ``value`` isn't in the run yet and the run is shorter than ``most``. A null
    value repeats nothing. A run commits only with two frames or more, all with a value, and
    values at least ``spread`` apart; another dissolves into runs of one frame each. Frames
    without ``at`` are runs of one, at the end. Null keys are one key; frames that are equal
    in all of it are frames of their own; an empty table gives no rows.
    """
    if stretch < most:
        raise ValueError("a stretch has at least as many frames as a run")
    stages = Stages(frames.sparkSession, "runs")
    rows = frames.select(F.col(key).alias("key"), F.col(name).alias("name"), F.col(at).cast("double").alias("at"), F.col(value).cast("double").alias("value"))
    placed = numbered(rows, stages, F.col("key"), F.col("at").asc_nulls_last(), F.col("name"), F.col("value"))
    own, place = F.floor(F.col("g") / stretch), F.col("g") % stretch
    # A stretch also sees the frame before it and the first frames of the next.
    seen = F.filter(F.array(own, F.when(place < most, own - 1), F.when(place == stretch - 1, own + 1)), lambda s: s >= 0)
    names = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"stretch long, g long, key {names['key']}, name {names['name']}, hop int, own_holds boolean, own_keyed boolean, " + MAP.partition(", ")[2]
    hopped = stages.write("hopped", placed.withColumn("stretch", F.explode(seen)).groupBy("stretch").applyInArrow(_hopped(stretch, gap, most, spread), schema))
    stages.drop("ranged")
    maps = hopped.where("leaves is not null").select("stretch", "leaves", "holds", "counts", "keyed")
    if maps.isEmpty():
        return rows.select(F.col("key").alias(key), F.col("name").alias(name), F.lit(0).cast("long").alias("run"), F.lit(False).alias("committed")).limit(0)
    entries = stages.write("entries", _entries(stages, maps, fan))
    walks = hopped.select("stretch", "g", "key", "name", "hop", "own_holds", "own_keyed").groupBy("stretch").cogroup(entries.groupBy("stretch"))
    out = walks.applyInArrow(_placed, f"key {names['key']}, name {names['name']}, run long, committed boolean")
    return out.select(F.col("key").alias(key), F.col("name").alias(name), "run", "committed")
