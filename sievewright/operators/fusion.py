"""Exposure fusion of committed runs, over frames given as arrays of RGB values."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.shipping import ship

#: The middle grey and the width of what counts as well exposed.
MIDDLE, WIDTH = 0.5, 0.2
#: Steps of two by which frames may be shifted against each other: up to 2^STEPS - 1 pixels either way.
STEPS = 5
#: Pixels of the shorter side that the coarsest bitmaps have at least.
COARSE = 24
#: Greys nearer to the median than this say nothing about a shift.
NOISE = 4


def grey(frame: np.ndarray) -> np.ndarray:
    return frame @ np.array([0.299, 0.587, 0.114])


def shifted(frame: np.ndarray, dy: int, dx: int) -> np.ndarray:
    """``frame`` moved down and to the right; what comes in from outside repeats the edge."""
    h, w = frame.shape[:2]
    return frame[np.clip(np.arange(h) - dy, 0, h - 1)][:, np.clip(np.arange(w) - dx, 0, w - 1)]


def _means(x: np.ndarray, n: int) -> np.ndarray:
    """Means of squares of ``n`` pixels; what is left at the edges goes."""
    h, w = x.shape[0] // n, x.shape[1] // n
    return x[: h * n, : w * n].reshape(h, n, w, n).mean(axis=(1, 3))


def shift(still: np.ndarray, moving: np.ndarray) -> tuple[int, int]:
    """How ``moving`` (grey) must be moved to lie on ``still``: bitmaps above the median are compared from coarse to fine, since a median doesn't depend on the exposure."""
    dy = dx = 0
    for step in range(min(STEPS, max(0, int(np.log2(max(1, min(still.shape) / COARSE))))), -1, -1):
        a, b = (_means(x, 1 << step) for x in (still, moving))
        maps = [(x > np.median(x), np.abs(x - np.median(x)) > NOISE) for x in (a, b)]
        best = None
        for i in (0, -1, 1):
            for j in (0, -1, 1):
                y, x = 2 * dy + i, 2 * dx + j
                differ = (maps[0][0] ^ shifted(maps[1][0], y, x)) & maps[0][1] & shifted(maps[1][1], y, x)
                found = (int(differ.sum()), abs(y) + abs(x), y, x)
                best = min(best, found) if best else found
        dy, dx = best[2], best[3]
    return dy, dx


def _smaller(x: np.ndarray) -> np.ndarray:
    """Half as large, by a binomial filter of five."""
    for axis in (0, 1):
        p = np.pad(x, [(2, 2) if a == axis else (0, 0) for a in range(x.ndim)], mode="edge" if x.shape[axis] < 3 else "reflect")
        n = x.shape[axis]
        x = sum(k * np.take(p, np.arange(0, n, 2) + i, axis) for i, k in enumerate((1 / 16, 4 / 16, 6 / 16, 4 / 16, 1 / 16)))
    return x


def _larger(x: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """``shape`` large, between neighbours in proportion."""
    for axis in (0, 1):
        at = np.arange(shape[axis]) / 2
        low = np.minimum(at.astype(int), x.shape[axis] - 1)
        part = (at - low).reshape([-1 if a == axis else 1 for a in range(x.ndim)])
        x = np.take(x, low, axis) * (1 - part) + np.take(x, np.minimum(low + 1, x.shape[axis] - 1), axis) * part
    return x


def weights(frame: np.ndarray) -> np.ndarray:
    """Of each pixel of a frame (0 to 1): contrast, colour and exposure together, never nothing."""
    p = np.pad(grey(frame), 1, mode="edge")
    contrast = np.abs(p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1])
    exposed = np.exp(-((frame - MIDDLE) ** 2).sum(axis=2) / (2 * WIDTH * WIDTH))
    return contrast * frame.std(axis=2) * exposed + 1e-12


def fuse(frames: list[np.ndarray]) -> np.ndarray:
    """Frames (height, width, 3; 0 to 255) of one shape as one: aligned on the middle one, weighed pixel by pixel, and blended at each scale by itself, so that no seam shows."""
    still = grey(frames[len(frames) // 2])
    stack = [shifted(f, *shift(still, grey(f))) / 255.0 for f in frames]
    own = [weights(f) for f in stack]
    total = np.sum(own, axis=0)
    own = [w / total for w in own]
    levels = max(1, int(np.log2(min(still.shape))))
    out: list[np.ndarray] = []
    for f, w in zip(stack, own):
        for level in range(levels):
            last = level == levels - 1
            less = None if last else _smaller(f)
            part = (f if last else f - _larger(less, f.shape[:2])) * w[..., None]
            if len(out) <= level:
                out.append(part)
            else:
                out[level] = out[level] + part
            if not last:
                f, w = less, _smaller(w)
    result = out[-1]
    for part in reversed(out[:-1]):
        result = _larger(result, part.shape[:2]) + part
    return np.clip(np.rint(result * 255.0), 0, 255).astype(np.uint8)


def _fused(frames: pa.Table) -> pa.Table:
    frames = frames.sort_by("name")
    names, widths = frames.column("name").to_pylist(), frames.column("width").to_pylist()
    arrays = [None if p is None else np.asarray(p, dtype=np.float64) for p in frames.column("pixels").to_pylist()]
    shapes = {(None if a is None or not w or len(a) % (3 * w) else (len(a) // (3 * w), w)) for a, w in zip(arrays, widths)}
    error, whole, width = None, None, None
    if None in shapes or (0, widths[0]) in shapes:
        error = "a frame without pixels in whole rows"
    elif len(shapes) > 1:
        error = "frames of different sizes are no bracket: " + ", ".join(f"{n} {w}x{len(a) // (3 * w)}" for n, a, w in zip(names, arrays, widths))
    else:
        height, width = shapes.pop()
        whole = fuse([a.reshape(height, width, 3) for a in arrays]).ravel().tolist()
    return pa.table({"run": frames.column("run").slice(0, 1), "frames": pa.array([len(names)], pa.int32()), "width": pa.array([width], pa.int32()), "pixels": pa.array([whole], pa.list_(pa.int32())), "error": pa.array([error], pa.string())})


def fused(frames: DataFrame, run: str, name: str, most: int = 9) -> DataFrame:
    """A row for each run of ``frames`` (run, name, width, pixels: RGB row by row): frames, width, the fused pixels, or an error.

    Runs are those of ``runs.bracket_runs``, of at most ``most`` frames, so a task holds so
    many; a longer one is no bracket and has an error. Frames of other sizes or without pixels
    give an error and stop nothing. Frames are aligned on the one in the middle by name.
    """
    ship(frames.sparkSession)
    kind = frames.schema[run].dataType.simpleString()
    own = frames.select(F.col(run).alias("run"), F.col(name).cast("string").alias("name"), F.col("width").cast("int").alias("width"), F.col("pixels").cast("array<int>").alias("pixels"))
    sizes = own.groupBy("run").agg(F.count("*").alias("n"))
    long = sizes.where(F.col("n") > most)
    made = own.join(long, "run", "left_anti").groupBy("run").applyInArrow(_fused, f"run {kind}, frames int, width int, pixels array<int>, error string")
    refused = long.select("run", F.col("n").cast("int").alias("frames"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("array<int>").alias("pixels"), F.format_string("%d frames are no bracket", "n").alias("error"))
    return made.unionByName(refused).withColumnRenamed("run", run)
