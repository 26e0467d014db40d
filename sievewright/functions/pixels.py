"""Measures of grey pictures, given row by row as arrays of 0 to 255: clipping, sharpness, a perceptual hash, line segments.

Functions over Arrow batches: pictures of one shape are stacked and measured together.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewright.shipping import ship

#: Greys that are crushed and blown, the side to which a picture is brought, and the side of what is kept of its transform.
LOW, HIGH, SIDE, KEPT = 2, 253, 32, 8
#: Coefficients that differ by less are equal: a flat picture has no noise for a hash.
STEP = 1e-6
#: Gradients of an edge that begins a line and of one that goes on with it, degrees of a step of the voting table, and shares of the height of the shortest line and the longest gap.
STRONG, WEAK, ANGLE, LENGTH, GAP = 180.0, 60.0, 0.5, 0.14, 0.02
#: Degrees that a line may lean, degrees that an edge may differ from its line, pixels that it may lie beside it, and the share of a line's rows that have an edge.
LEAN, TURN, BESIDE, COVER = 20.0, 8.0, 1.5, 0.75

_MEASURES = T.StructType([T.StructField(n, k()) for n, k in (
    ("shadow_clip", T.DoubleType), ("highlight_clip", T.DoubleType), ("sharpness", T.DoubleType), ("high", T.LongType), ("low", T.LongType), ("height", T.IntegerType))])
_SEGMENTS = T.ArrayType(T.StructType([T.StructField(n, T.DoubleType()) for n in ("x1", "y1", "x2", "y2")]))


@lru_cache(maxsize=256)
def areas(n: int) -> np.ndarray:
    """What each of ``n`` pixels in a row gives to each of SIDE that cover the same length."""
    edge = np.arange(SIDE + 1) * n / SIDE
    own = np.arange(n)
    return np.clip(np.minimum(edge[1:, None], own + 1) - np.maximum(edge[:-1, None], own), 0, None) * SIDE / n


@lru_cache(maxsize=1)
def cosines() -> np.ndarray:
    k, j = np.arange(KEPT)[:, None], np.arange(SIDE)
    return 2 * np.cos(np.pi * k * (2 * j + 1) / (2 * SIDE))


def hashes(pictures: np.ndarray) -> np.ndarray:
    """64 bits of each of a stack (n, height, width): which low frequencies of the cosine transform are above their median, row by row from the highest bit."""
    small = areas(pictures.shape[1]) @ pictures @ areas(pictures.shape[2]).T
    low = np.round((cosines() @ small @ cosines().T).reshape(len(pictures), -1) / STEP) * STEP
    bits = low > np.median(low, axis=1, keepdims=True)
    return (bits.astype(np.uint64) << np.arange(KEPT * KEPT - 1, -1, -1, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def laplacians(pictures: np.ndarray) -> np.ndarray:
    """Variance of the four-neighbour Laplacian over the inner pixels of each of a stack; not a number without inner pixels."""
    if min(pictures.shape[1:]) < 3:
        return np.full(len(pictures), np.nan)
    p = pictures
    inner = p[:, :-2, 1:-1] + p[:, 2:, 1:-1] + p[:, 1:-1, :-2] + p[:, 1:-1, 2:] - 4 * p[:, 1:-1, 1:-1]
    return inner.reshape(len(p), -1).var(axis=1)


def _shapes(pixels: pd.Series, width: pd.Series) -> dict[tuple[int, int], list[int]]:
    """Places of the pictures that have pixels in whole rows, by height and width."""
    out: dict[tuple[int, int], list[int]] = {}
    for i, (p, w) in enumerate(zip(pixels, width)):
        if p is not None and w is not None and w == w and w > 0 and len(p) and len(p) % int(w) == 0:
            out.setdefault((len(p) // int(w), int(w)), []).append(i)
    return out


@F.pandas_udf(_MEASURES)
def _measured(pixels: pd.Series, width: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame({f.name: pd.Series([None] * len(pixels), dtype=object) for f in _MEASURES})
    for (h, w), at in _shapes(pixels, width).items():
        # Some 32 MB of doubles at once, or one picture.
        for some in np.array_split(at, max(1, len(at) * h * w // (4 << 20))):
            stack = np.stack([np.asarray(pixels.iloc[i], dtype=np.float64) for i in some]).reshape(-1, h, w)
            code, sharp = hashes(stack), laplacians(stack)
            flat = stack.reshape(len(some), -1)
            for i, j in enumerate(some):
                out.iloc[j] = [
                    float((flat[i] <= LOW).mean() * 100), float((flat[i] >= HIGH).mean() * 100), None if np.isnan(sharp[i]) else float(sharp[i]), int(code[i] >> np.uint64(32)), int(code[i] & np.uint64(0xFFFFFFFF)), h]
    return out


def measured(pixels: Column, width: Column) -> Column:
    """A struct: shadow_clip and highlight_clip in percent, sharpness, the two halves of the hash, height. Null fields where pixels are null, empty or no whole rows; sharpness also without inner pixels."""
    ship(SparkSession.active())
    return _measured(pixels, width.cast("int"))


def edges(picture: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, column (between pixels), lean in degrees and gradient of the edges of upright lines: where the gradient along a row is greatest."""
    p = np.pad(picture, 1, mode="edge")
    gx = (p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[1:-1, :-2] + p[2:, :-2])
    gy = (p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[:-2, 1:-1] + p[:-2, 2:])
    size = np.abs(gx) + np.abs(gy)
    upright = (np.abs(gy) <= np.tan(np.radians(LEAN + TURN)) * np.abs(gx)) & (size >= WEAK)
    before, after = np.pad(size, ((0, 0), (1, 0)))[:, :-1], np.pad(size, ((0, 0), (0, 1)))[:, 1:]
    y, x = np.nonzero(upright & (size > before) & (size >= after))
    a, b, c = before[y, x], size[y, x], after[y, x]
    # The top of the parabola through three gradients.
    beside = 0.5 * (a - c) / np.where(a - 2 * b + c == 0, 1, a - 2 * b + c)
    return y, x + np.clip(beside, -0.5, 0.5), -np.degrees(np.arctan(gy[y, x] / gx[y, x])), b


def lines(picture: np.ndarray) -> list[tuple[float, float, float, float]]:
    """Segments (x1, y1, x2, y2) of lines that lean at most LEAN, from the top down: edges vote for angle and offset, and a peak's edges are traced, fitted and taken away."""
    h, w = picture.shape
    least, gap = max(3.0, h * LENGTH), max(1.0, h * GAP)
    y, x, lean, size = edges(picture)
    angles = np.arange(-LEAN, LEAN + ANGLE / 2, ANGLE)
    slope, pad = np.tan(np.radians(angles)), int(np.ceil(np.tan(np.radians(LEAN)) * h)) + 2
    width = w + 2 * pad
    votes = np.zeros((len(angles), width), np.int32)

    def vote(some: np.ndarray, by: int) -> None:
        for i in range(len(angles)):
            own = some[(np.abs(lean[some] - angles[i]) <= TURN) & (size[some] >= STRONG)]
            votes[i] += by * np.bincount(np.rint(x[own] - slope[i] * (y[own] - h / 2)).astype(int) + pad, minlength=width).astype(np.int32)

    alive = np.ones(len(y), bool)
    vote(np.arange(len(y)), 1)
    found = []
    while len(y):
        i, offset = np.unravel_index(int(votes.argmax()), votes.shape)
        if votes[i, offset] < least * 0.5:
            break
        off = x - slope[i] * (y - h / 2) - (offset - pad)
        own = np.flatnonzero(alive & (np.abs(off) <= BESIDE) & (np.abs(lean - angles[i]) <= TURN))
        own = own[np.argsort(y[own], kind="stable")]
        taken = []
        for run in np.split(own, np.flatnonzero(np.diff(y[own]) > gap + 1) + 1):
            rows = np.unique(y[run])
            if not len(run) or rows[-1] - rows[0] + 1 < least or len(rows) < COVER * (rows[-1] - rows[0] + 1) or (size[run] >= STRONG).mean() < 0.5:
                continue
            b, a = np.polyfit(y[run], x[run], 1)
            if np.hypot(1, b) * (rows[-1] - rows[0]) < least or np.abs(x[run] - a - b * y[run]).mean() > BESIDE / 2:
                continue
            found.append((float(a + b * rows[0]), float(rows[0]), float(a + b * rows[-1]), float(rows[-1])))
            # All that lies on the fitted line goes with it.
            taken.append(np.flatnonzero(alive & (y >= rows[0]) & (y <= rows[-1]) & (np.abs(x - a - b * y) <= 2 * BESIDE)))
        if taken:
            gone = np.unique(np.concatenate([*taken]))
            vote(gone, -1)
            alive[gone] = False
        votes[i, offset] = -(1 << 30)
    return sorted(found)


@F.pandas_udf(_SEGMENTS)
def _lines(pixels: pd.Series, width: pd.Series) -> pd.Series:
    out: list = [None] * len(pixels)
    for (h, w), at in _shapes(pixels, width).items():
        for i in at:
            out[i] = [dict(zip(("x1", "y1", "x2", "y2"), s)) for s in lines(np.asarray(pixels.iloc[i], dtype=np.float64).reshape(h, w))]
    return pd.Series(out)


def segments(pixels: Column, width: Column) -> Column:
    """The line segments of a picture that lean at most LEAN degrees from upright, for ``operators.geometry``; null where there is no picture, empty where it has none."""
    ship(SparkSession.active())
    return _lines(pixels, width.cast("int"))
