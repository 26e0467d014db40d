"""Whether a building's verticals stay vertical, from line segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def vertical_geometry(segments: DataFrame, photo: str, order: list, lean: float = 15.0, length: float = 0.14, least: int = 6, span: float = 0.35, most: int = 40, apart: float = 0.05) -> DataFrame:
    """``convergence_deg``, ``roll_deg`` and ``lines`` of each photo of ``segments`` (x1, y1, x2, y2, w, h).

    Usable are segments that lean at most ``lean`` degrees and are at least ``length`` of the
    frame's height long. Of too few, or of such that stand too close together, both measures
    are null: unknown isn't straight. The slope of the lean over the frame is the median of
    pairs (Theil-Sen) of at most ``most`` segments, evenly chosen in ``order``, that stand
    ``apart`` of the width apart, so pairs are bounded however many segments there are; the
    roll is the median lean that is left at the middle, over all of them.
    """
    down = F.col("y2") < F.col("y1")
    dx = F.when(down, F.col("x1") - F.col("x2")).otherwise(F.col("x2") - F.col("x1")).cast("double")
    dy = F.abs(F.col("y2") - F.col("y1")).cast("double")
    own = segments.withColumns({"__x": (F.col("x1") + F.col("x2")) / 2.0, "__y": F.degrees(F.atan2(dx, dy)), "__long": F.sqrt(dx * dx + dy * dy), "__dy": dy})
    good = (F.col("__dy") > 0) & (F.abs("__y") <= lean) & (F.col("__long") >= F.col("h") * length)
    lines = own.groupBy(photo).agg(F.count_if(good).alias("lines"))
    used = own.where(good).withColumns({"__i": F.row_number().over(Window.partitionBy(photo).orderBy(*order)) - 1, "__n": F.count("*").over(Window.partitionBy(photo))})
    spread = used.groupBy(photo).agg(F.first("w").alias("w"), (F.max("__x") - F.min("__x")).alias("__span"), F.first("__n").alias("__n")).where((F.col("__n") >= least) & (F.col("__span") >= F.col("w") * span)).select(photo)
    used = used.join(spread, photo).select(photo, "w", "__x", "__y", "__i", "__n")
    k = F.ceil(F.col("__i") * (most - 1) / F.greatest(F.lit(1), F.col("__n") - 1))
    some = used.where((F.col("__n") <= most) | (F.floor(k * (F.col("__n") - 1) / (most - 1)) == F.col("__i")))
    a, b = some.alias("a"), some.alias("b")
    pairs = a.join(b, (F.col(f"a.{photo}") == F.col(f"b.{photo}")) & (F.col("a.__i") < F.col("b.__i"))).where(F.abs(F.col("b.__x") - F.col("a.__x")) > F.col("a.w") * apart)
    slopes = pairs.groupBy(F.col(f"a.{photo}").alias(photo)).agg(F.median((F.col("b.__y") - F.col("a.__y")) / (F.col("b.__x") - F.col("a.__x"))).alias("__slope"), F.count("*").alias("__pairs")).where("__pairs >= 3")
    fit = used.join(slopes, photo).groupBy(photo).agg(
        F.bround(F.abs(F.first("__slope") * F.first("w")), 2).alias("convergence_deg"), F.bround(F.median(F.col("__y") - F.col("__slope") * (F.col("__x") - F.col("w") / 2.0)), 2).alias("roll_deg"))
    return lines.join(fit, photo, "left").select(photo, "convergence_deg", "roll_deg", "lines")
