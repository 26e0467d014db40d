"""The measurement row of a photo: what its header says, what its pixels say, and what follows from both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.functions import pixels, quality
from sievewright.operators import geometry
from sievewright.sources.lines import file_kind

#: Orientations whose picture lies on its side.
TURNED = ("5", "6", "7", "8")


def facts(headers: DataFrame) -> DataFrame:
    """Rows of ``photo_headers`` with what their tags say: is_raw, upright width and height, orientation_applied, the fields of ``quality.header``, and notes on what is missing."""
    turned = F.coalesce(F.col("tags")["Image Orientation"].isin(*TURNED), F.lit(False))
    told = headers.withColumn("__h", quality.header(F.coalesce("tags", F.create_map().cast("map<string,string>"))))
    notes = F.array_compact(F.array(
        F.when(F.col("error").isNotNull(), F.concat(F.lit("header unreadable: "), "error")), F.when(F.col("error").isNull() & (F.size(F.coalesce("tags", F.create_map().cast("map<string,string>"))) == 0), "no tags at all"),
        F.when(F.col("__h.shot_at").isNull(), "no time: it can't be part of a bracket"), F.when(F.col("__h.focal_mm").isNotNull() & F.col("__h.focal_35mm").isNull(), "the sensor's size is unknown")))
    return told.select(
        "path", F.col("size").alias("bytes_on_disk"), (file_kind(F.col("path")) == "raw").alias("is_raw"), F.when(turned, F.col("height")).otherwise(F.col("width")).alias("width"),
        F.when(turned, F.col("width")).otherwise(F.col("height")).alias("height"), turned.alias("orientation_applied"), "__h.*", notes.alias("notes"))


def measurements(headers: DataFrame, pictures: DataFrame, limits: quality.Limits = quality.Limits()) -> DataFrame:
    """A row for each of ``headers``: its ``facts``, the measures of its picture (path, pixels: greys row by row, grey_width), and flags, warnings and verdict.

    A photo without a picture has null measures, and its flags are those of its header alone;
    a picture without a header is left out. Pictures are measured where they lie; only lines
    and measures are joined.
    """
    seen = pictures.select("path", F.col("grey_width").cast("int").alias("w"), pixels.measured(F.col("pixels"), F.col("grey_width")).alias("m"), pixels.segments(F.col("pixels"), F.col("grey_width")).alias("s"))
    lines = seen.select("path", "w", F.col("m.height").alias("h"), F.explode("s").alias("s")).select("path", "w", "h", "s.*")
    upright = geometry.vertical_geometry(lines, "path", ["x1", "y1", "x2", "y2"])
    measured = seen.where("m.height is not null").select("path", "m.shadow_clip", "m.highlight_clip", "m.sharpness", "m.high", "m.low").join(upright, "path", "left").withColumn("lines", F.coalesce("lines", F.lit(0)))
    out = facts(headers).join(measured, "path", "left")
    roll, splay, focal = F.col("roll_deg"), F.col("convergence_deg"), F.col("focal_35mm")
    return out.withColumns({
        "flags": quality.flags(limits, roll, splay, focal), "warnings": quality.warnings(limits, roll, splay, F.col("lines"), focal, F.col("focal_mm"), F.col("highlight_clip"), F.col("shadow_clip"), F.lit(False)),
        "verdict": quality.verdict(limits, roll, splay, focal, F.col("highlight_clip"), F.col("shadow_clip"), F.lit(1))})
