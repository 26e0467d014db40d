"""Flags, warnings, verdicts, sizes and ink, as column functions. What flags, warnings and verdicts say are fixed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievewright.functions.scalars import contrast

#: The ratios that are offered, and crop factors by camera, first match first.
RATIOS = {"21:9": 21 / 9, "16:9": 16 / 9, "3:2": 1.5, "4:3": 4 / 3, "5:4": 1.25, "1:1": 1.0, "4:5": 0.8, "3:4": 0.75, "2:3": 2 / 3, "9:16": 9 / 16}
CROP_FACTORS = {
    r"ILCE-7|A7|DSC-RX1|EOS R[P58]?$|EOS 5D|EOS 6D|EOS 1D X|D8[0-9]{2}|D7[45]0|Z [678]|LUMIX S": 1.0,
    r"ILCE-6|EOS R7|EOS R10|EOS 90D|EOS 7D|D5[0-9]{3}|D7[0-9]{3}|Z 50|Z fc|X-T[0-9]|X-H[0-9]|X-Pro": 1.5,
    r"EOS M|EOS [0-9]{3}D|EOS Rebel": 1.6,
    r"DC-G|DMC-G|OM-1|OM-5|E-M[0-9]": 2.0,
}


@dataclass(frozen=True)
class Limits:
    """Thresholds of a delivery's rules. The last four have fixed values."""

    roll_warn: float = 1.0
    roll_flag: float = 3.0
    convergence_warn: float = 5.0
    convergence_flag: float = 12.0
    focal_warn: float = 18.0
    focal_flag: float = 15.0
    least_lines: int = 6
    highlight_warn: float = 8.0
    highlight_some: float = 3.0
    shadow_warn: float = 12.0


def _texts(*rules: tuple[Column, Column]) -> Column:
    return F.array_compact(F.array(*(F.when(c, t) for c, t in rules)))


def flags(x: Limits, roll: Column, convergence: Column, focal_35: Column) -> Column:
    """Texts of the rules that are broken; a null measure breaks none."""
    return _texts(
        (F.abs(roll) >= x.roll_flag, F.format_string("leaning %+.1f°", F.bround(roll, 1))),
        (convergence >= x.convergence_flag, F.format_string("verticals splay %s° (three-point perspective)", _whole(convergence))),
        (focal_35 < x.focal_flag, F.format_string("%smm equivalent — edge stretching", _whole(focal_35))))


def warnings(x: Limits, roll: Column, convergence: Column, lines: Column, focal_35: Column, focal: Column, highlights: Column, shadows: Column, bracket: Column) -> Column:
    """Texts of what to look at: between the warning and the flag, unmeasured, or clipped."""
    blown = F.concat(F.format_string("%s%% blown out", _whole(highlights)), F.when(bracket, " — a bracket should fix this").otherwise(""))
    return _texts(
        ((F.abs(roll) >= x.roll_warn) & (F.abs(roll) < x.roll_flag), F.format_string("slight lean %+.1f°", F.bround(roll, 1))),
        ((convergence >= x.convergence_warn) & (convergence < x.convergence_flag), F.format_string("verticals splay %s°", _whole(convergence))),
        (convergence.isNull() & (lines < x.least_lines), F.format_string("geometry unmeasurable (%d verticals found)", lines)),
        ((focal_35 >= x.focal_flag) & (focal_35 < x.focal_warn), F.format_string("%smm equivalent, wide", _whole(focal_35))),
        (focal_35.isNull() & focal.isNotNull(), F.format_string("%smm, sensor unknown — can't check the wide-angle rule", _whole(focal))),
        (highlights >= x.highlight_warn, blown), (shadows >= x.shadow_warn, F.format_string("%s%% crushed black", _whole(shadows))))


def _whole(x: Column) -> Column:
    """To an integer, halves to the even one, as text."""
    return F.bround(x, 0).cast("long").cast("string")


def verdict(x: Limits, roll: Column, convergence: Column, focal_35: Column, highlights: Column, shadows: Column, frames: Column) -> Column:
    """What the measures say, in words: a number means nothing without its scale."""
    level = (F.when(roll.isNull(), "levelness not measurable").when(F.abs(roll) >= x.roll_flag, F.format_string("FAULT: leaning %s degrees off level", _whole(F.abs(roll))))
             .when(F.abs(roll) >= x.roll_warn, "slightly off level").otherwise("level"))
    upright = (F.when(convergence.isNull(), "too few verticals in frame to check them").when(convergence >= x.convergence_flag, "FAULT: verticals splay badly (three-point perspective)")
               .when(convergence >= x.convergence_warn, "verticals splay a little").otherwise("verticals straight"))
    light = F.when(highlights >= x.highlight_warn, "large blown-out areas").when(highlights >= x.highlight_some, "some blown highlights")
    dark = F.when(shadows >= x.shadow_warn, "crushed blacks")
    wide = F.when((focal_35 != 0) & (focal_35 < x.focal_flag), F.format_string("FAULT: %smm equivalent, stretches the edges", _whole(focal_35)))
    return F.concat_ws("; ", level, upright, light, dark, wide, F.when(frames > 1, F.format_string("exposure bracket of %d, will be merged", frames)))


def nearest_ratio(width: Column, height: Column) -> Column:
    """The offered ratio that is nearest; of two the first. Null without a height."""
    off = [F.struct(F.abs(width / height - v).alias("off"), F.lit(i).alias("place"), F.lit(k).alias("name")) for i, (k, v) in enumerate(RATIOS.items())]
    return F.when(height > 0, F.array_min(F.array(*off))["name"])


def round16(x: Column) -> Column:
    return F.greatest(F.lit(16), (F.bround(x / 16, 0) * 16).cast("int"))


def custom_size(width: Column, height: Column, long_edge: int = 2048) -> Column:
    """A struct width, height of the source's shape with the long edge given, both multiples of 16."""
    ratio = width / height
    w = F.when(ratio >= 1, F.lit(float(long_edge))).otherwise(long_edge * ratio)
    h = F.when(ratio >= 1, long_edge / ratio).otherwise(F.lit(float(long_edge)))
    return F.when(height > 0, F.struct(round16(w).alias("width"), round16(h).alias("height")))


def request(model: Column, width: Column, height: Column, long_edge: int = 2048) -> Column:
    """What a request asks for: a size where the model takes one, else a ratio."""
    size = custom_size(width, height, long_edge)
    return F.when(model.contains("gpt-image"), F.format_string("%dx%d", size["width"], size["height"])).otherwise(nearest_ratio(width, height))


def shutter(seconds: Column) -> Column:
    text = F.when(seconds >= 1, F.format_string("%.1fs", seconds)).otherwise(F.concat(F.lit("1/"), _whole(1 / F.nullif(seconds, F.lit(0.0)))))
    return F.when(seconds.isNull() | (seconds == 0), "—").otherwise(text)


def ev_span(values: Column) -> Column:
    """Between the least and the greatest of an array; 0 unless two are known."""
    known = F.array_compact(values)
    return F.when(F.size(known) > 1, F.array_max(known) - F.array_min(known)).otherwise(F.lit(0.0))


def geometry(width: Column, height: Column, art_width: Column, art_height: Column, share: float = 0.10, margin: float = 0.03) -> Column:
    """Width, height and margin of a mark: shares of the photo's long edge."""
    base = F.greatest(width, height)
    tall = F.bround(base * share, 0).cast("int")
    return F.struct(F.bround(tall * art_width / art_height, 0).cast("int").alias("width"), tall.alias("height"), F.bround(base * margin, 0).cast("int").alias("margin"))


def ink(ground: Column, spread: Column, dark: Column, light: Column, variant: Column, glow: Column, least: float = 4.0, busy: float = 0.18) -> Column:
    """The ink that stands out from ``ground``, a forced one first, and whether it needs a glow: weak contrast or a busy ground, unless that is told. Equal contrasts: dark."""
    d, b = contrast(ground, dark), contrast(ground, light)
    name = F.when(variant.isin("dark", "light"), variant).otherwise(F.when(d >= b, "dark").otherwise("light"))
    best = F.when(name == "dark", d).otherwise(b)
    return F.struct(
        name.alias("ink"), F.when(variant.isin("dark", "light"), "forced").otherwise("contrast").alias("why"), best.alias("contrast"),
        F.coalesce(glow, (best < least) | (spread > busy)).alias("glow"), F.when(best < least, "weak contrast").when(spread > busy, "busy ground").otherwise("").alias("reason"))


def crop_factor(model: Column) -> Column:
    """By the first pattern that the camera's name holds; null for others: a guess would be worse."""
    return F.coalesce(*(F.when(model.rlike(f"(?i){p}"), F.lit(v)) for p, v in CROP_FACTORS.items()))


def focal_35(recorded: Column, focal: Column, model: Column) -> Column:
    """Equivalent focal length and where it comes from: as recorded, or derived for a camera that is known."""
    told = F.when(recorded != 0, recorded)
    derived = F.when(focal != 0, F.bround(focal * crop_factor(model), 1))
    return F.struct(F.coalesce(told, derived).alias("mm"), F.when(told.isNotNull(), "exif").when(derived.isNotNull(), "derived").alias("source"))


def ratio(text: Column) -> Column:
    """A number as cameras write it, ``8/10`` or ``0.8``; null for other texts and a denominator of 0."""
    above, below = F.split_part(text, F.lit("/"), F.lit(1)).try_cast("double"), F.split_part(text, F.lit("/"), F.lit(2)).try_cast("double")
    return F.when(text.contains("/"), above / F.nullif(below, F.lit(0.0))).otherwise(text.try_cast("double"))


def subsecond(*tags: Column) -> Column:
    """Milliseconds by the first tag of digits alone: three of them, filled with zeros behind."""
    return F.coalesce(*(F.when(F.trim(t).rlike("^[0-9]+$"), F.rpad(F.substring(F.trim(t), 1, 3), 3, "0").cast("int")) for t in tags), F.lit(0))


def greys(pixels: Column, low: int = 2, high: int = 253) -> Column:
    """Percent of an array of grey values (0 to 255) that is crushed and blown; null without pixels."""
    n = F.size(pixels)
    share = lambda f: 100.0 * F.size(F.filter(pixels, f)) / n
    return F.when(n > 0, F.struct(share(lambda p: p <= low).alias("shadow_clip"), share(lambda p: p >= high).alias("highlight_clip")))


def sharpness(pixels: Column, width: Column) -> Column:
    """Variance of the four-neighbour Laplacian over the inner pixels of an image given row by row; null without inner pixels."""
    n = F.size(pixels)
    inner = F.filter(F.sequence(F.lit(1), n), lambda i: (i > width) & (i <= n - width) & ((i - 1) % width > 0) & ((i - 1) % width < width - 1))
    at = lambda i: F.element_at(pixels, i.cast("int")).cast("double")
    values = F.transform(inner, lambda i: at(i - 1) + at(i + 1) + at(i - width) + at(i + width) - 4 * at(i))
    sums = F.aggregate(values, F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("xx")), lambda s, v: F.struct((s["x"] + v).alias("x"), (s["xx"] + v * v).alias("xx")))
    return F.when(F.size(inner) > 0, sums["xx"] / F.size(inner) - (sums["x"] / F.size(inner)) * (sums["x"] / F.size(inner)))


#: Tags of times, parts of a second and equivalent lengths, the first that holds.
TIMES, PARTS = ("EXIF DateTimeOriginal", "EXIF DateTimeDigitized", "Image DateTime"), ("EXIF SubSecTimeOriginal", "EXIF SubSecTime")
EQUIVALENTS = ("EXIF FocalLengthIn35mmFilm", "EXIF FocalLengthIn35mmFormat")


def header(tags: Column) -> Column:
    """What a map of header tags says, as a struct; a tag that is missing or no number leaves its field null, never a default."""
    number = lambda name: ratio(tags[name])
    camera = F.nullif(F.trim(tags["Image Model"]), F.lit(""))
    length = focal_35(F.coalesce(*(ratio(tags[n]) for n in EQUIVALENTS)), number("EXIF FocalLength"), camera)
    at = F.coalesce(*(F.try_to_timestamp(tags[n], F.lit("yyyy:MM:dd HH:mm:ss")) for n in TIMES))
    return F.struct(
        at.cast("timestamp_ntz").alias("shot_at"), subsecond(*(tags[n] for n in PARTS)).alias("subsec"), number("EXIF ExposureBiasValue").alias("exposure_bias"), number("EXIF ExposureTime").alias("exposure_time"),
        F.nullif(number("EXIF ISOSpeedRatings").cast("int"), F.lit(0)).alias("iso"), camera.alias("camera"), number("EXIF FocalLength").alias("focal_mm"), length["mm"].alias("focal_35mm"), length["source"].alias("focal_35mm_source"))
