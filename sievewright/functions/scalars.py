"""Column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def linear(channel: Column) -> Column:
    """sRGB channel, 0 to 255, to linear light (WCAG 2)."""
    c = channel / 255.0
    return F.when(c <= 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4)))


def luminance(r: Column, g: Column, b: Column) -> Column:
    return 0.2126 * linear(r) + 0.7152 * linear(g) + 0.0722 * linear(b)


def contrast(a: Column, b: Column) -> Column:
    return (F.greatest(a, b) + 0.05) / (F.least(a, b) + 0.05)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def sign_bits(vector: Column, start: int, size: int) -> Column:
    """Bits of ``size`` components from ``start`` (0-based): 1 where positive, the first as the highest."""
    return F.aggregate(F.slice(vector, start + 1, size), F.lit(0).cast("long"), lambda s, x: s * 2 + F.when(x > 0, 1).otherwise(0))


def hash_halves(hexes: Column) -> tuple[Column, Column]:
    """A 16-digit hexadecimal hash as two integers; null for another text."""
    sound = hexes.rlike("^[0-9a-fA-F]{16}$")
    return tuple(F.when(sound, F.conv(F.substring(hexes, i, 8), 16, 10).cast("long")) for i in (1, 9))


def clamped_score(text: Column) -> Column:
    """A number cut to 0..10 as an integer; null if it is none."""
    n = text.try_cast("double").try_cast("int")
    return F.when(n.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(10), n)))


def first_of(*rules: tuple[Column, object], default=None) -> Column:
    """The value of the first rule that holds: the order is part of the meaning."""
    out = reduce(lambda w, r: (w.when if w is not None else F.when)(r[0], F.lit(r[1])), rules, None)
    return out.otherwise(F.lit(default))


def flagged(*rules: tuple[Column, str]) -> Column:
    """The names of the rules that hold, in order."""
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in rules)))


def human_bytes(n: Column) -> Column:
    out = F.concat(n.cast("string"), F.lit(" B"))
    for unit, size in (("KB", 1024), ("MB", 1024**2), ("GB", 1024**3)):
        out = F.when(n >= size, F.format_string(f"%.1f {unit}", n / float(size))).otherwise(out)
    return out


def when_short(stamp: Column) -> Column:
    """Day, month and time of an ISO stamp, as it is written there; empty for other texts."""
    pattern = r"^(\d{4})-(\d{2})-(\d{2})(?:[T ](\d{2}):(\d{2})(?::\d{2}(?:[.,]\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"
    part = lambda i: F.regexp_extract(stamp, pattern, i)
    hours, minutes = F.when(part(4) == "", "00").otherwise(part(4)), F.when(part(5) == "", "00").otherwise(part(5))
    sound = stamp.rlike(pattern) & F.try_to_date(F.substring(stamp, 1, 10)).isNotNull() & (hours.cast("string") < "24") & (minutes < "60")
    return F.when(sound, F.concat(part(3), F.lit("/"), part(2), F.lit(" "), hours, F.lit(":"), minutes)).otherwise("")


def table_cell(text: Column) -> Column:
    """Safe within a table of bars: the bar becomes a look-alike, white space one space."""
    return F.trim(F.regexp_replace(F.translate(text, "|", "∣"), r"\s+", " "))


def micros(at: Column) -> Column:
    """Microseconds since 1970 of a time without zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), at)
