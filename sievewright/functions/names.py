"""Folds, labels, codes and file names, as column functions."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What copies of a file are called, and the endings of results, longest first.
COPY_MARK = r"(?i)(?:\s\([0-9]+\)|\s-\s?[0-9]+|\scop(?:y|ie|ia)(?:\s[0-9]+)?)$"
RESULT_MARKS = ("_edit", "_enhanced", "_final")
RESULT_ENDING = r"(_edit|_final|_enhanced)(_[0-9]+)?$"
#: Numbered labels, labels with a shot, numbered folders, frame counters, parts of sets.
ORDERED_LABEL, PLAIN_LABEL = r"^([0-9]{1,2})_(.+?)_([0-9]{1,3}[a-z]?)$", r"^([^0-9_][^_]*?)[ _-]([0-9]{1,3}[a-z]?)$"
NUMBERED_FOLDER, COUNTER = r"^([0-9]{1,2})_(.+)$", r"^(.*?)([0-9]{3,})$"
PART, SPLIT, LEGACY_SPLIT = r"^(.+)-([0-9]{3})$", r"(?i)\.(?:zip|7z|rar)\.([0-9]{3})$", r"(?i)\.(?:z|r)([0-9]{2})$"


@lru_cache(maxsize=1)
def _bases() -> tuple[str, str]:
    """Letters that decompose into one character and marks, and those characters: a rule over Unicode's tables."""
    pairs = []
    for c in map(chr, range(0x80, min(sys.maxunicode, 0x10000))):
        plain = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if len(plain) == 1 and plain != c:
            pairs.append((c, plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold(text: Column) -> Column:
    """For keywords: lower case, without accents, composed or not. Scripts without accents stay as they are."""
    return F.regexp_replace(F.translate(F.lower(text), *_bases()), r"\p{Mn}+", "")


def _composed(name: Column) -> Column:
    def run(texts: pa.Array) -> pa.Array:  # goes to executors by value
        return pa.array([None if n is None else unicodedata.normalize("NFC", n).casefold() for n in texts.to_pylist()], pa.string())

    return F.arrow_udf(run, StringType())(name)


def same_name(name: Column) -> Column:
    """For file names: accents composed, case ignored; accents still count. Spark has no normal forms, hence a function over Arrow batches."""
    return _composed(name)


def fold_name(name: Column) -> Column:
    """``same_name`` without white space around it."""
    return F.regexp_replace(_composed(name), r"^\s+|\s+$", "")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(name: Column) -> Column:
    """The ending with its dot, in the case it has; empty without one. A name's first dot begins no ending."""
    return F.regexp_extract(basename(name), r"[^.].*?(\.[^.]+)$", 1)


def stem(path: Column) -> Column:
    name = basename(path)
    return F.substr(name, F.lit(1), F.length(name) - F.length(suffix(name)))


def code_pattern(described: str) -> str:
    """The pattern of a reference that is described with N for its digits, as ``WC-N``; for folded text."""
    head = described.rstrip("N")
    if head == described or not head:
        raise ValueError(f"no digits in the code {described!r}: write N for them")
    plain = "".join(c for c in unicodedata.normalize("NFD", head.lower()) if unicodedata.category(c) != "Mn")
    return "".join(c if c.isalnum() or c == "_" else f"[{c}]" for c in plain) + "[0-9]+"


def strip_codes(label: Column, codes: list[str]) -> Column:
    """The folded label without references (``codes``: patterns), ready for keywords."""
    out = fold(F.coalesce(label, F.lit("")))
    for pattern in codes:
        out = F.regexp_replace(out, pattern, " ")
    return F.regexp_replace(out, r"^[ \-_]+|[ \-_]+$", "")


def has_code(label: Column, codes: list[str]) -> Column:
    return fold(F.coalesce(label, F.lit(""))).rlike("|".join(codes)) if codes else F.lit(False)


def labels(path: Column, codes: list[str] = []) -> Column:
    """Of a path below the source: a struct of room, room_order, shot, area, area_order.

    The name says ``NN_Room_shot`` or ``Room shot``, unless a reference stands in it. The area
    is the first numbered folder. Without a room in the name the innermost folder is it, less
    its number, but not one with a reference, nor one whose whole name is the area's.
    """
    name, folders = stem(path), F.slice(F.split(path, "/"), 1, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0)))
    free = ~has_code(name, codes)
    ordered, plain = free & name.rlike(ORDERED_LABEL), free & name.rlike(PLAIN_LABEL)
    own = F.when(ordered, F.regexp_extract(name, ORDERED_LABEL, 2)).when(plain, F.regexp_extract(name, PLAIN_LABEL, 1))
    own = F.replace(F.trim(own), F.lit("_"), F.lit(" "))
    numbered = F.try_element_at(F.filter(folders, lambda f: f.rlike(NUMBERED_FOLDER)), F.lit(1))
    area = F.trim(F.regexp_extract(numbered, NUMBERED_FOLDER, 2))
    inner = F.try_element_at(folders, F.lit(-1))
    usable = inner.isNotNull() & ~has_code(inner, codes) & ~F.coalesce(inner == area, F.lit(False))
    fallback = F.when(usable, F.when(inner.rlike(NUMBERED_FOLDER), F.trim(F.regexp_extract(inner, NUMBERED_FOLDER, 2))).otherwise(F.trim(inner)))
    order = F.when(ordered, F.regexp_extract(name, ORDERED_LABEL, 1)).when(own.isNull() & usable & inner.rlike(NUMBERED_FOLDER), F.regexp_extract(inner, NUMBERED_FOLDER, 1))
    shot = F.when(ordered, F.regexp_extract(name, ORDERED_LABEL, 3)).when(plain, F.regexp_extract(name, PLAIN_LABEL, 2))
    return F.struct(
        F.coalesce(own, fallback).alias("room"), order.cast("int").alias("room_order"), shot.alias("shot"), area.alias("area"), F.regexp_extract(numbered, NUMBERED_FOLDER, 1).try_cast("int").alias("area_order"))


def without_copy_mark(name: Column) -> Column:
    """A copy's original name: the mark in front of the ending goes."""
    return F.concat(F.regexp_replace(stem(name), COPY_MARK, ""), suffix(name))


def counter(name: Column) -> tuple[Column, Column]:
    """A frame's prefix (the ending in lower case where there is none) and its number; null without three digits at the end."""
    own = stem(name)
    prefix = F.regexp_extract(own, COUNTER, 1)
    return F.when(own.rlike(COUNTER), F.when(prefix == "", F.lower(suffix(name))).otherwise(prefix)), F.when(own.rlike(COUNTER), F.regexp_extract(own, COUNTER, 2).cast("long"))


def strip_result(name: Column) -> Column:
    """A stem up to the first mark of a result, in the marks' order."""
    out = name
    for mark in reversed(RESULT_MARKS):
        out = F.when(name.contains(mark), F.substring_index(name, mark, 1)).otherwise(out)
    return out


def valid_slug(claimed: Column, slugs: list[str]) -> Column:
    """One of ``slugs`` that is meant: as it stands, with letters alone in upper case, or folded; else null."""
    bare = F.trim(F.regexp_replace(F.trim(F.coalesce(claimed, F.lit(""))), "^`+|`+$", ""))
    squashed = F.upper(F.regexp_replace(F.regexp_replace(bare, "[^A-Za-z]+", "_"), "^_+|_+$", ""))
    wanted = F.replace(F.lower(bare), F.lit(" "), F.lit("_"))
    folded = F.coalesce(*(F.when(wanted == s.casefold(), F.lit(s)) for s in slugs), F.lit(None).cast("string"))
    return F.when(bare.isin(*slugs), bare).when(squashed.isin(*slugs), squashed).otherwise(folded)


def ascii_name(name: Column) -> Column:
    """A name for stores that take ASCII alone: without accents, other characters as underscores."""
    cleaned = F.regexp_replace(F.regexp_replace(F.translate(name, *_bases()), r"\p{Mn}+", ""), "[^A-Za-z0-9._-]+", "_")
    return F.when(cleaned == "", "image.jpg").otherwise(cleaned)


def delivery_name(source: Column) -> Column:
    """What a person would call a delivery: the last part of a remote, ``Download`` for an address, or the file less its ending and part number."""
    remote, address = source.rlike("^[A-Za-z0-9_-]+:(?!//)"), source.rlike("^[a-z]+://")
    inner = F.regexp_replace(F.substring_index(source, ":", -1), "/+$", "")
    last = F.when(inner == "", F.substring_index(source, ":", 1)).otherwise(basename(inner))
    whole = F.regexp_replace(F.regexp_replace(basename(source), SPLIT, ""), LEGACY_SPLIT, "")
    local = F.regexp_replace(stem(whole), PART, "$1")
    name = F.trim(F.regexp_replace(F.when(address, "Download").when(remote, last).otherwise(local), r"[/\\:]", "-"))
    return F.when(name == "", "Delivery").otherwise(name)


def archive_set(path: Column) -> Column:
    """What the archives of one delivery share: folder, name without the part number and, for numbered wholes, the ending."""
    folder, name = F.regexp_extract(path, "^(.*/)?", 0), basename(path)
    part = F.concat(F.regexp_extract(stem(name), PART, 1), F.lit("|"), F.lower(suffix(name)))
    return F.concat(folder, F.when(stem(name).rlike(PART), part).when(name.rlike(SPLIT), F.regexp_replace(name, SPLIT, "")).when(name.rlike(LEGACY_SPLIT), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name))


def is_address(source: Column) -> Column:
    return source.rlike("^[a-z]+://")


def target(text: Column) -> Column:
    """``40-60`` or ``50`` as a struct lo, hi; null for other texts."""
    lo, hi = F.regexp_extract(text, r"^\s*([0-9]+)", 1).try_cast("int"), F.regexp_extract(text, r"[-–]\s*([0-9]+)\s*$", 1).try_cast("int")
    return F.when(text.rlike(r"^\s*[0-9]+\s*([-–]\s*[0-9]+\s*)?$"), F.struct(lo.alias("lo"), F.coalesce(hi, lo).alias("hi")))
