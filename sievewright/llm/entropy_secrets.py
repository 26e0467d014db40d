"""Secrets by form and by sliding-window entropy, in DataFrame functions alone.

Three kinds are known by their form: an assignment to a telling name, an access key, a long
hexadecimal run. The method adds what has no form: in runs of a character class, windows
whose Shannon entropy reaches the class's bound. A window slides by one character; the
counts of its characters change by the one that enters and the one that leaves, and so does
the sum of n * log2(n) over them, which is kept in whole numbers, so that no order of adding
matters. Runs that an allow-list covers are left out: words, numbers, UUIDs, alphabets,
examples.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import table

#: Names that are assigned secrets, what may follow them, and the least lengths of a value, an access key and a hexadecimal run.
NAMES = "password|passwd|secret|token|api_?key"
ASSIGNED = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
#: Patterns of the base kinds in their order. An assignment's value is its first group; a run is taken whole, so its least length can stand in the pattern.
BASE = {"assign": f"(?i:{NAMES}){ASSIGNED}", "access": f"AKIA[A-Z0-9]{{{LEAST_ACCESS - 4},}}", "hex": f"[0-9a-f]{{{LEAST_HEX},}}"}


@dataclass(frozen=True)
class Class:
    """Characters (as within brackets, and all of them in order), a window's length, and the bits a character that it must reach."""

    kind: str
    brackets: str
    alphabet: str
    window: int
    bits: float

    @property
    def run(self) -> str:
        return f"[{self.brackets}]{{{self.window},}}"

    @property
    def most(self) -> int:
        """The greatest sum of a window that reaches ``bits``: entropy is log2(window) less the sum over the window."""
        return math.floor(self.window * (math.log2(self.window) - self.bits) * UNIT)

    @property
    def parts(self) -> list[int]:
        """n * log2(n) in units, for n from 0 to the window."""
        return [round(n * math.log2(n) * UNIT) if n else 0 for n in range(self.window + 1)]


#: Steps of n * log2(n) that are told apart, for each bit.
UNIT = 1 << 20
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
CLASSES = (Class("entropy16", "0-9a-fA-F", DIGITS + "abcdefABCDEF", 20, 3.0), Class("entropy64", "A-Za-z0-9+/_=-", UPPER + LOWER + DIGITS + "+/_=-", 24, 4.0))
#: A run is allowed if nothing is left once one of these is taken out of it,
ALLOWED = (
    "[A-Z]?[a-z]{2,}|[A-Z]{3,}|[0-9]+|[-_/+=]+", "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "^.*(?:EXAMPLE|[Ee]xample|PLACEHOLDER|[Pp]laceholder|CHANGEME|[Cc]hangeme).*$")
#: or if it lies within one of these.
ORDERED = (UPPER + LOWER + DIGITS + "+/=", LOWER + UPPER + DIGITS + "-_", DIGITS + UPPER + LOWER, DIGITS + LOWER + UPPER, DIGITS + "abcdef" + DIGITS + "abcdef", DIGITS + "ABCDEF" + DIGITS + "ABCDEF")
#: Windows of one fold, and numbers of one running sum: what a fold appends is copied with each step.
BLOCK = 128
SPAN = "struct<start:bigint,place:int,end:bigint,kind:string>"


def _let(value: Column, then) -> Column:
    """``then`` of a value that is worked out once, however often it is named."""
    return F.transform(F.array(value), then)[0]


def _folded(numbers: Column) -> Column:
    """Running sums of a short array."""
    none = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("out"))

    def add(s: Column, x: Column) -> Column:
        return F.struct((s["sum"] + x).alias("sum"), F.concat(s["out"], F.array(s["sum"] + x)).alias("out"))

    return F.aggregate(numbers, none, add, lambda s: s["out"])


def _running(numbers: Column) -> Column:
    """Running sums of an array (of longs, not empty): within blocks, and of the blocks."""

    def blocks(of: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(of) - 1) / BLOCK).cast("int")), lambda k: _folded(F.slice(of, k * BLOCK + 1, F.lit(BLOCK))))

    def joined(parts: Column) -> Column:
        ends = _folded(F.transform(parts, lambda p: F.element_at(p, -1)))
        return _let(ends, lambda e: F.flatten(F.transform(parts, lambda p, k: F.transform(p, lambda x: x + F.when(k == 0, F.lit(0).cast("long")).otherwise(F.get(e, k - 1))))))

    return _let(numbers, lambda n: _let(blocks(n), joined))


def _found(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, text), starts counted in code points from 0; null if there are none."""

    def placed(parts: Column) -> Column:
        sizes = F.transform(parts["found"], lambda x, i: (F.length(x) + F.length(F.get(parts["between"], i))).cast("long"))
        return _let(_running(sizes), lambda ends: F.transform(parts["found"], lambda x, i: F.struct((F.get(ends, i) - F.length(x)).alias("start"), x.alias("text"))))

    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between"))
    return F.when(text.rlike(pattern), _let(parts, placed))


def _span(start: Column, end: Column, place: int, kind: str) -> Column:
    return F.struct(start.cast("long").alias("start"), F.lit(place).alias("place"), end.cast("long").alias("end"), F.lit(kind).alias("kind"))


def _whole(found: Column, place: int, kind: str) -> Column:
    return F.transform(found, lambda m: _span(m["start"], m["start"] + F.length(m["text"]), place, kind))


def _base(text: Column) -> list[Column]:
    out = []
    for place, (kind, pattern) in enumerate(BASE.items()):
        found = _found(text, pattern)
        if kind == "assign":
            found = F.filter(found, lambda m: F.length(F.regexp_extract(m["text"], f"^(?:{BASE['assign']})$", 1)) >= LEAST_VALUE)
        out.append(_whole(found, place, kind))
    return out


def _flags(piece: Column, of: Class) -> Column:
    """For each window of ``piece``, a short string, whether its entropy reaches the bound: one fold, a character entering and one leaving at each step."""
    parts = F.array(*map(F.lit, of.parts))
    none = F.struct(F.array_repeat(F.lit(0), len(of.alphabet)).alias("counts"), F.lit(0).alias("sum"), F.array().cast("array<boolean>").alias("flags"))

    def changed(counts: Column, at: Column, by: int) -> Column:
        return F.concat(F.slice(counts, F.lit(1), at - 1), F.array(F.get(counts, at - 1) + by), F.slice(counts, at + 1, F.lit(len(of.alphabet))))

    def counted(s: Column, at: Column, by: int) -> Column:
        held = F.get(s["counts"], at - 1)
        return F.struct(changed(s["counts"], at, by).alias("counts"), (s["sum"] + F.get(parts, held + by) - F.get(parts, held)).alias("sum"), s["flags"].alias("flags"))

    def slid(codes: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            left = F.when(i >= of.window, counted(s, F.get(codes, i - of.window), -1)).otherwise(s)
            entered = _let(left, lambda s: counted(s, F.get(codes, i), 1))
            return _let(entered, lambda s: F.struct(
                s["counts"].alias("counts"), s["sum"].alias("sum"), F.when(i >= of.window - 1, F.concat(s["flags"], F.array(s["sum"] <= of.most))).otherwise(s["flags"]).alias("flags")))

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), none, step, lambda s: s["flags"])

    return _let(F.transform(F.split(piece, ""), lambda c: F.instr(F.lit(of.alphabet), c)), slid)


def _allowed(run: Column) -> Column:
    out = F.lit(False)
    for pattern in ALLOWED:
        out = out | (F.regexp_replace(run, pattern, "") == "")
    for letters in ORDERED:
        out = out | F.lit(letters).contains(run)
    return out


def _dense(run: Column, of: Class) -> Column:
    """(start, end) of the stretches of ``run`` that windows above the bound cover; touching windows are one stretch."""

    def flagged(pieces: Column) -> Column:
        def windows(piece: Column, k: Column) -> Column:
            held = F.concat(piece, F.coalesce(F.substring(F.get(pieces, k + 1), 1, of.window - 1), F.lit("")))
            # The last piece may be shorter than a window: its characters are in the windows before it.
            return F.when(F.length(held) >= of.window, F.transform(_flags(held, of), lambda f, i: F.when(f, k * BLOCK + i))).otherwise(F.array().cast("array<int>"))

        return F.filter(F.flatten(F.transform(pieces, windows)), lambda x: x.isNotNull())

    def stretches(at: Column) -> Column:
        first = F.filter(at, lambda x, i: (i == 0) | (x - F.get(at, i - 1) > of.window))
        last = F.filter(at, lambda x, i: (i == F.size(at) - 1) | (F.get(at, i + 1) - x > of.window))
        return F.zip_with(first, last, lambda a, b: F.struct(a.alias("start"), (b + of.window).alias("end")))

    return _let(F.regexp_extract_all(run, F.lit(f".{{1,{BLOCK}}}"), F.lit(0)), lambda pieces: _let(flagged(pieces), stretches))


def _entropic(text: Column, of: Class, place: int) -> Column:
    runs = F.filter(_found(text, of.run), lambda m: ~_allowed(m["text"]))
    return F.flatten(F.transform(runs, lambda m: F.transform(_dense(m["text"], of), lambda d: _span(m["start"] + d["start"], m["start"] + d["end"], place, of.kind))))


def find_secrets(docs: DataFrame, column: str = "text", classes: tuple[Class, ...] = CLASSES) -> DataFrame:
    """``docs`` with ``secrets``, an array of (start, place, end, kind) by start, then by the kinds' order.

    Starts and ends count code points from 0, the end exclusive. Each row on its own, without
    a shuffle or Python: null and empty texts have no secrets, repeated rows have the same
    ones, an empty table gives an empty one, and a text of any length is searched whole, in
    time that grows with it. Spans of different kinds may overlap; equal starts are in the
    order of the kinds. Other columns stay; one called ``secrets`` is replaced.
    """
    text = F.col(column)
    kinds = [*_base(text), *(_entropic(text, c, len(BASE) + i) for i, c in enumerate(classes))]
    none = F.array().cast(f"array<{SPAN}>")
    return docs.withColumn("secrets", F.array_sort(F.concat(*(F.coalesce(k, none) for k in kinds))))


def _said(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def query(spark, sf_dir):
    """doc_id, the number of each base kind, the digest of the base spans, and all spans."""
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["place"] < len(BASE))
    return found.select("doc_id", *map(count, BASE), F.sha2(_said(base), 256).alias("base_sha256"), _said(F.col("secrets")).alias("spans"))


def _oracle() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    # The names in either case, letter by letter: engines fold other letters differently.
    names = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in NAMES)
    patterns = {"assign": f"(?:{names}){ASSIGNED}", "access": BASE["access"], "hex": BASE["hex"]} | {c.kind: c.run for c in CLASSES}
    found = " UNION ALL ".join(
        f"SELECT place, {i} AS ord, '{kind}' AS kind, text, string_split_regex(text, {quoted(p)}) AS between, regexp_extract_all(text, {quoted(p)}, 0) AS found FROM t WHERE regexp_matches(text, {quoted(p)})"
        for i, (kind, p) in enumerate(patterns.items()))
    allowed = " OR ".join([*(f"regexp_replace(run, {quoted(p)}, '', 'g') = ''" for p in ALLOWED), *(f"contains({quoted(s)}, run)" for s in ORDERED)])
    dense = " UNION ALL ".join(f"""SELECT place, ord, kind, start, run, i FROM (
    SELECT *, unnest(range(length(run) - {c.window - 1})) AS i FROM runs WHERE kind = '{c.kind}' AND NOT ({allowed})
  ) WHERE list_sum(list_transform(map_values(list_aggregate(string_split(substr(run, i::INTEGER + 1, {c.window}), ''), 'histogram')), lambda n: {c.parts}[n::INTEGER + 1])) <= {c.most}""" for c in CLASSES)
    window = "CASE kind " + " ".join(f"WHEN '{c.kind}' THEN {c.window}" for c in CLASSES) + " END"
    said = "coalesce(string_agg({0}, ',' ORDER BY start, ord), '')"
    return f"""WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS place FROM documents
), f AS ({found}
), runs AS (
  SELECT place, ord, kind, unnest(found) AS run,
         unnest(list_transform(range(1, len(found) + 1), lambda i: list_sum(list_transform(between[1:i], lambda s: length(s)))::BIGINT + coalesce(list_sum(list_transform(found[1:i - 1], lambda s: length(s))), 0)::BIGINT)) AS start
  FROM f
), dense AS ({dense}
), marked AS (
  SELECT *, CASE WHEN i - lag(i) OVER w <= {window} THEN 0 ELSE 1 END AS fresh FROM dense WINDOW w AS (PARTITION BY place, kind, start ORDER BY i)
), grouped AS (
  SELECT *, sum(fresh) OVER (PARTITION BY place, kind, start ORDER BY i) AS stretch FROM marked
), spans AS (
  SELECT place, ord, kind, start, start + length(run) AS stop FROM runs
  WHERE kind IN ('access', 'hex') OR kind = 'assign' AND length(regexp_extract(run, {quoted("^(?:" + patterns["assign"] + ")$")}, 1)) >= {LEAST_VALUE}
  UNION ALL
  SELECT place, ord, kind, start + min(i), start + max(i) + {window} FROM grouped GROUP BY place, ord, kind, start, stretch
), said AS (
  SELECT *, kind || ':' || start || ':' || stop AS s FROM spans
)
SELECT any_value(t.doc_id) AS doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(s, ',' ORDER BY start, ord) FILTER (ord < {len(BASE)}), '')) AS base_sha256, {said.format("s")} AS spans
FROM t LEFT JOIN said ON said.place = t.place GROUP BY t.place"""


ORACLE_SQL = _oracle()
