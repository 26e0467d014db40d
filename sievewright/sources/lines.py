"""Line formats as DataFrames: bar tables, pick lists, decision lines, key and value lines."""

from __future__ import annotations

import hashlib
import re
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions import names

#: File kinds by extension, fixed values.
RAW = ("nef", "nrw", "cr2", "cr3", "crw", "arw", "srf", "sr2", "raf", "orf", "rw2", "pef", "dng", "srw", "3fr", "fff", "iiq", "erf", "mos", "mrw", "x3f")
IMAGE = ("jpg", "jpeg", "png", "webp", "tif", "tiff", "heic", "heif")
ARCHIVE = ("zip", "7z", "rar")
JUNK_NAMES, JUNK_ENDINGS = (".ds_store", "thumbs.db", "desktop.ini", "__macosx"), ("xmp", "lrcat", "lrdata", "dop", "pp3", "cos")


def files(spark: SparkSession, path: str, extensions: tuple[str, ...] = RAW + IMAGE) -> DataFrame:
    """Files below ``path``, without their content."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).drop("content")
    return found.where(extension(F.col("path")).isin(*extensions))


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def file_kind(path: Column) -> Column:
    e = extension(path)
    return F.when(e.isin(*RAW), "raw").when(e.isin(*IMAGE), "image").when(e.isin(*ARCHIVE), "archive").otherwise("other")


def is_junk(path: Column) -> Column:
    """What systems and editors leave behind, by name, ending, or a folder's name."""
    parts = F.split(F.lower(path), "/")
    return extension(path).isin(*JUNK_ENDINGS) | F.element_at(parts, -1).startswith("._") | F.arrays_overlap(parts, F.array(*map(F.lit, JUNK_NAMES)))


def shot_at(*tags: Column) -> Column:
    """The first tag that is a time; a malformed one gives way to the next."""
    return F.coalesce(*(F.try_to_timestamp(t, F.lit("yyyy:MM:dd HH:mm:ss")) for t in tags))


def table_rows(lines: DataFrame, cells: int) -> DataFrame:
    """``cells`` of lines between bars, without rules; of rows with another number of cells none."""
    own = lines.where(F.trim("value").rlike(r"^\|.*\|$") & ~F.trim("value").rlike(r"^[|\s:-]+$"))
    split = F.transform(F.split(F.regexp_replace(F.trim("value"), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    return own.select("*", split.alias("cells")).where(F.size("cells") == cells)


def picks(lines: DataFrame) -> DataFrame:
    """Frames and note of pick lines: ``a+b # note``; comments and blank lines are left out."""
    body, note = F.trim(F.element_at(F.split("value", "#", 2), 1)), F.trim(F.try_element_at(F.split("value", "#", 2), F.lit(2)))
    return lines.where(body != "").select("*", F.transform(F.split(body, r"\+"), lambda c: F.trim(c)).alias("frames"), note.alias("note"))


def decisions(line: Column) -> dict[str, Column]:
    """Parts of a decision line ``[+]KEY # note variant=a glow=b``: key, back, note without options, variant, glow.

    Options are known in any case and given in lower case; where one is cut out of a sentence,
    the signs on both sides of it become the first. Blank lines, comments, and lines without a
    key have a null key.
    """
    body, note = F.trim(F.element_at(F.split(line, "#", 2), 1)), F.trim(F.coalesce(F.try_element_at(F.split(line, "#", 2), F.lit(2)), F.lit("")))
    option = r"(?i)\b(?:variant|glow)=[A-Za-z_-]+"
    tidy = F.regexp_replace(F.regexp_replace(F.regexp_replace(note, option, ""), r"([,;.·])(?:\s*[,;.·])+", "$1"), r"\s{2,}", " ")
    tidy = F.regexp_replace(tidy, r"^[ ·,;.]+|[ ·,;.]+$", "")
    told = lambda name: F.nullif(F.lower(F.element_at(F.concat(F.array(F.lit("")), F.regexp_extract_all(note, F.lit(rf"(?i)\b{name}=([A-Za-z_-]+)"), F.lit(1))), -1)), F.lit(""))
    return {
        "key": F.when(body != "", F.trim(F.regexp_replace(body, r"^\++", ""))), "back": F.when(body != "", ~body.startswith("+")),
        "note": F.when(note.rlike(option), tidy).otherwise(note), "variant": told("variant"), "glow": told("glow")}


def refuse_rich(lines: DataFrame) -> DataFrame:
    """The lines; one that begins a rich text fails when it is reached, since none of such a file can be read."""
    return lines.withColumn("value", F.when(F.ltrim("value").startswith("{\\rtf"), F.raise_error(F.lit("rich text: save it as plain text"))).otherwise(F.col("value")))


def expected(lines: DataFrame) -> DataFrame:
    """Paths of an inventory, one a line; blank lines and comments are left out."""
    return lines.select(F.trim("value").alias("path")).where((F.col("path") != "") & ~F.col("path").startswith("#"))


def field(text: Column, name: str) -> Column:
    """The first value of a ``**Name:** value`` line."""
    return F.nullif(F.trim(F.regexp_extract(text, rf"(?m)^\s*(?:- )?\*\*{name}:\*\*[ \t]*(.*)$", 1)), F.lit(""))


def json_object(text: Column, schema: str) -> Column:
    """The object between the first and the last brace; null if it isn't one."""
    return F.from_json(F.regexp_extract(text, r"(?s)\{.*\}", 0), schema)


def key_values(lines: DataFrame) -> DataFrame:
    """``key`` and ``text`` of indented ``key: value`` lines; of one key the last holds where it is read by ``rules``."""
    pattern = r"^ {4,}([a-z][a-z /]*?):\s*(\S.*?)\s*$"
    return lines.where(F.col("value").rlike(pattern)).select(F.trim(F.regexp_extract("value", pattern, 1)).alias("key"), F.regexp_extract("value", pattern, 2).alias("text"))


def between(text: str, start: str, end: str, least: int = 200) -> str:
    """What stands between two marker lines; fails where a marker is missing or less than ``least`` characters are left."""
    if start not in text or end not in text:
        raise ValueError(f"the text lacks its marker lines {start!r} and {end!r}")
    body = text.split(start, 1)[1].partition("\n")[2].split(end, 1)[0].strip()
    if len(body) < least:
        raise ValueError(f"only {len(body)} characters stand between the markers")
    return body


def blocks(text: str, markers: dict[str, str], end: str, least: int = 200) -> dict[str, str]:
    """What stands behind each marker line, up to the next; ``markers`` in the order in which they must stand, ``end`` behind them all.

    Only a line that begins with a marker is one: prose may name it. A marker that is missing,
    out of order, or has fewer than ``least`` characters behind it fails.
    """
    starts = {m: re.search(rf"(?m)^{re.escape(m)}.*(?:\n|\Z)", text) for m in [*markers.values(), end]}
    missing = [m for m, at in starts.items() if at is None]
    if missing:
        raise ValueError(f"no line begins with {', '.join(missing)}")
    places = [at.start() for at in starts.values()]
    if places != sorted(places):
        raise ValueError(f"marker lines must stand in this order: {', '.join(starts)}")
    found = {key: text[starts[m].end() : until].strip() for (key, m), until in zip(markers.items(), places[1:])}
    short = [key for key, body in found.items() if len(body) < least]
    if short:
        raise ValueError(f"fewer than {least} characters in: {', '.join(short)}")
    return found


#: Fixed value: the line of a log that names the address of a picture's source.
SOURCE_LINE = r"(?m)^\|\s*Uploaded source\s*\|\s*(\S+)\s*\|"


def recorded_source(log: Column) -> Column:
    """The address that a log records first, which is the original's; empty without one."""
    return F.coalesce(F.regexp_extract(log, SOURCE_LINE, 1), F.lit(""))


def rules(spark: SparkSession, path: str) -> dict:
    """A rules file, checked: settings, ``target`` (lo, hi), ``keywords`` (keyword, category, longest first), ``priorities``, ``typology`` bands and a fingerprint. A dimension: read on the driver."""
    text = _whole(spark, path)
    lines = spark.createDataFrame([(x,) for x in text.splitlines()], "value string")
    settings = {r["key"]: r["text"] for r in key_values(lines).collect()}
    target = re.fullmatch(r"(\d+)\s*[-–]\s*(\d+)", settings.get("gallery target", ""))
    missing = [k for k in ("base per room", *(f"{what} {how}" for what in ("roll", "convergence", "focal") for how in ("warn", "flag"))) if k not in settings]
    if missing or not target:
        raise ValueError(f"rules without {', '.join(missing) or 'a gallery target like 40-60'}")
    rows = [r["cells"] for r in table_rows(lines, 3).collect()]
    priorities = {c: int(n) for n, c, _ in rows if n.isdigit()}
    words = [(plain_fold(w.strip().strip("*_()")), c) for n, c, listed in rows if n.isdigit() and c != "default" for w in listed.split(",")]
    words = sorted((w for w in words if w[0] and "anything unmatched" not in w[0]), key=lambda w: -len(w[0]))
    if not words:
        raise ValueError("rules without keywords: nothing says which rooms grow")
    bands = []
    for name, rooms, photos in rows:
        span, numbers = re.fullmatch(r"(\d+)\s*[-–]\s*(\d+)", photos), re.findall(r"\d+", rooms)
        if re.match(r"T\d", name) and span and numbers:
            bands.append((10**6 if "more" in rooms.lower() else int(numbers[-1]), name, int(span[1]), int(span[2])))
    return {"settings": settings, "target": (int(target[1]), int(target[2])), "keywords": words, "priorities": priorities, "typology": sorted(bands), "fingerprint": hashlib.sha256(text.encode()).hexdigest()[:8]}


def vocabulary(spark: SparkSession, path: str, unknown: str = "NAO_IDENTIFICADO") -> dict:
    """A vocabulary file, checked: ``categories`` by slug in order, ``synonyms`` (keyword, slug, longest first), ``codes`` (patterns) and a fingerprint."""
    text = _whole(spark, path)
    lines = spark.createDataFrame([(x,) for x in text.splitlines()], "value string")
    codes = [r["cells"][0].strip("`") for r in table_rows(lines, 2).collect() if re.fullmatch(r"`[A-Za-z][A-Za-z_]{0,7}[-_ ]?N+`", r["cells"][0])]
    rows = [r["cells"] for r in table_rows(lines, 3).collect() if re.fullmatch("[A-Z][A-Z_]*", r["cells"][0])]
    slugs = [r[0] for r in rows]
    if len(set(slugs)) < len(slugs) or unknown not in slugs:
        raise ValueError(f"a vocabulary lists each kind once, and {unknown}")
    words = [(plain_fold(w.strip().strip("*_()")), slug) for slug, _, listed in rows for w in listed.split(",")]
    return {"categories": {s: c for s, c, _ in rows}, "synonyms": sorted((w for w in words if w[0] and "nothing matched" not in w[0]), key=lambda w: -len(w[0])), "codes": [names.code_pattern(c) for c in codes], "fingerprint": hashlib.sha256(text.encode()).hexdigest()[:8]}


def plain_fold(text: str) -> str:
    """``names.fold`` of a string on the driver."""
    return "".join(c for c in unicodedata.normalize("NFD", text.lower()) if unicodedata.category(c) != "Mn")


def _whole(spark: SparkSession, path: str) -> str:
    found = spark.read.text(path, wholetext=True).collect()
    if len(found) != 1:
        raise ValueError(f"no single file at {path}")
    return found[0][0]


def catalog(lines: DataFrame, order: str) -> DataFrame:
    """Catalogue rows of a bar table (kind, seen, room, label, file, origin, note), the last of each file. Rows whose kind is no slug, or without a file, are left out; a room that is no number is 1; a dash is null."""
    c = [F.col("cells")[i] for i in range(7)]
    bare = lambda x: F.when((x != "—") & (x != ""), x)
    file = F.regexp_replace(c[4], "^`+|`+$", "")
    rows = table_rows(lines, 7).where(c[0].rlike("^[A-Z][A-Z_]*$") & bare(file).isNotNull())
    own = rows.select(F.col(order).alias("__order"), names.fold_name(file).alias("key"), c[0].alias("ambiente"), bare(c[1]).alias("seen"), F.when(c[2].rlike("^[0-9]+$"), c[2].try_cast("int")).otherwise(1).alias("room_no"), bare(c[3]).alias("label"), file.alias("file"), c[5].alias("source"), bare(c[6]).alias("note"))
    last = own.groupBy("key").agg(F.max_by(F.struct(*own.columns[2:]), "__order").alias("r"))
    return last.select("key", "r.*")


def rounds(records: DataFrame, key: str, text: str) -> DataFrame:
    """Gate rounds of whole record texts: ``key``, stage, n, at, photo, back, comment. Of a photo's rows in a round the first holds; text outside the format is left alone."""
    head = r"## (.+?) · rodada ([0-9]+) · (\S+)[ \t]*"
    blocks = records.select(key, F.posexplode(F.slice(F.split(F.concat(F.lit("\n"), text), r"\n(?=## .+? · rodada [0-9]+ · \S)"), 2, 1 << 30)).alias("__at", "__block"))
    line = F.split_part("__block", F.lit("\n"), F.lit(1))
    own = blocks.select(key, "__at", F.trim(F.regexp_extract(line, head, 1)).alias("stage"), F.regexp_extract(line, head, 2).try_cast("int").alias("n"), F.regexp_extract(line, head, 3).alias("at"), F.posexplode(F.split("__block", "\n")).alias("__row", "__line"))
    row = r"^\| `([^`]+)` \| (volta|ok) \| (.*?) \|\s*$"
    cut = own.where(F.col("__line").rlike(row)).withColumns({"photo": F.regexp_extract("__line", row, 1), "back": F.regexp_extract("__line", row, 2) == "volta", "comment": F.nullif(F.trim(F.regexp_extract("__line", row, 3)), F.lit("—"))})
    first = cut.groupBy(key, "__at", "stage", "n", "at", "photo").agg(F.min_by(F.struct("back", "comment"), "__row").alias("r"))
    return first.select(key, "stage", "n", "at", "photo", "r.back", F.nullif("r.comment", F.lit("")).alias("comment"))


def retouches(logs: DataFrame, key: str, text: str) -> DataFrame:
    """Retouch blocks of whole log texts: ``key``, n, at, text, previous, result, model. A block ends at the next, or at its first ``###``; of equal labels the first holds."""
    head = r"## Retoque ([0-9]+)\b[ \t]*[—–-]?[ \t]*(.*)"
    blocks = logs.select(key, F.explode(F.slice(F.split(F.concat(F.lit("\n"), text), r"\n(?=## Retoque [0-9])"), 2, 1 << 30)).alias("__block"))
    line, body = F.split_part("__block", F.lit("\n"), F.lit(1)), F.split_part("__block", F.lit("\n### "), F.lit(1))

    def cell(label: str) -> Column:
        found = F.regexp_extract(body, rf"(?im)^\|\s*{label}\s*\|(.*)\|[ \t]*$", 1)
        bare = F.trim(F.regexp_replace(F.trim(found), "^`+|`+$", ""))
        return F.when(~bare.isin("", "—", "-"), bare)

    return blocks.select(key, F.regexp_extract(line, head, 1).try_cast("int").alias("n"), F.trim(F.regexp_extract(line, head, 2)).alias("at"), cell("instrução humana").alias("text"), cell("edit anterior").alias("previous"),
                         F.trim(F.regexp_replace(F.split_part(cell("resultado"), F.lit("·"), F.lit(1)), "`", "")).alias("result"), cell("model").alias("model"))
