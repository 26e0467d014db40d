"""A data source of photo headers: sizes and tags of JPEG and TIFF files, by their first bytes and directories alone."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith

from sievewright.shipping import ship
from sievewright.sources import ranged

#: Tags by number, of the first directory and of the one for exposures, and the directory's own tag.
FIRST = {0x010F: "Image Make", 0x0110: "Image Model", 0x0112: "Image Orientation", 0x0132: "Image DateTime"}
EXPOSURE = {
    0x829A: "EXIF ExposureTime", 0x829D: "EXIF FNumber", 0x8827: "EXIF ISOSpeedRatings", 0x9003: "EXIF DateTimeOriginal", 0x9004: "EXIF DateTimeDigitized", 0x9204: "EXIF ExposureBiasValue", 0x920A: "EXIF FocalLength",
    0x9290: "EXIF SubSecTime", 0x9291: "EXIF SubSecTimeOriginal", 0xA405: "EXIF FocalLengthIn35mmFilm"}
EXPOSURE_AT, WIDTH, HEIGHT = 0x8769, 0x0100, 0x0101
#: Types of a tag's values and their bytes: byte, text, short, long, ratio, undefined, and those with signs.
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8}
NUMBERS = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i"}
#: Markers of frames (which have the size), those without a length, and the start of the picture itself.
FRAMES = {*range(0xC0, 0xD0)} - {0xC4, 0xC8, 0xCC}
BARE, SCAN, END = {0x01, *range(0xD0, 0xD8)}, 0xDA, 0xD9
#: Bytes that a header may have, values and entries that a tag and a directory may have, and bytes of headers of one task.
MOST, VALUES, ENTRIES, TASK = 1 << 20, 4096, 1024, 64 << 20
SCHEMA = "path string, size long, kind string, width int, height int, tags map<string, string>, bytes_read long, error string"


class Damaged(ValueError):
    """What is written there can't be a header."""


def directories(window: ranged.Window, base: int, tags: dict[str, str]) -> tuple[int | None, int | None]:
    """Width and height of a block of directories that starts at ``base``; its tags go to ``tags``. Ratios are written as ``n/d``."""
    head = window.at(base, 8)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    if order is None or len(head) < 8 or struct.unpack(order + "H", head[2:4])[0] != 42:
        raise Damaged("no directories")
    sizes: dict[int, int] = {}

    def value(kind: int, n: int, field: bytes) -> str | None:
        size = SIZES.get(kind, 0) * n
        if not size or n > VALUES:
            return None
        data = field[:size] if size <= 4 else window.at(base + struct.unpack(order + "I", field)[0], size)
        if len(data) < size:
            raise Damaged("a value lies beyond the end")
        if kind == 2:
            return data.split(b"\0")[0].decode("utf-8", "replace")
        if kind in (5, 10):
            return "%d/%d" % struct.unpack(order + ("II" if kind == 5 else "ii"), data[:8])
        return str(struct.unpack_from(order + NUMBERS[kind], data)[0]) if kind in NUMBERS else None

    def directory(at: int, names: dict[int, str]) -> int | None:
        count = window.at(base + at, 2)
        n = struct.unpack(order + "H", count)[0] if len(count) == 2 else 0
        if not 0 < n <= ENTRIES:
            raise Damaged("an empty or endless directory")
        entries = window.at(base + at + 2, 12 * n)
        if len(entries) < 12 * n:
            raise Damaged("a directory goes beyond the end")
        inner = None
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", entries, 12 * i)
            field = entries[12 * i + 8 : 12 * i + 12]
            if tag == EXPOSURE_AT:
                inner = struct.unpack(order + "I", field)[0]
            elif tag in (WIDTH, HEIGHT) and kind in (3, 4):
                sizes[tag] = struct.unpack_from(order + NUMBERS[kind], field)[0]
            elif tag in names and (text := value(kind, count, field)) is not None:
                tags[names[tag]] = text
        return inner

    inner = directory(struct.unpack(order + "I", head[4:8])[0], FIRST)
    if inner:
        directory(inner, EXPOSURE)
    return sizes.get(WIDTH), sizes.get(HEIGHT)


def segments(window: ranged.Window, tags: dict[str, str]) -> tuple[int, int]:
    """Width and height of a JPEG file, from its segments up to the picture itself; its tags go to ``tags``."""
    at = 2
    while True:
        mark = window.at(at, 4)
        if len(mark) < 2 or mark[0] != 0xFF:
            raise Damaged("no segment where one must be")
        if mark[1] == 0xFF or mark[1] in BARE:
            at += 1 if mark[1] == 0xFF else 2
            continue
        if mark[1] in (SCAN, END):
            raise Damaged("no frame before the picture")
        if len(mark) < 4:
            raise Damaged("a segment goes beyond the end")
        length = struct.unpack(">H", mark[2:4])[0]
        if mark[1] in FRAMES:
            frame = window.at(at + 5, 4)
            if len(frame) < 4:
                raise Damaged("a frame goes beyond the end")
            height, width = struct.unpack(">HH", frame)
            return width, height
        if mark[1] == 0xE1 and not tags and window.at(at + 4, 6) == b"Exif\0\0":
            directories(window, at + 10, tags)
        at += 2 + max(2, length)


def header(source, path: str, size: int, most: int = MOST) -> tuple:
    """A row of SCHEMA. A file that is no photo, or a damaged one, has an ``error`` and what was read before it."""
    window = ranged.Window(source, size, most)
    kind, width, height, error = None, None, None, None
    tags: dict[str, str] = {}
    try:
        start = window.at(0, 4)
        if start[:2] == b"\xff\xd8":
            kind = "jpeg"
            width, height = segments(window, tags)
        elif start in (b"II*\0", b"MM\0*"):
            kind = "tiff"
            width, height = directories(window, 0, tags)
        else:
            error = "neither JPEG nor TIFF"
    except (Damaged, ranged.TooLarge) as e:
        error = str(e)
    return path, size, kind, width, height, tags, window.read, error


#: Where a picture within a file lies and how long it is, its packing (JPEG), the strips of one, and further directories.
INNER_AT, INNER_SIZE, PACKING, PACKED, STRIPS, STRIP_SIZES, FURTHER = 0x0201, 0x0202, 0x0103, (6, 7), 0x0111, 0x0117, 0x014A
#: Directories of a file that are looked through.
DIRECTORIES = 32


def inner(window: ranged.Window, base: int) -> list[tuple[int, int]]:
    """(place, size) of the JPEG pictures that the directories starting at ``base`` hold, the largest first."""
    head = window.at(base, 8)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    if order is None or len(head) < 8:
        raise Damaged("no directories")
    todo, seen, found = [struct.unpack(order + "I", head[4:8])[0]], set(), []
    while todo and len(seen) < DIRECTORIES:
        at = todo.pop(0)
        if not at or at in seen:
            continue
        seen.add(at)
        count = window.at(base + at, 2)
        n = struct.unpack(order + "H", count)[0] if len(count) == 2 else 0
        entries = window.at(base + at + 2, 12 * n + 4) if 0 < n <= ENTRIES else b""
        if len(entries) < 12 * n + 4 or not n:
            continue
        one: dict[int, tuple[int, int]] = {}
        for i in range(n):
            tag, kind, many = struct.unpack_from(order + "HHI", entries, 12 * i)
            if kind in (3, 4):
                one[tag] = many, struct.unpack_from(order + NUMBERS[kind], entries, 12 * i + 8)[0]
        todo.append(struct.unpack_from(order + "I", entries, 12 * n)[0])
        if FURTHER in one:
            many, place = one[FURTHER]
            listed = window.at(base + place, 4 * min(many, DIRECTORIES)) if many > 1 else struct.pack(order + "I", place)
            todo += struct.unpack(order + f"{len(listed) // 4}I", listed[: len(listed) // 4 * 4])
        pair = (INNER_AT, INNER_SIZE) if INNER_AT in one and INNER_SIZE in one else (STRIPS, STRIP_SIZES)
        if pair[0] in one and pair[1] in one and (pair[0] == INNER_AT or one.get(PACKING, (0, 0))[1] in PACKED and one[STRIPS][0] == 1):
            found.append((base + one[pair[0]][1], one[pair[1]][1]))
    return sorted(((at, size) for at, size in found if size > 3 and window.at(at, 3) == b"\xff\xd8\xff"), key=lambda x: -x[1])


def preview(source, path: str, size: int, most: int = MOST) -> tuple:
    """(path, source, content, error): the largest picture that a raw file carries (``embedded``), or a JPEG file as it is (``file``); nothing is decoded."""
    window = ranged.Window(source, size, most)
    try:
        start = window.at(0, 4)
        if start[:2] == b"\xff\xd8":
            place, kind = (0, size), "file"
        elif start in (b"II*\0", b"MM\0*"):
            held = inner(window, 0)
            if not held:
                return path, None, None, "no picture is embedded"
            place, kind = held[0], "embedded"
        else:
            return path, None, None, "neither JPEG nor TIFF"
    except (Damaged, ranged.TooLarge) as e:
        return path, None, None, str(e)
    source.seek(place[0])
    content = source.read(place[1])
    return (path, kind, content, None) if len(content) == place[1] else (path, None, None, "the picture goes beyond the end")


class Files(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        super().__init__(None)
        self.files = files


#: Filters that are decided before a file is opened: on its path and its size.
DECIDED = {
    EqualTo: lambda x, v: x == v, In: lambda x, v: x in v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v,
    StringStartsWith: lambda x, v: x.startswith(v), StringEndsWith: lambda x, v: x.endswith(v), StringContains: lambda x, v: v in x}


class HeaderReader(DataSourceReader):
    """Reads one row of each file: its header, or what ``row`` makes of it."""

    def __init__(self, options: dict, row=header, empty: tuple = (None, None, None, None, None, 0)):
        self.row, self.empty = row, empty
        self.path, self.glob, self.most, self.task = options["path"], options.get("pathGlobFilter", "*"), int(options.get("maxHeaderBytes", MOST)), int(options.get("taskBytes", TASK))
        self.kept: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if type(f) in DECIDED and f.attribute in (("path",), ("size",)):
                self.kept.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        place = {"path": 0, "size": 1}
        wanted = [f for f in ranged.listed(self.path, self.glob) if all(DECIDED[type(x)](f[place[x.attribute[0]]], x.value) for x in self.kept)]
        # A header costs a few blocks, however large its file is; a picture may be most of it.
        return [Files(some) for some in ranged.splits(wanted, lambda f: min(f[1], 1 << 16) if self.row is header else f[1], self.task)] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        for path, size in partition.files:
            try:
                with ranged.opened(path) as source:
                    yield self.row(source, path, size, self.most)
            except OSError as e:
                yield (path, *self.empty, f"{type(e).__name__}: {e}")


class Headers(DataSource):
    """``spark.read.format("photo_headers").load(folder)``: a row for each file below it, as SCHEMA says.

    Options: pathGlobFilter, maxHeaderBytes (a file that needs more has an error) and
    taskBytes (of headers that one task reads). Filters on path and size keep files from being
    opened: ``register`` allows Python sources that. The list of files is made on the
    driver, as for Spark's own file sources; headers are read by the tasks.
    """

    @classmethod
    def name(cls) -> str:
        return "photo_headers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HeaderReader:
        return HeaderReader(self.options)


class Previews(DataSource):
    """``photo_previews``: path, source, content, error: the picture by which each file below a folder can be judged, without decoding a raw one. Options as of ``photo_headers``, but filters stay with Spark."""

    @classmethod
    def name(cls) -> str:
        return "photo_previews"

    def schema(self) -> str:
        return "path string, source string, content binary, error string"

    def reader(self, schema) -> HeaderReader:
        return PreviewReader(self.options)


class PreviewReader(HeaderReader):
    def __init__(self, options: dict):
        super().__init__(options, preview, (None, None))

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        return filters


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Headers)
    spark.dataSource.register(Previews)
