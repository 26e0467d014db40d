"""Data sources of ZIP archives: their directories as rows, and their members, spread by bytes."""

from __future__ import annotations

import io
import re
import tempfile
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sievewright.shipping import ship
from sievewright.sources import ranged
from sievewright.sources.lines import JUNK_ENDINGS, JUNK_NAMES

#: How deep archives within archives are opened.
DEPTH = 2
#: Names of the pieces of one archive, the first of which is its beginning, and of the kind that only its own tool joins.
PIECE, FRAGMENT = re.compile(r"\.(zip|7z|rar)\.(\d{3})$", re.I), re.compile(r"\.[zr]\d{2}$", re.I)
#: Packed bytes of a task, and bytes of an archive within an archive that are held in memory; more goes to a nameless file.
TASK, HELD = 128 << 20, 32 << 20
LISTING = "archive string, member string, depth int, size long, packed long, crc long, nested boolean, junk boolean, error string"


class Joined(io.RawIOBase):
    """Pieces of one file, read as the whole."""

    def __init__(self, pieces: list[tuple[str, int]]):
        self.pieces, self.length, self.place, self.open = pieces, sum(n for _, n in pieces), 0, {}

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.place

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self.place = max(0, offset + (0, self.place, self.length)[whence])
        return self.place

    def readinto(self, into) -> int:
        start = 0
        for path, n in self.pieces:
            if start <= self.place < start + n:
                if path not in self.open:
                    self.open[path] = ranged.opened(path)
                source = self.open[path]
                source.seek(self.place - start)
                data = source.read(min(len(into), start + n - self.place))
                into[: len(data)] = data
                self.place += len(data)
                return len(data)
            start += n
        return 0

    def close(self) -> None:
        for source in self.open.values():
            source.close()
        super().close()


def archives(files: list[tuple[str, int]]) -> list[tuple[str, list[tuple[str, int]], str | None]]:
    """(name, pieces, error) of the archives among ``files``; the pieces of a split one are one archive."""
    whole, split = [], {}
    for path, size in files:
        if m := PIECE.search(path):
            split.setdefault((path[: m.start()], m[1].lower()), []).append((int(m[2]), path, size))
        elif path.lower().endswith(".zip"):
            whole.append((path, [(path, size)], None))
        elif FRAGMENT.search(path) or path.lower().endswith((".7z", ".rar")):
            whole.append((path, [(path, size)], "not a ZIP archive that can be read by itself"))
    for (stem, kind), pieces in sorted(split.items()):
        pieces.sort()
        gap = [n for n, _, _ in pieces] != list(range(1, len(pieces) + 1))
        error = "not a ZIP archive" if kind != "zip" else "a piece is missing" if gap else None
        whole.append((f"{stem}.{kind}", [(p, n) for _, p, n in pieces], error))
    return sorted(whole)


def is_junk(member: str) -> bool:
    parts = member.lower().split("/")
    return parts[-1].rpartition(".")[2] in JUNK_ENDINGS and "." in parts[-1].lstrip(".") or parts[-1].startswith("._") or any(p in JUNK_NAMES for p in parts)


@contextmanager
def _source(pieces: list[tuple[str, int]]):
    source = ranged.opened(pieces[0][0]) if len(pieces) == 1 else Joined(pieces)
    try:
        yield source
    finally:
        source.close()


FAULTS = (zipfile.BadZipFile, NotImplementedError, RuntimeError, OSError, EOFError, zlib.error, ValueError)


def members(archive: str, source, within: range | None = None) -> Iterator[tuple]:
    """(row of LISTING, a function that opens the member or None) of an archive and, up to DEPTH, of the archives in it.

    With ``within`` only members whose entry begins there. The directory at the end is read,
    and no member but archives.
    """
    try:
        zipped = zipfile.ZipFile(source)
    except FAULTS as e:
        if within is None or 0 in within:
            yield (archive, None, 0, None, None, None, None, None, f"{type(e).__name__}: {e}"), None
        return
    with zipped:
        yield from _members(archive, zipped, within, "", 0)


def _members(archive: str, zipped: zipfile.ZipFile, within: range | None, prefix: str, depth: int) -> Iterator[tuple]:
    for m in zipped.infolist():
        if m.is_dir() or within is not None and m.header_offset not in within:
            continue
        nested, junk, error = m.filename.lower().endswith(".zip") and depth < DEPTH, is_junk(m.filename), "encrypted" if m.flag_bits & 1 else None
        row = (archive, prefix + m.filename, depth, m.file_size, m.compress_size, m.CRC, nested, junk)
        if not nested or junk or error:
            yield (*row, error), None if error else lambda m=m: zipped.open(m)
            continue
        with tempfile.SpooledTemporaryFile(HELD) as held:
            try:
                with zipped.open(m) as inner:
                    while block := inner.read(1 << 20):
                        held.write(block)
                held.seek(0)
                own = zipfile.ZipFile(held)
            except FAULTS as e:
                yield (*row, f"{type(e).__name__}: {e}"), None
                continue
            yield (*row, None), None
            with own:
                yield from _members(archive, own, None, f"{prefix}{m.filename}!", depth + 1)


class Slice(InputPartition):
    """Archives, or the part of one whose members begin within a range of places."""

    def __init__(self, some: list, start: int | None = None, end: int | None = None):
        super().__init__(None)
        self.some, self.start, self.end = some, start, end


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict, contents: bool):
        self.path, self.glob, self.task, self.contents = options["path"], options.get("pathGlobFilter", "*"), int(options.get("taskBytes", TASK)), contents

    def partitions(self) -> list[InputPartition]:
        found = archives(ranged.listed(self.path, self.glob))
        size = lambda a: sum(n for _, n in a[1])
        if not self.contents:
            # A directory is a small part of its archive.
            return [Slice(some) for some in ranged.splits(found, lambda a: min(size(a), 1 << 20), self.task)] or [Slice([])]
        out = []
        for some in ranged.splits(found, size, self.task):
            if len(some) == 1 and size(some[0]) > self.task:
                out += [Slice(some, at, at + self.task) for at in range(0, size(some[0]), self.task)]
            else:
                out.append(Slice(some))
        return out or [Slice([])]

    def read(self, partition: Slice) -> Iterator[tuple]:
        within = None if partition.start is None else range(partition.start, partition.end)
        for name, pieces, error in partition.some:
            if error:
                if within is None or 0 in within:
                    yield self._row((name, None, 0, None, None, None, None, None, error), None)
                continue
            try:
                with _source(pieces) as source:
                    for row, open_ in members(name, source, within):
                        yield self._row(row, open_)
            except OSError as e:
                yield self._row((name, None, 0, None, None, None, None, None, f"{type(e).__name__}: {e}"), None)

    def _row(self, row: tuple, open_) -> tuple:
        if not self.contents:
            return row
        data = None
        # Junk is listed, so that it can be counted, and not read.
        if open_ and not row[7]:
            try:
                with open_() as member:
                    data = member.read()
            except FAULTS as e:
                row = (*row[:8], f"{type(e).__name__}: {e}")
        return (*row, data)


class Listing(DataSource):
    """``spark.read.format("archive_listing").load(folder)``: a row for each member of the ZIP archives below it, as LISTING says.

    Folders are left out. An archive within an archive has a row (``nested``), and its members,
    named ``outer.zip!inner``, have theirs, to a depth of two. A damaged, encrypted or foreign
    archive or member has an ``error`` and stops nothing. Pieces ``.zip.001``, ``.zip.002`` are
    read as one. Options: pathGlobFilter, taskBytes.
    """

    @classmethod
    def name(cls) -> str:
        return "archive_listing"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options, False)


class Members(DataSource):
    """``archive_members``: the rows of ``archive_listing`` with ``content``, null for junk, archives and errors.

    An archive larger than taskBytes is read by several tasks, each the members that begin in
    its stretch; a member is read whole by one.
    """

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return LISTING + ", content binary"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options, True)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(Listing)
    spark.dataSource.register(Members)
