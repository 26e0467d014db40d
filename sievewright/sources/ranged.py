"""Reading parts of files: a window on a file of any store that counts what it reads, lists of files, and splits by bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from fnmatch import fnmatch

from pyarrow import fs


class TooLarge(ValueError):
    """More bytes were asked for than a header may have."""


class Window:
    """Bytes of a file by place; read in blocks, each once, and at most ``most`` in all."""

    def __init__(self, source, size: int, most: int, block: int = 4096):
        self.source, self.size, self.most, self.block = source, size, most, block
        self.blocks: dict[int, bytes] = {}
        self.read = 0

    def at(self, start: int, n: int) -> bytes:
        """``n`` bytes from ``start``, fewer at the end of the file."""
        if start < 0 or n <= 0:
            return b""
        n = min(n, max(0, self.size - start))
        out = []
        for b in range(start // self.block, (start + n - 1) // self.block + 1) if n else ():
            if b not in self.blocks:
                if self.read + self.block > self.most:
                    raise TooLarge(f"more than {self.most} bytes of header")
                self.source.seek(b * self.block)
                self.blocks[b] = self.source.read(self.block)
                self.read += len(self.blocks[b])
            out.append(self.blocks[b])
        skip = start % self.block
        return b"".join(out)[skip : skip + n]


def store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    if own := re.match(r"file:(?://)?(/.*)", path):
        return fs.LocalFileSystem(), own[1]
    return fs.FileSystem.from_uri(path)


def opened(path: str):
    where, own = store(path)
    return where.open_input_file(own)


def listed(path: str, glob: str = "*", recursive: bool = True) -> list[tuple[str, int]]:
    """(path, size) of the files below a folder whose name ``glob`` fits, or of a file; ascending."""
    where, own = store(path)
    prefix = path[: len(path) - len(own)] if path.endswith(own) else ""
    found = where.get_file_info(own)
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    infos = [found] if found.type == fs.FileType.File else where.get_file_info(fs.FileSelector(own, recursive=recursive))
    return sorted((prefix + i.path, i.size) for i in infos if i.type == fs.FileType.File and fnmatch(i.base_name, glob))


def splits(files: list, cost, most: int) -> Iterator[list]:
    """Neighbours together up to ``most`` bytes by ``cost``; one that is larger stands alone."""
    held, total = [], 0
    for f in files:
        c = cost(f)
        if held and total + c > most:
            yield held
            held, total = [], 0
        held.append(f)
        total += c
    if held:
        yield held
