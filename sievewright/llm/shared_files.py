"""Arrays in files of the shared folder, memory-mapped where they are read."""

from __future__ import annotations

import json
import os
import tempfile
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs


def _local(path: str) -> str | None:
    return path.removeprefix("file://").removeprefix("file:") if path.startswith(("/", "file:")) else None


def write(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Write once; a repeated task replaces the file by an equal one."""
    heads, at = [], 0
    for name, a in arrays.items():
        heads.append((name, a.dtype.str, len(a), at))
        at += -(-a.nbytes // 8) * 8
    head = json.dumps(heads).encode()
    head += b" " * (-len(head) % 8)
    store, where = (fs.LocalFileSystem(), own) if (own := _local(path)) else fs.FileSystem.from_uri(path)
    store.create_dir(where.rpartition("/")[0], recursive=True)
    part = f"{where}.{os.getpid()}-{os.urandom(4).hex()}"
    with store.open_output_stream(part) as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for a in arrays.values():
            out.write(np.ascontiguousarray(a))
            out.write(b"\0" * (-a.nbytes % 8))
    store.move(part, where)


@lru_cache(maxsize=4096)
def read(path: str) -> dict[str, np.ndarray]:
    """The arrays, mapped. A file of a store that can't be mapped is copied to a nameless local file first."""
    own = _local(path)
    if own:
        mapped = pa.memory_map(own)
    else:
        store, where = fs.FileSystem.from_uri(path)
        with store.open_input_stream(where) as source, tempfile.NamedTemporaryFile() as copy:
            while block := source.read(1 << 22):
                copy.write(block)
            copy.flush()
            mapped = pa.memory_map(copy.name)  # stays readable once the name is gone
    whole = memoryview(mapped.read_buffer())
    size = int.from_bytes(whole[:8], "little")
    base = 8 + size
    out = {}
    for name, kind, n, at in json.loads(bytes(whole[8:base])):
        out[name] = np.frombuffer(whole, dtype=kind, count=n, offset=base + at)
    return out
