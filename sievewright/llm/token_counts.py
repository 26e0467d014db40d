"""Token counts: batch encoding in an Arrow function that returns lengths only."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import release
from sievewright.llm.tokens import END_ID, encoder, vocabulary

#: A place where a long text may be cut: a space or line feed that follows an ASCII letter,
#: digit, full stop or comma. No pre-token reaches across it and no pattern looks back.
SAFE = re.compile(r"(?<=[A-Za-z0-9.,])[ \n]")


def cut(text: str, limit: int) -> list[str]:
    """Parts of about ``limit`` characters whose token counts add up to the text's; a stretch without a safe place stays whole."""
    parts, start = [], 0
    while len(text) - start > limit:
        at = SAFE.search(text, start + limit)
        if not at:
            break
        parts.append(text[start : at.start()])
        start = at.start()
    parts.append(text[start:])
    return parts


def counter(path: str, batch_bytes: int, part_chars: int):
    def lengths(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release(encoder.cache_clear)
        # Each distinct stretch between white space is encoded once; a text's length is that of its stretches.
        encode = encoder(path, END_ID).encode
        for column in columns:
            totals, owners, parts, held = np.zeros(len(column), dtype=np.int64), [], [], 0

            def flush():
                _, edges = encode(pa.array(parts, pa.string()))
                np.add.at(totals, owners, np.diff(edges) - 1)  # each part has an end of its own
                owners.clear()
                parts.clear()

            for i, text in enumerate(column.cast(pa.string()).to_pylist()):
                for part in cut(text or "", part_chars):
                    size = len(part) if part.isascii() else len(part.encode())
                    if held + size > batch_bytes and parts:
                        flush()
                        held = 0
                    owners.append(i)
                    parts.append(part)
                    held += size
            if parts:
                flush()
            yield pa.array(totals, pa.int64())

    return lengths


def token_counts(docs: DataFrame, vocabulary_path: str, limit: int = 512, batch_bytes: int = 1 << 20, part_chars: int = 1 << 16) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Each row is counted on its own: null and empty texts have 0 bytes and 0 tokens, repeated
    rows repeat, an empty table gives an empty one. Columns of ``docs`` with one of the three
    names are replaced. No shuffle; a worker holds one Arrow batch, ``batch_bytes`` of
    encodings and the stretches that recur (``tokens.KEPT`` at most). A text beyond
    ``part_chars`` is counted in parts; a stretch without a safe place goes on whole. Rows are
    counted each, so there are no ties.
    """
    count = F.arrow_udf(counter(vocabulary_path, batch_bytes, part_chars), "long")
    out = docs.withColumns({"n_bytes": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"), "n_tokens": count("text")})
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, sf_dir):
    from sievewright.llm.common import table

    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary()).drop("text")
