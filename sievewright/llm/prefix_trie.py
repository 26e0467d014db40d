"""The prefix trie of conversations: chained digests, one group a node, contributions to all ancestors.

A turn is a digest of its role and text; a prefix is the digest of the prefix before it and
its last turn, so equal prefixes are found by equal digests alone, however long. Every
conversation gives one row for each of its prefixes; a group of (depth, digest) is a node,
and its smallest member stands for it.

The ancestors of a node are the prefixes of its smallest member. What a node adds to all of
them is therefore laid on that conversation's rows, added up there from the deepest prefix
upwards, and exploded with them: n rows for n turns, where exploding node by node would
make n * n / 2. Nothing is joined on a node that many share but by a salt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.common import discard, fresh_path, ready, table, write_at

#: The textless root.
ROOT = hashlib.sha256(b"").digest()
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: A word of a turn's text.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a batch that leaves a task, ids joined into one chunk, and groups into which a node's children are dealt.
BATCH, CHUNK, SALTS = 8192, 16384, 1024
#: Conversations that share the first turns of one, and the most turns that they share.
BLOCK, MOST_SHARED = 20, 3
NODE = "depth long, digest binary"


def digested(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), digest, words of every turn.

    Turns are ordered by ``turn``, null first, and equal ones by their digest. A null role or
    text is an empty one; rows without conv_id are left out; a repeated row is a turn of its own.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return turns.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("place"), "digest", "words")


def rebuilt(turns: DataFrame, block: int = BLOCK, most: int = MOST_SHARED) -> DataFrame:
    """``turns`` (of ``digested``) with the first h of each conversation c replaced by the first h of conversation c - c % block; h = crc32(c) % (most + 1).

    All if there are fewer, none if there is no such conversation. Every conversation also
    has a row without digest, so that a turnless one is not lost.
    """
    own = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most + 1))
    convs = turns.where("place = 0").select("conv_id", own.alias("shared"), (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    first = turns.where((F.col("place") < most) & (F.col("conv_id") % block == 0)).select(F.col("conv_id").alias("base"), "place", "digest", "words")
    lent = convs.join(first, "base").where("place < shared").select("conv_id", "place", "digest", "words")
    marks = convs.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"))
    return turns.where(F.col("place") >= own).unionByName(lent).unionByName(marks)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation and place to the conversation's prefixes; a conversation may run over any number of batches."""
    out, conv, last = [], None, None

    def batch() -> pa.RecordBatch:
        conv_id, depth, digest, parent, words, ends = zip(*out)
        out.clear()
        return pa.RecordBatch.from_arrays([
            pa.array(conv_id, pa.int64()), pa.array(depth, pa.int64()), pa.array(digest, pa.binary()), pa.array(parent, pa.binary()), pa.array(words, pa.int64()), pa.array(ends, pa.bool_())],
            ["conv_id", "depth", "digest", "parent", "words", "ends"])

    for some in batches:
        for c, turn, words in zip(some.column("conv_id").to_pylist(), some.column("digest").to_pylist(), some.column("words").to_pylist()):
            if c != conv:
                if last:
                    out.append((*last, True))
                conv, last = c, (c, 0, ROOT, None, 0)
            if turn is not None:
                out.append((*last, False))
                last = (c, last[1] + 1, hashlib.sha256(last[2] + turn).digest(), last[2], words)
            if len(out) >= BATCH:
                yield batch()
    if last:
        out.append((*last, True))
    if out:
        yield batch()


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, digest, parent, words, ends of every prefix of every conversation, the root among them. A task streams whole conversations and holds one digest."""
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return dealt.select("conv_id", "digest", "words").mapInArrow(_chained, "conv_id long, depth long, digest binary, parent binary, words long, ends boolean")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (digest, conv_id) to comma-joined ids: chunks of at most CHUNK, each with its digest and first id."""
    key, ids, out = None, [], []

    def batch() -> pa.RecordBatch:
        digest, first, text = zip(*out)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array(first, pa.int64()), pa.array(text)], ["digest", "first", "ids"])

    for some in batches:
        for d, c in zip(some.column("digest").to_pylist(), some.column("conv_id").to_pylist()):
            if ids and (d != key or len(ids) >= CHUNK):
                out.append((key, ids[0], ",".join(map(str, ids))))
                ids = []
            key = d
            ids.append(c)
        if sum(len(x[2]) for x in out) >= 1 << 20:
            yield batch()
    if ids:
        out.append((key, ids[0], ",".join(map(str, ids))))
    if out:
        yield batch()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to one digest of each node's whole list, which is never held."""
    key, state, out = None, None, []

    def batch() -> pa.RecordBatch:
        digest, sha = zip(*out)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array(sha)], ["digest", "ends_sha256"])

    for some in batches:
        for d, ids in zip(some.column("digest").to_pylist(), some.column("ids").to_pylist()):
            if d != key:
                if state:
                    out.append((key, state.hexdigest()))
                key, state = d, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if len(out) >= BATCH:
            yield batch()
    if state:
        out.append((key, state.hexdigest()))
    if out:
        yield batch()


def _ends(rows: DataFrame) -> DataFrame:
    """digest, ends_sha256 of the nodes at which conversations end. Ids are joined by ranges of (digest, conv_id), so a node at which many end is spread; its chunks then pass one task, as one digest reads them in order."""
    ranged = rows.where("ends").select("digest", "conv_id").repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    chunks = ranged.mapInArrow(_joined, "digest binary, first long, ids string")
    return chunks.repartition("digest").sortWithinPartitions("digest", "first").select("digest", "ids").mapInArrow(_hashed, "digest binary, ends_sha256 string")


def _at(df: DataFrame, depth: Column, digest: str, **columns: Column) -> DataFrame:
    """Rows of the last grouping; what they don't know is null."""
    names = {"conv_id": "long", "parent_conv_id": "long", "n_convs": "long", "n_children": "long", "n_leaves": "long", "saved_tokens": "long", "ends_sha256": "string"}
    return df.select(depth.alias("depth"), F.col(digest).alias("digest"), *(columns.get(n, F.lit(None)).cast(t).alias(n) for n, t in names.items()))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, digest of every node.

    ``turns`` (conv_id, place, digest, words) as of ``digested``; a row without digest only
    says that its conversation exists. conv_id is the least member; a node's parent is the
    prefix one turn shorter (root: null). n_leaves and saved_tokens are summed over the
    node's subtree, itself included: nodes without children, and (n_convs - 1) times the
    words of the last turn. ends_sha256: of the comma-joined ascending conv_ids that end
    there, or of nothing. No rows come of an empty table; other columns are left out,
    whatever their names.

    The rows of all prefixes are written once, and once more with what their conversations
    stand for. A conversation is a chain, so one task reads all of its digests in turn, in
    bounded memory; nodes that many conversations share are summed before they are shuffled.
    """
    spark = turns.sparkSession
    ready(spark)
    raw = fresh_path(spark, "prefixes")
    rows = write_at(prefixes(turns), raw)
    nodes = rows.groupBy("depth", "digest").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if("ends").alias("n_ends"))
    # Only the least member's row finds its node: each pair (conv_id, depth) is there once.
    known = rows.join(nodes.select("conv_id", "depth", "n_convs", "n_ends"), ["conv_id", "depth"], "left")
    upwards = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    below = upwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stands = F.col("n_convs").isNotNull()
    laid = write_at(known.select(
        "conv_id", "depth", "digest", "parent", "ends", "n_convs", F.lead(stands, 1, False).over(upwards).alias("parent_too"),
        F.sum(F.when(F.col("n_convs") == F.col("n_ends"), 1).otherwise(0)).over(below).alias("leaves"), F.sum(F.when(stands, (F.col("n_convs") - 1) * F.col("words")).otherwise(0)).over(below).alias("saved")), fresh_path(spark, "prefixes"))
    discard(spark, raw)
    own, depth = laid.where("n_convs is not null"), F.col("depth")
    # A node whose conversation doesn't stand for its parent asks for the parent's; children of one parent ask in groups by salt.
    salt = F.pmod(F.xxhash64("digest"), F.lit(SALTS))
    asks = own.where("depth > 0 and not parent_too").select("depth", "digest", "parent", salt.alias("salt"))
    asked = asks.select("parent", "salt").distinct().join(own.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent")
    parts = [
        _at(own, depth, "digest", conv_id=F.col("conv_id"), n_convs=F.col("n_convs"), parent_conv_id=F.when(F.col("parent_too"), F.col("conv_id"))),
        _at(asks.join(asked, ["parent", "salt"]), depth, "digest", parent_conv_id=F.col("parent_conv_id")),
        _at(own.where("depth > 0"), depth - 1, "parent", n_children=F.lit(1)),
        _at(laid.where("leaves > 0 or saved > 0"), depth, "digest", n_leaves=F.col("leaves"), saved_tokens=F.col("saved")),
        _at(_ends(laid).join(own.select("digest", "depth"), "digest"), depth, "digest", ends_sha256=F.col("ends_sha256")),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    most, total = (lambda c: F.max(c).alias(c)), (lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c))
    found = whole.groupBy("depth", "digest").agg(*map(most, ["conv_id", "parent_conv_id", "n_convs"]), *map(total, ["n_children", "n_leaves", "saved_tokens"]), F.coalesce(F.max("ends_sha256"), F.lit(NO_ENDS)).alias("ends_sha256"))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "digest")


ORACLE_SQL = f"""WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % {BLOCK} AS base,
         xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::UBIGINT)),
             lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)))) % {MOST_SHARED + 1} AS shared
  FROM t WHERE place = 0
), r AS (
  SELECT c.conv_id, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.place < c.shared
  UNION ALL
  SELECT c.conv_id, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.place >= c.shared
), s AS (
  SELECT c.conv_id, coalesce(list({{'role': r.role, 'text': r.text}} ORDER BY r.place) FILTER (r.place IS NOT NULL), []) AS turns
  FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id
), p AS (
  SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM s
), n AS (
  SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256
  FROM p GROUP BY ALL
), k AS (
  SELECT n.*, q.conv_id AS parent_conv_id, (SELECT count(*) FROM n m WHERE m.depth = n.depth + 1 AND m.path[1:n.depth] = n.path) AS n_children,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * len(regexp_extract_all(n.path[n.depth].text, '{WORD}')) END AS saved
  FROM n LEFT JOIN n q ON q.depth = n.depth - 1 AND q.path = n.path[1:n.depth - 1]
), u AS (
  SELECT depth, path[1:depth] AS path, sum(saved)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves
  FROM (SELECT path, saved, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, unnest(range(depth + 1)) AS depth FROM k) GROUP BY ALL
)
SELECT k.conv_id, k.depth, k.parent_conv_id, k.n_convs, k.n_children, u.n_leaves, u.saved_tokens, k.ends_sha256
FROM k JOIN u ON u.depth = k.depth AND u.path = k.path"""


def query(spark, sf_dir):
    path = fresh_path(spark, "turns")
    turns = write_at(digested(table(spark, sf_dir, "conversations")), path)
    found = prefix_trie(rebuilt(turns)).drop("digest")
    discard(spark, path)
    return found
