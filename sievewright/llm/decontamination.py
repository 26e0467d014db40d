"""Benchmark decontamination by a distributed positional inverted index.

The index is a table of segments: each holds a few megabytes of whole documents, the terms
seen in them and, by term, the ascending positions of its postings. Documents follow each
other with one position left free, so a phrase never reaches across two of them. Segments
are searched where they lie: a frequent term's postings never meet in one task.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm.common import WORD, by_bytes, fresh_path, release, table, words_of

#: Bytes of a segment in the stage, where workers stand beside a heap that earlier stages have filled.
STAGE_BYTES = 3 << 20
INDEX_SCHEMA = "segment long, doc_id array<long>, n_words array<int>, terms array<binary>, ends array<int>, postings binary"


def _index(segment_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        number = itertools.count(TaskContext.get().partitionId() << 32)
        held, size = [], 0

        def segment() -> pa.RecordBatch:
            ids = defaultdict(itertools.count().__next__)
            words = [w for b in held for w in words_of(b.column("text"))]
            counts = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            term = np.fromiter(map(ids.__getitem__, itertools.chain.from_iterable(words)), dtype=np.int32, count=int(counts.sum()))
            position = np.arange(len(term), dtype=np.int64) + np.repeat(np.arange(len(counts)), counts)
            order = np.argsort(term, kind="stable")
            ends = np.cumsum(np.bincount(term, minlength=len(ids)))
            steps = np.diff(position[order], prepend=0)
            steps[ends[:-1]] = position[order][ends[:-1]]  # each list starts afresh
            docs = pa.concat_arrays([b.column("doc_id").cast(pa.int64()) for b in held])
            whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.RecordBatch.from_arrays([
                pa.array([next(number)], pa.int64()), whole(docs), whole(pa.array(counts.astype(np.int32))), whole(pa.array(list(ids), pa.binary())),
                whole(pa.array(ends.astype(np.int32))), pa.array([steps.astype("<i4").tobytes()], pa.binary())], ["segment", "doc_id", "n_words", "terms", "ends", "postings"])

        for batch in by_bytes(batches, "text", segment_bytes):
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= segment_bytes:
                yield segment()
                held, size = [], 0
        if held:
            yield segment()

    return run


def build_index(docs: DataFrame, path: str, segment_bytes: int = 8 << 20) -> DataFrame:
    """Write the postings of every word of ``docs`` (doc_id, text) under ``path`` and read them back."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_index(segment_bytes), INDEX_SCHEMA)
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(INDEX_SCHEMA).parquet(path)


class Segment:
    """One row of the index."""

    def __init__(self, row: dict):
        self.doc_id, self.n_words = row["doc_id"], np.array(row["n_words"], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.n_words + 1)))  # of each document, and the end
        self.place = dict(zip(row["terms"], range(len(row["terms"]))))
        self.edges = np.concatenate(([0], np.array(row["ends"], dtype=np.int64)))
        self.steps = np.frombuffer(row["postings"], dtype="<i4").astype(np.int64)

    def postings(self, term: bytes) -> np.ndarray:
        i = self.place.get(term)
        return np.empty(0, dtype=np.int64) if i is None else np.cumsum(self.steps[self.edges[i] : self.edges[i + 1]])


class Phrases:
    """The windows of some items, with the place of each window's rarest term."""

    def __init__(self, items: list[tuple[str, list[bytes]]], size: int):
        self.names = [name for name, _ in items]
        terms = defaultdict(itertools.count().__next__)
        self.term, self.item = [], []
        self.spans = []
        for i, (_, words) in enumerate(items):
            self.spans.append((len(self.term), len(words)))
            self.term += [terms[w] for w in words] + [-1]
            self.item += [i] * (len(words) + 1)
        self.terms, self.size = list(terms), size
        self.term, self.item = np.array(self.term, dtype=np.int64), np.array(self.item, dtype=np.int64)
        self.need = np.array([min(size, n) for _, n in self.spans], dtype=np.int64)
        self.anchors = np.empty(0, dtype=np.int64)

    def anchor(self, frequency: np.ndarray) -> None:
        """Choose each window's rarest term over all documents; windows with an absent term are left out."""
        found = set()
        for start, n in self.spans:
            often = frequency[self.term[start : start + n]] if n else []
            for s in range(n - min(self.size, n) + 1 if n else 0):
                part = often[s : s + self.size]
                at = int(np.argmin(part))
                if part[at]:
                    found.add(start + s + at)
        self.anchors = np.array(sorted(found), dtype=np.int64)

    def matches(self, segment: Segment, chunk: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(item, first position, words) of the phrases found, each of a window or more."""
        lists = [segment.postings(t) for t in self.terms]
        space = int(segment.first[-1]) + 2 * self.size + 2
        keys = np.concatenate([p + (i * space + self.size) for i, p in enumerate(lists)]) if lists else np.empty(0, dtype=np.int64)
        sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        edge = np.concatenate(([0], np.cumsum(sizes)))
        counts = sizes[self.term[self.anchors]] if len(self.anchors) else np.empty(0, dtype=np.int64)
        cuts = np.searchsorted(np.cumsum(counts), np.arange(chunk, counts.sum() + chunk, chunk), side="left") + 1
        for some in np.split(np.arange(len(counts)), np.unique(cuts[cuts < len(counts)])):
            n = counts[some]
            if not n.sum():
                continue
            place = np.repeat(self.anchors[some], n)
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = keys[edge[self.term[place]] + within] - self.term[place] * space  # the position, moved by size
            reach = {}
            for side in (-1, 1):
                run, live = np.zeros(len(at), dtype=np.int64), np.arange(len(at))
                for d in range(1, self.size):
                    where = place[live] + side * d
                    inside = (where >= 0) & (where < len(self.term))
                    live, where = live[inside], where[inside]
                    live, where = live[self.term[where] >= 0], where[self.term[where] >= 0]
                    want = self.term[where] * space + at[live] + side * d
                    i = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                    live = live[keys[i] == want]
                    if not len(live):
                        break
                    run[live] = d
                reach[side] = run
            item = self.item[place]
            good = reach[-1] + reach[1] + 1 >= self.need[item]
            yield item[good], (at - self.size - reach[-1])[good], (reach[-1] + reach[1] + 1)[good]


def proximity(segment: Segment, terms: list[bytes], span: int) -> list[tuple[int, int, int]]:
    """(document's place in the segment, first word, last word) of the stretches of at most ``span`` words that hold all ``terms``, each ending at one of them and as short as can be."""
    lists = [segment.postings(t) for t in dict.fromkeys(terms)]
    if not lists or not all(map(len, lists)):
        return []
    ends = np.unique(np.concatenate(lists))
    starts = np.full(len(ends), np.iinfo(np.int64).max)
    for p in sorted(lists, key=len):
        i = np.searchsorted(p, ends, side="right") - 1
        starts = np.minimum(starts, np.where(i >= 0, p[i], -1))
    doc = np.searchsorted(segment.first, ends, side="right") - 1
    good = (starts >= segment.first[doc]) & (ends - starts < span)
    return [(int(d), int(a - segment.first[d]), int(b - segment.first[d])) for d, a, b in zip(doc[good], starts[good], ends[good])]


def near(index: DataFrame, terms: list[bytes], span: int) -> DataFrame:
    """Proximity matches over all documents: doc_id, first_word, last_word."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row)
                found = [(segment.doc_id[d], a, b) for d, a, b in proximity(segment, terms, span)]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(3)], ["doc_id", "first_word", "last_word"])

    return index.mapInArrow(run, "doc_id long, first_word long, last_word long")


def _frequencies(index: DataFrame, terms: list[bytes]) -> np.ndarray:
    """Occurrences of the terms over all documents: one array for each task, then added."""
    wanted = index.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def run(batches):
        place = wanted.value
        total = np.zeros(len(place), dtype=np.int64)
        for batch in batches:
            for words, ends in zip(batch.column("terms"), batch.column("ends")):
                sizes = np.diff(ends.values.to_numpy(), prepend=0)
                for i, w in enumerate(words.values.to_pylist()):
                    if (k := place.get(w)) is not None:
                        total[k] += sizes[i]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])

    rows = index.select("terms", "ends").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect()
    out = np.zeros(len(terms), dtype=np.int64)
    for k, n in rows:
        out[k] = n
    return out


def _search(phrases):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment, wanted = Segment(row), phrases.value
                hit = np.zeros(int(segment.first[-1]), dtype=bool)
                pairs = [np.empty(0, dtype=np.int64)]
                for item, start, n in wanted.matches(segment):
                    doc = np.searchsorted(segment.first, start, side="right") - 1
                    pairs.append(np.unique(doc * len(wanted.names) + item))
                    for d in range(int(n.max()) if len(n) else 0):
                        hit[start[n > d] + d] = True
                found: dict[int, set[str]] = {}
                for x in np.unique(np.concatenate(pairs)).tolist():
                    found.setdefault(x // len(wanted.names), set()).add(wanted.names[x % len(wanted.names)])
                where = [np.flatnonzero(hit[segment.first[d] : segment.first[d + 1]]) if d in found else () for d in range(len(segment.doc_id))]
                count = len(segment.doc_id)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["segment"]] * count, pa.int64()), pa.array(range(count), pa.int32()), pa.array(segment.doc_id, pa.int64()), pa.array(segment.n_words),
                    pa.array(where, pa.list_(pa.int32())), pa.array([sorted(found.get(d, ())) for d in range(count)], pa.list_(pa.string()))],
                    ["segment", "place", "doc_id", "n_words", "hits", "items"])

    return run


def phrase_matches(index: DataFrame, items: DataFrame, size: int = 10, block_bytes: int = 16 << 20) -> DataFrame:
    """For every indexed document: doc_id, n_words, hits (places of its words inside some window of an item), items (their ids, sorted as strings).

    A window is ``size`` consecutive words of an item; an item of fewer words, but not none,
    is one window. ``items`` (item_id, text) go to the executors in blocks of at most about
    ``block_bytes`` of text, each a search of its own, so any number of items is handled.
    Null and empty texts have no words; an item with a null id takes no part; repeated items
    count once; documents repeat as often as their rows. An empty table gives no rows, and
    without items nothing is hit. Very long texts are indexed whole, in a segment of their own
    if need be. Of equally rare terms a window's first is looked up, which changes no result.
    """
    context = index.sparkSession.sparkContext
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id is not null and text is not null")
    size_all = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size_all // block_bytes))
    parts = []
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).distinct().collect()
        phrases = Phrases(sorted((r[0], WORD.findall(r[1].encode().lower())) for r in rows), size)
        phrases.anchor(_frequencies(index, phrases.terms))
        parts.append(index.mapInArrow(_search(context.broadcast(phrases)), "segment long, place int, doc_id long, n_words long, hits array<int>, items array<string>"))
    if blocks == 1:
        return parts[0].drop("segment", "place")
    both = parts[0]
    for p in parts[1:]:
        both = both.unionAll(p)
    joined = both.groupBy("segment", "place", "doc_id", "n_words").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("items")).alias("items"))
    return joined.select("doc_id", "n_words", F.array_sort(F.array_distinct("hits")).alias("hits"), F.array_sort(F.array_distinct("items")).alias("items"))


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 10, segment_bytes: int = 8 << 20) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated. A worker holds ``segment_bytes`` of text and its words, or one text. Other columns of ``docs`` and ``items`` are left out, whatever their names; for odd rows see ``phrase_matches``."""
    index = build_index(docs, fresh_path(docs.sparkSession, "postings"), segment_bytes)
    found = phrase_matches(index, items, size)
    return found.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without those that hold a window of an item of ``benchmark``, one without an id too.

    A doc_id that repeats goes if any of its rows does; rows without doc_id go by their text.
    Null and empty texts stay, and so do all columns; an empty table stays empty.
    """
    items = table(spark, sf_dir, "benchmark").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")

    def clean(rows: DataFrame, key: Column) -> DataFrame:
        found = decontaminate(rows.select(key.alias("doc_id"), "text"), items, segment_bytes=STAGE_BYTES).where("contaminated").select(F.col("doc_id").alias("__key")).distinct()
        return rows.join(found, key == F.col("__key"), "left_anti").select(docs.columns)

    out, nameless = clean(docs.where("doc_id is not null"), F.col("doc_id")), docs.where("doc_id is null")
    return out if nameless.isEmpty() else out.unionByName(clean(nameless, F.xxhash64("text")))


def query(spark, sf_dir):
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: DuckDB SQL for the rows of ``query``: windows as strings, equal to those of the items.
ORACLE_SQL = r"""
WITH parts AS (SELECT translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, row_number() OVER () AS rid, doc_id FROM documents),
docs AS (SELECT rid, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM parts),
items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
sized AS (SELECT item, w, least(10, len(w)) AS k FROM items WHERE len(w) > 0),
wanted AS (SELECT DISTINCT item, k, array_to_string(w[p:p + k - 1], ' ') AS phrase FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM sized)),
windows AS (SELECT rid, k, p, array_to_string(w[p:p + k - 1], ' ') AS phrase FROM
  (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM docs JOIN (SELECT DISTINCT k FROM sized) ON len(w) >= k)),
met AS (SELECT rid, k, p, item FROM windows JOIN wanted USING (k, phrase)),
hits AS (SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest(range(p, p + k)) AS place FROM (SELECT DISTINCT rid, k, p FROM met)) GROUP BY rid),
named AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM met) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits h USING (rid) LEFT JOIN named i USING (rid)"""
