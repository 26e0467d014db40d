"""Toxicity from the nearest labelled examples by TF-IDF cosine.

Terms are all words of the examples, and one term that every text has. Inverse document
frequencies count all documents. A word's weight grows smoothly with how surely its rate
differs between the labelled classes, so what a text is about doesn't drown what it is
labelled for; no word weighs nothing, so every example is reached by its own words.

The index is an inverted one with block maxima. Examples lie in blocks of alike ones. A
seldom term lists its examples; a common term's list is an array over the blocks, with its
largest value in each. A search adds up the seldom terms and the most frequent ones, knows
from the best of these sums how similar the last neighbour is at least, and reads the common
terms only of blocks whose best sum and maxima together can reach that, each block once for
all texts searched together that need it.
Neighbours are exact. Their votes, weighted by similarity, are calibrated on the examples
themselves, each left out of its own vote. Near copies are one example with as many votes,
so what is much copied doesn't choose the terms.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import shared_files
from sievewright.llm.common import CACHES, by_bytes, distinct, fresh_path, release, spaced, table, trim, write_once
from sievewright.llm.near_dedup import shingles, signatures

#: Bounds of what is learned from: labelled rows of each class (the first by hash).
POSITIVE, NEGATIVE = 4096, 8192
#: Half of a word's weight comes at this square of its error-scaled difference of rates; the least share of a weight; neighbours.
HALF_Z2, LEAST_SHARE, NEIGHBOURS = 25.0, 0.01, 15
#: A term in these shares of the examples is common, or so frequent that it is added up for all; examples in a block; texts searched at once; what a copy's distance counts at least.
COMMON, FREQUENT, BLOCK, TOGETHER, NEAR = 0.05, 0.1, 64, 64, 0.03
#: Texts that share so many of the registers of a signature are compared, and are one example at this Jaccard similarity of shingles.
REGISTERS, ALIKE, COPY = 16, 4, 0.8
COMMON_WEIGHT, EVIDENCE, REMEMBERED = 1.0, 5, 50_000
#: Terms of the texts that are searched at once, or one text.
TERMS = 1 << 15
#: What rounding may do to a sum of similarities.
SLACK = 1e-5


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % 5 == 0


def _stretches(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places of stretches that begin at ``first`` and are ``n`` long."""
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


def _coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of ``spaced`` texts, in order: whose text's, and which of the texts' distinct words; and the 64-bit hashes of these, by which words are known."""
    from xxhash import xxh64_intdigest

    lists = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
    own = lists.values.dictionary_encode()  # each word is hashed, and looked for, once
    hashes = np.fromiter(map(xxh64_intdigest, own.dictionary.to_numpy(zero_copy_only=False)), dtype=np.uint64, count=len(own.dictionary))
    text, words = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy())), own.indices.to_numpy()
    real = (hashes != np.uint64(xxh64_intdigest("")))[words]  # beside white space at a text's ends
    return text[real], words[real], hashes


def coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words of ``spaced`` texts, in order: whose text's, and their hashes."""
    text, words, hashes = _coded(texts)
    return text, hashes[words]


def found(texts: list[bytes], terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of ``spaced`` texts that are among the ascending ``terms``, in order: whose text's, and which."""
    text, words, hashes = _coded(texts)
    if not len(terms):
        return text[:0], np.empty(0, dtype=np.int64)
    order = np.argsort(hashes)  # ascending ones are found near each other
    asked = hashes[order]
    near = np.minimum(np.searchsorted(terms, asked), len(terms) - 1)
    at = np.empty_like(near)
    at[order] = np.where(terms[near] == asked, near, -1)
    which = at[words]
    known = which >= 0
    return text[known], which[known]


class Index:
    """Examples as unit vectors, by example and by term."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, ids: np.ndarray, counts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rates: tuple[float, float], sizes: np.ndarray):
        # Terms are numbered by falling frequency, from the one that all have: most looks are at few numbers, which stay in the processor's cache.
        seen = np.bincount(np.concatenate([at for at, _ in counts]), minlength=len(terms))
        order = np.argsort(-seen, kind="stable")
        self.terms, self.numbers = terms, np.empty(len(terms), dtype=np.int32)  # hashes, ascending
        self.numbers[order] = np.arange(1, len(terms) + 1)
        self.weights = np.concatenate(([COMMON_WEIGHT], weights[order]))
        vectors = []
        for at, n in counts:
            by = np.argsort(self.numbers[at])
            vectors.append(self._unit(self.numbers[at][by], n[by]))
        often = np.concatenate(([1], seen[order] / len(ids)))
        # Terms below the first of these numbers are frequent, others below the second common, the rest seldom.
        self.frequent, self.common = (int((often >= share).sum()) for share in (FREQUENT, COMMON))
        # Alike ones beside each other: by label, by the frequent word that says most (as languages differ), and by length.
        chief = []
        for at, value in vectors:
            end = np.searchsorted(at, self.frequent)
            chief.append(int(at[1 + np.argmax(value[1:end])]) if end > 1 else -1)
        order = np.lexsort((np.arange(len(ids)), [value[0] for _, value in vectors], chief, labels))
        self.ids, self.labels, self.sizes = ids[order], labels[order].astype(np.float64), sizes[order]
        self.weight = np.where(self.labels == 1, rates[1], rates[0])
        vectors = [vectors[i] for i in order]
        n = np.array([len(at) for at, _ in vectors], dtype=np.int64)
        self.row_sizes, self.row_edges = n, np.concatenate(([0], np.cumsum(n)))
        self.row_at = np.concatenate([at for at, _ in vectors])
        self.row_value = np.concatenate([value for _, value in vectors])
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), n)
        self.blocks = -(-len(ids) // BLOCK)

        def part(begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            own = np.flatnonzero((self.row_at >= begin) & (self.row_at < end))
            return self.row_at[own] - begin, owner[own], self.row_value[own]

        at, row, value = part(0, self.frequent)
        self.matrix = np.zeros((self.frequent, self.blocks * BLOCK), dtype=np.float32)
        self.matrix[at, row] = value
        at, row, value = part(self.frequent, self.common)
        self.lists = np.zeros((self.blocks, self.common - self.frequent, BLOCK), dtype=np.float32)  # a block's lists beside each other
        self.lists[row // BLOCK, at, row % BLOCK] = value
        self.most = np.ascontiguousarray(self.lists.max(axis=2).T)
        by = np.argsort(self.row_at, kind="stable")
        by = by[self.row_at[by] >= self.common]
        # A row and its value side by side: one look for both.
        self.postings = np.stack([owner[by], self.row_value[by].view(np.int32)], axis=1).view(np.int64).ravel()
        self.edges = np.concatenate(([0], np.cumsum(np.bincount(self.row_at[by], minlength=len(self.weights)))))
        self.asked = np.zeros(len(self.weights), dtype=np.float32)
        self.slope, self.shift, self.memo, self.read = 1.0, 0.0, {}, [0, 0]

    #: What a search needs; arrays of two or three dimensions with their shapes' rest.
    PARTS = ("terms", "numbers", "weights", "ids", "labels", "sizes", "weight", "row_sizes", "row_edges", "row_at", "row_value", "postings", "edges", "matrix", "lists", "most")

    def save(self, path: str) -> None:
        """Write the index to the shared folder, where all workers map it: none holds a copy."""
        shared_files.write(path, {name: np.ascontiguousarray(getattr(self, name)).ravel() for name in self.PARTS} | {"fit": np.array([self.slope, self.shift])})

    @classmethod
    def load(cls, path: str) -> "Index":
        self = cls.__new__(cls)
        found = shared_files.read(path)
        for name in cls.PARTS:
            setattr(self, name, found[name])
        self.blocks = -(-len(self.ids) // BLOCK)
        self.matrix = self.matrix.reshape(-1, self.blocks * BLOCK)
        self.lists, self.most = self.lists.reshape(self.blocks, -1, BLOCK), self.most.reshape(-1, self.blocks)
        self.frequent, self.common = len(self.matrix), len(self.matrix) + len(self.most)
        self.slope, self.shift = found["fit"].tolist()
        self.asked, self.memo, self.read = np.zeros(len(self.weights), dtype=np.float32), {}, [0, 0]
        return self

    @property
    def dense(self) -> np.ndarray:
        """All vectors, for small indexes."""
        out = np.zeros((len(self.ids), len(self.weights)), dtype=np.float32)
        out[np.repeat(np.arange(len(self.ids)), np.diff(self.row_edges)), self.row_at] = self.row_value
        return out

    def own(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.row_edges[row], self.row_edges[row + 1])
        return self.row_at[part], self.row_value[part]

    def vectors(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Unit vectors of ``spaced`` texts."""
        width = len(self.weights)
        text, term = found(texts, self.terms)
        key, often = np.unique(text * width + self.numbers[term], return_counts=True)
        edges = np.searchsorted(key, np.arange(len(texts) + 1) * width)
        return [self._unit((key[a:b] - i * width).astype(np.int32), often[a:b]) for i, (a, b) in enumerate(itertools.pairwise(edges.tolist()))]

    def _unit(self, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words' ascending numbers and their counts."""
        at = np.concatenate(([np.int32(0)], at))
        value = (1 + np.log(np.concatenate(([1], n)))) * self.weights[at]
        return at, (value / np.sqrt((value * value).sum())).astype(np.float32)

    def nearest(self, at: np.ndarray, value: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and similarities of the ``k`` most similar examples; ties go to the smaller id."""
        return next(self.nearest_each([(at, value)], k))

    def nearest_each(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        k, some, held = min(k, len(self.ids)), [], 0
        for vector in vectors:
            # Few long texts have as many postings as many short ones.
            if some and (len(some) == TOGETHER or held + len(vector[0]) > TERMS):
                yield from self._search(some, k)
                some, held = [], 0
            some.append(vector)
            held += len(vector[0])
        if some:
            yield from self._search(some, k)

    def _search(self, some: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n, width = len(some), self.blocks * BLOCK
        edge = np.concatenate(([0], np.cumsum([len(x) for x, _ in some])))
        who = np.repeat(np.arange(n), np.diff(edge))
        at, value = (np.concatenate(x) for x in zip(*some))

        def table(begin: int, end: int) -> np.ndarray:
            out, own = np.zeros((n, end - begin), dtype=np.float32), (at >= begin) & (at < end)
            out[who[own], at[own] - begin] = value[own]
            return out

        seldom = np.flatnonzero(at >= self.common)
        first = self.edges[at[seldom]]
        many = self.edges[at[seldom] + 1] - first
        sums = table(0, self.frequent) @ self.matrix
        # Text by text: what one reads stays in the processor's cache.
        for t, (a, b) in enumerate(itertools.pairwise(np.searchsorted(seldom, edge).tolist())):
            read = self.postings[_stretches(first[a:b], many[a:b])].view(np.int32).reshape(-1, 2)
            rest = np.bincount(read[:, 0], read[:, 1].view(np.float32) * np.repeat(value[seldom[a:b]], many[a:b]), minlength=width)
            sums[t] += rest.astype(np.float32)
        sums[:, len(self.ids) :] = -1  # the last block's empty places
        asked, sums = table(self.frequent, self.common), sums.reshape(n, self.blocks, BLOCK)
        top = sums.max(axis=2)
        # What the best so far reach in the end, the last neighbour reaches too.
        block, place, reached = self._best(sums, top, k)
        own = np.flatnonzero((at >= self.frequent) & (at < self.common))
        if len(own):
            texts, begin = np.unique(who[own], return_index=True)
            more = value[own, None] * self.lists[block[who[own]], at[own, None] - self.frequent, place[who[own]]]
            reached[texts] += np.add.reduceat(more, begin, axis=0)
        near = top + asked @ self.most >= reached.min(axis=1, keepdims=True) - SLACK
        self.read[0] += int(near.sum())
        self.read[1] += near.size
        # A block's lists are read once, for all texts that need them.
        for lists, whose, b in zip(self.lists, near.T, range(self.blocks)):
            texts = np.flatnonzero(whose)
            sums[texts, b] += asked[texts] @ lists
        sums[~near] = -1
        least = self._best(sums, sums.max(axis=2), k)[2].min(axis=1, keepdims=True) - SLACK
        text, rows = np.nonzero(sums.reshape(n, width) >= least)
        for t, own in enumerate(np.split(rows, np.searchsorted(text, np.arange(1, n)))):
            yield self._exact(at[edge[t] : edge[t + 1]], value[edge[t] : edge[t + 1]], own, k)

    def _best(self, sums: np.ndarray, top: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Blocks, places and values of the ``k`` greatest sums of each text: they lie in the ``k`` blocks with the greatest tops."""
        lead = np.argpartition(top, -min(k, self.blocks), axis=1)[:, -min(k, self.blocks) :]
        some = np.take_along_axis(sums, lead[:, :, None], axis=1).reshape(len(sums), -1)
        best = np.argpartition(some, -k, axis=1)[:, -k:]
        return np.take_along_axis(lead, best // BLOCK, axis=1), best % BLOCK, np.take_along_axis(some, best, axis=1)

    def _exact(self, at: np.ndarray, value: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The best of ``rows``, added up in an order that doesn't depend on the texts searched beside this one."""
        n = self.row_sizes[rows]
        parts = [slice(a, b) for a, b in zip(self.row_edges[rows].tolist(), self.row_edges[rows + 1].tolist())]
        terms, values = (np.concatenate([x[part] for part in parts]) for x in (self.row_at, self.row_value))
        self.asked[at] = value
        scores = np.add.reduceat(values * self.asked[terms], np.cumsum(n) - n, dtype=np.float64)
        self.asked[at] = 0
        best = np.lexsort((rows, self.ids[rows], -scores))[:k]
        return rows[best], scores[best]

    def vote(self, rows: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Of the NEIGHBOURS nearest labelled texts, in the last dimension; an example stands for its near copies."""
        s, sizes = np.clip(scores, 1e-4, 1), self.sizes[rows]
        n = np.clip(NEIGHBOURS - (np.cumsum(sizes, axis=-1) - sizes), 0, sizes)
        w = n * s * s / (1 - s + NEAR) * self.weight[rows]  # a copy outvotes those that share but common words
        return (w * self.labels[rows]).sum(axis=-1) / w.sum(axis=-1)

    def calibrate(self) -> None:
        """Fit a logistic curve to the votes that the examples get from each other."""
        votes = []
        for row, (rows, scores) in enumerate(self.nearest_each([self.own(i) for i in range(len(self.ids))], NEIGHBOURS + 1)):
            others = rows != row
            votes.append(float(self.vote(rows[others][:NEIGHBOURS], scores[others][:NEIGHBOURS])))
        x, n1, n0 = _logit(np.array(votes)), self.labels.sum(), (1 - self.labels).sum()
        goal = np.where(self.labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))  # Platt's targets
        beta = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-(beta[0] * x + beta[1])))
            z, d = self.weight * (p - goal), self.weight * p * (1 - p) + 1e-9
            gradient = np.array([(z * x).sum(), z.sum()]) + 1e-3 * (beta - [1.0, 0.0])
            hessian = np.array([[(d * x * x).sum(), (d * x).sum()], [(d * x).sum(), d.sum()]]) + 1e-3 * np.eye(2)
            step = np.linalg.solve(hessian, gradient)
            beta -= np.clip(step, -1, 1)
            if abs(step).max() < 1e-8:
                break
        self.slope, self.shift = max(float(beta[0]), 1e-3), float(beta[1])

    def score(self, texts: list[bytes]) -> list[tuple[float, list[int]]]:
        """Of ``spaced`` texts."""
        keys = [hashlib.blake2b(t, digest_size=16).digest() for t in texts]
        if len(self.memo) >= REMEMBERED:
            self.memo.clear()
        new = {k: t for k, t in zip(keys, texts) if k not in self.memo}
        if new:
            rows, scores = map(np.stack, zip(*self.nearest_each(self.vectors([*new.values()]), NEIGHBOURS)))
            p = 1 / (1 + np.exp(-(self.slope * _logit(self.vote(rows, scores)) + self.shift)))
            self.memo.update(zip(new, zip(p.tolist(), self.ids[rows[:, :EVIDENCE]].tolist())))
        return [self.memo[k] for k in keys]


@lru_cache(maxsize=1)
def _loaded(path: str) -> Index:
    """One for each Python worker, with what it remembers."""
    return Index.load(path)


CACHES.append(_loaded.cache_clear)


def _logit(p):
    p = np.clip(p, 0.01, 0.99)
    return np.log(p / (1 - p))


def _document_counts(docs: DataFrame, terms: np.ndarray) -> tuple[int, np.ndarray]:
    """Documents, and those that hold each term, over all of ``docs``."""
    wanted = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        terms = wanted.value
        total = np.zeros(len(terms) + 1, dtype=np.int64)
        for batch in by_bytes(batches, "text", 2 << 20):
            text, term = found(spaced(batch.column("text")), terms)
            total += np.bincount(distinct(text * len(terms) + term) % max(1, len(terms)), minlength=len(total))
            total[-1] += len(batch)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])

    rows = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    wanted.unpersist()
    out = np.zeros(len(terms) + 1, dtype=np.int64)
    out[rows.column("term").to_numpy()] = rows.column("n").to_numpy()
    return int(out[-1]), out[:-1]


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's words as ascending hashes, their counts, its signature and its shingles."""
    release()
    for batch in by_bytes(batches, "text", 1 << 19):
        texts = spaced(batch.column("text"))
        sets = shingles([t.split() for t in texts])
        marks = signatures(sets, REGISTERS).view(np.int64).tolist()
        text, hashes = coded(texts)
        often = [np.unique(own, return_counts=True) for own in np.split(hashes, np.searchsorted(text, np.arange(1, len(texts))))]
        blobs = ([w.astype("<u8").tobytes() for w, _ in often], [n.astype("<i4").tobytes() for _, n in often], [h.astype("<u8").tobytes() for h, _ in sets])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(marks, pa.list_(pa.int64())), *(pa.array(b, pa.binary()) for b in blobs)], ["doc_id", "toxic", "marks", "words", "counts", "hashes"])


def _apart(labels: list[int], marks: list[list[int]], hashes: list[np.ndarray]) -> dict[int, int]:
    """Places of those that aren't near copies of an earlier one with their label, and how many each stands for, itself included."""
    seen: dict[tuple, list[int]] = {}
    kept: dict[int, int] = {}
    for i, (label, own) in enumerate(zip(labels, marks)):
        keys = [(label, k, m) for k, m in enumerate(own)] if len(hashes[i]) else [(label,)]  # those without words are one
        met = Counter(d for k in keys for d in seen.get(k, ()))
        for d, often in sorted(met.items(), key=lambda x: (-x[1], x[0])):
            both = len(np.intersect1d(hashes[i], hashes[d], assume_unique=True))
            if len(keys) == 1 or often >= ALIKE and both >= COPY * (len(hashes[i]) + len(hashes[d]) - both):
                kept[d] += 1
                break
        else:
            kept[i] = 1
            for k in keys:
                seen.setdefault(k, []).append(i)
    return kept


def learn(docs: DataFrame, labels: DataFrame) -> Index | None:
    """The index of the labelled examples, or None without any.

    Learns from labelled rows that aren't held out: of each class those of least hash, up to
    POSITIVE and NEGATIVE, near copies as one with their number; what they leave out of a class weighs the votes of the rest. A
    document with several labels counts as toxic if one says so; null labels don't count.
    The sample's ids are broadcast (at most POSITIVE + NEGATIVE rows), so no text is shuffled.
    """
    known = labels.where(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    size = {int(y): n for y, n in known.groupBy("toxic").agg(F.count("*")).collect()}
    parts = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in ((1, POSITIVE), (0, NEGATIVE))]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id")
    sample = write_once(texts.select("doc_id", "toxic", "text").mapInArrow(_sample_terms, "doc_id long, toxic int, marks array<long>, words binary, counts binary, hashes binary"), "examples")
    # At most a row for each of the sample, a partition at a time.
    got = [(doc, label, hashlib.blake2b(words + often).digest(), np.frombuffer(words, dtype="<u8"), np.frombuffer(often, dtype="<i4"), marks, np.frombuffer(hashes, dtype="<u8"))
           for doc, label, marks, words, often, hashes in ((*r[:3], *map(bytes, r[3:])) for r in sample.toLocalIterator())]
    got.sort(key=lambda r: r[:3])
    apart = _apart([r[1] for r in got], [r[5] for r in got], [r[6] for r in got])
    got, sizes = [got[i][:5] for i in apart], np.array(list(apart.values()), dtype=np.int64)
    trim()
    ids, y = (np.array([r[i] for r in got], dtype=np.int64) for i in (0, 1))
    p, q = float((y == 1).sum()), float((y == 0).sum())
    if not (p and q):
        return None
    terms = distinct(np.concatenate([words for *_, words, _ in got]))
    counts = [(np.searchsorted(terms, words).astype(np.int32), n) for *_, words, n in got]
    del got
    a, b = (np.bincount(np.concatenate([at for (at, _), label in zip(counts, y) if label == k]), minlength=len(terms)) for k in (1, 0))
    rate = (a + b) / (p + q)
    z2 = (a / p - b / q) ** 2 / (rate * (1 - rate) * (1 / p + 1 / q) + 1e-12)
    n, df = _document_counts(docs, terms)
    weights = (np.log((n + 1) / (df + 1)) + 1e-6) * (z2 + LEAST_SHARE * HALF_Z2) / (z2 + HALF_Z2)
    rates = tuple(size.get(c, 0) / max(1, int((y == c).sum())) for c in (0, 1))
    index = Index(terms, weights, ids, counts, y, rates, sizes)
    index.calibrate()
    trim()
    return index


def scorer(spark: SparkSession, index: Index | None):
    """A function of a text column: a struct of score and evidence."""
    path = fresh_path(spark, "index") if index else None
    if index:
        index.save(path)

    @F.arrow_udf("struct<score: double, evidence: array<bigint>>")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release(_loaded.cache_clear)
        index = _loaded(path) if path else None
        for column in columns:
            found = [x for i in range(0, len(column), 1024) for x in index.score(spaced(column[i : i + 1024]))] if index else [(0.25, [])] * len(column)
            yield pa.StructArray.from_arrays([pa.array([s for s, _ in found], pa.float64()), pa.array([e for _, e in found], pa.list_(pa.int64()))], ["score", "evidence"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with held_out, score (0 to 1), predicted (1 at 0.5 or more) and evidence (doc_ids of the nearest examples).

    Null and empty texts have no words and score as such texts do. Repeated rows score
    alike; without examples of both classes every score is 0.25. Very long texts are scored by
    all their words; an empty table gives no rows; equally near examples count by their
    doc_id. Columns of ``docs`` with these names are replaced.
    """
    score = scorer(docs.sparkSession, learn(docs, labels))
    out = docs.withColumn("__toxicity", score("text"))
    return out.withColumns({"held_out": held_out(), "score": F.col("__toxicity.score"), "predicted": (F.col("__toxicity.score") >= 0.5).cast("int"), "evidence": F.col("__toxicity.evidence")}).drop("__toxicity")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without those predicted toxic. All columns stay as they are, whatever their names; null and empty texts, repeated rows and an empty table as in ``toxicity``."""
    score = scorer(spark, learn(docs, table(spark, sf_dir, "labels")))
    return docs.withColumn("__toxicity", score("text")).where("__toxicity.score < 0.5").drop("__toxicity")


def query(spark, sf_dir):
    out = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted", "evidence")
