"""A language model in an Elias-Fano n-gram trie.

Words are numbered by hash; an n-gram is its context's number and its last word, so a
search goes from level to level, each time among the successors of one context. Levels lie
in files by a hash of the context (a context too frequent for one file is dealt by last
word too), and readers map the files they need.

Counts cover all training documents. An n-gram is kept if it occurs ``least`` times; such an
n-gram's parts do too, so only those are counted. The query keeps all. Discounted, interpolated probabilities:
    P(w | u v) = a(uvw) + g(uv) (a(vw) + g(v) P(w)),   a = (count - D) / count of the context,
    g = 1 - the sum of the context's kept a,   P(w) = (1 - p) c(w) / N,   P(unknown) = p,
with p the share of tokens whose word occurs once. Each is a distribution over the known
words and one unknown. a and g are stored as steps of -log10.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.llm import elias_fano, shared_files
from sievewright.llm.common import by_bytes, bytes_of, fresh_path, give_back, table, tidy
from sievewright.llm.near_dedup import _mixed

DISCOUNT, STEPS, LEAST = 0.6, 4096.0, 2
#: Training tokens for each file of the higher levels.
TOKENS_A_FILE = 2_500_000
#: Text of a segment.
SEGMENT_BYTES = 6 << 20
SEGMENT_SCHEMA = "doc_id array<long>, held_out array<boolean>, sizes array<int>, words array<long>, counts array<int>, codes binary"
END_WORD = b"\n"  # no word holds white space


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % 7 == 2


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words' hashes, each word's place among them with an end behind each text's, and where texts begin (one more than texts)."""
    from xxhash import xxh64_intdigest

    lists = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
    coded = lists.values.dictionary_encode()
    words, own, owner = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    if "" in words:  # beside white space at a text's ends
        real = own != words.index("")
        own, owner = own[real], owner[real]
    edges = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(texts)) + 1)))
    codes = np.zeros(edges[-1], dtype=np.int32)  # 0: the end
    codes[np.arange(len(own)) + owner] = own + 1
    hashes = np.fromiter(map(xxh64_intdigest, [END_WORD.decode(), *words]), dtype=np.uint64, count=len(words) + 1)
    return hashes, codes, edges


def _merged(word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(word)
    word, n = word[order], n[order]
    new = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))[: len(word)])
    return word[new], np.add.reduceat(n, new) if len(new) else n


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as places in a segment's own list of words, with the words' counts in training texts."""
    for batch in by_bytes(batches, "text", SEGMENT_BYTES):
        word, codes, edges = _words(bytes_of(batch.column("text")))
        sizes, held = np.diff(edges), batch.column("held_out").to_numpy(zero_copy_only=False)
        counts = np.bincount(codes[np.repeat(~held.astype(bool), sizes)], minlength=len(word))
        whole = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        yield pa.RecordBatch.from_arrays([
            whole(batch.column("doc_id")), whole(batch.column("held_out")), whole(pa.array(sizes.astype(np.int32))), whole(pa.array(word.view(np.int64))), whole(pa.array(counts.astype(np.int32))),
            pa.array([codes.astype("<i4").tobytes()], pa.binary())], ["doc_id", "held_out", "sizes", "words", "counts", "codes"])


def _count_words(bits: int):
    """Each task's words and counts, as one blob for each file of the first level."""

    def dealt(parts) -> pa.RecordBatch:
        word, n = _merged(*(np.concatenate(x) for x in zip(*parts)))
        cuts = np.searchsorted(word, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
        rows = [(k, len(w).to_bytes(8, "little") + pa.compress(w.tobytes() + c.astype(np.int64).tobytes(), codec="zstd", asbytes=True)) for k, (w, c) in enumerate(zip(np.split(word, cuts), np.split(n, cuts))) if len(w)]
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.binary())], ["file", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for word, n in zip(batch.column("words"), batch.column("counts")):
                word, n = word.values.to_numpy().view(np.uint64), n.values.to_numpy()
                held.append((word[n > 0], n[n > 0].astype(np.int64)))
                size += len(held[-1][0])
                if size > 2_000_000:
                    held = [_merged(*(np.concatenate(x) for x in zip(*held)))]
                    if (size := len(held[0][0])) > 1_000_000:
                        yield dealt(held)
                        held, size = [], 0
        if held:
            yield dealt(held)

    return run


class Words:
    """The first level: hashes in files by their leading bits, and counts. A word's number is its rank."""

    def __init__(self, path: str, bits: int, first: np.ndarray):
        self.path, self.bits, self.first = path, bits, first  # first: ranks at which files begin, and the end

    def _file(self, k: int) -> dict[str, np.ndarray]:
        return shared_files.read(f"{self.path}/words-{k}")

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Of ascending hashes; -1 for unknown ones."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        low = np.uint64((1 << (64 - self.bits)) - 1)
        tops = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits) if self.bits else np.zeros(1, dtype=np.uint64)
        for k, a, b in _stretches(np.append(np.searchsorted(hashes, tops), len(hashes))):
            if self.first[k + 1] > self.first[k]:
                at = elias_fano.Sequence(self._file(k)).find(hashes[a:b] & low)
                out[a:b] = np.where(at >= 0, at + self.first[k], -1)
        return out

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        """Of ascending numbers; 0 for -1."""
        out = np.zeros(len(numbers), dtype=np.int64)
        for k, a, b in _stretches(np.searchsorted(numbers, self.first)):
            out[a:b] = self._file(k)["counts"][numbers[a:b] - self.first[k]]
        return out


def _stretches(edges: np.ndarray) -> list[tuple[int, int, int]]:
    """(which, first, stop) of the stretches between edges that aren't empty."""
    return [(k, int(edges[k]), int(edges[k + 1])) for k in np.flatnonzero(np.diff(edges)).tolist()]


def _write_words(path: str, bits: int):
    def run(part):
        k, words, counts = int(part.column("file")[0].as_py()), [], []
        for blob in part.column("words").to_pylist():
            n = int.from_bytes(blob[:8], "little")
            raw = pa.decompress(blob[8:], decompressed_size=16 * n, codec="zstd", asbytes=True)
            words.append(np.frombuffer(raw, dtype=np.uint64, count=n))
            counts.append(np.frombuffer(raw, dtype=np.int64, count=n, offset=8 * n))
        word, n = _merged(np.concatenate(words), np.concatenate(counts))
        arrays = elias_fano.encode(word & np.uint64((1 << (64 - bits)) - 1), 1 << (64 - bits))
        shared_files.write(f"{path}/words-{k}", arrays | {"counts": n.astype(np.uint32) if n.max() < 1 << 32 else n})
        from xxhash import xxh64_intdigest

        ends = n[word == np.uint64(xxh64_intdigest(END_WORD))]
        return pa.table({name: pa.array([int(value)], pa.int64()) for name, value in (("file", k), ("n", len(word)), ("tokens", n.sum()), ("once", (n == 1).sum()), ("texts", ends.sum()))})

    return run


def _steps(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(np.maximum(p, 1e-15)) * STEPS), 0, 65535).astype(np.uint16)


_SHARES = 10.0 ** (np.arange(1 << 16) / -STEPS)


def _share(steps: np.ndarray) -> np.ndarray:
    return _SHARES[steps]


def _by_file(file: np.ndarray) -> np.ndarray:
    return np.argsort(file.astype(np.uint16) if len(file) and file.max() < 1 << 16 else file, kind="stable")


class Level:
    """One of the higher levels: files by context, bases of entry numbers, the weights of split contexts."""

    def __init__(self, path: str, files: int, universe: int, target: int):
        self.path, self.files, self.universe, self.target = path, files, universe, target
        self.first = np.zeros(files + 1, dtype=np.int64)
        self.split, self.rest = np.empty(0, dtype=np.int64), np.empty(0)

    def file_of(self, context: np.ndarray, word: np.ndarray, often: np.ndarray) -> np.ndarray:
        """``often``: occurrences of the context; one above ``target`` is dealt by its last word."""
        pieces = np.maximum(1, -(-often // self.target)).astype(np.uint64)
        return (_mixed(_mixed(context.astype(np.uint64)) + _mixed(word.astype(np.uint64) + np.uint64(1)) % pieces) % np.uint64(self.files)).astype(np.int64)

    def find(self, context: np.ndarray, word: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entry number (or -1), a and g of each pair, equal contexts together; contexts and words of -1 have none."""
        entry, a, g = np.full(len(context), -1, dtype=np.int64), np.zeros(len(context)), np.ones(len(context))
        known = np.flatnonzero(context >= 0)
        file = self.file_of(context[known], word[known], often[known])
        order = _by_file(file)
        for own in np.split(known[order], np.flatnonzero(np.diff(file[order])) + 1):
            if not len(own):
                continue
            k = int(self.file_of(context[own[:1]], word[own[:1]], often[own[:1]])[0])
            if self.first[k + 1] == self.first[k]:
                continue
            f = shared_files.read(f"{self.path}-{k}")
            part = lambda name: elias_fano.Sequence({x.partition(".")[2]: y for x, y in f.items() if x.startswith(name)})
            mine = context[own]
            new = np.diff(mine, prepend=-1) != 0  # equal contexts come together
            some, back = mine[new], np.cumsum(new) - 1
            row = part("context.").find(some.astype(np.uint64))
            g[own] = np.where(row >= 0, _share(f["rest"][np.maximum(row, 0)]), 1.0)[back]
            first, stop = (x[back] for x in part("pointer.").both(np.maximum(row, 0)))
            row = row[back]
            good = (row >= 0) & (word[own] >= 0)
            at = part("key.").find(row[good].astype(np.uint64) * np.uint64(self.universe) + word[own[good]].astype(np.uint64), first[good], stop[good])
            hit, at = own[good][at >= 0], at[at >= 0]
            entry[hit], a[hit] = at + self.first[k], _share(f["a"][at])
        if len(self.split):
            i = np.minimum(np.searchsorted(self.split, context), len(self.split) - 1)
            g = np.where(self.split[i] == context, self.rest[i], g)
        return entry, a, g

    def counts(self, entries: np.ndarray) -> np.ndarray:
        """Occurrences of ascending entries; 0 for -1."""
        out = np.zeros(len(entries), dtype=np.int64)
        for k, a, b in _stretches(np.searchsorted(entries, self.first)):
            out[a:b] = shared_files.read(f"{self.path}-{k}")["counts"][entries[a:b] - self.first[k]]
        return out


def _planes(a: np.ndarray) -> tuple[int, bytes]:
    """Bytes of whole numbers, all lowest ones first: the higher ones are much alike."""
    a = a.astype(np.uint32) if not len(a) or a.max() < 1 << 32 else a.astype(np.uint64)
    return a.itemsize, a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()


def _pack(context: np.ndarray, word: np.ndarray, n: np.ndarray, often: np.ndarray) -> bytes:
    """N-grams whose contexts ascend: contexts once each, with how many words follow and how often they occur."""
    new = np.flatnonzero(np.diff(context, prepend=-1))
    parts = [_planes(a) for a in (np.diff(context[new], prepend=0), np.diff(new, append=len(context)), often[new], word, n)]
    raw = b"".join(p for _, p in parts)
    return bytes(w for w, _ in parts) + len(new).to_bytes(8, "little") + len(word).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(blob: bytes) -> list[np.ndarray]:
    widths, few, many = blob[:5], int.from_bytes(blob[5:13], "little"), int.from_bytes(blob[13:21], "little")
    counts = (few, few, few, many, many)
    raw, at, out = pa.decompress(blob[21:], decompressed_size=sum(w * c for w, c in zip(widths, counts)), codec="zstd", asbytes=True), 0, []
    for w, c in zip(widths, counts):
        out.append(np.frombuffer(raw, dtype=np.uint8, count=w * c, offset=at).reshape(w, c).T.copy().view(f"<u{w}").ravel().astype(np.int64))
        at += w * c
    context, sizes, often, word, n = out
    return [np.repeat(np.cumsum(context), sizes), word, n, np.repeat(often, sizes)]


def _order(context: np.ndarray, word: np.ndarray, universe: int) -> np.ndarray:
    """By context and word; one sort of whole numbers where both fit into one."""
    if not len(context) or int(context.max()) < (1 << 62) // universe:
        return np.argsort(context * universe + word)
    return np.lexsort((word, context))


def _write_level(level: Level, least: int, counted: bool):
    def run(part):
        give_back()
        k = int(part.column("file")[0].as_py())
        context, word, n, often = (np.concatenate(x) for x in zip(*(_unpack(b) for b in part.column("grams").to_pylist())))
        order = _order(context, word, level.universe)
        context, word, n, often = context[order], word[order], n[order], often[order]
        new = np.flatnonzero(np.diff(context, prepend=-1).astype(bool) | np.diff(word, prepend=-1).astype(bool))
        n = np.add.reduceat(n, new) if len(new) else n
        context, word, often = context[new], word[new], often[new]
        kept = n >= least
        context, word, n, often = context[kept], word[kept], n[kept], often[kept]
        first = np.flatnonzero(np.diff(context, prepend=-1))
        row = np.repeat(np.arange(len(first)), np.diff(first, append=len(context)))
        a = (n - DISCOUNT) / often
        held = np.add.reduceat(a, first) if len(first) else np.empty(0)
        arrays = {f"context.{x}": y for x, y in elias_fano.encode(context[first], int(context[-1]) + 1 if len(context) else 1).items()}
        arrays |= {f"key.{x}": y for x, y in elias_fano.encode(row.astype(np.uint64) * np.uint64(level.universe) + word.astype(np.uint64), max(1, len(first)) * level.universe).items()}
        arrays |= {f"pointer.{x}": y for x, y in elias_fano.encode(np.append(first, len(context)), len(context) + 1).items()}
        arrays |= {"a": _steps(a), "rest": _steps(1 - held)}
        if counted:  # the last level's counts are never asked for
            arrays["counts"] = n.astype(next((t for t in (np.uint16, np.uint32) if not len(n) or n.max() <= np.iinfo(t).max), np.uint64))
        shared_files.write(f"{level.path}-{k}", arrays)
        split = often[first] > level.target
        return pa.table({"file": pa.array([k], pa.int64()), "n": pa.array([len(context)], pa.int64()), "split": pa.array([context[first][split].tolist()], pa.list_(pa.int64())), "held": pa.array([held[split].tolist()], pa.list_(pa.float64()))})

    return run


def _build(grams: DataFrame, level: Level, least: int, counted: bool) -> Level:
    """Write a level's files. The driver gets one row a file, and the weights of contexts that are split: fewer than twice the files."""
    rows = grams.groupBy("file").applyInArrow(_write_level(level, least, counted), "file long, n long, split array<long>, held array<double>").collect()
    sizes, held = np.zeros(level.files, dtype=np.int64), {}
    for file, n, contexts, shares in rows:
        sizes[file] = n
        for c, s in zip(contexts, shares):
            held[c] = held.get(c, 0.0) + s
    level.first = np.concatenate(([0], np.cumsum(sizes)))
    level.split = np.array(sorted(held), dtype=np.int64)
    level.rest = np.array([max(1e-6, 1 - held[c]) for c in sorted(held)])
    return level


class _Model:
    """What tasks need; files are mapped as they are used."""

    def __init__(self, words: Words, vocabulary: int, tokens: int, texts: int, once: int):
        self.words, self.v, self.n, self.texts = words, vocabulary, tokens, texts
        self.unknown = (once + 1) / (tokens + 2)
        self.two: Level | None = None
        self.three: Level | None = None

    def positions(self, segment: "Segment"):
        """For each token its word's and pair's place and whether it begins a text; the distinct words and pairs (context, word, context's count)."""
        order = np.argsort(segment.words)
        number = self.words.numbers(segment.words[order])
        known = number >= 0
        some = np.concatenate(([-1], number[known]))  # -1: all unknown words
        place = np.zeros(len(order), dtype=np.int64)
        place[order[known]] = np.arange(1, len(some))
        often, word = self.words.counts(some), place[segment.codes]
        begin = np.zeros(len(word), dtype=bool)
        begin[segment.starts] = True
        left = np.where(begin, len(some), np.concatenate(([0], word[:-1])))
        pair, at = np.unique(left * (len(some) + 1) + word, return_inverse=True)
        left, right = np.divmod(pair, len(some) + 1)
        return word, at, begin, some, often, np.append(some, self.v)[left], some[right], np.append(often, self.texts)[left], often[right]


class Segment:
    def __init__(self, row: dict, training: bool):
        sizes, codes = np.array(row["sizes"], dtype=np.int64), np.frombuffer(row["codes"], dtype="<i4")
        self.words = np.array(row["words"], dtype=np.int64).view(np.uint64)
        if training:
            own = ~np.array(row["held_out"], dtype=bool)
            codes, sizes = codes[np.repeat(own, sizes)], sizes[own]
        self.codes, self.sizes, self.starts = codes, sizes, np.cumsum(sizes) - sizes


def _each(batches: Iterator[pa.RecordBatch], training: bool) -> Iterator[tuple[dict, Segment]]:
    for batch in batches:
        for i in range(len(batch)):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            flat = {n: row[n].values.to_numpy(zero_copy_only=False) for n in ("held_out", "sizes", "words")}
            segment = Segment(flat | {"codes": row["codes"].as_buffer()}, training)
            if len(segment.sizes):
                yield row, segment
                give_back()


def _dealt(level: Level, context: np.ndarray, word: np.ndarray, n: np.ndarray, often: np.ndarray) -> pa.RecordBatch:
    """Ascending n-grams, as one blob for each file."""
    file = level.file_of(context, word, often)
    by = _by_file(file)
    cuts = np.flatnonzero(np.diff(file[by])) + 1
    parts = [p for p in np.split(by, cuts) if len(p)]
    return pa.RecordBatch.from_arrays([pa.array([int(file[p[0]]) for p in parts], pa.int64()), pa.array([_pack(context[p], word[p], n[p], often[p]) for p in parts], pa.binary())], ["file", "grams"])


def _pairs(shared, level: Level, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for _, segment in _each(batches, True):
            _, at, _, _, _, context, word, c, often = model.positions(segment)
            n = np.bincount(at, minlength=len(context))
            # What occurs so often has a context and a word that do.
            good = (c >= least) & (often >= least)
            yield _dealt(level, context[good], word[good], n[good], c[good])

    return run


def _found(model: _Model, segment: Segment):
    """For each token: its word's number and count, pair's entry, a and g; and whether it begins a text."""
    word, at, begin, some, often, context, right, c, _ = model.positions(segment)
    entry, a, g = model.two.find(context, right, c)
    return some[word], often[word], entry[at], a[at], g[at], begin


def _triples(shared, level: Level):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for _, segment in _each(batches, True):
            ids, _, entry, _, _, begin = _found(model, segment)
            context = np.concatenate(([-1], entry[:-1]))
            good = ~begin & (context >= 0) & (entry >= 0)
            own, word = context[good], ids[good]
            order = _order(own, word, level.universe)
            own, word = own[order], word[order]
            new = np.flatnonzero(np.diff(own, prepend=-1).astype(bool) | np.diff(word, prepend=-1).astype(bool))
            if len(new):
                yield _dealt(level, own[new], word[new], np.diff(new, append=len(own)), model.two.counts(own[new]))

    return run


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for row, segment in _each(batches, False):
            ids, c, entry, a, g, begin = _found(model, segment)
            p = a + g * np.where(c > 0, (1 - model.unknown) * c / max(1, model.n), model.unknown)
            context = np.where(begin, -1, np.concatenate(([-1], entry[:-1])))
            longer = np.flatnonzero(context >= 0)
            longer = longer[np.argsort(context[longer])]
            _, a3, g3 = model.three.find(context[longer], ids[longer], model.two.counts(context[longer]))
            p[longer] = a3 + g3 * p[longer]
            base, at = np.log10((c + 1) / (model.n + model.v + 1)), segment.starts
            columns = [row["doc_id"].values, row["held_out"].values, pa.array(segment.sizes), pa.array(np.add.reduceat((c > 0).astype(np.int64), at)), pa.array(np.full(len(at), model.n)), pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(np.log10(np.minimum(p, 1.0)), at))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def _learned(source: DataFrame, least: int) -> tuple[DataFrame, _Model]:
    """The segments of ``source``, written, and the model in its files."""
    spark = source.sparkSession
    path = fresh_path(spark, "trie")
    # About four input partitions' words go to a file.
    bits = max(0, (source.rdd.getNumPartitions() // 4).bit_length())
    segments_path = fresh_path(spark, "segments")
    source.mapInArrow(_segments, SEGMENT_SCHEMA).write.option("compression", "zstd").parquet(segments_path)
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(segments_path)
    counted = segments.select("words", "counts").mapInArrow(_count_words(bits), "file long, words binary")
    sizes, sums = np.zeros(1 << bits, dtype=np.int64), np.zeros(3, dtype=np.int64)
    for k, size, *rest in counted.groupBy("file").applyInArrow(_write_words(path, bits), "file long, n long, tokens long, once long, texts long").collect():
        sizes[k] = size
        sums += rest
    v, (n, once, texts) = int(sizes.sum()), sums.tolist()
    words = Words(path, bits, np.concatenate(([0], np.cumsum(sizes))))
    model = _Model(words, v, n, texts, once)
    used = segments.select("held_out", "sizes", "words", "codes")
    files = max(1, -(-n // TOKENS_A_FILE))
    two = Level(f"{path}/two", files, v + 1, TOKENS_A_FILE)
    model.two = _build(used.mapInArrow(_pairs(spark.sparkContext.broadcast(model), two, least), "file long, grams binary"), two, least, counted=True)
    three = Level(f"{path}/three", files, v + 1, TOKENS_A_FILE)
    model.three = _build(used.mapInArrow(_triples(spark.sparkContext.broadcast(model), three), "file long, grams binary"), three, least, counted=False)
    return segments, model


def language_scores(docs: DataFrame, held: Column, least: int = LEAST) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for each row of ``docs`` (doc_id, text).

    ``held``: a boolean column; the model learns from the other rows, and from their pairs
    and triples that occur ``least`` times. Null and empty texts
    are an end alone. Repeated rows are each learned from and score alike; a null doc_id is
    kept. With no rows to learn from, every word is unknown. Words are told apart by 64-bit
    hashes. Very long texts are read whole, in a segment of their own; an empty table gives no
    rows; equal counts need no order, so there are no ties. Other columns are left out,
    whatever their names.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text")
    with tidy(spark):
        segments, model = _learned(source, least)
    return segments.drop("counts").mapInArrow(_score(spark.sparkContext.broadcast(model)), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def query(spark, sf_dir):
    return language_scores(table(spark, sf_dir, "documents"), held_out(), least=1)
