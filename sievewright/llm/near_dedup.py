"""Near-duplicates by ProbMinHash over weighted five-word shingles.

ProbMinHash (Ertl, 2020): every shingle is the start of a Poisson process with its weight
as rate; each arrival falls on one register, which keeps the shingle of its earliest
arrival; a process ends once it is later than every register. Two signatures agree on a
register with the probability Jaccard similarity of the weights, which for equal weights
is the Jaccard similarity. Texts that agree on a band of registers are compared exactly.

Equal texts are one node from the start. Buckets with the same members are compared once,
and large ones in pairs of blocks, each with a bounded number of texts; a block gives back
no more links than hold its classes together, never all its pairs.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm.common import by_bytes, discard, fresh_path, ready, release, table, words_of, write_at, write_once
from sievewright.llm.components import components

WORDS, BANDS, ROWS, SIMILARITY, BLOCK = 5, 24, 4, 0.8, 512
#: Bytes of text that a worker shingles at once in the stage, where it stands beside a heap that earlier stages have filled.
STAGE_BYTES = 2 << 20
#: Words of bits that are compared at once.
SLICE = 1 << 17
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[list[bytes]], width: int = WORDS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingle hashes (ascending) and weights, 1 + ln(count), of each text's words; a shorter text is one shingle."""
    from xxhash import xxh64_intdigest

    padded = [w if len(w) >= width or not w else w + [b""] * (width - len(w)) for w in texts]
    counts = np.fromiter(map(len, padded), dtype=np.int64, count=len(padded))
    place = defaultdict(itertools.count().__next__)
    codes = np.fromiter(map(place.__getitem__, itertools.chain.from_iterable(padded)), dtype=np.int32, count=int(counts.sum()))
    words = np.fromiter(map(xxh64_intdigest, place), dtype=np.uint64, count=len(place))[codes]
    value = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    for i in range(width):
        value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + words[i : i + len(value)])
    out = []
    for first, n in zip((np.cumsum(counts) - counts).tolist(), counts.tolist()):
        own, often = np.unique(value[first : first + n - width + 1] if n else value[:0], return_counts=True)
        out.append((own, 1 + np.log(often)))
    return out


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """One row of shingle hashes for each set; rows of empty sets hold 0."""
    sizes = np.array([len(h) for h, _ in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    seed = np.concatenate([h for h, _ in sets]) if sets else np.empty(0, dtype=np.uint64)
    rate = np.concatenate([w for _, w in sets]) if sets else np.empty(0)
    kept, first = np.zeros(len(sets) * registers, dtype=np.uint64), np.full(len(sets) * registers, np.inf)
    last = np.full(len(sets), np.inf)
    time, state = np.zeros(len(seed)), seed
    while len(owner):
        state = state + np.uint64(0x9E3779B97F4A7C15)
        draw = _mixed(state)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        # A second draw for the register, so that it doesn't depend on the time.
        slot = owner * registers + (_mixed(draw ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(registers)).astype(np.int64)
        better = np.flatnonzero(time < first[slot])
        better = better[np.argsort(-time[better], kind="stable")]  # the earliest is written last
        first[slot[better]], kept[slot[better]] = time[better], seed[better]
        touched = np.unique(owner[better])
        last[touched] = first.reshape(-1, registers)[touched].max(axis=1)
        live = time < last[owner]
        owner, seed, rate, time, state = owner[live], seed[live], rate[live], time[live], state[live]
    return kept.reshape(-1, registers)


def band_keys(kept: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    parts = kept.reshape(len(kept), bands, rows)
    value = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(kept), bands)).copy()
    for i in range(rows):
        value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return value.astype(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard: over the shared shingles i, the sum of 1 / sum over j of max(x_j / x_i, y_j / y_i)."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    union = len(a[0]) + len(b[0]) - len(both)
    if not len(both):
        return 0.0
    if (a[1] == 1).all() and (b[1] == 1).all():
        return len(both) / union
    x, y = a[1][i], b[1][j]
    only_x, only_y = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    pairs, often = np.unique(np.stack([x, y], axis=1), axis=0, return_counts=True)
    most = np.maximum(pairs[None, :, 0] / pairs[:, None, 0], pairs[None, :, 1] / pairs[:, None, 1]) @ often
    return float((often / (most + only_x / pairs[:, 0] + only_y / pairs[:, 1])).sum())


def _key(text: bytes | None, words: list[bytes]) -> bytes | None:
    if text is None:
        return None
    whole = b"w" + b" ".join(words) if words else b"t" + text
    return hashlib.blake2b(whole, digest_size=16).digest()


def _sign(bands: int, rows: int, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in by_bytes(batches, "text", batch_bytes):
            raw, texts = batch.column("text").cast(pa.binary()).to_pylist(), words_of(batch.column("text"))
            keys = band_keys(signatures(shingles(texts), bands * rows), bands, rows)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([_key(t, w) for t, w in zip(raw, texts)], pa.binary()),
                pa.array([k if w else None for k, w in zip(keys, texts)], pa.list_(pa.int64()))], ["doc_id", "key", "bands"])

    return run


def _payload(batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in by_bytes(batches, "text", batch_bytes):
            texts = words_of(batch.column("text"))
            keys = [_key(t, w) for t, w in zip(batch.column("text").cast(pa.binary()).to_pylist(), texts)]
            sets = shingles(texts)
            weights = [None if (w == 1).all() else w.astype("<f4").tobytes() for _, w in sets]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([h.astype("<u8").tobytes() for h, _ in sets], pa.binary()), pa.array(weights, pa.binary())], ["key", "hashes", "weights"])

    return run


def _linked(sets: list[tuple[np.ndarray, np.ndarray]], threshold: float) -> list[tuple[int, int]]:
    """Links that join the classes of all pairs at ``threshold`` or more."""
    n = len(sets)
    root = list(range(n))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    plain = np.array([(w == 1).all() for _, w in sets])
    sizes = np.array([len(h) for h, _ in sets], dtype=np.int64)
    owner = np.repeat(np.arange(n), sizes)
    _, code, often = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(often > 1)  # a shingle of one text meets nothing
    column = np.full(len(often), -1, dtype=np.int64)
    column[shared] = np.arange(len(shared))
    some = column[code] >= 0
    bits = np.zeros((n, -(-max(1, len(shared)) // 64)), dtype=np.uint64)
    at = column[code[some]]
    np.bitwise_or.at(bits, (owner[some], at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
    out = []
    step = max(1, SLICE // bits.shape[1])
    for i in range(n - 1):
        both = np.concatenate([np.bitwise_count(bits[k : k + step] & bits[i]).sum(axis=1, dtype=np.int64) for k in range(i + 1, n, step)])
        ratio = both / np.maximum(1, sizes[i + 1 :] + sizes[i] - both)
        even = plain[i + 1 :] & plain[i]
        # Weights can move the similarity of a pair; those are computed one by one.
        for j in (np.flatnonzero((ratio >= threshold) | (~even & (ratio >= threshold / 4))) + i + 1).tolist():
            a, b = top(i), top(j)
            if a != b and (even[j - i - 1] or similarity(sets[i], sets[j]) >= threshold):
                root[max(a, b)] = min(a, b)
                out.append((i, j))
    return out


def _compare(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(keys, sets) -> pa.RecordBatch:
            found = _linked(sets, threshold) if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([keys[p[k]] for p in found], pa.binary()) for k in (0, 1)], ["a", "b"])

        release()
        group, keys, sets = None, [], []
        for batch in batches:
            for g, key, hashes, weights in zip(*(batch.column(c).to_pylist() for c in ("block", "key", "hashes", "weights"))):
                if g != group:
                    yield links(keys, sets)
                    group, keys, sets = g, [], []
                own = np.frombuffer(hashes, dtype="<u8")
                keys.append(key)
                sets.append((own, np.ones(len(own)) if weights is None else np.frombuffer(weights, dtype="<f4").astype(np.float64)))
        yield links(keys, sets)

    return run


def _keys(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in columns:
        yield pa.array([_key(t, w) for t, w in zip(column.cast(pa.binary()).to_pylist(), words_of(column))], pa.binary())


def _classes(source: DataFrame, threshold: float, bands: int, rows: int, block: int, batch_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key) for each row of ``source`` (doc_id, text), and for each text its key, least doc_id (``first``) and the key of its class's ``root``."""
    signed = write_once(source.mapInArrow(_sign(bands, rows, batch_bytes), "doc_id long, key binary, bands array<long>"), "signed")
    texts = write_once(signed.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("first"), F.min("bands").alias("bands")), "texts")
    spread = texts.where("bands is not null").select("key", F.explode("bands").alias("band"))
    buckets = spread.groupBy("band").agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(key))").alias("who"), F.expr("sum(cast(xxhash64(key, 7) as decimal(38,0)))").alias("sum")).where("n > 1")
    once = buckets.groupBy("n", "who", "sum").agg(F.min("band").alias("band")).select("band", "n")
    spark = source.sparkSession
    dead = [fresh_path(spark, x) for x in ("members", "shingles")]
    members = write_at(spread.join(once, "band"), dead[0])
    # The texts that met another, once each: their shingles. An id only narrows what is read again; a text is known by its key.
    met = members.select("key").distinct().join(texts.select("key", "first"), "key")
    again = source.join(met.select(F.col("first").alias("doc_id")).distinct(), "doc_id", "left_semi").unionAll(source.where("doc_id is null"))
    sets = again.where("text is not null").select("text").mapInArrow(_payload(batch_bytes), "key binary, hashes binary, weights binary")
    payload = write_at(sets.join(met.select("key"), "key", "left_semi").dropDuplicates(["key"]), dead[1])
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("key"), blocks).cast("int")
    dealt = members.withColumns({"own": own, "blocks": blocks}).select("key", "band", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("key", F.xxhash64("band", F.least("own", "other"), F.greatest("own", "other")).alias("block"))
    links = dealt.join(payload, "key").repartition("block").sortWithinPartitions("block").mapInArrow(_compare(threshold), "a binary, b binary")
    roots = components(links)
    # Nothing reads them once the links are classes.
    for path in dead:
        discard(spark, path)
    classes = texts.select("key", "first").join(roots.withColumnRenamed("node", "key"), "key", "left").select("key", "first", F.coalesce("root", "key").alias("root"))
    return signed.select("doc_id", "key"), classes


def near_duplicates(docs: DataFrame, threshold: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK, batch_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class) and kept (whether the document stands for it), for each row of ``docs`` (doc_id, text).

    Words are runs of ASCII letters (case aside), digits and characters beyond ASCII. Texts
    with equal words are copies; so are texts without words that are equal, the empty one
    too. A null text is a class of its own, with its doc_id. Other texts are linked at a
    probability Jaccard of ``threshold`` or more (1 + ln(count) as a shingle's weight), and
    classes are what links join. With 24 bands of 4, a pair at 0.8 misses every band with a
    probability of 3e-6. Repeated rows are copies, and of these all with the least doc_id are
    kept; a null doc_id has a class but can't name it. A doc_id of several texts stands for
    each of them. Very long texts are shingled whole; no rows come of an empty table; other
    columns of ``docs`` are left out, whatever their names.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed, classes = _classes(source, threshold, bands, rows, block, batch_bytes)
    named = classes.join(classes.groupBy("root").agg(F.min("first").alias("class_id")), "root").select("key", "class_id")
    out = signed.join(named, "key", "left")
    return out.select("doc_id", F.coalesce("class_id", F.when(F.col("key").isNull(), F.col("doc_id"))).alias("class_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class: of its texts the one with the least doc_id (then the least key), of that text's rows the one with the least doc_id, then the least text.

    Rows are known by their text, not by doc_id, so a doc_id that repeats neither saves nor
    drops another text. A null doc_id comes after all others. Every row with a null text
    stays. An empty table stays empty, and so do all columns of ``docs``.
    """
    ready(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    _, classes = _classes(source, SIMILARITY, BANDS, ROWS, BLOCK, STAGE_BYTES)
    late = F.struct(F.col("first").isNull().alias("none"), "first", "key")
    chiefs = write_once(classes.groupBy("root").agg(F.min_by(F.struct("key", "first"), late).alias("c")).select(F.col("c.key").alias("__key"), F.col("c.first").alias("__first")), "chiefs")
    keyed = docs.withColumn("__key", F.arrow_udf(_keys, "binary")("text"))
    rows = keyed.where("text is not null").join(chiefs, "__key").where(F.col("doc_id").cast("long").eqNullSafe(F.col("__first")))
    once = rows.groupBy("__key").agg(F.min_by(F.struct(*docs.columns), "text").alias("__row")).select("__row.*")
    return once.unionByName(docs.where("text is null"))


def query(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
