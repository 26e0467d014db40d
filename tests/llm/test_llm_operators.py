"""Each operator against brute force on small fixtures, with the edge cases of its docstring."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.llm import decontamination, hash_forest, jump_shards, near_dedup, ngram_trie, packing, pii, token_counts, token_files, toxicity
from sievewright.llm.tokens import library, vocabulary

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SCHEMA = "doc_id long, text string, part int, rank long, key string"
LONG = " ".join(f"w{i % 97} the,  fox{i}" for i in range(3000))
TEXTS = ["one two three four five six seven eight nine ten eleven", "One two three FOUR five six seven eight nine ten eleven", None, "", "   \n ", LONG, LONG + " tail", "don't <|endoftext|> a\x1c b  c\n\n d", "x", "日本 語 é ñ", "x"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, 2, "k") for i, t in enumerate(TEXTS)] + [(None, "no id at all", 1, 2, "k"), (5, LONG, 1, 2, "k")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def ids(text):
    return library(vocabulary()).encode(text or "", add_special_tokens=False).ids


def crc(values):
    return zlib.crc32(np.array(values, dtype="<u4").tobytes())


def words(text):
    return WORD.findall((text or "").encode().lower())


def test_token_counts(docs, nothing):
    got = token_counts.token_counts(docs, vocabulary(), limit=512, batch_bytes=1000, part_chars=500).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((r["text"] or "").encode()), len(ids(r["text"])), len(ids(r["text"])) > 512)
    assert token_counts.token_counts(nothing, vocabulary()).count() == 0


def test_token_files_round_trip(spark, docs, nothing, tmp_path):
    token_files.write_token_files(docs, str(tmp_path / "t"), vocabulary(), batch_bytes=2000, files=3)
    got = sorted(token_files.read_token_files(spark, str(tmp_path / "t")).collect(), key=lambda r: r["start"])
    want = {i: ids(t) + [2] for i, t in enumerate(TEXTS)} | {None: ids("no id at all") + [2]}
    at = 0
    for r in got:
        assert (r["start"], r["n_tokens"], list(r["ids"])) == (at, len(want[r["doc_id"]]), want[r["doc_id"]])
        at += r["n_tokens"]
    assert [r["doc_id"] for r in got] == [None, *sorted([*range(len(TEXTS)), 5])]
    assert token_files.read_token_files(spark, str(tmp_path / "t")).where("doc_id = 8").count() == 1
    token_files.write_token_files(nothing, str(tmp_path / "e"), vocabulary())
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


def test_packing(docs, nothing):
    got = packing.pack(docs, vocabulary(), capacity=64, batch_bytes=2000).collect()
    want = {i: ids(t) + [2] for i, t in enumerate(TEXTS)} | {None: ids("no id at all") + [2]}
    for r in got:
        own = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(own) == r["length"] and crc(own) == r["ids_crc32"]
        assert r["length"] == 64 or r["piece"] == 0
    assert sum(r["length"] for r in got) == sum(map(len, want.values())) + len(want[5])
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 64
    assert packing.pack(nothing, vocabulary()).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_plan_holds_all_and_pairs_large_items(seed):
    rng = np.random.default_rng(seed)
    counts = Counter(rng.choice([rng.integers(1, 1025), rng.integers(1, 1025), *rng.integers(1, 1025, 60)], 4000).tolist())
    runs = packing.plan(counts, 1024)
    held = Counter()
    for bins, contents in runs:
        assert sum(s * n for s, n in contents) <= 1024 and sum(n for s, n in contents if 3 * s > 1024) <= 2
        for s, n in contents:
            held[s] += bins * n
    assert held == counts and len(runs) <= 3 * 1024
    least = max(-(-sum(s * n for s, n in counts.items()) // 1024), sum(n for s, n in counts.items() if s > 512))
    assert sum(b for b, _ in runs) <= 1.25 * least + 1


def test_jump_shards(spark, docs, nothing):
    many = spark.range(3000).selectExpr("id as doc_id", "cast(id as string) as text", "0 as shard")
    got = jump_shards.jump_shards(many, 40).collect()
    moved = [r for r in got if r["shard"] != r["grown_shard"]]
    assert {r["grown_shard"] for r in moved} == {40} and len(moved) < 3000 / 41 * 2
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())

    def one(draws, n):  # the published loop, one key at a time
        b, j = -1, 0
        while j < n:
            b = j
            j = int((b + 1) / next(draws))
        return b

    grown = {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in got}
    draws = {r[0]: r[1] for r in spark.range(200).selectExpr("id", "transform(sequence(1, 41), i -> (shiftrightunsigned(xxhash64(id, i), 12) + 1) / 4503599627370496D)").collect()}
    assert all(grown[k] == (one(iter(d), 40), one(iter(d), 41)) for k, d in draws.items())
    held = Counter(r["shard"] for r in got)
    assert len(held) == 40 and max(held.values()) < 2 * 3000 / 40
    hot = jump_shards.jump_shards(spark.range(900).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "'same' as text"), 5).collect()
    own = [r for r in hot if r["doc_id"] == 7]
    assert len({r["shard"] for r in own}) == 1 and len({(r["shard"], r["slot"]) for r in hot}) == 900
    edge = {(r["doc_id"], r["size"], r["text_crc32"]) for r in jump_shards.jump_shards(docs, 3).collect()}
    assert edge >= {(2, 16, 0), (3, 16, 0), (None, 28, zlib.crc32(b"no id at all"))}
    assert jump_shards.jump_shards(nothing).count() == 0


def test_decontamination(spark, docs, nothing):
    items = spark.createDataFrame([(1, "two three four five six seven eight nine ten eleven twelve"), (2, "x"), (10, "absent words"), (None, "x"), (3, None), (4, ""), (2, "x"), (5, "fox7 w8 the")], "item_id long, text string")
    listed = [(str(r[0]), words(r[1])) for r in items.collect() if r[0] is not None]
    for blocks in (16 << 20, 20):
        index = decontamination.build_index(docs, decontamination.fresh_path(spark, "test"), segment_bytes=5000)
        got = decontamination.phrase_matches(index, items, block_bytes=blocks).collect()
        assert len(got) == len(TEXTS) + 2
        for r in got:
            own = words("no id at all" if r["doc_id"] is None else TEXTS[r["doc_id"]])
            hits, found = set(), set()
            for name, w in listed:
                n = min(10, len(w))
                for s in range(len(w) - n + 1 if n else 0):
                    for d in range(len(own) - n + 1):
                        if own[d : d + n] == w[s : s + n]:
                            hits.update(range(d, d + n))
                            found.add(name)
            assert (r["n_words"], list(r["hits"]), list(r["items"])) == (len(own), sorted(hits), sorted(found))
    out = {r["doc_id"]: r for r in decontamination.decontaminate(docs, items).collect()}
    assert out[8]["items_sha256"] == hashlib.sha256(b"2").hexdigest() and out[0]["n_hit"] == 10 and not out[3]["contaminated"]
    assert decontamination.decontaminate(nothing, items).count() == 0
    near = {(r["doc_id"], r["first_word"], r["last_word"]) for r in decontamination.near(index, [b"three", b"one"], 3).collect()}
    assert near == {(0, 0, 2), (1, 0, 2)}


def test_decontamination_without_ids(spark, tmp_path):
    passage, other = (" ".join(f"{c}{i}" for i in range(12)) for c in "pq")
    spark.createDataFrame([("1", passage), (None, other)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, f"some {passage}"), (None, "clean"), (None, None), (1, passage), (2, f"{other} end"), (3, "clean")]
    kept = decontamination.stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [(None, "clean"), (None, None), (3, "clean")]))


def near_classes(texts):
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := words(t)) else {("raw", t)} for i, t in texts.items() if t is not None}
    root = {i: i for i in texts}
    for a, b in combinations(sorted(sets), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            ra, rb = sorted((root[a], root[b]))
            root = {k: ra if v == rb else v for k, v in root.items()}
    return root


def test_near_duplicates(spark, docs, nothing):
    rng = np.random.default_rng(5)
    base = [f"u{i}" for i in rng.integers(0, 10**6, 200)]
    texts = {}
    for i in range(60):
        own = list(base)
        for at in rng.integers(0, 200, rng.integers(0, 12)):
            own[at] = f"v{rng.integers(0, 10**6)}"
        texts[i] = " ".join(own)
    for i in range(60, 120):
        texts[i] = " ".join(f"z{x}" for x in rng.integers(0, 10**6, 40))
    texts |= {200: "a b", 201: "A, b!", 202: None, 203: None, 204: "", 205: "", 206: "!!", 207: texts[70]}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for block in (512, 8):
        got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_dedup.near_duplicates(df, block=block).collect()}
        want = near_classes(texts)
        assert {i: c for i, (c, _) in got.items()} == want
        assert {i for i, (_, k) in got.items() if k} == set(want.values())
    rows = near_dedup.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS) + 2 and next(r for r in rows if r["doc_id"] == 10)["class_id"] == 8
    assert near_dedup.near_duplicates(nothing).count() == 0
    kept = near_dedup.stage(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [0, 2, 3, 4, 5, 7, 8, 9]


def test_near_duplicates_of_the_query(spark):
    """Classes of the whole table, against all pairs."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.query(spark, "/root/testdata/sf0.01").collect()}
    assert got == near_classes({r["doc_id"]: r["text"] for r in rows})


def test_near_dedup_stage_keeps_by_row(spark):
    rng = np.random.default_rng(12)
    base = [f"b{x}" for x in rng.integers(0, 10**6, 100)]
    a, near = " ".join(base), " ".join([*base[:50], "other", *base[51:]])
    other, far = " ".join(base[::-1]), " ".join(f"f{i}" for i in range(30))
    rows = [(1, a, "x"), (5, other, "x"), (5, near, "x"), (None, near, "n"), (None, far, "n"), (None, far, "n"), (7, None, "x"), (7, None, "x"), (8, "", "x"), (9, "", "x"), (1, a.upper(), "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)
    kept = near_dedup.stage(spark, df, "")
    assert kept.columns == df.columns
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [(1, a.upper(), "y"), (5, other, "x"), (None, far, "n"), (7, None, "x"), (7, None, "x"), (8, "", "x")]))
    assert near_dedup.stage(spark, df.limit(0), "").count() == 0


def test_near_duplicates_with_irregular_ids(spark):
    rng = np.random.default_rng(11)
    base = [[f"{g}x{x}" for x in rng.integers(0, 10**6, 100)] for g in range(12)]
    near = lambda g: " ".join([*base[g][:50], "other", *base[g][51:]])
    # One id for different texts, each with a near copy under an id of its own; and texts without an id near such that have one.
    rows = [(1000, " ".join(base[g])) for g in range(8)] + [(g, near(g)) for g in range(8)]
    rows += [(None, " ".join(base[g])) for g in range(8, 12)] + [(g, near(g)) for g in range(8, 11)] + [(None, near(11))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_dedup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert sorted(r["class_id"] for r in got if r["doc_id"] == 1000) == list(range(8))
    assert sorted(r["class_id"] for r in got if r["doc_id"] is None and r["class_id"] is not None) == [8, 9, 10]
    assert all(r["class_id"] == r["doc_id"] and r["kept"] for r in got if r["doc_id"] is not None and r["doc_id"] < 1000)


def test_weighted_similarity():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = ({int(k): float(w) for k, w in zip(rng.choice(30, 15, replace=False), rng.integers(1, 4, 15))} for _ in range(2))
        want = sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in set(a) | set(b)) for i in set(a) & set(b))
        pair = [(np.array(sorted(s), dtype=np.uint64), np.array([s[k] for k in sorted(s)])) for s in (a, b)]
        assert near_dedup.similarity(*pair) == pytest.approx(want)
    kept = near_dedup.signatures([(near_dedup._mixed(p[0]), p[1]) for p in pair], 4096)
    assert (kept[0] == kept[1]).mean() == pytest.approx(want, abs=0.04)


def test_pseudonyms(spark, docs, nothing):
    def luhn(s):
        d = [int(c) for c in s][::-1]
        return sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])

    texts = ["a 4785380592391139$$$ b 4785380592391139", "4785380592391139", "4111 1111 1111 1112 is not one", "10.20.30.40 and 999.1.1.1", "2021-02-28, 2/28/2021, 28.02.2021; 2021-02-30", "123-45-6789 000-12-3456", "DE89 3704 0044 0532 0130 00", "write to some.one9@mail5.example.com.", "+1 (663) 555-6869", "nothing 12.5 here"]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, n_private string")
    got = [r["text"] for r in pii.pseudonymise(df, "k").orderBy("doc_id").collect()]
    card = got[1]
    assert got[0] == f"a {card}$$$ b {card}" and card != texts[1] and luhn(card) % 10 == 0 and len(card) == 16
    assert got[2] == texts[2] and got[9] == texts[9]
    assert re.fullmatch(r"(\d+\.){3}\d+ and 999\.1\.1\.1", got[3]) and got[3] != texts[3]
    y, m, d = re.match(r"(\d+)-(\d+)-(\d+)", got[4]).groups()
    assert got[4].startswith(f"{y}-{m}-{d}, {int(m)}/{d}/{y}, {d}.{m}.{y}; 2021-02-30") or got[4].startswith(f"{y}-{m}-{d}, {m}/{d}/{y}, {d}.{m}.{y}; 2021-02-30")
    assert re.fullmatch(r"\d{3}-\d{2}-\d{4} 000-12-3456", got[5]) and got[5] != texts[5]
    flat = got[6].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1 and got[6] != texts[6]
    assert got[7].endswith("@mail5.example.com.") and got[7] != texts[7]
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[8]) and got[8] != texts[8]
    phones = ["+442071234567", "+44 20 7123 4567", "+16635556869", "+1 663 555 6869", "(663) 555-6869", "663-555-6869"]
    mails = ["иван@mail.ru", "é@x.com", "日本@x.jp", "Ａ@x.com", "a@b.co", "z@b.co", "𝒳y@z.com", "\u0561b@q.org"]
    out = pii.pseudonymise(spark.createDataFrame(list(enumerate(phones + mails)), "doc_id long, text string"), "k").orderBy("doc_id").collect()
    new = [r["text"] for r in out]
    bare = [re.sub("[^0-9]", "", x) for x in new[:6]]
    assert new[0].startswith("+44") and bare[0] == bare[1] and bare[2] == bare[3] and bare[2][1:] == bare[4] == bare[5] and bare[2][0] == "1"
    assert all(r["n_private"] == 1 for r in out) and all(a != b and a.partition("@")[2] == b.partition("@")[2] and not set(a.partition("@")[0]) & set(b.partition("@")[0]) for a, b in zip(mails, new[6:]))
    long = "x " * 200_000 + "write to somebody@mail.example.org, " + "y" * 100_000 + "@z.org"
    whole = pii.pseudonymise(spark.createDataFrame([(1, long)], "doc_id long, text string"), "k").first()
    assert whole["n_private"] == 2 and len(whole["text"]) == len(long) and "somebody@" not in whole["text"]
    edge = pii.pseudonymise(docs, "k")
    assert edge.columns == [*docs.columns, "n_private"] and edge.where("text is null").count() == 1 and edge.where("n_private > 0").count() == 0
    assert pii.pseudonymise(nothing, "k").count() == 0


def by_hand(text, secret, kind):
    """The network over a string of digits and ASCII letters, one character at a time."""
    kinds = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]

    def move(c, by):
        return next((k[(k.index(c) + by) % len(k)] for k in kinds if c in k), c)

    halves = [text[: len(text) // 2], text[len(text) // 2 :]]

    def turn(step, sign):
        key = hashlib.sha256(f"{secret}|{kind}|{step}|{halves[1 - step % 2]}".encode()).hexdigest()
        halves[step % 2] = "".join(move(c, sign * int(hashlib.sha256(f"{key}|{i}".encode()).hexdigest()[:15], 16)) for i, c in enumerate(halves[step % 2], 1))

    for step in range(pii.ROUNDS):
        turn(step, 1)
    halves = ["".join(move(c, 1) for c in h) for h in halves]
    for step in reversed(range(pii.ROUNDS)):
        turn(step, -1)
    return "".join(halves)


def test_feistel_is_a_permutation(spark):

    out = spark.range(90).select((F.col("id") % 9).alias("a"), F.floor(F.col("id") / 9).alias("b"), pii._numbers("k", "x", F.col("id") % 9, F.floor(F.col("id") / 9), 9, 10).alias("p")).select("a", "b", "p.l", "p.r")
    assert out.select("l", "r").distinct().count() == 90 and out.where("l between 0 and 8 and r between 0 and 9").count() == 90 and out.where("a = l and b = r").count() == 0
    text = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("t")).select("t", pii._text("k", "x", F.col("t")).alias("p"))
    assert text.select("p").distinct().count() == 1000 and text.where("p rlike '^[0-9]{3}$' and p != t").count() == 1000
    odd = ["", "a", "Z9", "some.one_7", "x" * 40, "+-._%", "0000000000"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "i int, t string").select("i", pii._text("k", "mail", F.col("t")).alias("p")).orderBy("i").collect()
    assert [r["p"] for r in got] == [by_hand(t, "k", "mail") for t in odd]
    letters = [chr(c) for c in (*range(0xC0, 0x250), *range(0x370, 0x3FF), *range(0x400, 0x460), *range(0xFF21, 0xFF40))]
    moved = spark.createDataFrame([(c,) for c in letters + ["\ufeff", "."]], "c string").select("c", pii._moved(F.col("c"), F.lit(1)).alias("n"), pii._moved(pii._moved(F.col("c"), F.lit(1)), F.lit(-1)).alias("b")).collect()
    assert all(r["b"] == r["c"] for r in moved) and all(r["n"] != r["c"] or not r["c"].isalpha() for r in moved) and len({r["n"] for r in moved}) == len(moved), [tuple(r) for r in moved if r["b"] != r["c"] or r["n"] == r["c"]]


def test_pseudonyms_of_the_query(spark):
    """Values that the query replaced in whole documents, against the network by hand."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    old = {r["doc_id"]: r["text"] for r in rows}
    got = pii.query(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(rows)
    mail, seen = re.compile(r"(?<![\w.%+-])([A-Za-z0-9._%+-]+)@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24})(?![A-Za-z0-9])"), 0
    for r in got:
        before, after = (mail.findall(t or "") for t in (old[r["doc_id"]], r["text"]))
        assert [(by_hand(a, pii.SECRET, "mail"), d) for a, d in before] == after
        assert (r["n_private"] > 0) == (old[r["doc_id"]] != r["text"])
        seen += len(before)
    assert seen > 10


def test_language_model(spark, docs, nothing):
    rng = np.random.default_rng(2)
    texts = {i: " ".join(rng.choice(["a", "b", "c", "d", "e\tf", "G"], rng.integers(0, 30))) for i in range(60)} | {100: None, 101: "", 102: "unseen words here"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in ngram_trie.language_scores(df, ngram_trie.held_out()).collect()}
    token = {i: re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower()) + [b"\n"] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    one, two, three = Counter(), Counter(), Counter()
    for i, t in token.items():
        if not held[i]:
            s = [None, *t]
            one.update(t), two.update(zip(s, s[1:])), three.update(zip(s, s[1:], s[2:]))
    n, v, unknown = sum(one.values()), len(one), (sum(c == 1 for c in one.values()) + 1) / (sum(one.values()) + 2)
    first = dict(one) | {None: sum(not h for h in held.values())}
    two2, three2 = {k: c for k, c in two.items() if c > 1}, {k: c for k, c in three.items() if c > 1}
    D = ngram_trie.DISCOUNT

    def p(u, v_, w, uv):
        out = (1 - unknown) * one[w] / n if one[w] else unknown
        rest = 1 - sum((c - D) / first[v_] for k, c in two2.items() if k[0] == v_)
        out = (two2.get((v_, w), D) - D) / first.get(v_, 1) + rest * out
        if uv in two2:
            rest = 1 - sum((c - D) / two[uv] for k, c in three2.items() if k[:2] == uv)
            out = (three2.get((*uv, w), D) - D) / two[uv] + rest * out
        return out

    for i, t in token.items():
        s = [None, *t]
        want = sum(np.log10(p(None, s[k], w, (s[k - 1], s[k]) if k else ())) for k, w in enumerate(t))
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(t), sum(one[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((one[w] + 1) / (n + v + 1)) for w in t)) and r["score"] == pytest.approx(want, abs=1e-3 * len(t))
    assert ngram_trie.language_scores(docs, ngram_trie.held_out()).count() == len(TEXTS) + 2
    assert ngram_trie.language_scores(nothing, ngram_trie.held_out()).count() == 0


def test_language_model_learns_from_what_occurs_once(spark, tmp_path):
    train = [i for i in range(300) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 7 == 2]
    words_ = [f"w{k}" for k in range(20)]
    texts = {train[0]: " ".join(words_), train[1]: " ".join(words_[::-1][::2] + words_[::-1][1::2])}
    texts |= {held[0]: " ".join(words_[5:13]), held[1]: " ".join(words_[5:13][::-1])}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in ngram_trie.query(spark, str(tmp_path)).collect()}
    one, two, three = Counter(), Counter(), Counter()
    for d in train[:2]:
        s = [None, *texts[d].split(), "\n"]
        one.update(s), two.update(zip(s, s[1:])), three.update(zip(s, s[1:], s[2:]))
    n, D = sum(c for w, c in one.items() if w), ngram_trie.DISCOUNT
    unknown = (sum(c == 1 for w, c in one.items() if w) + 1) / (n + 2)

    def share(grams, context, word, often, lower):
        kinds = sum(k[:-1] == context for k in grams)
        return (max(grams[(*context, word)] - D, 0) + D * kinds * lower) / often if kinds else lower

    for d in held[:2]:
        s = [None, *texts[d].split(), "\n"]
        want = 0.0
        for k in range(1, len(s)):
            p = share(two, (s[k - 1],), s[k], one[s[k - 1]], (1 - unknown) * one[s[k]] / n)
            want += np.log10(share(three, (s[k - 2], s[k - 1]), s[k], two[(s[k - 2], s[k - 1])], p) if k > 1 else p)
        assert got[d]["score"] == pytest.approx(want, abs=1e-3 * len(s))
    assert got[held[0]]["score"] > got[held[1]]["score"] + 1


def test_elias_fano():
    from sievewright.llm import elias_fano

    rng = np.random.default_rng(0)
    for n, universe in ((0, 5), (1, 1), (50, 60), (3000, 10**6), (3000, 2**63)):
        values = np.unique(rng.integers(0, universe, n).astype(np.uint64))
        s = elias_fano.Sequence(elias_fano.encode(values, universe))
        assert s.get(np.arange(len(values))).tolist() == values.astype(np.int64).tolist()
        ask = np.concatenate([values, rng.integers(0, universe, 500).astype(np.uint64)])
        place = {int(x): i for i, x in enumerate(values)}
        assert s.find(ask).tolist() == [place.get(int(x), -1) for x in ask]


def test_toxicity(spark, docs, nothing):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join([f"w{x}" for x in rng.integers(0, 50, 30)] + (["vile", "foul"] if i % 4 == 0 else [])), int(i % 4 == 0)) for i in range(400)]
    df = spark.createDataFrame([r[:2] for r in rows] + [(1000, None), (1001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, None), (None, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(df, labels).collect()}
    assert all(got[i]["predicted"] == y and 0 <= got[i]["score"] <= 1 and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, y in rows)
    assert got[1000]["score"] == got[1001]["score"] < 0.5
    index = toxicity.learn(df, labels)
    for row in range(0, len(index.ids), 7):
        at = np.flatnonzero(index.dense[row])
        rows_, scores = index.nearest(at, index.dense[row, at], 15)
        every = index.dense[:, at] @ index.dense[row, at]
        assert np.allclose(np.sort(every)[::-1][:15], scores, atol=1e-6)
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.25}
    assert toxicity.toxicity(nothing, labels).count() == 0


def test_toxicity_by_hand(spark):
    """Neighbours, votes and scores against the formulas over all examples."""
    rng = np.random.default_rng(14)
    rows = [(i, " ".join([f"w{x}" for x in rng.zipf(1.3, 40) if x < 3000] + (["vile", "foul"][: rng.integers(0, 3)] if i % 4 == 0 else [])), int(i % 4 == 0)) for i in range(500)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(df, labels).collect()}
    index = toxicity.learn(df, labels)
    texts = {i: Counter(t.split()) for i, t, _ in rows}
    df_ = Counter(w for c in texts.values() for w in c)
    learned = [i for i in index.ids.tolist()]
    y = {i: lab for i, _, lab in rows}
    p, q = (sum(y[i] == k for i in learned) for k in (1, 0))
    weight = {}
    for w in {w for i in learned for w in texts[i]}:
        a, b = (sum(w in texts[i] for i in learned if y[i] == k) for k in (1, 0))
        rate = (a + b) / (p + q)
        z2 = (a / p - b / q) ** 2 / (rate * (1 - rate) * (1 / p + 1 / q) + 1e-12)
        weight[w] = (np.log(501 / (df_[w] + 1)) + 1e-6) * (z2 + 0.25) / (z2 + 25)

    def unit(counts):
        v = {w: (1 + np.log(n)) * weight[w] for w, n in counts.items() if w in weight} | {None: toxicity.COMMON_WEIGHT}
        size = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    vectors = {i: unit(texts[i]) for i in learned}
    for d, _, _ in rows[::9]:
        own = unit(texts[d])
        scores = sorted(((sum(x * v.get(w, 0) for w, x in own.items()), i) for i, v in vectors.items()), key=lambda x: (-round(x[0], 6), x[1]))[:15]
        votes = [(max(s, 1e-4) ** 2 / (1 - min(s, 1) + 0.03) * index.weight[learned.index(i)], y[i]) for s, i in scores]
        share = np.clip(sum(w for w, k in votes if k) / sum(w for w, _ in votes), 0.01, 0.99)
        assert (index.sizes == 1).all() and got[d]["score"] == pytest.approx(1 / (1 + np.exp(-(index.slope * np.log(share / (1 - share)) + index.shift))), abs=2e-3)
        assert got[d]["evidence"][0] == scores[0][1]


def test_toxicity_searches_over_many_blocks():
    """Terms lie by frequency, blocks' lists by block; texts searched together get what each gets alone, and all examples would give."""
    rng = np.random.default_rng(21)

    def draw(often: int) -> tuple[np.ndarray, np.ndarray]:
        at, n = np.unique(rng.zipf(1.2, often) % 4000, return_counts=True)
        return at.astype(np.int32), n

    examples = 1500
    counts = [draw(rng.integers(1, 120)) for _ in range(examples)]
    counts[7] = counts[800] = counts[1400]  # equally near
    index = toxicity.Index(np.arange(4000, dtype=np.uint64) * 3, rng.random(4000) + 1e-6, rng.permutation(examples), counts, rng.integers(0, 2, examples), (1.0, 2.0), np.ones(examples, dtype=np.int64))
    often = (index.dense > 0).sum(axis=0)
    assert (np.diff(often) <= 0).all() and often[0] == examples
    assert index.lists.shape == (index.blocks, index.common - index.frequent, toxicity.BLOCK) and index.blocks > 15 and index.common > index.frequent > 0
    asked = [index.own(row) for row in range(0, examples, 9)] + [(np.zeros(1, dtype=np.int32), np.ones(1, dtype=np.float32))]
    for (at, value), (rows, scores) in zip(asked, index.nearest_each(asked, 15)):
        alone = index.nearest(at, value, 15)
        assert rows.tolist() == alone[0].tolist() and scores.tolist() == alone[1].tolist()
        every = (index.dense[:, at].astype(np.float64) * value).sum(axis=1)
        want = np.lexsort((index.ids, -every.round(6)))[:15]
        assert np.allclose(every[want], scores, atol=1e-6) and (np.diff(scores) <= 0).all()
        ties = scores[1:] == scores[:-1]
        assert (np.diff(index.ids[rows])[ties] > 0).all()
    assert 0 < index.read[0] < index.read[1]


def test_toxicity_on_held_out_rows_of_the_query(spark):
    got = {r["doc_id"]: r for r in toxicity.query(spark, "/root/testdata/sf0.1").where("held_out").collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    toxic = [got[d]["predicted"] for d, y in labels.items() if y == 1 and d in got]
    clean = [got[d]["predicted"] for d, y in labels.items() if y == 0 and d in got]
    assert len(toxic) > 50 and np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.01


def test_toxicity_reaches_examples_by_their_own_words(spark):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 2000, 30)) + (" vile foul" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]
    learned = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5][:6]
    # Toxic in words of their own, each once among the labels, and word for word again without a label.
    own = {d: " ".join(f"own{d}x{j}" for j in range(30)) for d in learned}
    plain = {d + 2000: " ".join(f"else{d}x{j}" for j in range(30)) for d in learned}
    texts = [r[:2] for r in rows] + list(own.items()) + [(d + 1000, t) for d, t in own.items()] + list(plain.items())
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(d, 1) for d in learned], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(spark.createDataFrame(texts, "doc_id long, text string"), labels).collect()}
    assert all(got[d + 1000]["predicted"] == 1 and got[d + 1000]["evidence"][0] == d for d in learned)
    assert not any(got[d]["predicted"] for d in plain)


def test_toxicity_keeps_examples_that_share_a_passage(spark):
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 2000, 30)) + (" vile foul" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]
    free = [i for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 5]
    passage = " ".join(f"licence{j}" for j in range(40))
    part = {d: f"{passage} " + " ".join(f"own{d}x{j}" for j in range(20)) for d in free[:5]}
    hot = {d: " ".join(f"hot{j}" for j in range(30)) for d in free[5:45]}
    texts = [r[:2] for r in rows] + [*part.items(), *hot.items(), (5000, hot[free[5]])]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(d, 1) for d in [*part, *hot]], "doc_id long, toxic int")
    df = spark.createDataFrame(texts, "doc_id long, text string")
    index = toxicity.learn(df, labels)
    assert set(part) <= set(index.ids.tolist()) and index.sizes.sum() == sum(bool(zlib.crc32(str(i).encode()) % 5) for i, _, _ in rows) + 45
    assert index.sizes[index.ids.tolist().index(free[5])] == 40 and not set(free[6:45]) & set(index.ids.tolist())
    assert [r["predicted"] for r in toxicity.toxicity(df, labels).where("doc_id = 5000").collect()] == [1]


def test_hash_forest(spark):
    rng = np.random.default_rng(6)
    data = rng.standard_normal((900, 16)).astype(np.float32)
    data[500:600] = data[20]
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [1.0] * 3), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = hash_forest.nearest(df, part_rows=300).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert sorted(by) == list(range(0, 900, 20))
    found = 0
    for q, near in by.items():
        scores = data.astype(np.float64) @ data[q].astype(np.float64)
        scores[q] = -np.inf
        want = np.lexsort((np.arange(900), -scores))[:20]
        assert len(near) == 20 and all(abs(s - scores[v]) < 1e-12 for v, s in near) and near == sorted(near, key=lambda x: (-x[1], x[0]))
        found += len({v for v, _ in near} & set(want.tolist()))
    assert found >= 0.9 * 20 * len(by)
    assert hash_forest.nearest(df.limit(0)).count() == 0
    clash = df.withColumns({"part": F.lit("x"), "block": F.lit(1), "size": F.lit(2), "rank": F.lit(3)})
    twice = clash.unionByName(clash.where("vec_id < 40"))
    same = {(r["query_id"], r["rank"], r["vec_id"]) for r in hash_forest.nearest(twice, part_rows=300).where("query_id < 40").collect()}
    assert len(same) == 40 and len({(q, v) for q, _, v in same}) == 40
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r["rank"], r["vec_id"]) for r in hash_forest.nearest(few).orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_hash_forest_beside_a_hot_vector(spark):
    rng = np.random.default_rng(7)
    groups = rng.standard_normal((40, 64))
    data = (groups[rng.integers(0, 40, 2000)] + 0.7 * rng.standard_normal((2000, 64))).astype(np.float32)
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    hot = np.sort(rng.choice(2000, 667, replace=False))
    data[hot] = data[hot[0]]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    by = {}
    for r in hash_forest.nearest(df).collect():
        by.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = {}
    for q in range(0, 2000, 20):
        scores = np.einsum("ij,j->i", data.astype(np.float64), data[q].astype(np.float64))
        scores[q] = -np.inf
        recall[q] = len(by[q] & set(np.lexsort((np.arange(2000), -scores))[:20].tolist())) / 20
    assert sorted(by) == sorted(recall) and all(recall[q] == 1 for q in recall if q in set(hot.tolist()))
    assert np.mean([x for q, x in recall.items() if q not in set(hot.tolist())]) >= 0.9


def test_sql_of_decontamination(spark):
    import duckdb

    from sievewright.llm import queries

    at, name = "/root/testdata/sf0.01", "op4_positional_index"
    df = queries.QUERIES[name](spark, at)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet'")
    cur = con.execute(queries.ORACLES[name])
    assert [c[0] for c in cur.description] == df.columns
    found = sorted(tuple(r) for r in df.collect())
    assert found == sorted(cur.fetchall()) and any(r[-1] for r in found)
