"""Prefix tries, entropy secrets and Drake's bounds against brute force and SQL, with the edge cases of their docstrings."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.llm import drake, entropy_secrets, prefix_trie

DIR = "/root/testdata/sf0.01"


def against_sql(spark, module, tables):
    got = module.query(spark, DIR)
    order = sorted(got.columns)
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    cur = con.execute(module.ORACLE_SQL)
    names = [c[0] for c in cur.description]
    assert sorted(names) == order
    assert sorted((tuple(r[c] for c in order) for r in got.collect()), key=str) == sorted((tuple(v[names.index(c)] for c in order) for v in cur.fetchall()), key=str)


@pytest.mark.parametrize("module, tables", [(prefix_trie, ["conversations"]), (entropy_secrets, ["documents"]), (drake, ["embeddings"])])
def test_against_sql(spark, module, tables):
    against_sql(spark, module, tables)


# ----------------------------------------------------------------- prefix trie

TURNS = "conv_id long, turn long, role string, text string, depth int, digest string"


def trie_by_hand(rows):
    """conv_id -> its rebuilt turns, then all nodes."""
    convs = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[c].append(((t is not None, t or 0), digest, role, text))
    convs = {c: [x[2:] for x in sorted(turns, key=lambda x: x[:2])] for c, turns in convs.items()}
    whole = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = convs.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    nodes = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    out = set()
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        saved = sum((len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes) for p in below)
        ends = sorted(c for c in members if len(whole[c]) == len(path))
        children = sum(len(p) == len(path) + 1 for p in below)
        parent = min(nodes[path[:-1]]) if path else None
        out.add((min(members), len(path), parent, len(members), children, leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def trie(spark, rows):
    turns = prefix_trie.digested(spark.createDataFrame(rows, TURNS).repartition(3))
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(turns)).collect()
    found = [tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in got]
    assert len(found) == len(set(found))
    return set(found)


def test_trie_of_odd_rows(spark):
    rows = [(0, 0, "user", "hello there"), (0, 1, "assistant", "general\tkenobi"), (0, 2, "user", "x"), (0, 3, None, None), (7, 0, "user", "own words"), (7, None, "user", "first"), (7, 1, "user", "more"), (7, 1, "user", "more"),
            (25, 0, "user", "no base"), (26, 3, "user", None), (-3, 0, "user", "below zero"), (-3, 1, "ab", "c"), (-4, 1, "a", "bc"), (None, 0, "user", "lost"), (40, 0, "", ""), (41, 5, "user", "  two words "), (43, 0, "user", "  two words ")]
    rows += [(100 + i, t, "user", f"same {t}") for i in range(12) for t in range(6)]
    rows += [(200, t, "user", f"turn {t}" if t < 290 else "end") for t in range(300)]
    rows = [(*r, 1, "d") for r in rows]
    assert trie(spark, rows) == trie_by_hand(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_of_random_rows(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(c), int(t), rng.choice(["u", "a", None]), rng.choice(["x", "y z", "", None]), 0, "") for c in rng.integers(-30, 90, 60) for t in range(int(rng.integers(1, 6)))]
    assert trie(spark, rows) == trie_by_hand(rows)


def test_trie_of_nothing(spark):
    assert trie(spark, []) == set()


def test_ends_run_over_chunks(spark, monkeypatch):
    rows = [(i * 20, 0, "u", "t", 0, "") for i in range(40)]
    want = trie_by_hand(rows)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    joined = list(prefix_trie._joined(iter([])))
    assert joined == []
    assert trie(spark, rows) == want


# --------------------------------------------------------------------- secrets

TOKEN = "a8Zk3/9qLw0Xv+7TmR2bN5cYp1Hd6sGf"
TEXTS = [
    None, "", "nothing to see", 'password = "hunter2hunter2"', "PassWord:short", "secret=abc.def-ghi_jkl=", "token=token:abcdefgh12", "apikey: aB3dE5fG7hI9 api_KEY='zzzzzzzz'", "x AKIAABCDEFGHIJKL y AKIAAAAA z AKIAAKIAAKIAAKIA1",
    "deadbeefdeadbeefdeadbeefdeadbeef 0123456789abcdef0123456789abcde", f"key {TOKEN} and {TOKEN}{TOKEN}", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "550e8400-e29b-41d4-a716-446655440000",
    "a/very/long/path/of/many/words/that/is/no/secret/at/all", "日本 token = \"9f86d081884c7d659a2feaa0c55ad015\" ñ", "f" * 40, f"é{TOKEN}é", f"{TOKEN}EXAMPLE", "--------------------------------------------", "12345678901234567890123456",
    "kelvin toKen = abcdefghij ſecret=abcdefghij", "".join(f"{TOKEN} filler " for _ in range(300)), "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" * 40, ("a" * 30 + TOKEN) * 5]


def spans_by_hand(text):
    """All spans by plain loops: counts are made anew for each window."""
    text, out = text or "", []
    assign = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for place, (kind, pattern, good) in enumerate([("assign", assign, lambda m: len(m[1]) >= 8), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32)]):
        out += [(m.start(), place, kind, m.end()) for m in pattern.finditer(text) if good(m)]
    for place, c in enumerate(entropy_secrets.CLASSES):
        for m in re.finditer(c.run, text):
            run, covered = m[0], []
            if any(re.sub(p, "", run) == "" for p in entropy_secrets.ALLOWED) or any(run in s for s in entropy_secrets.ORDERED):
                continue
            for i in range(len(run) - c.window + 1):
                counts = Counter(run[i : i + c.window])
                h = -sum(n / c.window * math.log2(n / c.window) for n in counts.values())
                if h >= c.bits - 1e-9:
                    if covered and i <= covered[-1][1]:
                        covered[-1][1] = i + c.window
                    else:
                        covered.append([i, i + c.window])
            out += [(m.start() + a, 3 + place, c.kind, m.start() + b) for a, b in covered]
    return [(k, s, e) for s, _, k, e in sorted(out)]


def test_secrets(spark):
    docs = spark.createDataFrame([(i, t, "s", "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "s", "x"), (None, TEXTS[10], None, None)], "doc_id long, text string, secrets string, start string").repartition(3)
    got = entropy_secrets.find_secrets(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        assert [(s["kind"], s["start"], s["end"]) for s in r["secrets"]] == spans_by_hand(r["text"]), r["text"]
    kinds = Counter(s["kind"] for r in got for s in r["secrets"])
    assert set(kinds) == {"assign", "access", "hex", "entropy16", "entropy64"}
    clean = {r["text"] for r in got if not r["secrets"]}
    assert {TEXTS[i] for i in (2, 4, 6, 11, 12, 13, 17, 18, 19)} <= clean
    assert entropy_secrets.find_secrets(docs.limit(0)).count() == 0
    plan = entropy_secrets.find_secrets(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("seed", range(2))
def test_secrets_of_random_runs(spark, seed):
    rng = np.random.default_rng(seed)
    letters = list("abcdef0123456789ABCxyzXYZ+/_-= \n")
    texts = ["".join(rng.choice(letters, int(rng.integers(0, 500)), p=rng.dirichlet(np.full(len(letters), 4.0)))) for _ in range(60)]
    got = entropy_secrets.find_secrets(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert sum(len(r["secrets"]) for r in got) > 20
    for r in got:
        assert [(s["kind"], s["start"], s["end"]) for s in r["secrets"]] == spans_by_hand(r["text"])


# -------------------------------------------------------------------- clusters


def clusters_by_hand(rows, k, rounds, dimension, scale):
    keep = [(i, [math.floor(float(np.float32(x)) * scale) for x in v]) for i, v in rows if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(keep, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in first]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((far(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in keep]
        for j in range(len(centroids)):
            own = [v for a, (_, v) in zip(at, keep) if a == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    last = [(i, *nearest(v)) for i, v in keep]
    inertia = Counter()
    for _, d, j in last:
        inertia[j] += d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, d, j in last), key=str)


VECTORS = "vec_id long, embedding array<float>, cluster int, was string"


@pytest.mark.parametrize("seed, k, rounds, spread", [(1, 16, 3, 1.0), (2, 16, 8, 0.05), (3, 5, 4, 300.0), (4, 1, 2, 1.0), (5, 9, 12, 1.0)])
def test_clusters(spark, seed, k, rounds, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8)) * 4
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * spread).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [(7, rows[7][1]), (None, rows[9][1]), (2000, None), (2001, [1.0]), (2002, [math.nan] + [0.0] * 7), (2003, [None] + [0.0] * 7), (2004, [0.0] * 8), (2005, [math.inf] + [0.0] * 7)]
    got = drake.clustered(spark.createDataFrame([(i, v, 3, "w") for i, v in rows], VECTORS).repartition(4), k, rounds, 8, 64)
    assert sorted((tuple(r) for r in got.collect()), key=str) == clusters_by_hand(rows, k, rounds, 8, 64)


def test_few_and_no_vectors(spark):
    rows = [(i, [float(i), 0.0]) for i in range(3)]
    got = drake.clustered(spark.createDataFrame([(i, v, 3, "w") for i, v in rows], VECTORS), 16, 3, 2, 64)
    assert sorted((tuple(r) for r in got.collect()), key=str) == clusters_by_hand(rows, 16, 3, 2, 64)
    assert drake.clustered(spark.createDataFrame([], VECTORS)).collect() == []
    assert drake.clustered(spark.createDataFrame([(1, [1e30, 0.0], 1, "")], VECTORS), dimension=2).collect() == []


def test_bounds_hold_and_spare_work():
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(c * 40, 6, size=(200, 8)) for c in range(8)]).astype(np.int64)
    c = v[:: len(v) // 16][:16].copy()
    know = drake.Bounds(len(v), 4)
    know.scan(np.arange(len(v)), v, c)
    spared = 0
    for _ in range(6):
        new = np.array([v[know.cluster == j].sum(0) // max(1, (know.cluster == j).sum()) if (know.cluster == j).any() else c[j] for j in range(16)])
        know.move(np.sqrt(((new - c) ** 2).sum(1)) * (1 + drake.SLACK))
        c = new
        true = np.sqrt(drake._distances(v, c).astype(float))
        rows = np.arange(len(v))
        assert (know.upper >= true[rows, know.cluster]).all() and (know.low <= true[rows[:, None], know.near]).all()
        others = true.copy()
        others[rows, know.cluster] = np.inf
        np.put_along_axis(others, know.near, np.inf, 1)
        assert (know.rest <= others.min(1)).all()
        know.settle(v, c, False)
        spared += int((know.needed == 0).sum())
        d = drake._distances(v, c)
        assert (know.cluster == d.argmin(1)).all()
    assert spared > 3 * len(v)


def test_exact_in_doubles_and_in_integers():
    rng = np.random.default_rng(6)
    for most in (100, 2**26):
        v, c = rng.integers(-most, most, (50, 64)), rng.integers(-most, most, (5, 64))
        assert (drake._distances(v, c) == [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in c] for x in v]).all()
