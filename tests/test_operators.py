import itertools
from collections import Counter
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievewright.functions import scalars
from sievewright.operators import matching, quantiles, quota, ranking, runs, sequences, similarity
from sievewright.sources import lines
from sievewright.streaming import ledger
from sievewright.streaming import runs as stream_runs


def by_hand(rooms, base, lo, hi):
    """The quota as a loop, one slot at a time."""
    slots = {r: min(base, a) for r, _, a in rooms}
    order = sorted(rooms, key=lambda x: (x[1], x[0]))
    while sum(slots.values()) < lo and any(slots[r] < a for r, _, a in rooms):
        for r, _, a in order:
            if sum(slots.values()) < lo and slots[r] < a:
                slots[r] += 1
    for p in sorted({p for _, p, _ in rooms}, reverse=True):
        band = sorted(r for r, q, _ in rooms if q == p)
        while sum(slots.values()) > hi and any(slots[r] > 1 for r in band):
            for r in band:
                if sum(slots.values()) > hi and slots[r] > 1:
                    slots[r] -= 1
    return slots


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 8)), min_size=1, max_size=6), st.integers(1, 4), st.integers(0, 20), st.integers(0, 12))
def test_quota_is_the_loop(spark, shape, base, lo, more):
    rooms = [(f"r{i}", p, a) for i, (p, a) in enumerate(shape)]
    got = quota.allocate(spark.createDataFrame(rooms, "room string, priority int, angles int"), base, lo, lo + more).collect()
    assert {r["room"]: r["slots"] for r in got} == by_hand(rooms, base, lo, lo + more)


def test_quota_reaches_the_lower_bound(spark):
    angles = {"a": 12, "b": 8, "c": 7, "d": 5, "e": 5, "f": 3, "g": 2, "h": 1, "i": 1, "j": 1, "k": 1, "l": 1, "m": 1}
    rooms = [(r, i, a) for i, (r, a) in enumerate(angles.items())]
    got = quota.allocate(spark.createDataFrame(rooms, "room string, priority int, angles int"), 3, 40, 60)
    assert got.agg(F.sum("slots")).first()[0] == min(40, sum(angles.values()))


def test_runs(spark):
    frames = [("k", 0.0, "a", 1.0), ("k", 2.0, "b", 2.0), ("k", 4.1, "c", 3.0), ("k", 4.2, "d", 3.0), ("k", 4.3, "e", None), ("k", 4.4, "f", None), ("k", None, "g", 1.0), ("k", None, "h", 1.0)]
    got = runs.bracket_runs(spark.createDataFrame(frames, "k string, at double, name string, value double"), "k", "at", "value", "name", 2.0).collect()
    assert {r["name"]: r["run"] for r in got} == {"a": 1, "b": 1, "c": 2, "d": 3, "e": 4, "f": 5, "g": 6, "h": 7}
    assert {r["name"] for r in got if r["committed"]} == {"a", "b"}


@pytest.mark.parametrize("values, committed", [((0.0, 0.49), False), ((0.0, 0.5), True), ((None, None), False), ((-1.0, 1.0), True)])
def test_runs_commit_or_dissolve(spark, values, committed):
    frames = [("k", float(i), f"n{i}", v) for i, v in enumerate(values)]
    got = runs.bracket_runs(spark.createDataFrame(frames, "k string, at double, name string, value double"), "k", "at", "value", "name", 2.0).collect()
    assert sorted((r["name"], r["run"], r["committed"]) for r in got) == [("n0", 1, committed), ("n1", 1 if committed else 2, committed)]


def test_run_length_limit(spark):
    frames = [("k", float(i) / 10, f"n{i:02d}", float(i)) for i in range(10)]
    got = runs.bracket_runs(spark.createDataFrame(frames, "k string, at double, name string, value double"), "k", "at", "value", "name", 2.0).collect()
    assert Counter(r["run"] for r in got) == {1: 9, 2: 1}


def test_gaps(spark):
    # The recorded range 7039 to 7470 with 28 present has 404 missing; its longest run is 403.
    present = [*range(7039, 7047), *range(7450, 7454), *range(7455, 7471)]
    row = sequences.sequence_gaps(spark.createDataFrame([("IMG_", n) for n in present], "g string, n int"), "g", "n").first()
    assert (row["present"], row["missing"], row["longest"], row["holes"], row["alarm"]) == (28, 404, 403, 2, True)


def test_stretches_join(spark):
    import random

    rng = random.Random(5)
    own = {g: sorted(rng.sample(range(-50, 400), n)) for g, n in (("a", 60), ("b", 1), ("c", 300))}
    df = spark.createDataFrame([(g, n) for g, ns in own.items() for n in ns * 2] + [("a", None)], "g string, n int")
    got = {(r["g"], r["n"]): r["next"] for r in sequences.followed(df, "g", "n", stretch=16).collect()}
    assert got == {(g, n): after for g, ns in own.items() for n, after in itertools.zip_longest(ns, ns[1:])}


@pytest.mark.parametrize("most", [3, 12, 14, 20])
def test_hamming(spark, most):
    import random

    rng = random.Random(3)
    base = rng.getrandbits(64)
    items = [(i, i % 2, base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 14)))) for i in range(40)]
    df = spark.createDataFrame([(i, b, v >> 32, v & (2**32 - 1)) for i, b, v in items], "id int, bucket int, high long, low long").unionByName(spark.createDataFrame([(99, 0, None, None)], "id int, bucket int, high long, low long"))
    links = similarity.hamming_links(df, "bucket", "id", "high", "low", most)
    want = {(a[0], b[0]) for a, b in itertools.combinations(items, 2) if a[1] == b[1] and (a[2] ^ b[2]).bit_count() <= most}
    assert {(r["a"], r["b"]) for r in links.collect()} == want
    root = {i: i for i, *_ in items} | {99: 99}
    for _ in items:
        for a, b in want:
            root[a] = root[b] = min(root[a], root[b])
    assert {r["id"]: r["class"] for r in similarity.classes(df, "id", links).collect()} == root


def test_dedupe_keeps_the_plain_name(spark):
    files = spark.createDataFrame([("IMG_2918 (1).HEIC", 5, "x"), ("IMG_2918.HEIC", 5, "x"), ("b", 5, "y"), ("c", 6, "x")], "name string, size int, body string")
    copy = F.col("name").rlike(r" \(\d+\)")
    got = similarity.dedupe(files, "size", F.sha2("body", 256), [copy, F.length("name"), "name"], "name").collect()
    assert {r["name"]: r["kept_as"] for r in got} == {"IMG_2918 (1).HEIC": "IMG_2918.HEIC", "IMG_2918.HEIC": "IMG_2918.HEIC", "b": "b", "c": "c"}


def test_keywords(spark):
    words = [("sala", "SALA"), ("sala de jantar", "JANTAR"), ("suite", "SUITE")]
    df = spark.createDataFrame([(1, "sala de jantar"), (2, "suite e sala"), (3, "x"), (4, None)], "id int, label string")
    assert {r["id"]: r["slug"] for r in matching.keyword_of(df, "id", F.col("label"), words).collect()} == {1: "JANTAR", 2: "SUITE", 3: None, 4: None}


def by_heats(items, slots, size):
    """A contest as a loop: items (key, seed, score)."""
    left = sorted(items, key=lambda x: (x[1], x[0]))
    best = lambda heat: sorted(heat, key=lambda x: (-x[2], x[0]))[:slots]
    while len(left) > size:
        n = -(-len(left) // size)
        kept = [x for i in range(n) for x in best(left[i::n])]
        if len(kept) >= len(left):
            break
        left = sorted(kept, key=lambda x: (x[1], x[0]))
    return [x[0] for x in best(left[:size])]


@pytest.mark.parametrize("slots", [1, 3, 12])
def test_tournament_is_the_loop(spark, slots):
    import random

    rng = random.Random(slots)
    rooms = {r: [(i, rng.randrange(9), float(rng.randrange(20))) for i in range(n)] for r, n in (("a", 50), ("b", 12), ("c", 3), ("d", 160))}
    df = spark.createDataFrame([(r, *x) for r, own in rooms.items() for x in own], "room string, id int, seed int, score double")
    got = quota.tournament(df, "room", slots, 12, ["seed", "id"], [F.desc("score"), "id"]).orderBy("room", "rank").collect()
    for r, own in rooms.items():
        assert [x["id"] for x in got if x["room"] == r] == by_heats(own, slots, 12)


def test_names(spark):
    df = spark.createDataFrame([("SALA", 1, 7), ("SALA", 100, 7)], "k string, r int, n int").select(ranking.composed_name(F.col("k"), F.col("r"), F.col("n")).alias("name"))
    assert [r[0] for r in df.collect()] == ["SALA_01_0007", None]
    assert tuple(df.select(*ranking.parsed_name(F.col("name"))).first()) == ("SALA", 1, 7)


def test_lines(spark):
    df = spark.createDataFrame([("+A_1 # good variant=warm  glow=off one",), ("B_2 # redo",), ("C_3",), ("D # sumiu, Variant=Warm. refazer glow=on-soft",), ("# only",), ("",)], "value string")
    got = [tuple(r) for r in df.select(*(c.alias(n) for n, c in lines.decisions(F.col("value")).items())).collect()]
    assert got == [("A_1", False, "good one", "warm", "off"), ("B_2", True, "redo", None, None), ("C_3", True, "", None, None), ("D", True, "sumiu, refazer", "warm", "on-soft"), (None, None, "only", None, None), (None, None, "", None, None)]
    rows = spark.createDataFrame([("| a | b |",), ("|---|---|",), ("| c |",), ("x",)], "value string")
    assert [r["cells"] for r in lines.table_rows(rows, 2).collect()] == [["a", "b"]]
    kinds = spark.createDataFrame([("x/a.JPG",), ("x/b.cr2",), ("__MACOSX/._b.zip",), ("n",), ("x.nrw",), ("a.xmp",), ("b.HEIF",)], "path string").select(lines.file_kind(F.col("path")), lines.is_junk(F.col("path")))
    assert [tuple(r) for r in kinds.collect()] == [("image", False), ("raw", False), ("archive", True), ("other", False), ("raw", False), ("other", True), ("image", False)]
    pick = lines.picks(spark.createDataFrame([("a+b # note",), ("# only",), ("c",)], "value string")).collect()
    assert [(r["frames"], r["note"]) for r in pick] == [(["a", "b"], "note"), (["c"], None)]


def test_scalars(spark):
    row = spark.range(1).select(scalars.luminance(F.lit(255), F.lit(255), F.lit(255)), scalars.contrast(F.lit(1.0), F.lit(0.0)), *(F.bit_count(h) for h in scalars.hash_halves(F.lit("ff00000000000001"))), scalars.clamped_score(F.lit("12.7")), scalars.clamped_score(F.lit("x")), scalars.human_bytes(F.lit(2048))).first()
    assert row[0] == pytest.approx(1.0) and row[1] == pytest.approx(21.0) and tuple(row[2:]) == (8, 1, 10, None, "2.0 KB")


def test_stream_matches_batch(spark, tmp_path):
    rows = [(i, datetime(2024, 1, 1, i % 24), "run" if i % 3 else "gate") for i in range(100)]
    events = spark.createDataFrame(rows, "id int, ts timestamp, kind string")
    events.write.parquet(str(tmp_path / "in"))
    stream = ledger.event_counts(ledger.landing(spark, str(tmp_path / "in"), events.schema), "ts", "kind")
    run = stream.writeStream.outputMode("complete").format("memory").queryName("counts").start()
    run.processAllAvailable()
    run.stop()
    got = {tuple(r) for r in spark.table("counts").collect()}
    assert got == {tuple(r) for r in ledger.event_counts(events, "ts", "kind").collect()} and sum(r[2] for r in got) == 100
