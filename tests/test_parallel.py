"""Runs, quantiles, Hamming links, matched names and contests against plain loops."""

import json
import statistics
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone
from pathlib import PurePosixPath

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright import stages
from sievewright.operators import contest, gates, quantiles, runs, similarity
from sievewright.streaming import runs as stream

FRAMES = "k string, at double, name string, value double, run string"


def folded(frames, gap, most, spread):
    """(key, name) -> (run, committed) by one pass over sorted frames."""
    keys, out = defaultdict(list), {}
    for f in frames:
        keys[f[0]].append(f)
    for key, own in keys.items():
        n, run = 0, []

        def flush():
            nonlocal n
            values = [f[3] for f in run]
            held = len(run) > 1 and None not in values and max(values) - min(values) >= spread
            for i, f in enumerate(run):
                n += not held or i == 0
                out[key, f[2]] = (n, held)

        for f in sorted(own, key=lambda f: (f[1] is None, f[1] or 0.0, f[2])):
            more = run and f[1] is not None and run[-1][1] is not None and f[1] - run[-1][1] <= gap and len(run) < most and (f[3] is None or f[3] not in [x[3] for x in run])
            if not more:
                flush()
                run = []
            run.append(f)
        flush()
    return out


def random_frames(rng, n):
    return [(str(rng.choice(["a", "b", "c"])), None if rng.random() < 0.05 else float(rng.integers(0, n)), f"n{i:05d}", None if rng.random() < 0.1 else float(rng.integers(0, 7)), "x") for i in range(n)]


@pytest.mark.parametrize("seed, n, stretch, fan", [(1, 300, 9, 2), (2, 500, 16, 3), (3, 40, 1 << 16, 4096), (4, 300, 11, 7)])
def test_runs_in_stretches(spark, seed, n, stretch, fan):
    frames = random_frames(np.random.default_rng(seed), n)
    got = runs.bracket_runs(spark.createDataFrame(frames, FRAMES).repartition(5), "k", "at", "value", "name", 2.0, spread=1.0, stretch=stretch, fan=fan).collect()
    assert len(got) == n
    assert {(r["k"], r["name"]): (r["run"], r["committed"]) for r in got} == folded(frames, 2.0, 9, 1.0)


def test_runs_of_copies_null_keys_and_nothing(spark):
    frames = [(None, 1.0, "n", 1.0, "x")] * 30 + [(None, 1.0, "o", 2.0, "x")]
    got = runs.bracket_runs(spark.createDataFrame(frames, FRAMES).repartition(3), "k", "at", "value", "name", 2.0, stretch=9, fan=2).collect()
    assert Counter(r["committed"] for r in got) == {False: 29, True: 2} and sorted({r["run"] for r in got}) == list(range(1, 31))
    assert runs.bracket_runs(spark.createDataFrame([], FRAMES), "k", "at", "value", "name", 2.0).collect() == []
    with pytest.raises(ValueError):
        runs.bracket_runs(spark.createDataFrame([], FRAMES), "k", "at", "value", "name", 2.0, stretch=3)


def test_one_burst_is_spread(spark):
    # One key and one burst: every frame within the gap of the last. Runs are of nine, as values never repeat.
    frames = spark.range(200_000).selectExpr("'k' as k", "id / 10.0 as at", "lpad(id, 8, '0') as name", "double(id) as value")
    got = runs.bracket_runs(frames, "k", "at", "value", "name", 2.0, stretch=4096)
    assert got.agg(F.max("run"), F.count_if("committed"), F.count("*")).first()[:] == (-(-200_000 // 9), 200_000, 200_000)
    assert got.where("run <> floor(int(name) / 9) + 1").isEmpty()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    assert got.groupBy(F.spark_partition_id()).count().count() > 1
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan


START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_gives_the_rows_of_the_batch(spark, tmp_path, seed):
    rng = np.random.default_rng(seed)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    frames = sorted(((str(rng.choice(["a", "b"])), float(rng.integers(0, 300)) / 2, f"n{i:03d}", None if rng.random() < 0.1 else float(rng.integers(0, 5))) for i in range(150)), key=lambda f: f[1])
    # Frames arrive out of order by at most 20 seconds; the last moves the watermark beyond all others.
    arrival = sorted(frames, key=lambda f: f[1] + rng.uniform(0, 20)) + [("end", 1000.0, "end", 1.0), ("end", 2000.0, "end", 2.0)]
    schema = "k string, at timestamp, name string, value double"
    put = lambda i, rows: spark.createDataFrame([(k, START + timedelta(seconds=at), n, v) for k, at, n, v in rows], schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{i:03d}"))
    for i in range(0, len(arrival), 20):
        put(i, arrival[i : i + 20])
    put(900, [("a", 3.0, "late", 9.0)])
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    out = stream.bracket_stream(source, "k", "at", "value", "name", 2.0, "25 seconds", spread=1.0)
    query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "out")).select("k", "name", "run_name", "run_at", "committed").where("k <> 'end'").collect()
    want = folded([(*f, "x") for f in frames], 2.0, 9, 1.0)
    first = {}
    for f in frames:
        first.setdefault((f[0], want[f[0], f[2]][0]), f[2])
    at = {(f[0], f[2]): f[1] for f in frames}
    for k, n in list(first):
        same = [f for f in frames if f[0] == k and want[k, f[2]][0] == n]
        first[k, n] = min(same, key=lambda f: (f[1], f[2]))[2]
    assert {(r["k"], r["name"]): (r["run_name"], r["committed"]) for r in got} == {key: (first[key[0], n], held) for key, (n, held) in want.items()}
    assert len(got) == len(frames) and stream.late(query) == 1
    assert all(r["run_at"].replace(tzinfo=None) is not None and at[r["k"], r["run_name"]] >= 0 for r in got)
    # Only what came last is still open.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 6


@pytest.mark.parametrize("small", [4, 1 << 16])
def test_quantiles(spark, monkeypatch, small):
    monkeypatch.setattr(quantiles, "SMALL", small)
    rng = np.random.default_rng(3)
    rows = [(str(rng.choice(["a", "b", None])) if rng.random() < 0.9 else None, float(rng.normal() * 10.0 ** rng.integers(-5, 9)), int(rng.integers(-50, 50))) for _ in range(500)]
    rows += [("hot", 1.5, 7)] * 400 + [("hot", -0.0, 8), ("hot", 0.0, 9), ("one", -3.25, -1), ("none", None, None), ("end", float("inf"), 2**62), ("end", float("-inf"), -(2**62))]
    df = spark.createDataFrame(rows, "g string, x double, n long").repartition(4)
    for value, at in (("x", 1), ("n", 2)):
        got = {r["g"]: (r["low"], r["mid"], r["p9"], r["top"]) for r in quantiles.quantiles(df, ["g"], value, {"low": 0.0, "mid": 0.5, "p9": 0.9, "top": 1.0}).collect()}
        groups = defaultdict(list)
        for r in rows:
            if r[at] is not None:
                groups[r[0]].append(float(r[at]))
        assert set(got) == set(groups)
        for g, values in groups.items():
            if g == "end":
                assert got[g][0] == min(values) and got[g][3] == max(values)
                continue
            assert got[g] == pytest.approx((min(values), statistics.median(values), float(np.quantile(values, 0.9)), max(values)), rel=1e-9, abs=1e-12)
    assert quantiles.quantiles(df.limit(0), ["g"], "x", {"m": 0.5}).collect() == []
    with pytest.raises(TypeError):
        quantiles.quantiles(df, ["x"], "g", {"m": 0.5})


def test_quantiles_of_a_hot_group(spark):
    df = spark.range(300_000).selectExpr("'g' as g", "double(id) / 7 as x", "timestamp_micros(id * 1000000) as t")
    assert quantiles.quantiles(df, ["g"], "x", {"m": 0.5}).first()["m"] == pytest.approx(299_999 / 14)
    assert quantiles.quantiles(df, ["g"], "t", {"m": 0.5}).first()["m"] == pytest.approx(149_999.5)


HASHES = "name long, bucket string, high long, low long, node string"


def pairs_by_hand(items, most):
    out = {}
    for i, (a, g, h, l, _) in enumerate(items):
        for b, g2, h2, l2, _ in items[i + 1 :]:
            if g == g2 and g is not None and None not in (h, l, h2, l2) and (d := bin((h << 32 | l) ^ (h2 << 32 | l2)).count("1")) <= most:
                out[min(a, b), max(a, b)] = d
    return out


@pytest.mark.parametrize("most", [0, 3, 12, 14, 20, 30])
def test_hamming_links_and_classes(spark, most):
    rng = np.random.default_rng(most)
    centres = rng.integers(0, 2**32, (6, 2))
    items = []
    for i in range(150):
        h, l = (int(x) for x in centres[i % 6])
        for bit in rng.integers(0, 64, int(rng.integers(0, 12))).tolist() if i % 3 else []:
            h, l = (h ^ (1 << (bit - 32)), l) if bit >= 32 else (h, l ^ (1 << bit))
        items.append((i, str(rng.choice(["p", "q"])), h, l, "x"))
    items += [(500, None, 1, 1, "x"), (501, "p", None, 1, "x")]
    df = spark.createDataFrame(items, HASHES).repartition(3)
    want = pairs_by_hand(items, most)
    links = similarity.hamming_links(df, "bucket", "name", "high", "low", most, block=16)
    got = links.collect()
    assert len(got) == len(want) and {(r["a"], r["b"]): r["distance"] for r in got} == want
    root = {i[0]: i[0] for i in items}
    for a, b in sorted(want):
        x, y = root[a], root[b]
        root = {k: min(x, y) if v in (x, y) else v for k, v in root.items()}
    spanning = similarity.hamming_links(df, "bucket", "name", "high", "low", most, spanning=True, block=16)
    for some in (links, spanning):
        assert {r["name"]: r["class"] for r in similarity.classes(df, "name", some).collect()} == root


def test_equal_hashes_have_few_links(spark):
    df = spark.range(100_000).selectExpr("id as name", "'b' as bucket", "7L as high", "id % 2 as low")
    assert similarity.hamming_links(df, "bucket", "name", "high", "low", 12, spanning=True).count() == 99_999
    near = spark.range(6000).selectExpr("id as name", "'b' as bucket", "0L as high", "id as low")
    assert similarity.hamming_links(near, "bucket", "name", "high", "low", 20, spanning=True, block=512).count() < 2 * 6000 * 12


def test_rows_meet_few_by_salt(spark, monkeypatch):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(["a", None, "b", "a", "c"] * 20)], "k string, i int")
    few = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    for limit in (50_000, 1):
        monkeypatch.setattr(stages, "BROADCAST_ROWS", limit)
        got = stages.joined(rows, few, ["k"], "left")
        assert Counter((r["k"], r["v"]) for r in got.collect()) == {("a", 1): 40, (None, 2): 20, ("b", None): 20, ("c", None): 20}
        assert got.columns == ["k", "i", "v"]


# --------------------------------------------------------------------- matched


def match_by_hand(claimed, offered):
    """The rule in plain words: whole, base name, a stem that only one has, a prefix that only one has."""
    own = {o.casefold().strip(): o for o in sorted(offered, reverse=True)}
    stem = lambda n: PurePosixPath(n).stem
    base = claimed.rpartition("/")[2].casefold().strip()
    for key in (claimed.casefold().strip(), base):
        if key in own:
            return own[key]
    for hits in ([o for o in own.values() if stem(o).casefold() == stem(claimed).casefold()], [o for k, o in own.items() if k.startswith(base[: max(8, len(base) - 4)])]):
        if len(hits) == 1:
            return hits[0]
    return None


@pytest.mark.parametrize("constant", [False, True])
def test_names_that_begin_alike(spark, constant):
    rng = np.random.default_rng(1)
    offered = sorted({f"IMG_2024{int(rng.integers(0, 400)):04d}{'ab'[i % 2]}.{['jpg', 'heic', 'JPG'][i % 3]}" for i in range(150)} | {"short.jpg", "Área.jpg"})
    claims = sorted({o[: int(rng.integers(6, len(o) + 1))] for o in offered} | {o.swapcase() for o in offered} | {"x/" + o for o in offered} | {"nobody.jpg", "", "área.png"})
    group = F.lit(1) if constant else F.col("g")
    left = spark.createDataFrame([(1, c) for c in claims], "g int, claim string").select(group.alias("g"), "claim")
    right = spark.createDataFrame([(1, o) for o in offered + offered[:5]] + [(2, "other.jpg")][: 0 if constant else 1], "g int, name string").select(group.alias("g"), "name")
    got = gates.matched(left, right, "g", "claim", "name").collect()
    assert {r["claim"]: r["match"] for r in got} == {c: match_by_hand(c, offered) for c in claims} and len(got) == len(claims)


def test_a_constant_group_over_a_range(spark):
    names = spark.range(20).select(F.lit(1).alias("g"), F.format_string("IMG_%04d.jpg", "id").alias("name"))
    got = gates.matched(names.withColumnRenamed("name", "claim"), names, "g", "claim", "name")
    assert got.where("claim = match").count() == 20


# --------------------------------------------------------------------- contest


def scripted():
    """Made here, so that tasks get it by value."""

    def script(room, slots, items):
        """Best score first, in odd spelling; turns down the rest; some heats and rooms fail, some answers are of no use."""
        if room == "down":
            raise TimeoutError("no answer")
        if room == "mute" and len(items) == 12:
            return "I can't say"
        ranked = sorted(items, key=lambda x: (-x["score"], x["file"]))
        if room == "stuck" and len(items) == 12:
            picks = []
        else:
            picks = [{"file": x["file"].upper(), "reason": f" {room} {x['score']} ", "purpose": 11, "staging": "x"} for x in ranked[:slots]] + [{"file": "nobody.jpg"}, {"file": ranked[0]["file"]}]
        # One that is turned down as well as picked.
        down = [{"file": x["file"], "why": f"of {len(items)}"} for x in ranked[slots:] + ranked[:1]]
        return "Sure: " + json.dumps({"picks": picks, "rejected": down, "nao_pertence": [{"file": x["file"], "why": "elsewhere"} for x in ranked if x["score"] % 5 == 0]})

    return script


script = scripted()


def contest_by_hand(rooms, slots, size=12):
    picks, rejected, foreign, calls, errors = {}, {}, {}, Counter(), {}
    for room, items in rooms.items():
        if not items or slots.get(room, 0) <= 0:
            continue
        seed = lambda x: (x["flags"], -x["score"], x["file"])
        left = sorted(items, key=seed)

        def call(heat):
            calls[room] += 1
            try:
                answer = script(room, min(slots[room], len(heat)), heat)
                data = json.loads(answer[answer.index("{") : answer.rindex("}") + 1])
            except (TimeoutError, ValueError) as e:
                errors.setdefault(room, type(e).__name__)
                return []
            names = {x["file"].casefold(): x["file"] for x in heat}
            out = []
            for p in data["picks"]:
                if (f := names.get(p["file"].casefold())) and f not in out:
                    out.append(f)
            for r in data["rejected"]:
                rejected.setdefault((room, r["file"]), r["why"])
            for r in data["nao_pertence"]:
                foreign.setdefault((room, r["file"]), r["why"])
            return out[: slots[room]]

        while len(left) > size:
            ranked = sorted(left, key=seed)
            n = -(-len(ranked) // size)
            went = [f for i in range(n) for f in call(ranked[i::n])]
            if room in errors:
                break
            if not went or len(went) >= len(left):
                break
            by = {x["file"]: x for x in left}
            left = [by[f] for f in went]
        if room not in errors:
            for rank, f in enumerate(call(left[:size]), 1):
                picks[room, f] = rank
    return picks, {k: v for k, v in rejected.items() if k not in picks}, foreign, calls, errors


def test_contest(spark):
    rng = np.random.default_rng(8)
    sizes = {"small": 5, "twelve": 12, "large": 100, "huge": 400, "down": 30, "mute": 36, "stuck": 48, "empty": 0, "closed": 20, "greedy": 30}
    slots = {"small": 3, "twelve": 4, "large": 4, "huge": 3, "down": 3, "mute": 3, "stuck": 3, "closed": 0, "greedy": 12}
    rooms = {r: [{"file": f"{r}-{i:04d}.jpg", "flags": int(rng.integers(0, 3)), "score": int(rng.integers(0, 1000))} for i in range(n)] for r, n in sizes.items()}
    items = spark.createDataFrame([(r, x["file"], x["flags"], x["score"]) for r, some in rooms.items() for x in some + some[:2]], "room string, file string, flags int, score int").repartition(3)
    got = contest.contest(items, spark.createDataFrame(list(slots.items()), "room string, slots int"), ["flags", F.desc("score"), "file"], script)
    picks, rejected, foreign, calls, errors = contest_by_hand(rooms, slots)
    assert {(r["room"], r["file"]): r["rank"] for r in got.picks.collect()} == picks
    assert {(r["room"], r["file"]): r["why"] for r in got.rejected.collect()} == rejected
    assert {(r["room"], r["file"]): r["why"] for r in got.not_room.collect()} == foreign
    told = got.rooms.collect()
    assert {r["room"]: r["calls"] for r in told} == calls
    assert {r["room"] for r in told if r["error"]} == set(errors) == {"down", "mute"}
    assert {r["claim"] for r in got.unmatched.collect()} == {"nobody.jpg"}
    one = got.picks.where("room = 'small' and rank = 1").first()
    assert one["reason"].startswith("small ") and one["purpose"] == 10 and one["staging"] is None


def test_contest_of_nobody(spark):
    items = spark.createDataFrame([], "room string, file string, flags int, score int")
    got = contest.contest(items, spark.createDataFrame([("a", 1)], "room string, slots int"), ["file"], script)
    assert [df.count() for df in (got.picks, got.rejected, got.not_room, got.unmatched, got.rooms)] == [0] * 5


def test_a_heat_is_asked_once_more(spark, tmp_path):
    log, script = str(tmp_path), scripted()

    def flaky(room, slots, items):
        import os
        import uuid

        key = f"{room}-{len(items)}"
        before = len([f for f in os.listdir(log) if f.startswith(key + ".")])
        open(f"{log}/{key}.{uuid.uuid4().hex}", "w").close()
        if not before:
            raise ConnectionError("lost")
        return script(room, slots, items)

    items = spark.createDataFrame([("r", f"f{i}.jpg", 0, i) for i in range(8)], "room string, file string, flags int, score int")
    got = contest.contest(items, spark.createDataFrame([("r", 2)], "room string, slots int"), ["file"], flaky)
    assert got.picks.count() == 2 and got.rooms.first()["error"] is None
    assert got.rejected.count() == 6 and len(list(tmp_path.iterdir())) == 2
