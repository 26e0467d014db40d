"""Incremental runs, prompt blocks, logs, stamps, lists of flags, and items without a test of their own."""

import shutil

import pytest
from pyspark.sql import functions as F

from sievewright.functions import names, scalars
from sievewright.operators import answers, gates, profiles, ranking, rooms
from sievewright.sinks import tables
from sievewright.sources import lines
from sievewright.streaming import incremental


def put(spark, path, i, rows):
    spark.createDataFrame(rows, "path string, changed long, size long").coalesce(1).write.parquet(f"{path}/in/{i:03d}")


def run(spark, path, checkpoint="state", step=None, key=("path", "changed")):
    items = spark.readStream.schema("path string, changed long, size long").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    step = step or (lambda df: df.withColumn("made", F.concat("path", F.lit(".out"))))
    query = incremental.incremental(items, list(key), step, f"{path}/out", f"{path}/{checkpoint}")
    query.awaitTermination(120)
    return query


def test_incremental_runs(spark, tmp_path):
    at = str(tmp_path)
    assert incremental.done(spark, f"{at}/out") is None
    put(spark, at, 0, [("a", 1, 5), ("b", 1, 5), ("a", 1, 5), (None, 1, 5)])
    put(spark, at, 1, [("b", 1, 5), ("c", 1, 5)])
    run(spark, at)
    assert rows_of(spark, at) == sorted([("a", 1), ("b", 1), ("c", 1), (None, 1)], key=str)
    assert incremental.done(spark, f"{at}/out").where("made = 'a.out'").count() == 1


def rows_of(spark, at):
    return sorted(((r["path"], r["changed"]) for r in incremental.done(spark, f"{at}/out").collect()), key=str)


def test_a_batch_that_fails_and_is_repeated(spark, tmp_path):
    at = str(tmp_path)
    for i, some in enumerate(["ab", "cd", "ae"]):
        put(spark, at, i, [(x, 1, 5) for x in some])
    calls = {"n": 0}

    def step(df):
        calls["n"] += 1
        if calls["n"] == 2:
            raise RuntimeError("stopped on purpose")
        return df

    with pytest.raises(Exception, match="stopped on purpose"):
        run(spark, at, step=step)
    run(spark, at)
    want = [(x, 1) for x in "abcde"]
    assert rows_of(spark, at) == want
    # As if the last batch had been written and the stream had ended before it was noted.
    last = max((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    for crc in (tmp_path / "state" / "commits").glob(f".{last.name}.crc"):
        crc.unlink()
    run(spark, at)
    assert rows_of(spark, at) == want
    # A changed file is new; a checkpoint that is lost makes nothing twice.
    put(spark, at, 7, [("a", 2, 5), ("b", 1, 5)])
    run(spark, at)
    shutil.rmtree(tmp_path / "state")
    run(spark, at)
    assert rows_of(spark, at) == sorted([*want, ("a", 2)], key=str)


MARKERS = {"name": "=== NAME", "split": "=== SPLIT"}


def test_blocks():
    body = "x" * 200
    text = f"intro naming `=== NAME` and `=== SPLIT`\n=== NAME below is sent\n{body} one\n=== SPLIT\n\n {body} two \n=== END\nprose that names === NAME"
    assert lines.blocks(text, MARKERS, "=== END") == {"name": f"{body} one", "split": f"{body} two"}
    for bad, why in ((text.replace("\n=== SPLIT", "\n== SPLIT"), "no line begins"), (text.replace("\n=== END", "\nEND"), "no line begins"), (text.replace(f"{body} two", "short"), "fewer than"), (f"=== SPLIT\n{body}\n=== NAME\n{body}\n=== END", "in this order")):
        with pytest.raises(ValueError, match=why):
            lines.blocks(bad, MARKERS, "=== END")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_recorded_source(spark):
    log = "# log\n| Uploaded source | https://a/first.jpg |\n## Retoque 1 \n| Uploaded source | https://a/second.jpg |"
    assert one(spark, lines.recorded_source(F.lit(log))) == "https://a/first.jpg"
    assert one(spark, lines.recorded_source(F.lit("x | Uploaded source | y |"))) == "" and one(spark, lines.recorded_source(F.lit(None).cast("string"))) == ""


@pytest.mark.parametrize("stamp, want", [("2026-08-01T07:52:32+00:00", "01/08 07:52"), ("2026-08-01 23:59", "01/08 23:59"), ("2026-08-01", "01/08 00:00"), ("2026-02-30T07:52", ""), ("2026-08-01T25:00", ""), ("soon", ""), ("2026-08-01T07:52:32.123456Z", "01/08 07:52"), (None, "")])
def test_when_short(spark, stamp, want):
    assert one(spark, scalars.when_short(F.lit(stamp).cast("string"))) == want


def test_flagged(spark):
    df = spark.createDataFrame([(f"r{i % 3}", f"f{i:03d}", ["leaning", "wide"] if i % 2 else []) for i in range(100)] + [("r", "g", None)], "room string, file string, flags array<string>")
    got = [tuple(r) for r in tables.flagged(df, "room", "file", "flags", ["file"]).orderBy("rank").collect()]
    assert len(got) == 41 and got[0] == (1, "r1", "f001 — leaning; wide") and got[39] == (40, "r1", "f079 — leaning; wide") and got[40] == (41, None, "10 more")
    assert tables.flagged(df.where("file < 'f010'"), "room", "file", "flags", ["file"]).count() == 5


def test_cluster_order(spark):
    df = spark.createDataFrame([("a", 1, "z"), ("a", 1, "b"), ("a", 2, "a"), ("b", 3, "q"), ("a", 4, "c")], "room string, cluster int, name string")
    assert {(r["room"], r["cluster"]): r["place"] for r in ranking.cluster_order(df, "room", "cluster", "name").collect()} == {("a", 2): 1, ("a", 1): 2, ("a", 4): 3, ("b", 3): 1}


def test_profiles(spark):
    def files(delivery, n, raw=0.0, dated=1.0, bracketed=0.0, named=0.0, rooms=5):
        return [(delivery, i < raw * n, i < dated * n, i < bracketed * n, f"room {i % rooms}" if i < named * n else None) for i in range(n)]

    rows = [*files("negatives", 100, raw=0.6), *files("brackets", 100, raw=0.6, bracketed=0.3), *files("chosen", 12, named=1.0, rooms=5), *files("nameless", 20), *files("one word", 100, named=1.0, rooms=1), *files("named", 100, named=0.7), *files("dump", 100, named=0.3), ("odd", None, None, None, None)]
    df = spark.createDataFrame(rows, "delivery string, raw boolean, dated boolean, bracketed boolean, room string")
    got = {r["delivery"]: r for r in profiles.profile(df, "delivery").collect()}
    assert {k: r["kind"] for k, r in got.items()} == {"negatives": "E", "brackets": "D", "chosen": "A", "nameless": "A", "one word": "C", "named": "B", "dump": "C", "odd": "A"}
    assert got["chosen"]["median_per_room"] == 2.0 and got["nameless"]["median_per_room"] is None and got["named"]["labelled_share"] == pytest.approx(0.7) and got["odd"]["raw_share"] == 0.0
    assert profiles.profile(df.limit(0), "delivery").count() == 0


def test_files_are_scanned_by_ending(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    for name in ("a/one.JPG", "a/b/two.nef", "a/b/three.txt", "four.jpeg", "noending"):
        (tmp_path / name).write_bytes(b"12345")
    got = lines.files(spark, str(tmp_path))
    assert sorted(r["path"].rpartition("/")[2] for r in got.collect()) == ["four.jpeg", "one.JPG", "two.nef"]
    assert "content" not in got.columns and {r["length"] for r in got.collect()} == {5}
    assert lines.files(spark, str(tmp_path), ("txt",)).count() == 1


@pytest.mark.parametrize("text, want", [("a|b", "a∣b"), ("  two\n lines\t", "two lines"), ("", ""), (None, None)])
def test_table_cells(spark, text, want):
    assert one(spark, scalars.table_cell(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("source, want", [("https://drive.example/x", True), ("http://x", True), ("/local/folder", False), ("folder", False), ("", False)])
def test_addresses(spark, source, want):
    assert bool(one(spark, names.is_address(F.lit(source)))) is want


def test_photographs_are_counted_by_their_names(spark):
    df = spark.createDataFrame([("j", "SALA_01_0001_edit.jpg"), ("j", "SALA_01_0001_final.jpg"), ("j", "SALA_01_0002_edit.jpg"), ("k", "QUARTO_01_0001_edit.jpg"), ("k", None)], "job string, name string")
    got = rooms.identities(df, "job", names.strip_result(names.stem(F.col("name"))))
    assert {r["job"]: r["photos"] for r in got.collect()} == {"j": 2, "k": 1}


def test_labelled_rooms_are_asked_together_and_others_one_by_one(spark):
    df = spark.createDataFrame([("a", f"f{i:02d}", "SALA") for i in range(26)] + [("b", "g", None), ("b", "h", None)], "room string, file string, mapped string")
    confirm, each = answers.dispatched(df, "mapped", ["file"])
    assert sorted((r["file"], r["batch"]) for r in confirm.collect()) == [(f"f{i:02d}", i // 12) for i in range(26)] and sorted(r["file"] for r in each.collect()) == ["g", "h"]


def test_delivery_lists(spark):
    inventory = spark.createDataFrame([(f"f{i:03d}", f"in/f{i:03d}.jpg", "missing") for i in range(70)] + [("x", None, "extra"), ("a", "a.jpg", "arrived"), ("c", "c (1).jpg", "deduped")], "key string, path string, status string")
    runs = spark.createDataFrame([("IMG_", 7, 7, 1), ("IMG_", 20, 31, 12)], "prefix string, first long, last long, size long")
    parts = spark.createDataFrame([("Casa", [2, 4], True, True), ("Mar", [], False, False)], "set string, holes array<int>, last_is_full boolean, alarm boolean")
    got = {(r["part"], r["rank"]): r["text"] for r in tables.delivery_lists(inventory, runs, parts).collect()}
    assert got["missing", 60] == "in/f059.jpg" and got["missing", 61] == "10 more" and got["extra", 1] == "x" and got["deduped", 1] == "c (1).jpg" and len([k for k in got if k[0] == "missing"]) == 61
    assert got["gap", 1] == "IMG_0007" and got["gap", 2] == "IMG_0020 to 0031, 12 frames"
    assert got["set", 1] == "Casa: part 2, 4 is missing; the last is as large as the others: more may follow" and not any(k[0] == "arrived" for k in got)


def test_arrived(spark):
    files = spark.range(10)
    inventory = lambda *s: spark.createDataFrame([(x,) for x in s], "status string")
    one = lambda *a: tuple(tables.arrived(files, *a).first())
    assert one() == ("unverified", None, 10, None) and one(None, 10) == ("confirmed by count", 10, 10, 0) and one(None, 12) == ("files are missing", 12, 10, 2) and one(None, 9) == ("more than expected", 9, 10, 0)
    assert one(inventory("arrived", "extra", "deduped")) == ("confirmed by name", 2, 1, 0) and one(inventory("arrived", "missing")) == ("files are missing", 2, 1, 1)


def test_run_blocks(spark, tmp_path):
    for at in ("1", "2"):
        tables.append_run(spark.createDataFrame([("j", at, 0, "12 photos | done"), ("j", at, 1, "two\nlines")], "job string, at string, place int, text string"), str(tmp_path / "runs"))
    assert sorted((r["at"], r["text"]) for r in spark.read.parquet(str(tmp_path / "runs")).collect()) == [("1", "12 photos ∣ done"), ("1", "two lines"), ("2", "12 photos ∣ done"), ("2", "two lines")]


def test_stale_writes_are_refused(spark):
    writes = spark.createDataFrame([("a", 3, 10), ("a", 3, 11), ("a", 2, 9), ("b", 1, 12), ("c", None, 13), ("d", 1, 14), (None, 1, 15)], "page string, generation int, at int")
    current = spark.createDataFrame([("a", 3), ("b", 2), ("c", 1), ("d", 1)], "page string, generation int")
    assert {r["at"]: r["refused"] for r in gates.admitted(writes, current, "page", ["at"]).collect()} == {10: None, 11: "stale", 9: "stale", 12: "stale", 13: "stale", 14: None, 15: "unknown"}
