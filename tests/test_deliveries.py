"""Labels, readers, sinks, answers and measures against hand-made and recorded values."""

import pytest
from pyspark.sql import functions as F

from sievewright.functions import names, quality
from sievewright.operators import answers, files, gates, matching, rooms
from sievewright.sinks import tables
from sievewright.sources import lines
from sievewright.streaming import ledger

WORDS = [("cobertura", "TERRACO"), ("sala", "SALA"), ("copa", "JANTAR"), ("suíte 1", "SUITE"), ("suíte", "QUARTO"), ("wc", "BANHEIRO"), ("banheiro", "BANHEIRO"), ("sacada", "VARANDA"), ("porta", "HALL"), ("lavabo", "LAVABO")]


def test_labels_become_kinds(spark):
    # Recorded: what the photographer wrote, and the kind it is filed under.
    want = {"Sala Cobertura": "SALA", "Cobertura": "TERRACO", "Suíte 1": "SUITE", "Suíte 2": "QUARTO", "Copa": "JANTAR", "Sacada": "VARANDA", "Porta": "HALL", "Lavabo Cobertura": "LAVABO", "Banheiro Suíte 1": "BANHEIRO", "WC-00660 sala": "SALA", "WC": "BANHEIRO", "suíte": "QUARTO", "x": None}
    df = spark.createDataFrame([(k,) for k in want], "label string")
    got = matching.keyword_of(df, "label", F.col("label"), WORDS, [names.code_pattern("WC-N")]).collect()
    assert {r["label"]: r["slug"] for r in got} == want


def test_path_labels(spark):
    want = {
        "1_Imóvel/8_Cozinha_1.JPG": ("Cozinha", 8, "1", "Imóvel", 1), "Sala 2.jpg": ("Sala", None, "2", None, None), "x/11_Banheiro_Suíte_11b.jpg": ("Banheiro Suíte", 11, "11b", None, None),
        "3_Condomínio/IMG9620.heic": ("Condomínio", 3, None, "Condomínio", 3), "WC-00660 - Casa/IMG9620x.heic": (None, None, None, None, None), "a/WC-660.jpg": ("a", None, None, None, None), "IMG1x.jpg": (None, None, None, None, None)}
    df = spark.createDataFrame([(k,) for k in want], "path string").select("path", names.labels(F.col("path"), [names.code_pattern("WC-N")]).alias("l"))
    assert {r["path"]: tuple(r["l"]) for r in df.collect()} == want


def test_names(spark):
    ask = lambda f, *v: [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(v)], "i int, x string").orderBy("i").select(f(F.col("x"))).collect()]
    assert ask(names.fold, "Terraço", "Área", "ß", None) == ["terraco", "area", "ß", None]
    assert ask(names.fold_name, " Área.JPG ", "Área.jpg", "Area.jpg") == ["área.jpg", "área.jpg", "area.jpg"]
    assert ask(names.without_copy_mark, "DSC_0142 (1).NEF", "DSC_0142 copy 2.NEF", "a - 3.jpg", "DSC_0142.NEF") == ["DSC_0142.NEF", "DSC_0142.NEF", "a.jpg", "DSC_0142.NEF"]
    assert ask(lambda c: names.counter(c)[0], "x/DSC_0142.NEF", "0142.NEF", "a12.jpg") == ["DSC_", ".nef", None]
    assert ask(names.stem, "a/.hidden", "b/x.tar.gz", "c") == [".hidden", "x.tar", "c"]
    assert ask(names.strip_result, "SALA_01_0001_edit_1", "SALA_01_0001_final", "SALA_01_0001") == ["SALA_01_0001"] * 3
    slugs = ["AREA_SERVICO", "QUARTO"]
    assert ask(lambda c: names.valid_slug(c, slugs), "`QUARTO`", "Quarto", "area servico", "cave", None) == ["QUARTO", "QUARTO", "AREA_SERVICO", None, None]
    assert ask(names.ascii_name, "Suíte 1.jpg", "日本") == ["Suite_1.jpg", "_"]
    assert ask(names.delivery_name, "drive:a/Casa Nirvana", "https://x.y/z", "in/Quinta.7z.001", "Casa-001.zip") == ["Casa Nirvana", "Download", "Quinta", "Casa"]
    assert ask(names.archive_set, "z/Casa-001.zip", "z/Casa-002.ZIP", "z/Q.7z.001", "z/Q.z01", "z/one.zip") == ["z/Casa|.zip", "z/Casa|.zip", "z/Q", "z/Q", "z/one.zip"]
    assert ask(lambda c: names.target(c)["hi"], "40-60", "50", "x") == [60, 50, None]
    with pytest.raises(ValueError):
        names.code_pattern("WC-")


def test_measures(spark):
    row = lambda *c: tuple(spark.range(1).select(*c).first())
    assert row(quality.crop_factor(F.lit("ILCE-7M3")), quality.crop_factor(F.lit("NIKON D5600")), quality.crop_factor(F.lit("canon eos r7")), quality.crop_factor(F.lit("phone")), quality.crop_factor(F.lit(None).cast("string"))) == (1.0, 1.5, 1.5, None, None)
    assert tuple(row(quality.focal_35(F.lit(0.0), F.lit(16.0), F.lit("NIKON D5600")))[0]) == (24.0, "derived")
    assert row(quality.ratio(F.lit("8/10")), quality.ratio(F.lit("1/0")), quality.ratio(F.lit("2.5")), quality.ratio(F.lit("x"))) == (0.8, None, 2.5, None)
    assert row(quality.subsecond(F.lit("x"), F.lit("5")), quality.subsecond(F.lit("1234"))) == (500, 123)
    assert row(quality.shutter(F.lit(2.0)), quality.shutter(F.lit(0.004)), quality.shutter(F.lit(None).cast("double"))) == ("2.0s", "1/250", "—")
    assert row(quality.ev_span(F.array(F.lit(-2.0), F.lit(None), F.lit(2.0))), quality.ev_span(F.array(F.lit(1.0)))) == (4.0, 0.0)
    assert tuple(row(quality.geometry(F.lit(2048), F.lit(1365), F.lit(166), F.lit(205)))[0]) == (166, 205, 61)
    flat, edge = F.array(*[F.lit(9)] * 9), F.array(*(F.lit(x) for x in (0, 0, 0, 0, 0, 255, 0, 0, 255, 0, 0, 255)))
    assert row(quality.sharpness(flat, F.lit(3)))[0] == 0.0 and row(quality.sharpness(edge, F.lit(3)))[0] == 0.0
    wide = [0, 0, 0, 0, 0, 8, 0, 0, 0, 0, 0, 0]  # four columns: inner places hold -32 and 8
    assert row(quality.sharpness(F.array(*map(F.lit, wide)), F.lit(4)))[0] == 400.0
    assert row(quality.request(F.lit("gpt-image-2"), F.lit(3000), F.lit(2000)), quality.request(F.lit("other"), F.lit(3000), F.lit(2000))) == ("2048x1360", "3:2")


def test_header(spark):
    tags = {"EXIF DateTimeOriginal": "broken", "Image DateTime": "2024:05:06 07:08:09", "EXIF SubSecTime": "7", "EXIF ExposureBiasValue": "-2/3", "EXIF ISOSpeedRatings": "100", "Image Model": " NIKON D5600 ", "EXIF FocalLength": "16"}
    df = spark.createDataFrame([(1, tags), (2, {})], "i int, t map<string, string>").select("i", quality.header(F.col("t")).alias("h")).orderBy("i")
    full, none = [r["h"] for r in df.collect()]
    assert str(full["shot_at"]) == "2024-05-06 07:08:09" and (full["subsec"], full["iso"], full["camera"], full["focal_35mm"], full["focal_35mm_source"]) == (700, 100, "NIKON D5600", 24.0, "derived") and full["exposure_bias"] == pytest.approx(-2 / 3)
    assert none["shot_at"] is None and none["exposure_bias"] is None and none["focal_35mm"] is None


def test_vertical_geometry(spark):
    from sievewright.operators import geometry

    level = [(1, i, 100 * i, 0, 100 * i, 300, 1000, 700) for i in range(8)]
    rolled = [(2, i, 100 * i, 300, 100 * i - 30, 0, 1000, 700) for i in range(8)]  # drawn upwards: the same lean
    few, narrow = [(3, i, 100 * i, 0, 100 * i, 300, 1000, 700) for i in range(5)], [(4, i, 10 * i, 0, 10 * i, 300, 1000, 700) for i in range(9)]
    flat = [(5, i, 0, 5, 900, 5, 1000, 700) for i in range(9)]
    splay = [(6, i, 100 * i, 0, 100 * i + 5 * i, 300, 1000, 700) for i in range(9)]
    df = spark.createDataFrame(level + rolled + few + narrow + flat + splay, "photo int, i int, x1 int, y1 int, x2 int, y2 int, w int, h int")
    got = {r["photo"]: (r["convergence_deg"], r["roll_deg"], r["lines"]) for r in geometry.vertical_geometry(df, "photo", ["i"]).collect()}
    assert got[1] == (0.0, 0.0, 8) and got[2][0] == 0.0 and got[2][1] == pytest.approx(5.71, abs=0.01) and got[3] == (None, None, 5) and got[4] == (None, None, 9) and got[5] == (None, None, 0) and got[6][0] > 8


def test_inventory_and_gaps_of_a_recorded_delivery(spark):
    arrived = spark.createDataFrame([("s/IMG_2918.HEIC",), ("s/Área 1.jpg",), ("s/new.jpg",)], "path string")
    wanted = spark.createDataFrame([("IMG_2918 (1).HEIC",), ("IMG_2918.HEIC",), ("Área 1.JPG",), ("gone.jpg",)], "path string")
    got = {r["key"]: r["status"] for r in files.inventory(wanted, arrived, "path").collect()}
    assert got == {"img_2918 (1).heic": "deduped", "img_2918.heic": "arrived", "área 1.jpg": "arrived", "gone.jpg": "missing", "new.jpg": "extra"}
    present = [*range(7039, 7047), *range(7450, 7454), *range(7455, 7471)]
    paths = spark.createDataFrame([(f"d/IMG_{n:04d}.JPG",) for n in present], "path string")
    row = files.frame_gaps(paths, "path").first()
    assert (row["prefix"], row["first"], row["last"], row["present"], row["missing"], row["longest"]) == ("IMG_", 7039, 7470, 28, 404, 403)
    prefix, number = names.counter(F.col("path"))
    runs = files.missing_runs(paths.select(prefix.alias("p"), number.alias("n")), "p", "n").collect()
    assert sorted((r["first"], r["last"], r["size"]) for r in runs) == [(7047, 7449, 403), (7454, 7454, 1)]


RULES = """# Rules

    base per room: 3
    gallery target: 40-60
    roll warn: 1
    roll flag: 3
    convergence warn: 5
    convergence flag: 12
    focal warn: 18
    focal flag: 15

| Priority | Category | Words |
|---|---|---|
| 1 | hero | terraço, vista |
| 2 | social | sala |
| 99 | default | *(anything unmatched)* |

| T0-T1 | up to 5 | 15-25 |
| T2 | 6 to 10 | 25-40 |
| T3 | 11 or more | 40-60 |
"""
VOCABULARY = """| SALA | social | sala, living |
| QUARTO | bedroom | suíte, quarto |
| NAO_IDENTIFICADO | default | *(nothing matched)* |
| `WC-N` | a reference |
"""


def test_dimensions(spark, tmp_path):
    (tmp_path / "r.md").write_text(RULES)
    got = lines.rules(spark, str(tmp_path / "r.md"))
    assert got["target"] == (40, 60) and got["keywords"] == [("terraco", "hero"), ("vista", "hero"), ("sala", "social")] and got["priorities"] == {"hero": 1, "social": 2, "default": 99}
    assert got["typology"] == [(5, "T0-T1", 15, 25), (10, "T2", 25, 40), (10**6, "T3", 40, 60)] and len(got["fingerprint"]) == 8
    (tmp_path / "r.md").write_text(RULES.replace("    roll flag: 3\n", ""))
    with pytest.raises(ValueError, match="roll flag"):
        lines.rules(spark, str(tmp_path / "r.md"))
    (tmp_path / "v.md").write_text(VOCABULARY)
    got = lines.vocabulary(spark, str(tmp_path / "v.md"))
    assert got["categories"]["QUARTO"] == "bedroom" and got["synonyms"][0] == ("living", "SALA") and got["codes"] == ["wc[-][0-9]+"]
    (tmp_path / "v.md").write_text(VOCABULARY + "| SALA | social | again |\n")
    with pytest.raises(ValueError):
        lines.vocabulary(spark, str(tmp_path / "v.md"))
    with pytest.raises(ValueError):
        lines.between("A\nshort\nB", "A", "B")


def test_catalogue_and_rounds(spark):
    rows = ["| SALA | SALA | 02 | Sala | `A.JPG` | filename | — |", "| QUARTO | SALA | x | — | `a.jpg` | manual | moved |", "| Ambiente | Visto | Sala | R | A | O | N |", "| SALA | — | 1 | — | — | vision | — |"]
    got = lines.catalog(spark.createDataFrame(list(enumerate(rows)), "i int, value string"), "i").collect()
    assert [(r["key"], r["ambiente"], r["seen"], r["room_no"], r["label"], r["note"]) for r in got] == [("a.jpg", "QUARTO", "SALA", 1, None, "moved")]
    record = "# gate\n\n## edit · rodada 2 · 2024-01-02\n\n| Foto | D | C |\n|---|---|---|\n| `P1` | volta | again |\n| `P1` | ok | later |\n\n## edit · rodada 1 · 2024-01-01\n| `P2` | ok | — |\n"
    got = lines.rounds(spark.createDataFrame([("j", record)], "job string, text string"), "job", "text").orderBy("n").collect()
    assert [tuple(r) for r in got] == [("j", "edit", 1, "2024-01-01", "P2", False, None), ("j", "edit", 2, "2024-01-02", "P1", True, "again")]
    log = "# log\n## Retoque 1 — 2024-01-01T10:00\n| Instrução humana | less | light |\n| Edit anterior | `P1_edit_r1.jpg` |\n| Resultado | `P1_edit.jpg` · 2 MB |\n\n### Prompt as sent\n| Model | no |\n## Retoque 2\n| Model | m |\n"
    got = lines.retouches(spark.createDataFrame([("P1", log)], "photo string, text string"), "photo", "text").orderBy("n").collect()
    assert [tuple(r) for r in got] == [("P1", 1, "2024-01-01T10:00", "less | light", "P1_edit_r1.jpg", "P1_edit.jpg", None), ("P1", 2, "", None, None, None, "m")]
    assert lines.expected(spark.createDataFrame([("a/b.jpg ",), ("# c",), ("",)], "value string").select("value")).collect()[0][0] == "a/b.jpg"
    with pytest.raises(Exception, match="rich text"):
        lines.refuse_rich(spark.createDataFrame([("{\\rtf1 x",)], "value string")).collect()


def test_fields_and_objects(spark):
    df = spark.createDataFrame([("x\n- **Shoot:** `A b`\n**Dropped as:** c\n", '```json\nsure: {"n": 3} done\n```')], "t string, j string")
    assert tuple(df.select(lines.field(F.col("t"), "Dropped as"), lines.json_object(F.col("j"), "n int")["n"], lines.shot_at(F.lit("bad"), F.lit("2024:01:02 03:04:05")).cast("string")).first()) == ("c", 3, "2024-01-02 03:04:05")


def test_answers(spark):
    texts = ['{"picks": [{"file": "A.jpg", "reason": " x ", "purpose": "12"}, {"file": "nope"}, {"file": "a.JPG"}]}', "no", '{"picks": 3}']
    df = spark.createDataFrame(list(enumerate(texts)), "room int, t string").select("room", answers.ranking(F.col("t")).alias("a"))
    got = {r["room"]: r["a"] for r in df.collect()}
    assert got[0]["picks"][0]["purpose"] == 10 and got[0]["picks"][0]["reason"] == "x" and got[1]["error"] and got[2]["error"]
    offered = spark.createDataFrame([(0, "a.jpg"), (0, "b.jpg")], "room int, file string")
    chosen = answers.chosen(df.select("room", "a.picks"), offered, spark.createDataFrame([(0, 5)], "room int, slots int"), "room", "file").collect()
    assert [(r["file"], r["rank"]) for r in chosen] == [("a.jpg", 1)]
    both = spark.createDataFrame([("bad", '{"comodos": [["a"], ["b"]]}'), ("bad", "worse")], "x string, y string").select(answers.retried(F.col("x"), F.col("y"), answers.splitting).alias("s")).collect()
    assert both[0]["s"]["rooms"] == [["a"], ["b"]] and both[1]["s"]["error"]
    named = answers.named(spark.createDataFrame([("a", "SALA"), ("b", None)], "file string, guess string"), "guess").collect()
    assert [(r["ambiente"], r["failed"]) for r in named] == [("SALA", False), ("NAO_IDENTIFICADO", True)]
    told = answers.Offline().naming(spark.createDataFrame([(1, "f", "SALA"), (1, "g", "SALA"), (2, "h", None)], "room int, file string, guess string"))
    assert {r["room"]: r["n"]["ambiente"] for r in told.select("room", answers.naming(F.col("answer")).alias("n")).collect()} == {1: "SALA", 2: "NAO_IDENTIFICADO"}


def test_matches_leave_doubt_open(spark):
    offered = spark.createDataFrame([(1, n) for n in ("IMG_0001.jpg", "IMG_0001.heic", "longname_one.jpg", "ab.jpg")], "room int, name string")
    want = {"img_0001.JPG": "IMG_0001.jpg", "x/ab.jpg": "ab.jpg", "IMG_0001.png": None, "longname_one.JPEG": "longname_one.jpg", "longname_one(1).jpg": "longname_one.jpg", "zz": None}
    claims = spark.createDataFrame([(1, c) for c in want], "room int, claim string")
    assert {r["claim"]: r["match"] for r in gates.matched(claims, offered, "room", "claim", "name").collect()} == {k: v for k, v in want.items()} | {"longname_one(1).jpg": None}


def test_contradictions(spark):
    text = "Remove kettles from the counter. The kettle stays. Take the lamp off? Keep it, then it goes. Boxes go away."
    got = gates.contradictions(spark.createDataFrame([(1, text)], "id int, text string"), "id", "text", ignored=["from", "remove", "stays"]).collect()
    assert [(r["word"], r["removed"], r["kept"]) for r in got] == [("kettle", "Remove kettles from the counter.", "The kettle stays.")]


def test_sinks(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    events = spark.createDataFrame([("t", "Job_1", "run 1", 3, "a | b\n c")], "at string, job string, event string, photos int, detail string")
    tables.append_events(events, at("ledger"))
    tables.append_events(events, at("ledger"))
    assert [(r["event"], r["detail"]) for r in spark.read.parquet(at("ledger")).collect()] == [("run 1", "a ∣ b c")] * 2
    with pytest.raises(Exception, match="unknown event"):
        ledger.checked(spark.createDataFrame([("walk",)], "event string"), "event").collect()
    marks = spark.createDataFrame([("j", "edit", "P1", True, "x"), ("j", "edit", "P2", False, None)], "job string, stage string, photo string, back boolean, comment string")
    tables.append_round(marks, None, at("rounds"))
    tables.append_round(marks, spark.read.parquet(at("rounds")), at("rounds"))
    assert sorted(r["n"] for r in spark.read.parquet(at("rounds")).collect()) == [1, 1, 2, 2]
    tables.write_catalog(spark.createDataFrame([("d1", 1), ("d2", 2)], "delivery string, n int"), at("cat"), "delivery")
    tables.write_catalog(spark.createDataFrame([("d1", 3)], "delivery string, n int"), at("cat"), "delivery")
    assert sorted((r["delivery"], r["n"]) for r in spark.read.parquet(at("cat")).collect()) == [("d1", 3), ("d2", 2)]
    picks = spark.createDataFrame([("r", 1, "A"), ("r", 2, None)], "room string, rank int, name string")
    with pytest.raises(ValueError, match="1 of picks"):
        tables.write_job(picks, at("job"))
    over = spark.createDataFrame([("r", f"why {i % 7}") for i in range(20)] + [("r", "")], "room string, comment string")
    got = tables.selection(picks.where("rank = 1"), over, "room", "comment").collect()
    assert [r["text"] for r in sorted(got, key=lambda r: (r["part"] != "pick", r["rank"]))] == ["A", *(f"why {i}" for i in range(5))]
    report = tables.delivery_report(spark.createDataFrame([("a.JPG",), ("b.jpg",)], "path string"), spark.createDataFrame([("missing",)], "status string"), spark.createDataFrame([("I", 4, 20, True)], "prefix string, missing int, longest int, alarm boolean"), picks.limit(1), F.col("path"))
    assert {tuple(r) for r in report.collect()} == {("files", ".jpg", 2), ("inventory", "missing", 1), ("removed", "copies", 1), ("missing", "I", 4), ("alarm", "I", 20)}
    fates = tables.originals(spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "S")], "k int, name string"), "k").collect()
    assert {r["k"]: r["fate"] for r in fates} == {1: "S", 2: "not chosen"}
    tables.write_profile(picks, at("profile"))
    tables.write_record(picks, at("record"))


def test_late_events_are_dropped_and_files_move(spark, tmp_path):
    from datetime import datetime, timedelta

    start, schema = datetime(2024, 1, 1), "ts timestamp, kind string"
    at = tmp_path / "in"
    for i, hours in enumerate(([0, 1, 10], [2, 11], [20])):  # 2 comes later than two hours behind 10
        spark.createDataFrame([(start + timedelta(hours=h), "run") for h in hours], schema).coalesce(1).write.mode("append").parquet(str(at))
        run = ledger.event_counts(ledger.landing(spark, str(at), schema, str(tmp_path / "done")), "ts", "kind").writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        run.awaitTermination(120)
    got = {r["start"].hour: r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert 2 not in got and got[0] == 1 and got[1] == 1 and got[10] == 1
    assert list((tmp_path / "done").rglob("*.parquet"))


def test_empty_picks_leave_the_choice(spark):
    scenes = spark.createDataFrame([(1, True), (2, False)], "f int, chosen boolean")
    none = spark.createDataFrame([], "k int, note string")
    assert {r["f"]: r["chosen"] for r in rooms.picked(scenes, "f", none, "k").collect()} == {1: True, 2: False}
