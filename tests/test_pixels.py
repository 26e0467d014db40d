"""Pictures drawn here: hashes against a double sum, lines of known lean."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.functions import art, pixels, quality
from sievewright.operators import fusion, geometry, measurement, similarity

SCHEMA = "name int, pixels array<int>, width int"


def frame(spark, pictures):
    return spark.createDataFrame([(i, None if p is None else p.astype(int).ravel().tolist(), None if p is None else p.shape[1]) for i, p in enumerate(pictures)], SCHEMA).repartition(2)


def hash_by_hand(p):
    """Area means and cosine sums, one by one."""
    h, w = p.shape
    small = [[sum(p[y, x] * max(0, min((r + 1) * h / 32, y + 1) - max(r * h / 32, y)) * max(0, min((c + 1) * w / 32, x + 1) - max(c * w / 32, x)) for y in range(h) for x in range(w)) * 32 * 32 / h / w for c in range(32)] for r in range(32)]
    low = [round(4 * sum(small[r][c] * math.cos(math.pi * u * (2 * r + 1) / 64) * math.cos(math.pi * v * (2 * c + 1) / 64) for r in range(32) for c in range(32)), 6) for u in range(8) for v in range(8)]
    middle = (sorted(low)[31] + sorted(low)[32]) / 2
    return int("".join("1" if x > middle else "0" for x in low), 2)


def test_hashes(spark):
    rng = np.random.default_rng(1)
    y, x = np.mgrid[:40, :50]
    pictures = [rng.integers(0, 256, (9, 13)), rng.integers(0, 256, (33, 20)), (128 + 100 * np.sin(x / 9.0) * np.cos(y / 7.0)), np.full((10, 10), 77), rng.integers(0, 256, (1, 5))]
    pictures = [p.astype(int) for p in pictures]
    got = {r["name"]: r["m"] for r in frame(spark, [*pictures, None, np.zeros((0, 3))]).select("name", pixels.measured(F.col("pixels"), F.col("width")).alias("m")).collect()}
    for i, p in enumerate(pictures):
        assert got[i]["high"] << 32 | got[i]["low"] == hash_by_hand(p), i
        assert got[i]["height"] == p.shape[0] and got[i]["shadow_clip"] == pytest.approx((p <= 2).mean() * 100) and got[i]["highlight_clip"] == pytest.approx((p >= 253).mean() * 100)
    assert got[3]["sharpness"] == 0.0 and got[4]["sharpness"] is None and all(v is None for i in (5, 6) for v in got[i])


def test_sharpness_is_that_of_the_columns(spark):
    rng = np.random.default_rng(2)
    df = frame(spark, [rng.integers(0, 256, (6, 7)), rng.integers(0, 256, (3, 3))])
    for r in df.select(pixels.measured(F.col("pixels"), F.col("width"))["sharpness"].alias("a"), quality.sharpness(F.col("pixels"), F.col("width")).alias("b")).collect():
        assert r["a"] == pytest.approx(r["b"])


def test_near_pictures_are_one_class(spark):
    rng = np.random.default_rng(3)
    scenes = [np.kron(rng.integers(20, 220, (10, 10)), np.ones((6, 8))) for _ in range(4)]
    pictures = [np.clip(scenes[i % 4] * (1 + i % 3 / 20) + rng.normal(0, 3, (60, 80)), 0, 255) for i in range(24)] + [scenes[0][::2, ::2]]
    hashed = frame(spark, pictures).select("name", F.lit("room").alias("bucket"), pixels.measured(F.col("pixels"), F.col("width")).alias("m")).select("name", "bucket", "m.high", "m.low")
    links = similarity.hamming_links(hashed, "bucket", "name", "high", "low", 10, spanning=True)
    assert {r["name"]: r["class"] for r in similarity.classes(hashed, "name", links).collect()} == {i: i % 4 for i in range(25)}


def drawn(h, w, uprights, noise=0.0, blur=True, seed=0):
    """Dark bars of six pixels whose middle leans from the top down: (x at mid height, degrees)."""
    y, x = np.mgrid[:h, :w]
    out = np.full((h, w), 200.0)
    for at, lean in uprights:
        far = np.abs((x - at - math.tan(math.radians(lean)) * (y - h / 2)) * math.cos(math.radians(lean)))
        out = np.where(far < 3, 40.0, np.where(far < 4, 200 - 160 * (4 - far) if blur else 200.0, out))
    return np.clip(out + np.random.default_rng(seed).normal(0, noise, (h, w)), 0, 255)


@pytest.mark.parametrize("lean", [-14.0, -7.3, -1.0, 0.0, 0.4, 3.0, 9.7, 15.0])
@pytest.mark.parametrize("noise", [0.0, 4.0])
def test_lines_of_known_lean(lean, noise):
    found = pixels.lines(drawn(240, 320, [(90, lean), (200, lean)], noise))
    long = [s for s in found if math.hypot(s[2] - s[0], s[3] - s[1]) > 150]
    assert len(long) >= 4  # both sides of two bars
    for x1, y1, x2, y2 in found:
        assert abs(math.degrees(math.atan2(x2 - x1, y2 - y1)) - lean) < 0.5


def test_pictures_without_lines():
    rng = np.random.default_rng(4)
    y, x = np.mgrid[:240, :320]
    for p in (np.full((240, 320), 99.0), rng.integers(0, 256, (240, 320)).astype(float), rng.normal(128, 60, (240, 320)).clip(0, 255), x * 255.0 / 320, drawn(240, 320, []).T, np.where((y // 8) % 2 == 0, 30.0, 220.0), np.zeros((1, 1)), np.zeros((2, 500))):
        assert pixels.lines(p) == []


def test_short_lines_and_gaps():
    p = drawn(400, 300, [(150, 2.0)])
    p[100:140] = 200.0  # a gap of a tenth of the height
    p[:60] = p[340:] = 200.0
    found = pixels.lines(p)
    assert {(round(a, -1), round(b, -1)) for _, a, _, b in found} == {(60, 100), (140, 340)} or {(round(a, -1), round(b, -1)) for _, a, _, b in found} == {(140, 340)}
    tiny = drawn(400, 300, [(150, 0.0)])
    tiny[:180] = tiny[220:] = 200.0
    assert pixels.lines(tiny) == []


def test_segments_feed_the_geometry(spark):
    level = drawn(240, 400, [(x, 0.0) for x in range(30, 380, 50)])
    leaning = drawn(240, 400, [(x, 4.0) for x in range(40, 360, 50)])
    splayed = drawn(240, 400, [(x, (x - 200) / 400 * 16) for x in range(40, 370, 50)])
    df = frame(spark, [level, leaning, splayed, np.full((240, 400), 5.0), None])
    cut = df.select("name", F.explode(pixels.segments(F.col("pixels"), F.col("width"))).alias("s"), F.col("width").alias("w"), F.lit(240).alias("h")).select("name", "s.*", "w", "h")
    got = {r["name"]: r for r in geometry.vertical_geometry(cut, "name", ["x1", "y1", "x2", "y2"]).collect()}
    assert set(got) == {0, 1, 2} and all(got[i]["lines"] >= 12 for i in got)
    assert abs(got[0]["roll_deg"]) < 0.3 and got[0]["convergence_deg"] < 0.5
    assert abs(got[1]["roll_deg"] - 4.0) < 0.3 and got[1]["convergence_deg"] < 0.5
    assert abs(got[2]["roll_deg"]) < 0.4 and abs(got[2]["convergence_deg"] - 16) < 1.5


# ------------------------------------------------------------- fusion and marks


def scene(h=64, w=96, seed=1):
    rng = np.random.default_rng(seed)
    return np.kron(rng.integers(20, 235, (h // 8, w // 8, 3)), np.ones((8, 8, 1))).astype(float)


def test_shifts_are_found():
    rng = np.random.default_rng(2)
    still = art.blurred(fusion.grey(scene(256, 320)), 2.0)
    for dy, dx in ((0, 0), (3, -2), (-7, 5), (1, 11)):
        moving = fusion.shifted(still, -dy, -dx) * 0.6 + rng.normal(0, 1, still.shape)
        assert fusion.shift(still, moving) == (dy, dx)


def test_fusion_takes_the_well_exposed():
    base = np.clip(scene() * 0.7 + 40 + np.random.default_rng(9).normal(0, 12, (64, 96, 3)), 0, 255)
    assert np.abs(fusion.fuse([base, base, base]).astype(float) - base).max() <= 1
    # The left half is black in one frame, the right half white in the other.
    dark, bright = base.copy(), base.copy()
    dark[:, :48], bright[:, 48:] = dark[:, :48] * 0.03, 255 - (255 - bright[:, 48:]) * 0.03
    got = fusion.fuse([dark, bright]).astype(float)
    for part in (np.s_[:, :40], np.s_[:, 56:]):
        assert np.abs(got[part] - base[part]).mean() < min(np.abs(x[part] - base[part]).mean() for x in (dark, bright) if np.abs(x[part] - base[part]).mean() > 1) / 2
    assert np.corrcoef(got.ravel(), base.ravel())[0, 1] > 0.8


def test_fused_runs(spark):
    a, b = scene(32, 48, 3), scene(24, 48, 4)
    rows = [("run", "a", a), ("run", "b", a * 0.5), ("run", "c", np.clip(a * 1.8, 0, 255)), ("sizes", "a", a), ("sizes", "b", b), ("none", "a", None), *(("long", f"{i}", a) for i in range(10)), ("one", "a", b)]
    df = spark.createDataFrame([(r, n, 48, None if p is None else p.astype(int).ravel().tolist()) for r, n, p in rows], "scene string, name string, width int, pixels array<int>")
    got = {r["scene"]: r for r in fusion.fused(df, "scene", "name").collect()}
    assert got["run"]["frames"] == 3 and got["run"]["width"] == 48 and len(got["run"]["pixels"]) == 32 * 48 * 3 and got["run"]["error"] is None
    assert got["one"]["pixels"] == b.astype(int).ravel().tolist()
    assert "different sizes" in got["sizes"]["error"] and "48x24" in got["sizes"]["error"] and "without pixels" in got["none"]["error"] and "10 frames" in got["long"]["error"]
    assert fusion.fused(df.limit(0), "scene", "name").count() == 0


def logo(colour):
    out = np.zeros((60, 50, 4))
    out[10:50, 12:40] = (*colour, 255)
    return out


ARTS = {"dark": logo((0, 0, 0)), "light": logo((255, 255, 255))}


def test_art_is_cut_to_what_is_seen():
    own = art.Art.of(ARTS["light"])
    assert own.pixels.shape == (40, 28, 4) and own.ink == pytest.approx(1.0) and art.Art.of(ARTS["dark"]).ink == 0.0
    half = ARTS["light"].copy()
    half[10:30, 12:40, :3], half[10:30, 12:40, 3] = 0, 85
    assert art.Art.of(half).ink == pytest.approx(0.75)
    with pytest.raises(ValueError):
        art.Art.of(np.zeros((4, 4, 4)))


def test_resized_and_blurred_keep_what_there_is():
    x = np.random.default_rng(5).integers(0, 256, (13, 17, 4)).astype(float)
    x[..., 3] = np.maximum(1, x[..., 3])
    assert art.resized(x, 13, 17) == pytest.approx(x)
    assert art.resized(x, 5, 40)[..., 3].mean() == pytest.approx(x[..., 3].mean())
    point = np.zeros((41, 41))
    point[20, 20] = 1
    assert art.blurred(point, 4.0).sum() == pytest.approx(1, abs=0.01) and art.blurred(point, 4.0)[20, 20] == pytest.approx(1 / (2 * math.pi * 16), rel=0.02)


def test_marks(spark):
    white, black, busy = np.full((200, 300, 3), 250), np.full((200, 300, 3), 5), np.random.default_rng(6).choice([0, 255], (200, 300, 1)) * np.ones((1, 1, 3), int)
    rows = [("white", white, None, None), ("black", black, None, None), ("busy", busy, None, None), ("told", white, "light", None), ("calm", busy, "dark", False), ("small", np.full((1, 100, 3), 9), None, None), ("none", None, None, None)]
    df = spark.createDataFrame([(n, None if p is None else p.ravel().tolist(), None if p is None else p.shape[1], v, g) for n, p, v, g in rows], "name string, pixels array<int>, width int, variant string, glow boolean")
    got = {r["name"]: r["m"] for r in df.select("name", art.marked(F.col("pixels"), F.col("width"), F.col("variant"), F.col("glow"), ARTS).alias("m")).collect()}
    assert [(got[n]["ink"], got[n]["glow"]) for n in ("white", "black", "busy", "told", "calm")] == [("dark", False), ("light", False), (got["busy"]["ink"], True), ("light", True), ("dark", False)]
    assert got["small"]["error"] == "too small for a mark" and got["none"]["error"] == "no pixels in whole rows" and got["white"]["contrast"] > 15
    new = np.array(got["white"]["pixels"]).reshape(200, 300, 3)
    # 30 high, 21 wide, 9 in: the ink at its opacity, and nothing else.
    assert (np.abs(new[12:36, 12:27] - 250 * 0.15) <= 1).all()
    outside = np.ones((200, 300), bool)
    outside[9:39, 9:30] = False
    assert (new[outside] == 250).all()
    glowing = np.array(got["told"]["pixels"]).reshape(200, 300, 3)
    assert (glowing[9:39, 9:30] != 250).any()
    assert np.array(got["black"]["pixels"]).reshape(200, 300, 3)[20, 20, 0] == pytest.approx(5 * 0.15 + 255 * 0.85, abs=1)


def test_measurement_rows(spark):
    schema = "path string, size long, kind string, width int, height int, tags map<string, string>, bytes_read long, error string"
    tags = {"EXIF DateTimeOriginal": "2024:01:02 03:04:05", "Image Model": "NIKON D5600", "EXIF FocalLength": "8/1", "Image Orientation": "6"}
    heads = spark.createDataFrame([("a/leans.NEF", 10, "tiff", 600, 400, tags, 1, None), ("a/level.jpg", 10, "jpeg", 400, 240, {}, 1, None), ("a/bad.jpg", 3, None, None, None, None, 1, "neither JPEG nor TIFF")], schema)
    leaning, level = drawn(240, 400, [(x, 4.0) for x in range(40, 360, 50)]), drawn(240, 400, [(x, 0.0) for x in range(30, 380, 50)])
    shown = spark.createDataFrame([(p, x.astype(int).ravel().tolist(), 400) for p, x in (("a/leans.NEF", leaning), ("a/level.jpg", level), ("a/other.jpg", level))], "path string, pixels array<int>, grey_width int")
    got = {r["path"]: r for r in measurement.measurements(heads, shown).collect()}
    assert set(got) == {"a/leans.NEF", "a/level.jpg", "a/bad.jpg"}
    a, b, c = got["a/leans.NEF"], got["a/level.jpg"], got["a/bad.jpg"]
    assert a["is_raw"] and a["orientation_applied"] and (a["width"], a["height"]) == (400, 600) and a["focal_35mm"] == 12.0 and a["shot_at"].year == 2024
    assert len(a["flags"]) == 2 and a["flags"][0].startswith("leaning +4") and "12mm" in a["flags"][1] and "FAULT" in a["verdict"] and a["sharpness"] > 0 and a["high"] is not None
    assert b["flags"] == [] and b["verdict"].startswith("level; verticals straight") and b["notes"] == ["no tags at all", "no time: it can't be part of a bracket"]
    assert c["sharpness"] is None and c["lines"] is None and c["notes"][0] == "header unreadable: neither JPEG nor TIFF" and c["flags"] == []
