"""Photo headers and archives, written here byte by byte."""

import io
import struct
import zipfile

import pytest

from sievewright.functions import quality
from sievewright.sources import archives, headers, ranged

TAGS = {0x0110: (2, b"NIKON D5600\0"), 0x0132: (2, b"2024:05:06 07:08:09\0")}
EXPOSURE = {0x829A: (5, (1, 60)), 0x8827: (3, 400), 0x9003: (2, b"2023:01:02 03:04:05\0"), 0x9204: (10, (-2, 3)), 0x920A: (5, (160, 10)), 0x9291: (2, b"07\0")}


def directory(order, entries, at, pointer=None):
    """One directory at ``at`` and the values that don't fit into it."""
    rows, after = [], b""
    entries = dict(entries) | ({0x8769: (4, pointer)} if pointer else {})
    start = at + 2 + 12 * len(entries) + 4
    for tag, (kind, value) in sorted(entries.items()):
        if kind == 2:
            n, data = len(value), value
        elif kind in (5, 10):
            n, data = 1, struct.pack(order + ("II" if kind == 5 else "ii"), *value)
        else:
            n, data = 1, struct.pack(order + {3: "H", 4: "I"}[kind], value)
        if len(data) > 4:
            field = struct.pack(order + "I", start + len(after))
            after += data + b"\0" * (len(data) % 2)
        else:
            field = data.ljust(4, b"\0")
        rows.append(struct.pack(order + "HHI", tag, kind, n) + field)
    return struct.pack(order + "H", len(rows)) + b"".join(rows) + b"\0" * 4 + after


def tiff(order="<", first=TAGS, exposure=EXPOSURE, gap=0):
    head = (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 8)
    size = len(directory(order, first, 8, 1))
    own = directory(order, first, 8, 8 + size + gap)
    return head + own + b"\0" * gap + directory(order, exposure, 8 + size + gap)


def jpeg(block=None, width=640, height=480, filler=0, picture=100_000):
    segment = lambda mark, data: bytes([0xFF, mark]) + struct.pack(">H", len(data) + 2) + data
    out = b"\xff\xd8" + segment(0xE0, b"JFIF\0" + b"\0" * 9)
    if block is not None:
        out += segment(0xE1, b"Exif\0\0" + block)
    out += b"".join(segment(0xE2, b"x" * 60_000) for _ in range(filler)) + b"\xff"
    out += segment(0xC2, struct.pack(">BHHB", 8, height, width, 3) + b"\0" * 9) + segment(0xDA, b"\0" * 10)
    return out + b"p" * picture + b"\xff\xd9"


@pytest.fixture(scope="module")
def photos(tmp_path_factory):
    at = tmp_path_factory.mktemp("photos")
    (at / "sub").mkdir()
    files = {
        "little.jpg": jpeg(tiff("<")), "big.jpg": jpeg(tiff(">")), "bare.jpg": jpeg(), "far.jpg": jpeg(tiff("<"), filler=20), "raw.nef": tiff(">", first=TAGS | {0x0100: (4, 6000), 0x0101: (3, 4000)}, gap=50_000) + b"r" * 300_000,
        "cut.jpg": jpeg(tiff("<"))[:90], "cut.tif": tiff("<")[:70], "loop.tif": b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 0), "text.txt": b"no photo", "empty.jpg": b"", "sub/inner.jpg": jpeg(tiff("<"), 4, 3), "noise.jpg": b"\xff\xd8" + b"noise" * 20}
    for name, data in files.items():
        (at / name).write_bytes(data)
    return at


def test_headers(spark, photos):
    headers.register(spark)
    df = spark.read.format("photo_headers").option("taskBytes", 100_000).load(str(photos))
    assert df.rdd.getNumPartitions() > 1
    got = {r["path"].rpartition("photos")[2].partition("/")[2]: r for r in df.collect()}
    assert len(got) == 12
    for name in ("little.jpg", "big.jpg", "raw.nef", "far.jpg", "sub/inner.jpg"):
        tags = got[name]["tags"]
        assert tags["Image Model"] == "NIKON D5600" and tags["EXIF ExposureBiasValue"] == "-2/3" and tags["EXIF ExposureTime"] == "1/60" and tags["EXIF ISOSpeedRatings"] == "400", name
        assert tags["EXIF SubSecTimeOriginal"] == "07" and tags["EXIF DateTimeOriginal"] == "2023:01:02 03:04:05" and got[name]["error"] is None
    assert [got[n]["width"] for n in ("little.jpg", "bare.jpg", "raw.nef", "sub/inner.jpg")] == [640, 640, 6000, 4] and got["raw.nef"]["height"] == 4000
    assert got["bare.jpg"]["tags"] == {} and got["bare.jpg"]["error"] is None
    for name in ("cut.jpg", "cut.tif", "loop.tif", "text.txt", "empty.jpg", "noise.jpg"):
        assert got[name]["error"], name
    assert got["cut.tif"]["kind"] == "tiff" and got["text.txt"]["kind"] is None
    # Some blocks of each file, wherever in it they are.
    assert all(r["bytes_read"] <= 16 * 4096 for n, r in got.items() if n != "far.jpg") and got["far.jpg"]["bytes_read"] < 120_000 < got["far.jpg"]["size"]


def test_headers_become_facts(spark, photos):
    headers.register(spark)
    df = spark.read.format("photo_headers").option("pathGlobFilter", "little.jpg").load(str(photos))
    h = df.select(quality.header(df["tags"]).alias("h")).first()["h"]
    assert (h["camera"], h["iso"], h["subsec"], h["focal_mm"], h["focal_35mm"], h["focal_35mm_source"]) == ("NIKON D5600", 400, 70, 16.0, 24.0, "derived")
    assert h["exposure_bias"] == pytest.approx(-2 / 3) and h["shot_at"].year == 2023


def test_filters_are_decided_before_files_are_opened(photos):
    from pyspark.sql.datasource import EqualTo, GreaterThan, StringEndsWith

    reader = headers.HeaderReader({"path": str(photos)})
    other = EqualTo(("kind",), "jpeg")
    assert list(reader.pushFilters([StringEndsWith(("path",), ".jpg"), GreaterThan(("size",), 1000), other])) == [other]
    assert sorted(p.rpartition("/")[2] for part in reader.partitions() for p, _ in part.files) == ["bare.jpg", "big.jpg", "far.jpg", "inner.jpg", "little.jpg"]


def test_pushed_filters(spark, photos):
    headers.register(spark)
    df = spark.read.format("photo_headers").load(str(photos)).where(f"path = '{photos}/big.jpg' and width = 640")
    assert [r["kind"] for r in df.collect()] == ["jpeg"]


def test_a_header_has_its_limit(photos):
    data = jpeg(tiff("<"), filler=20)
    row = headers.header(io.BytesIO(data), "far.jpg", len(data), 4 * 4096)
    assert row[7].startswith("more than") and row[6] <= 4 * 4096 and row[5]["Image Model"] == "NIKON D5600"
    with pytest.raises(FileNotFoundError):
        ranged.listed(str(photos / "nowhere"))


@pytest.mark.parametrize("cut", range(0, 400, 7))
def test_cut_headers_never_raise(cut):
    for whole in (jpeg(tiff("<")), jpeg(tiff(">")), tiff("<"), tiff(">")):
        row = headers.header(io.BytesIO(whole[:cut]), "x", min(cut, len(whole)))
        assert row[7] is not None or row[2] is not None


def raw_with(pictures, order="<"):
    """A raw file: a directory with a small picture, one behind it, and a further one named by a tag."""
    small, middle, large = pictures
    at = {"a": 8, "b": 200, "c": 400, "small": 600, "middle": 600 + len(small), "large": 600 + len(small) + len(middle)}
    entry = lambda tag, kind, value: struct.pack(order + "HHI", tag, kind, 1) + struct.pack(order + {3: "HH", 4: "I"}[kind], *((value, 0) if kind == 3 else (value,)))
    first = [entry(0x014A, 4, at["c"]), entry(0x0201, 4, at["small"]), entry(0x0202, 4, len(small))]
    second = [entry(0x0201, 4, at["middle"]), entry(0x0202, 4, len(middle))]
    third = [entry(0x0103, 3, 7), entry(0x0111, 4, at["large"]), entry(0x0117, 4, len(large))]
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, at["a"])).ljust(600, b"\0")
    for place, entries, after in ((at["a"], first, at["b"]), (at["b"], second, at["a"]), (at["c"], third, 0)):
        block = struct.pack(order + "H", len(entries)) + b"".join(entries) + struct.pack(order + "I", after)
        out[place : place + len(block)] = block
    return bytes(out) + small + middle + large


def test_previews(spark, tmp_path):
    pictures = [b"\xff\xd8\xff" + bytes([i]) * n for i, n in enumerate((50, 300, 9000))]
    files = {"a.nef": raw_with(pictures), "b.cr2": raw_with(pictures, ">"), "c.jpg": jpeg(picture=50), "none.tif": tiff("<"), "cut.nef": raw_with(pictures)[:-10], "x.txt": b"text", "odd.nef": raw_with([pictures[0], b"no picture", b"none either"])}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    headers.register(spark)
    df = spark.read.format("photo_previews").option("taskBytes", 10_000).load(str(tmp_path))
    got = {r["path"].rpartition("/")[2]: r for r in df.collect()}
    assert bytes(got["a.nef"]["content"]) == bytes(got["b.cr2"]["content"]) == pictures[2] and got["a.nef"]["source"] == "embedded"
    assert bytes(got["c.jpg"]["content"]) == files["c.jpg"] and got["c.jpg"]["source"] == "file" and bytes(got["odd.nef"]["content"]) == pictures[0]
    assert {n for n, r in got.items() if r["error"]} == {"none.tif", "cut.nef", "x.txt"} and df.where("source = 'file'").count() == 1


# -------------------------------------------------------------------- archives


def zipped(members, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("archives")
    deep = zipped({"deepest.zip": zipped({"too/deep.jpg": b"d"}), "d.jpg": b"depth two"})
    files = {
        "Casa-001.zip": zipped({"a.jpg": b"a" * 5000, "folder/": b"", "folder/b.jpg": b"b" * 10, "__MACOSX/._a.jpg": b"j", ".DS_Store": b"j", "x.xmp": b"j"}), "Casa-002.zip": zipped({"c.jpg": b"c" * 300}, zipfile.ZIP_STORED),
        "nested.zip": zipped({"inner.zip": zipped({"i.jpg": b"inner", "deep.zip": deep, "bad.zip": b"no archive"}), "o.jpg": b"outer"}), "damaged.zip": zipped({"a.jpg": b"a" * 3000})[:-30], "old.rar": b"Rar!", "readme.txt": b"no archive"}
    whole = zipped({f"s{i}.jpg": bytes([i]) * 2000 for i in range(9)}, zipfile.ZIP_STORED)
    files |= {"split.zip.001": whole[:7000], "split.zip.002": whole[7000:14000], "split.zip.003": whole[14000:], "torn.zip.001": whole[:900], "torn.zip.003": whole[900:]}
    broken = bytearray(zipped({"fine.jpg": b"f" * 100, "broken.jpg": b"q" * 100}, zipfile.ZIP_STORED))
    place = broken.index(b"q" * 100)
    broken[place : place + 3] = b"zzz"
    files["broken.zip"] = bytes(broken)
    locked = bytearray(zipped({"locked.jpg": b"l" * 50}, zipfile.ZIP_STORED))
    locked[locked.index(b"PK\x01\x02") + 8] |= 1
    files["locked.zip"] = bytes(locked)
    for name, data in files.items():
        (at / name).write_bytes(data)
    return at


def rows(df):
    return {(r["archive"].rpartition("/")[2], r["member"]): r for r in df.collect()}


def test_listing(spark, folder):
    archives.register(spark)
    got = rows(spark.read.format("archive_listing").load(str(folder)))
    names = {k for k, r in got.items() if not r["error"]}
    assert {("Casa-001.zip", "a.jpg"), ("Casa-001.zip", "folder/b.jpg"), ("Casa-002.zip", "c.jpg"), ("nested.zip", "inner.zip!deep.zip!d.jpg"), ("nested.zip", "inner.zip!deep.zip!deepest.zip")} <= names
    assert ("nested.zip", "inner.zip!deep.zip!deepest.zip!too/deep.jpg") not in names and ("Casa-001.zip", "folder/") not in names
    assert got["nested.zip", "inner.zip!deep.zip!d.jpg"]["depth"] == 2 and got["nested.zip", "inner.zip"]["nested"] and not got["nested.zip", "inner.zip!deep.zip!deepest.zip"]["nested"]
    assert sum(bool(r["junk"]) for r in got.values()) == 3
    assert [got["split.zip", f"s{i}.jpg"]["size"] for i in range(9)] == [2000] * 9
    errors = {k for k, r in got.items() if r["error"]}
    assert errors == {("damaged.zip", None), ("old.rar", None), ("torn.zip", None), ("nested.zip", "inner.zip!bad.zip"), ("locked.zip", "locked.jpg")}


def test_listing_reads_no_member(folder):
    class Watched(io.BytesIO):
        read_bytes = 0

        def read(self, *n):
            data = super().read(*n)
            Watched.read_bytes += len(data)
            return data

    data = zipped({"a.bin": b"\0" * 3_000_000, "b.bin": bytes(range(256)) * 10_000}, zipfile.ZIP_STORED)
    assert len(list(archives.members("x", Watched(data)))) == 2 and Watched.read_bytes < 2000


@pytest.mark.parametrize("task", [1 << 27, 4000])
def test_members(spark, folder, task):
    archives.register(spark)
    df = spark.read.format("archive_members").option("taskBytes", task).load(str(folder))
    read = df.collect()
    got = {(r["archive"].rpartition("/")[2], r["member"]): r for r in read}
    assert len(got) == len(read)
    content = {k: bytes(r["content"]) for k, r in got.items() if r["content"] is not None}
    assert content["Casa-001.zip", "a.jpg"] == b"a" * 5000 and content["nested.zip", "inner.zip!deep.zip!d.jpg"] == b"depth two" and content["nested.zip", "inner.zip!i.jpg"] == b"inner"
    assert [content["split.zip", f"s{i}.jpg"] for i in range(9)] == [bytes([i]) * 2000 for i in range(9)]
    assert content["broken.zip", "fine.jpg"] == b"f" * 100 and got["broken.zip", "broken.jpg"]["error"].startswith("BadZipFile")
    assert all(r["content"] is None for r in read if r["junk"] or r["error"] or r["nested"])
    if task < 10_000:
        assert df.rdd.getNumPartitions() > 6


def test_empty_folder(spark, tmp_path):
    archives.register(spark)
    headers.register(spark)
    for name in ("archive_listing", "archive_members", "photo_headers"):
        assert spark.read.format(name).load(str(tmp_path)).count() == 0
