import json
import zipfile

from pyspark.sql import functions as F

from corvane.functions import geometry
from corvane.operators import dedupe, metrics
from corvane.sources import listing, readers, sinks
from corvane.streaming import ingest


def test_coco_documents_of_any_segmentation(spark, tmp_path):
    doc = {
        "images": [{"id": 1, "file_name": "a.jpg", "width": 10, "height": 20}, {"id": 2, "file_name": "  ", "width": 1, "height": 1}],
        "categories": [{"id": 5, "name": " fire "}, {"id": 6, "name": ""}],
        "annotations": [
            {"id": 1, "image_id": 1, "category_id": 5, "segmentation": [1, 2, 3, 4, 5, 6], "bbox": [0, 0, 5, 5], "area": 1},
            {"id": 2, "image_id": 1, "category_id": 5, "segmentation": [[1, 2, 3, 4, 5, 6], [1, 2]], "bbox": [0, 0, 5, 5]},
            {"id": 3, "image_id": 1, "category_id": 5, "segmentation": {"counts": "x", "size": [1, 1]}, "bbox": [1, 2, 3, 4]},
            {"id": 4, "image_id": 1, "category_id": 6, "bbox": [1, 2, 1, 4]},
        ],
    }
    (tmp_path / "train").mkdir()
    (tmp_path / "train" / "_annotations.coco.json").write_text("﻿" + json.dumps(doc), encoding="utf-8")
    images, anns, cats = readers.coco(spark, str(tmp_path))
    assert [(r.id, r.file_name) for r in images.collect()] == [(1, "a.jpg")]
    assert {r.id: r.name for r in cats.collect()} == {5: "fire", 6: None}
    got = {r.id: r.polygons for r in anns.collect()}
    assert got == {1: [[1, 2, 3, 4, 5, 6]], 2: [[1, 2, 3, 4, 5, 6]], 3: [[1, 2, 4, 2, 4, 6, 1, 6]], 4: []}


def test_labels_there_and_back(spark, tmp_path):
    (tmp_path / "g01_000001.txt").write_text("0 .1 .2 .3 .4\n\n1 .5 .5 .1 .1\n")
    (tmp_path / "g01_000002.txt").write_text("")
    lines = readers.label_lines(spark, str(tmp_path))
    assert sorted(tuple(r) for r in lines.collect()) == [(tmp_path.name, "g01_000001", 1, "0 .1 .2 .3 .4"), (tmp_path.name, "g01_000001", 3, "1 .5 .5 .1 .1")]
    more = lines.drop("dir").unionByName(spark.createDataFrame([("x", None, None)], "stem string, line_number int, line string"))
    sinks.labels(more, f"{tmp_path}/out")
    assert {r.stem: r.text for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {"g01_000001": "0 .1 .2 .3 .4\n1 .5 .5 .1 .1\n", "x": ""}


def test_metrics_with_aliases(spark, tmp_path):
    (tmp_path / "results.csv").write_text("  epoch , metrics/mAP50(B) , train/box_loss\n 1 , 0.5 , x\n 2 , 0.7 , 0.1\n")
    m = readers.metrics(spark, str(tmp_path / "results.csv"))
    rows = metrics.with_known_names(m).withColumn("stage", F.lit("s")).orderBy("epoch").collect()
    assert [(r.epoch, r.mAP50, r["train/box_loss"], r.recall) for r in rows] == [(1.0, 0.5, None, None), (2.0, 0.7, 0.1, None)]


def test_zip_members_and_images(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("train/x.jpg", b"1")
        z.writestr("train/y.PNG", b"22")
    assert sorted((r.member, bytes(r.content)) for r in readers.zip_members(spark, str(tmp_path)).collect()) == [("train/x.jpg", b"1"), ("train/y.PNG", b"22")]
    (tmp_path / "img").mkdir()
    (tmp_path / "img" / "b.JPG").write_bytes(b"abc")
    (tmp_path / "img" / "c.gif").write_bytes(b"abc")
    r = readers.images(spark, str(tmp_path / "img")).collect()
    assert [(x.file_name, x.stem, x.suffix, x.length) for x in r] == [("b.JPG", "b", ".jpg", 3)]


def test_csv_and_json_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    sinks.csv(df.coalesce(1), f"{tmp_path}/c")
    sinks.json_lines(df, f"{tmp_path}/j")
    assert spark.read.csv(f"{tmp_path}/c", header=True).count() == 2 and spark.read.json(f"{tmp_path}/j").count() == 2


def test_sql_functions(spark):
    geometry.registered(spark)
    r = spark.sql("select hamming(-1, -4) h, box_iou(0,0,10,10, 0,0,10,5) i").first()
    assert r.h == 2 and r.i == 0.5


def test_streams(spark, tmp_path):
    from datetime import datetime

    rows = [(datetime(2024, 1, 1, 0, 5), "01", 0.9, "h1"), (datetime(2024, 1, 1, 0, 6), "01", 0.1, "h2"), (datetime(2024, 1, 1, 0, 7), "01", 0.8, "h1"), (datetime(2024, 1, 1, 3), "02", 0.9, "h3")]
    df = spark.createDataFrame(rows, "ts timestamp, grp string, score double, content_hash string")
    df.write.parquet(f"{tmp_path}/in")
    s = ingest.read_tables(spark, f"{tmp_path}/in", df.schema)
    q = ingest.alarms(s, "ts").writeStream.format("memory").queryName("alarms").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.grp, r.n) for r in spark.sql("select * from alarms").collect()) == [("01", 2), ("02", 1)]
    q = ingest.first_of_content(s, "ts").writeStream.format("memory").queryName("firsts").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select * from firsts").count() == 3


def test_group_inputs(spark):
    import pytest

    names = ["01_a", "02_Alley_Context", "03_x", "04_y", "05_Real_Situation"]
    children = spark.createDataFrame([(n,) for n in names], "name string")
    assert {r.grp: r.input for r in readers.group_inputs(children).collect()} == {n[:2]: n for n in names}
    explicit = spark.createDataFrame([("01", "/elsewhere")], "grp string, input string")
    more = children.union(spark.createDataFrame([("01_b",)], "name string"))
    assert {r.grp: r.input for r in readers.group_inputs(more, explicit).collect()}["01"] == "/elsewhere"
    with pytest.raises(Exception, match="group 01"):
        readers.group_inputs(more).collect()


def test_paths_records_and_subsets(spark):
    files = spark.createDataFrame([("a.jpg",), ("d/b.jpg",), ("d/x/c.jpg",), ("y/e.jpg",), ("b.jpg",)], "path string")
    asked = spark.createDataFrame([(1, "d", "a.jpg"), (2, "d", "x/b.jpg"), (3, "d", "x/c.jpg"), (4, "d", "no.jpg"), (5, "d", "y/e.jpg")], "id int, dir string, file_name string")
    assert {r.id: r.path for r in listing.image_paths(asked, files).collect()} == {1: "a.jpg", 2: "d/b.jpg", 3: "d/x/c.jpg", 4: None, 5: "y/e.jpg"}
    images = spark.createDataFrame([("train", "g01_000001", "g01_000001.jpg"), ("valid", "g01_000001", "g01_000001.jpg"), ("train", "g02_000001", "g02_000001.jpg"), ("train", "z", "z.jpg")], "dir string, stem string, file_name string")
    lines = spark.createDataFrame([("train", "g01_000001", 2, "b"), ("train", "g01_000001", 1, "a"), ("valid", "g01_000001", 1, "v")], "dir string, stem string, line_number int, line string")
    assert {(r.dir, r.stem): (r.grp, r.lines) for r in readers.records(images, lines).collect()} == {("train", "g01_000001"): ("01", ["a", "b"]), ("valid", "g01_000001"): ("01", ["v"]), ("train", "g02_000001"): ("02", []), ("train", "z"): ("unknown", [])}
    assert [r.stem for r in readers.records(images, lines, 2).collect()] == ["g01_000001", "g01_000001"]
    assert [r.stem for r in readers.subset(images, lines, "02").collect()] == ["g02_000001"] and readers.subset(images, lines, "05").isEmpty()


def test_class_names_of_every_form(spark, tmp_path):
    forms = {
        "a": "path: .\nnames:\n  0: \"fi\\u0072e\"\n  2: smoke\nnc: 2\n", "b": "names: [fire, 'two words']\ntrain: x\n", "c": "names:\n- fire\n- \"two words\"\n", "d": "names: {0: fire, 7: x}\n", "e": "path: .\nnames:\n  0: fire\n",
    }
    want = {"a": {0: "fire", 2: "smoke"}, "b": {0: "fire", 1: "two words"}, "c": {0: "fire", 1: "two words"}, "d": {0: "fire", 7: "x"}, "e": {0: "fire"}}
    for k, text in forms.items():
        (tmp_path / f"{k}.yaml").write_text(text)
        assert {r.class_id: r.class_name for r in listing.dataset_names(spark, str(tmp_path / f"{k}.yaml")).collect()} == want[k], k


def test_document_is_whole_when_parts_are_joined(spark, tmp_path):
    from corvane.operators import coco

    images = spark.createDataFrame([(i, f'a "{i}".jpg', i * 2) for i in range(1, 200)], "id long, file_name string, width int").repartition(5)
    anns = spark.createDataFrame([(i, 1 + i % 199, [[0.5, 1.0]]) for i in range(1, 300)], "id long, image_id long, segmentation array<array<double>>")
    sinks.coco_document(coco.document_lines(images, anns, spark.createDataFrame([(0, "x"), (1, "y")], "id int, name string")), f"{tmp_path}/doc")
    d = json.loads("".join(p.read_text() for p in sorted((tmp_path / "doc").glob("part-*"))))
    assert [x["id"] for x in d["images"]] == list(range(1, 200)) and d["images"][4]["file_name"] == 'a "5".jpg' and len(d["annotations"]) == 299 and d["categories"][1] == {"id": 1, "name": "y"}
    sinks.coco_document(coco.document_lines(images.limit(0), anns.limit(0), spark.createDataFrame([], "id int, name string")), f"{tmp_path}/none")
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*")))) == {"images": [], "annotations": [], "categories": []}


def test_reports_have_a_header_and_are_not_overwritten(spark, tmp_path):
    import pytest

    columns = ("action", "grp", "kept_source_key")
    none = spark.createDataFrame([], "action string, grp string, kept_source_key string")
    sinks.report(none, columns, f"{tmp_path}/r")
    assert spark.read.csv(f"{tmp_path}/r", header=True).columns == list(columns) and spark.read.csv(f"{tmp_path}/r", header=True).count() == 0
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.report(none, columns, f"{tmp_path}/r")
    some = spark.createDataFrame([("kept", "01", "k"), ("removed", "02", "k"), ("removed", "02", "k")], none.schema)
    sinks.report(some, columns, f"{tmp_path}/r", "overwrite")
    r = dedupe.summary_of(spark.read.csv(f"{tmp_path}/r", header=True)).first()
    assert (r.clusters, r.kept, r.removed, r.removed_by_group) == (1, 1, 2, {"02": 2})


def test_header_sizes():
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (640).to_bytes(4, "big") + (480).to_bytes(4, "big")
    jpeg = b"\xff\xd8\xff\xe1\x00\x08abcdef\xff\xff\xc0\x00\x11\x08" + (48).to_bytes(2, "big") + (64).to_bytes(2, "big") + b"\x03"
    webp = b"RIFF\0\0\0\0WEBPVP8 \0\0\0\0\0\0\0\x9d\x01\x2a" + (33).to_bytes(2, "little") + (44).to_bytes(2, "little")
    bmp = b"BM" + bytes(16) + (7).to_bytes(4, "little") + (-9).to_bytes(4, "little", signed=True)
    assert [listing.size_of(x) for x in (png, jpeg, webp, bmp, png[:20], jpeg[:10], b"", None)] == [(640, 480), (64, 48), (33, 44), (7, 9), (0, 0), (0, 0), (0, 0), (0, 0)]


def test_no_metric_rows_is_an_error(spark, tmp_path):
    import pytest

    (tmp_path / "results.csv").write_text("epoch,precision\n")
    with pytest.raises(ValueError):
        readers.metrics(spark, str(tmp_path / "results.csv"))


def png(x, kind, palette=None, filters=(0, 1, 2, 3, 4)):
    """An 8-bit PNG of x (height, width, channels), its lines filtered in turn."""
    import struct
    import zlib

    h, w, c = x.shape
    rows = x.reshape(h, w * c).astype(int)
    out = b""
    for y in range(h):
        f, line = filters[y % len(filters)], []
        for i in range(w * c):
            a, b, d = (rows[y][i - c] if i >= c else 0), (rows[y - 1][i] if y else 0), (rows[y - 1][i - c] if y and i >= c else 0)
            p = a + b - d
            paeth = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - d) else b if abs(p - b) <= abs(p - d) else d
            line.append((rows[y][i] - [0, a, b, (a + b) // 2, paeth][f]) % 256)
        out += bytes([f]) + bytes(line)
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    packed = zlib.compress(out)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + (chunk(b"PLTE", palette) if palette else b"") + chunk(b"IDAT", packed[:50]) + chunk(b"IDAT", packed[50:]) + chunk(b"IEND", b"")


def test_grey_pixels_of_every_kind_of_png_and_of_bmp():
    import struct

    import numpy as np

    from corvane.functions import pixels

    rng = np.random.default_rng(1)
    rgb = rng.integers(0, 256, (13, 17, 3))
    want = (rgb[..., 0] * 19595 + rgb[..., 1] * 38470 + rgb[..., 2] * 7471 + 0x8000) >> 16
    one = rng.integers(0, 256, (13, 17, 1))
    table = rng.integers(0, 256, (256, 3))
    assert (pixels.grey(png(rgb, 2)) == want).all() and (pixels.grey(png(np.dstack([rgb, one]), 6)) == want).all()
    assert (pixels.grey(png(one, 0)) == one[..., 0]).all() and (pixels.grey(png(np.dstack([one, one]), 4)) == one[..., 0]).all()
    assert (pixels.grey(png(one, 3, table.astype(np.uint8).tobytes())) == ((table @ [19595, 38470, 7471] + 0x8000) >> 16)[one[..., 0]]).all()
    lines = b"".join(bytes(rgb[y][:, ::-1].astype(np.uint8).tobytes()) + b"\0" for y in range(12, -1, -1))
    bmp = b"BM" + struct.pack("<IHHIIiiHHIIiiII", 54 + len(lines), 0, 0, 54, 40, 17, 13, 1, 24, 0, len(lines), 0, 0, 0, 0) + lines
    assert (pixels.grey(bmp) == want).all()
    assert all(pixels.grey(x) is None for x in (None, b"", b"\xff\xd8\xff", png(one, 0)[:40], bmp[:60]))


def test_difference_hashes_of_images(spark):
    import numpy as np

    from corvane.functions import pixels

    ramp = np.tile(np.arange(90)[None, :, None] * 2, (80, 1, 1))
    bars = np.zeros((64, 72, 1), int)
    bars[:, ::16] = 255
    flat = np.full((20, 30, 1), 77)
    assert pixels.hash_of(png(ramp, 0)) == 0 and pixels.hash_of(png(ramp[:, ::-1], 0)) == -1 and pixels.hash_of(png(flat, 0)) == 0
    assert (pixels.resampled(flat[..., 0].astype(np.uint8), 9, 8) == 77).all()
    rng = np.random.default_rng(2)
    noise = rng.integers(0, 256, (60, 63, 1))
    # Against the same window in floating point over the whole image.
    def plain(x, n):
        scale = x.shape[1] / n
        at = (np.arange(x.shape[1])[None] + 0.5 - (np.arange(n)[:, None] + 0.5) * scale) / scale
        w = np.where(np.abs(at) < 3, np.sinc(at) * np.sinc(at / 3), 0)
        return x @ (w / w.sum(1, keepdims=True)).T

    want = plain(plain(noise[..., 0].astype(float), 9).T, 8).T
    assert np.abs(pixels.resampled(noise[..., 0].astype(np.uint8), 9, 8) - want).max() <= 1.5
    near = noise.copy()
    near[5, 5] = 255 - near[5, 5]
    a, b = (pixels.hash_of(png(x, 0)) for x in (noise, near))
    assert ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    df = spark.createDataFrame([(1, png(noise, 0)), (2, None), (3, b"no image"), (4, png(ramp[:, ::-1], 0))], "i int, content binary")
    assert {r.i: r.h for r in df.select("i", pixels.difference_hash(F.col("content")).alias("h")).collect()} == {1: a, 2: None, 3: None, 4: -1}
