"""Files: scans, headers, dates, captions, writers, packages, streams."""

import datetime as dt
import io
import os
import struct
import zipfile
import zlib

from pyspark.sql import functions as F

from framewright.operators import export
from framewright.sources import images
from framewright.streaming import captions as stream_captions


def png(width, height):
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IEND", b"")


def jpeg(width, height, date=None):
    exif = b""
    if date:
        tiff = b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 1) + struct.pack("<HHII", 306, 2, len(date) + 1, 26) + struct.pack("<I", 0) + date.encode() + b"\0"
        body = b"Exif\0\0" + tiff
        exif = b"\xff\xe1" + struct.pack(">H", len(body) + 2) + body
    return b"\xff\xd8" + exif + b"\xff\xc0" + struct.pack(">HBHHB", 11, 8, height, width, 1) + b"\x01\x11\x00" + b"\xff\xd9"


def webp(width, height):
    body = b"VP8X" + struct.pack("<I", 10) + b"\0\0\0\0" + (width - 1).to_bytes(3, "little") + (height - 1).to_bytes(3, "little")
    return b"RIFF" + struct.pack("<I", len(body) + 4) + b"WEBP" + body


def test_headers():
    assert images.sizes_of(png(30, 20)) == images.sizes_of(jpeg(30, 20)) == images.sizes_of(webp(30, 20)) == (30, 20)
    for bad in (None, b"", b"text", png(3, 2)[:18], jpeg(3, 2)[:8], b"RIFF....WEBPxxxx"):
        assert images.sizes_of(bad) is None
    assert images.exif_date(jpeg(3, 2, "2018:06:15 12:30:00")) == "2018:06:15 12:30:00"
    assert images.exif_date(jpeg(3, 2)) is images.exif_date(None) is None


def test_scan_and_facts(spark, tmp_path):
    for name, content in {"b.JPG": jpeg(1024, 1024, "2018:06:15 12:30:00"), "a.png": png(40, 30), "c.webp": webp(5, 6), "bad.jpg": b"not a picture", "note.txt": b"x"}.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "d.png").write_bytes(png(1, 1))
    files = images.scan(spark, str(tmp_path), contents=True)
    assert [os.path.basename(r["path"]) for r in files.orderBy("ord").collect()] == ["a.png", "b.JPG", "bad.jpg", "c.webp"]
    facts = {os.path.basename(r["path"]): r for r in images.facts(files).collect()}
    assert (facts["b.JPG"]["width"], facts["b.JPG"]["year"]) == (1024, 2018) and facts["bad.jpg"]["width"] is None
    assert facts["a.png"]["year"] == dt.datetime.now().year
    report = [r["size"] for r in images.dimension_report(images.facts(files)).collect()]
    assert report == ["40x30", "1024x1024", "Failed to load", "5x6"]
    assert {os.path.basename(r["path"]) for r in files.where(images.intact(F.col("content"))).collect()} == {"a.png", "b.JPG", "c.webp"}


def test_capture_dates(spark):
    rows = [("2018:06:15 12:30:00",), ("2018-06-15",), ("1969:01:01 x",), ("2018:13:01",), ("2019:02:30 1:1:1",), ("junk",), ("",), (None,)]
    df = spark.createDataFrame(rows, "e string").withColumn("m", F.lit("2020-01-02 03:04:05").cast("timestamp"))
    got = [r["d"] for r in df.select(images.capture_date(F.col("e"), F.col("m")).alias("d")).collect()]
    file_time = dt.datetime(2020, 1, 2, 3, 4, 5)
    assert got == [dt.datetime(2018, 6, 15)] * 2 + [file_time] * 6


def test_captions_fall_back_to_all(spark, tmp_path):
    (tmp_path / "other_1.txt").write_text("first\nsecond")
    assert [tuple(r) for r in images.captions(spark, str(tmp_path), "tok").collect()] == [("other_1", "first\nsecond")]
    (tmp_path / "tok_1.txt").write_text("mine")
    assert [tuple(r) for r in images.captions(spark, str(tmp_path), "tok").collect()] == [("tok_1", "mine")]


def test_curated_files(spark):
    df = spark.createDataFrame([("/x/tok_001.JPG",), ("/x/tok_002.txt",), ("/x/other.png",)], "path string")
    assert [r["path"] for r in images.curated(df, "tok").collect()] == ["/x/tok_001.JPG"]
    assert images.curated(df, "none").count() == 0
    assert {r["path"] for r in images.curated(df, "none", fall_back=True).collect()} == {"/x/tok_001.JPG", "/x/other.png"}


def test_writers_and_package(spark, tmp_path):
    folder = str(tmp_path / "out")
    images.write_captions(spark.createDataFrame([("tok_001", "été"), ("tok_002", None)], "stem string, text string"), folder)
    images.write_files(spark.createDataFrame([("tok_001.jpg", bytearray(b"abc"))], "out_name string, content binary"), folder)
    assert (tmp_path / "out" / "tok_001.txt").read_text(encoding="utf-8") == "été" and (tmp_path / "out" / "tok_001.jpg").read_bytes() == b"abc"
    target = io.BytesIO()
    assert images.package([("tok_001.jpg", b"abc", "été")], target) == 1
    assert sorted(zipfile.ZipFile(target).namelist()) == ["tok_001.jpg", "tok_001.txt"]


def test_export_plan_numbers_what_is_written(spark):
    schema = "path string, width int, height int, face_box struct<x:int,y:int,w:int,h:int>, seat int"
    rows = [("/a/x.PNG", 100, 100, None, 1), ("/a/y.jpg", None, None, None, 2), ("/a/z.webp", 2000, 1000, (5, 5, 9, 9), 3), ("/a/marked.jpg", 100, 100, None, 4), ("/a/plain", 64, 64, None, 5)]
    boxes = spark.createDataFrame([("/a/marked.jpg", [([(1.0, 1.0), (20.0, 9.0)], "logo", 0.9)])], "path string, boxes array<struct<poly:array<struct<x:double,y:double>>,text:string,prob:double>>")
    selected = spark.createDataFrame(rows, schema)
    plan = export.export_plan(selected, boxes, "tok", "preserve", drop_watermarked=True).collect()
    assert {r["path"]: r["out_name"] for r in plan} == {"/a/x.PNG": "tok_001.png", "/a/z.webp": "tok_002.webp", "/a/plain": "tok_003.jpg"}
    kept = {r["path"]: r for r in export.export_plan(selected, boxes, "tok", "png", preserve_aspect_ratio=False).collect()}
    assert kept["/a/marked.jpg"]["out_name"] == "tok_003.png" and len(kept["/a/marked.jpg"]["blur"]) == 1
    assert (kept["/a/z.webp"]["target"]["w"], kept["/a/z.webp"]["target"]["h"]) == (2048, 1024)


def test_streams(spark, tmp_path):
    told = tmp_path / "in"
    told.mkdir()
    (told / "1.json").write_text('{"c": "bad", "at": "2024-01-01 10:00:00"}\n{"c": null, "at": "2024-01-02 10:00:00"}\n')
    stream = spark.readStream.schema("c string, at string").json(str(told))
    query = stream_captions.audited_stream(stream, "c", F.lit("tok")).writeStream.format("memory").queryName("audited").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r["passed"] for r in spark.table("audited").collect()] == [False, False]
    rates = stream_captions.pass_rates(stream, "c", F.lit("tok"), "at").writeStream.format("memory").outputMode("complete").queryName("rates").trigger(availableNow=True).start()
    rates.awaitTermination()
    assert sorted((r["total"], r["passed_count"]) for r in spark.table("rates").collect()) == [(1, 0), (1, 0)]
    drop = tmp_path / "drop"
    drop.mkdir()
    (drop / "a.png").write_bytes(png(7, 5))
    seen = images.scan_stream(spark, str(drop)).writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    seen.awaitTermination()
    assert [images.sizes_of(bytes(r["content"])) for r in spark.table("seen").collect()] == [(7, 5)]
