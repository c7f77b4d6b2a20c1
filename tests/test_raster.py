"""Decoding, scaling, blurring, export, caption generation and the command line."""

import base64
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.__main__ import main
from framewright.functions import pixels
from framewright.operators import captions, export, filters
from framewright.sources import images, raster


@pytest.fixture
def folder(tmp_path):
    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (40, 60, 3)).astype("u1")
    (tmp_path / "a.png").write_bytes(raster.png(a))
    (tmp_path / "b.png").write_bytes(raster.png(np.full((20, 10, 3), 128, "u1")))
    (tmp_path / "broken.png").write_bytes(b"not a picture")
    return tmp_path, a


def test_decode_and_pixels(spark, folder):
    path, a = folder
    rows = {os.path.basename(r["path"]): r for r in raster.decoded(spark, str(path)).collect()}
    assert set(rows) == {"a.png", "b.png"}
    r = rows["a.png"]
    assert (raster.array_of(bytes(r["data"]), r["height"], r["width"], r["channels"]) == a).all()
    long = raster.long_pixels(raster.decoded(spark, str(path))).withColumnRenamed("path", "img_id")
    contrast = {os.path.basename(x["img_id"]): x["contrast"] for x in pixels.contrast(long).collect()}
    assert contrast["b.png"] == 0 < contrast["a.png"]


def test_scaling_is_area_mean():
    a = np.arange(48).reshape(4, 4, 3).astype("u1")
    assert (raster.scaled(a, 2, 2) == np.rint(a.reshape(2, 2, 2, 2, 3).mean(axis=(1, 3)))).all()
    assert raster.scaled(a, 7, 3).shape == (3, 7, 3) and (raster.scaled(np.full((5, 9, 3), 77, "u1"), 4, 3) == 77).all()


def test_blur_stays_in_its_box():
    a = np.zeros((50, 50, 3), "u1")
    a[20:25, 20:25] = 255
    out = raster.blurred(a, [(10, 10, 40, 40), (3, 3, 3, 9)])
    assert out[22, 22, 0] < 255 and out[12, 12, 0] > 0 and not out[:10].any() and not out[:, 40:].any()


def test_export(spark, folder, tmp_path):
    path, _ = folder
    found = raster.decoded(spark, str(path))
    selected = found.select("path", "width", "height", F.lit(None).cast("struct<x:int,y:int,w:int,h:int>").alias("face_box"), F.row_number().over(__import__("pyspark").sql.Window.orderBy("path")).alias("seat"))
    boxes = spark.createDataFrame([], "path string, boxes array<struct<poly:array<struct<x:double,y:double>>,text:string,prob:double>>")
    for keep, sizes in ((True, {(64, 64)}), (False, {(1024, 1024)})):
        files = raster.rendered(found, export.export_plan(selected, boxes, "tok", "png", preserve_aspect_ratio=keep))
        out = str(tmp_path / f"out{keep}")
        images.write_files(files, out)
        assert sorted(os.listdir(out)) == ["tok_001.png", "tok_002.png"]
        assert {images.sizes_of(open(os.path.join(out, f), "rb").read()) for f in os.listdir(out)} == sizes
    thumb = raster.thumbnails(found).first()["picture"]
    assert images.sizes_of(base64.b64decode(thumb)) in {(60, 40), (10, 20)}
    assert images.sizes_of(base64.b64decode(raster.thumbnail(np.zeros((2000, 1000, 3), "u1")))) == (512, 1024)


GOOD = "She stands by a red door in a blue linen coat with both hands resting in the pockets, lit by soft morning window light from the left."


def test_generation_asks_again(spark):
    rows = [("tok_001", "Describe.", "tok", "tok woman, a close-up shot"), ("tok_002", "Describe.", "tok", "tok woman, a close-up shot"), ("tok_003", "Describe.", "tok", "tok woman, a close-up shot")]
    requests = spark.createDataFrame(rows, "stem string, prompt string, trigger string, lead string")

    def provider(asked):
        again = F.col("prompt").contains("rejected")
        answer = F.when(F.col("stem") == "tok_001", F.when(again, GOOD).otherwise("bad")).when(F.col("stem") == "tok_002", F.lit(GOOD.replace("both hands resting", "gloves")))
        return asked.select("stem", answer.alias("content"))

    got = {r["stem"]: r for r in captions.generate(requests, provider).collect()}
    assert set(got) == {"tok_001", "tok_002"}
    assert got["tok_001"]["attempt"] == 2 and not got["tok_001"]["repaired"]
    assert got["tok_002"]["repaired"] and "Hands are out of frame." in got["tok_002"]["caption"]


def test_rejection_reasons(spark):
    points = [(0.45, 0.3), (0.55, 0.3), (0.5, 0.35), (0.5, 0.4)]
    face = (0.9, 0.4, 0.2, 0.2, 0.25, points)
    schema = "path string, width int, height int, letterboxed boolean, faces array<struct<score:double,x:double,y:double,w:double,h:double,keypoints:array<struct<x:double,y:double>>>>"
    rows = [("ok", 1200, 1100, False, [face]), ("u", None, 5, False, [face]), ("s", 10, 1100, False, [face]), ("l", 1200, 1100, True, [face]), ("n", 1200, 1100, False, []), ("c", 1200, 1100, False, [(0.1, *face[1:])]), ("k", 1200, 1100, False, [(*face[:5], points[:2])])]
    got = {r["path"]: r["reason"] for r in filters.rejection(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"ok": None, "u": "unreadable", "s": "resolution", "l": "letterbox", "n": "not one face", "c": "uncertain face", "k": "missing keypoints"}
    df = spark.range(3)
    assert filters.require_survivors(df, 5) == (3, True) and filters.require_survivors(df, 2) == (3, False)
    with pytest.raises(filters.TooFewImages):
        filters.require_survivors(df.limit(0))


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "tok_001.txt").write_text("tok woman, a close-up shot. " + GOOD)
    (tmp_path / "tok_001.png").write_bytes(raster.png(np.zeros((4, 4, 3), "u1")))
    assert main(["audit", "--folder", str(tmp_path), "--trigger", "tok"], spark) == 0
    assert main(["package", "--folder", str(tmp_path), "--trigger", "tok"], spark) == 0
    (tmp_path / "tok_002.png").write_bytes(raster.png(np.zeros((4, 4, 3), "u1")))
    assert main(["package", "--folder", str(tmp_path), "--trigger", "tok"], spark) == 1
    data = "/root/testdata/sf0.001"
    if os.path.isdir(data):
        out = str(tmp_path / "portfolio")
        assert main(["curate", "--metrics", f"{data}/image_metrics.parquet", "--verdicts", f"{data}/vlm_verdicts.parquet", "--output", out, "--dims", "64", "--era", "2010-2025"], spark) == 0
        assert spark.read.parquet(out).count() == 30
