"""Whole runs over real files, picture metrics in one pass, and calls of a model."""

import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.__main__ import main
from framewright.functions import pixels
from framewright.operators import filters, providers
from framewright.plans import run
from framewright.sources import images, metrics, raster

FACES = "array<struct<score:double,x:double,y:double,w:double,h:double,keypoints:array<struct<x:double,y:double>>>>"
FACE = [(0.9, 0.35, 0.1, 0.3, 0.3, [(0.40, 0.30), (0.50, 0.30), (0.45, 0.36), (0.45, 0.42)])]
GOOD = "A woman stands by a brick wall in a grey coat and looks to the left, both hands rest on the iron railing, and soft window light falls across the room from the right side."


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path, rng = tmp_path_factory.mktemp("in"), np.random.default_rng(0)
    for k in range(8):
        small = rng.integers(20, 230, (8, 8, 3)).astype("u1")
        (path / f"p{k}.png").write_bytes(raster.png(np.kron(small, np.ones((128, 128, 1), "u1"))))
    (path / "broken.png").write_bytes(b"\x89PNG\r\n\x1a\nno")
    return path


def tables(spark):
    faces = [(f"p{k}.png", FACE, [], [float(i == k) for i in range(8)]) for k in range(7)]  # p7 has no row
    detections = spark.createDataFrame(faces, f"name string, faces {FACES}, hands array<array<struct<x:double,y:double>>>, feature_vector array<float>")
    verdicts = spark.createDataFrame([], "path string, is_single boolean, lighting string, has_sunglasses boolean, has_face_occlusion boolean, model_name string, checked_at timestamp")
    boxes = spark.createDataFrame([], "path string, boxes array<struct<poly:array<struct<x:double,y:double>>,text:string,prob:double>>")
    return detections, verdicts, boxes


def test_folder_to_package(spark, folder, tmp_path):
    out = tmp_path / "out"
    answers = lambda asked: asked.select("stem", F.lit(GOOD).alias("content"))
    report = run.curate_folder(spark, str(folder), str(out), "tok", *tables(spark), provider=answers, target=4, dims=8)
    assert report["scanned"] == 9 and report["accepted"] == 7 and not report["few"] and report["faults"] == 0
    assert report["exported"] == 4 and report["captioned"] == 4
    assert sorted(p.name for p in out.glob("tok_*.png")) == [f"tok_00{k}.png" for k in range(1, 5)] and len(list(out.glob("*.txt"))) == 4
    assert main(["package", "--folder", str(out), "--trigger", "tok", "--zip", str(tmp_path / "set.zip")], spark) == 0
    assert len(zipfile.ZipFile(tmp_path / "set.zip").namelist()) == 8
    (out / "tok_001.txt").write_text("a full-body picture", encoding="utf-8")
    (out / "tok_002.txt").unlink()
    assert run.pack(spark, str(out), "tok", str(tmp_path / "no.zip"))[0] == 0 and not (tmp_path / "no.zip").exists()
    asked = []

    def again(requests):
        rows = requests.collect()
        asked.extend(r["prompt"] for r in rows)
        return spark.createDataFrame([(r["stem"], GOOD if r["stem"] != "tok_003" else None) for r in rows], "stem string, content string")

    assert tuple(run.recaption(spark, str(out), "tok", again).first()) == (3, 4)
    assert sum("full-body" in p for p in asked) >= 1 and (out / "tok_002.txt").read_text(encoding="utf-8").startswith("tok woman, a waist-up")
    (out / "tok_004.png").write_bytes(raster.png(np.zeros((10, 10, 3), "u1")))
    (out / "tok_003.png").unlink()
    plan = spark.createDataFrame([(f"tok_00{k}.png", (1024, 1024)) for k in range(1, 5)], "out_name string, target struct<w:int,h:int>")
    assert {tuple(r) for r in run.export_faults(spark, str(out), plan).collect()} == {("tok_003.png", "missing"), ("tok_004.png", "size")}


def test_too_few_pictures(spark, folder, tmp_path):
    with pytest.raises(filters.TooFewImages):
        run.curate_folder(spark, str(folder), str(tmp_path), "tok", *tables(spark), target=30, dims=8)


def test_one_pass_metrics_equal_the_long_form(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k, (h, w) in enumerate([(1, 1), (1, 9), (7, 5), (30, 41)]):
        a = rng.integers(0, 256, (h, w, 3)).astype("u1")
        if k == 3:
            a[:4] = a[-4:] = 2
        rows.append((k, h, w, 3, bytearray(a.tobytes()), (1, -2, 4, 6)))
    df = spark.createDataFrame(rows, "path long, height int, width int, channels int, data binary, box struct<x:int,y:int,w:int,h:int>")
    got = {r["path"]: r for r in metrics.picture_metrics(df, box="box").collect()}
    long = raster.long_pixels(df.withColumn("path", F.col("path").cast("string"))).withColumn("img_id", F.col("path").cast("long"))
    ends = df.select(F.col("path").alias("img_id"), F.lit(1).alias("x0"), F.lit(-2).alias("y0"), F.lit(5).alias("x1"), F.lit(4).alias("y1"))
    sizes = df.select(F.col("path").alias("img_id"), "width", "height")
    for table in (pixels.sharpness(long), pixels.exposure(long), pixels.contrast(long), pixels.colorfulness(long), pixels.noise(long), pixels.letterbox(long, sizes), pixels.face_sharpness(long, ends)):
        name = table.columns[1]
        for r in table.collect():
            assert got[r["img_id"]][name] == pytest.approx(r[name], abs=1e-9), (name, r)
    empty = spark.createDataFrame([(1, None, None, None, None)], "path long, height int, width int, channels int, data binary")
    assert metrics.picture_metrics(empty).first()["sharpness"] is None and metrics.picture_metrics(empty.limit(0)).count() == 0


def test_failing_calls(spark):
    tries = []

    def shaky(*args):
        tries.append(args)
        if len(tries) < 3:
            raise OSError("busy")
        return "yes"

    assert providers.persistent(shaky, pause=0)() == "yes" and len(tries) == 3
    assert providers.persistent(lambda: 1 / 0, pause=0)() is None

    def answer(key, picture):
        if key == "b":
            raise OSError("down")
        return "MULTIPLE_PEOPLE Outdoor SUNGLASSES"

    rows = spark.createDataFrame([("a", "x"), ("b", "x"), ("a", "x")], "path string, picture string")
    got = {r["path"]: tuple(r)[1:5] for r in providers.verdicts(rows, answer, pause=0).collect()}
    assert got == {"a": (False, "Outdoor", True, False), "b": (True, "Indoor", False, False)}
    told = providers.provider(lambda stem, prompt, t: f"{stem} {t:.1f}", pause=0)(spark.createDataFrame([("s", "p", 0.2)], "stem string, prompt string, temperature double"))
    assert told.first()["content"] == "s 0.2"


def test_cut_off_files(spark):
    whole = raster.png(np.zeros((3, 3, 3), "u1"))
    riff = b"RIFF" + (20).to_bytes(4, "little") + b"WEBP" + b"x" * 16
    files = {"a": whole, "b": whole[:-20], "c": riff, "d": riff[:-1], "e": b"\xff\xd8\xff..\xff\xd9", "f": b"\xff\xd8\xff..", "g": b"", "h": b"text"}
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in files.items()], "k string, content binary")
    assert {r["k"] for r in df.where(images.intact(F.col("content"))).collect()} == {"a", "c", "e"}
