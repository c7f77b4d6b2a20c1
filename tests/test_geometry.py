"""Sizes, crops, boxes, poses and pixels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.functions import geometry, pixels, vectors


def one(spark, schema, row, column):
    return spark.createDataFrame([row], schema).select(column.alias("r")).first()["r"]


SIZE = "w int, h int"


def test_aspect_bucket(spark):
    got = one(spark, SIZE, (1600, 900), geometry.aspect_bucket(F.col("w"), F.col("h")))
    assert got["w"] % 64 == got["h"] % 64 == 0 and 800_000 < got["w"] * got["h"] < 1_300_000
    assert tuple(one(spark, SIZE, (720, 880), geometry.aspect_bucket(F.col("w"), F.col("h")))) == (704, 896)
    assert tuple(one(spark, SIZE, (10, 10), geometry.aspect_bucket(F.col("w"), F.col("h")))) == (64, 64)


def test_square_crop(spark):
    box = "w int, h int, b struct<x:int,y:int,w:int,h:int>"
    crop = geometry.square_crop(F.col("w"), F.col("h"), F.col("b"))
    assert tuple(one(spark, box, (2048, 1024, (1900, 0, 100, 100)), crop)) == (2048, 1024, 1024, 0)
    assert tuple(one(spark, box, (2048, 1024, None), crop)) == (2048, 1024, 512, 0)
    assert tuple(one(spark, box, (1024, 2048, (0, 1000, 100, 100)), crop)) == (1024, 2048, 0, int(1050 - 1024 * 0.35))


def test_canonical_and_detection_size(spark):
    assert tuple(one(spark, SIZE, (4000, 3000), geometry.canonical_size(F.col("w"), F.col("h"))))[:2] == (1024, 768)
    assert tuple(one(spark, SIZE, (100, 50), geometry.canonical_size(F.col("w"), F.col("h")))) == (100, 50, 1.0)
    assert tuple(one(spark, SIZE, (8000, 3001), geometry.detection_size(F.col("w"), F.col("h")))) == (4000, 1500)


@pytest.mark.parametrize(("side", "name"), [(21, "close-up"), (16, "medium"), (10, "full-body")])
def test_composition(spark, side, name):
    assert one(spark, "s int", (side,), geometry.composition_class(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.col("s").alias("w"), F.col("s").alias("h")), F.lit(100), F.lit(100))) == name


def test_composition_without_area(spark):
    box = F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(5).alias("w"), F.lit(5).alias("h"))
    assert one(spark, SIZE, (0, 0), geometry.composition_class(box, F.col("w"), F.col("h"))) is None


@pytest.mark.parametrize(("r", "l", "n", "pose"), [(0.4, 0.6, 0.5, "frontal"), (0.4, 0.6, 0.42, "profile"), (0.4, 0.6, 0.47, "three-quarter-right"), (0.4, 0.6, 0.53, "three-quarter-left"), (0.5, 0.5, 0.5, "frontal")])
def test_head_pose(spark, r, l, n, pose):  # noqa: E741
    assert one(spark, "r double, l double, n double", (r, l, n), geometry.head_pose(F.col("r"), F.col("l"), F.col("n"))) == pose


def test_hands(spark):
    inside, edge = [(0.5, 0.5)] * 21, [(0.5, 0.5)] * 20 + [(0.99, 0.5)]
    schema = "h array<array<struct<x:double,y:double>>>"
    facts = geometry.hand_facts(F.col("h"))
    assert tuple(one(spark, schema, ([inside, inside],), facts)) == (2, False, "2 hands visible")
    assert tuple(one(spark, schema, ([edge],), facts)) == (1, True, "hands partially cropped at image edge")
    assert tuple(one(spark, schema, ([],), facts)) == tuple(one(spark, schema, (None,), facts)) == (0, False, None)


def test_faces(spark):
    schema = "f array<struct<score:double,y:double,keypoints:array<struct<x:double,y:double>>>>"
    points = [(0.45, 0.3), (0.55, 0.3), (0.5, 0.35), (0.5, 0.4)]
    accepted = geometry.face_accepted(F.col("f"))
    assert one(spark, schema, ([(0.9, 0.2, points)],), accepted)
    for bad in ([(0.5, 0.2, points)], [(0.9, 0.5, points)], [(0.9, 0.2, points[:3])], [(0.9, 0.2, points)] * 2, [], None, [(None, 0.2, points)]):
        assert not one(spark, schema, (bad,), accepted)


def test_blur_boxes(spark):
    schema = "b array<struct<poly:array<struct<x:double,y:double>>,text:string,prob:double>>"
    square = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    rows = [(square(10.0, 2.0, 10.0), "logo", 0.9), (square(10.0, 50.0, 10.0), "middle", 0.9), (square(90.0, 95.0, 30.0), "low", 0.9), (square(0.0, 0.0, 5.0), " ", 0.9), (square(0.0, 0.0, 5.0), "dim", 0.2)]
    got = one(spark, schema, (rows,), geometry.blur_boxes(F.col("b"), F.lit(100), F.lit(100)))
    assert [tuple(r) for r in got] == [(5, 0, 25, 15), (85, 90, 100, 100)]
    assert one(spark, schema, (None,), geometry.blur_boxes(F.col("b"), F.lit(100), F.lit(100))) == []


def test_cosine_distance(spark):
    schema = "a array<float>, b array<float>"
    d = vectors.cosine_distance(F.col("a"), F.col("b"))
    assert one(spark, schema, ([1.0, 0.0], [0.0, 2.0]), d) == 1.0
    assert one(spark, schema, ([0.0, 0.0], [0.0, 2.0]), d) == 1.0
    assert one(spark, schema, ([1.0, 1.0], [3.0, 3.0]), d) == pytest.approx(0, abs=1e-12)
    for bad in ([1.0], None, [float("nan"), 1.0], [float("inf"), 1.0]):
        assert not one(spark, schema, (bad, bad), vectors.usable(F.col("a"), 2))


def long_pixels(spark, arrays):
    rows = [(i, y, x, *map(int, a[y, x])) for i, a in enumerate(arrays) for y in range(a.shape[0]) for x in range(a.shape[1])]
    return spark.createDataFrame(rows, "img_id long, y int, x int, b int, g int, r int")


def reflected_laplacian(gray):
    p = np.pad(gray.astype(float), 1, mode="reflect")
    return p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * gray


def median_noise(gray):
    p = np.pad(gray, 1, mode="edge")
    stack = np.stack([p[i : i + gray.shape[0], j : j + gray.shape[1]] for i in range(3) for j in range(3)])
    return np.abs(gray - np.median(stack, axis=0)).mean()


def test_pixel_metrics(spark):
    rng = np.random.default_rng(0)
    arrays = [rng.integers(0, 256, (7, 9, 3)), np.full((6, 6, 3), 128)]
    df = long_pixels(spark, arrays)
    luma = [np.round(0.299 * a[..., 2] + 0.587 * a[..., 1] + 0.114 * a[..., 0]) for a in arrays]

    def values(frame, column):
        return [r[column] for r in frame.orderBy("img_id").collect()]

    assert values(pixels.sharpness(df), "sharpness") == pytest.approx([reflected_laplacian(g).var() for g in luma])
    assert values(pixels.contrast(df), "contrast") == pytest.approx([g.std() for g in luma])
    assert values(pixels.noise(df), "noise") == pytest.approx([median_noise(g) for g in luma])
    assert values(pixels.exposure(df), "exposure_score") == pytest.approx([1 - ((g < 15) | (g >= 240)).mean() for g in luma])
    assert values(pixels.colorfulness(df), "colorfulness")[1] == 0 < values(pixels.colorfulness(df), "colorfulness")[0]
    boxes = spark.createDataFrame([(0, -1, 1, 5, 6), (1, 6, 6, 9, 9)], "img_id long, x0 int, y0 int, x1 int, y1 int")
    assert values(pixels.face_sharpness(df, boxes), "face_sharpness") == pytest.approx([reflected_laplacian(luma[0][1:6, 0:5]).var(), 0.0])


def test_letterbox(spark):
    clean, bars, pillars = (np.full((100, 100, 3), 150) for _ in range(3))
    bars[:8] = bars[-8:] = 0
    pillars[:, :8] = pillars[:, -8:] = 0
    df = long_pixels(spark, [clean, bars, pillars])
    sizes = spark.createDataFrame([(i, 100, 100) for i in range(4)], "img_id long, width int, height int")
    assert [r["letterboxed"] for r in pixels.letterbox(df, sizes).orderBy("img_id").collect()] == [False, True, True, False]
