"""Pixel queries that join: nothing is broadcast, pixels stay where they are made, odd keys agree with SQL."""

import duckdb
import pytest

from framewright.functions import pixels
from framewright.plans import catalogue


def joined(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def odd_parts(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame([(k,) for k in (None, -7, -5, 0, 5, 11, 123456789)], "p_partkey long").write.parquet(f"{folder}/part.parquet")
    return folder


def agrees(spark, folder, name):
    df = catalogue.queries()[name](spark, folder)
    with duckdb.connect() as con:
        con.execute(f"create view part as select * from '{folder}/part.parquet/*.parquet'")
        want = con.execute(catalogue.oracle_sql()[name]).fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    plan = joined(df)
    assert "Broadcast" not in plan, plan
    assert all("hashpartitioning(img_id" in line and "REPARTITION_BY_NUM" in line for line in plan.splitlines() if "Exchange" in line), plan


def test_face_sharpness_moves_no_pixels(spark, odd_parts):
    agrees(spark, odd_parts, "pixel_face_sharpness")


def test_face_sharpness_broadcasts_no_pixels(spark):
    long = spark.createDataFrame([(i, y, x, 1, 2, x * y) for i in range(2) for y in range(4) for x in range(4)], "img_id long, y int, x int, b int, g int, r int")
    boxes = spark.createDataFrame([(0, 0, 0, 4, 4), (2, 0, 0, 4, 4)], "img_id long, x0 int, y0 int, x1 int, y1 int")
    df = pixels.face_sharpness(long, boxes)
    assert {r["img_id"]: r["face_sharpness"] > 0 for r in df.collect()} == {0: True, 2: False}
    assert "Broadcast" not in joined(df)


def test_pictures_are_split_by_their_number(spark, tmp_path, monkeypatch):
    spark.range(61).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    assert catalogue.picture_keys(spark, str(tmp_path)).rdd.getNumPartitions() == 3 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(catalogue, "PICTURES_A_TASK", 2)
    assert catalogue.picture_keys(spark, str(tmp_path)).rdd.getNumPartitions() == 31


def test_sunglasses_move_no_pixels(spark, odd_parts):
    agrees(spark, odd_parts, "sunglasses_patches")


def test_eye_patches_broadcast_no_pixels(spark):
    shade = lambda y: 20 if y < 7 else 200
    long = spark.createDataFrame([(i, y, x, *[shade(y) if i else 200] * 3) for i in range(2) for y in range(12) for x in range(12)], "img_id long, y int, x int, b int, g int, r int")
    eyes = spark.createDataFrame([(i, 2, 4, 10, 4, 6, 7) for i in range(3)], "img_id long, rx int, ry int, lx int, ly int, nx int, ny int")
    df = pixels.eye_patches(long, eyes)
    assert {r["img_id"]: r["has_sunglasses"] for r in df.collect()} == {0: False, 1: True, 2: False}
    assert "Broadcast" not in joined(df)
