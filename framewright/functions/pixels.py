"""Pixel metrics on long tables (img_id, y, x, b, g, r): windows for stencils, aggregates for moments.

All of them shuffle once by ``img_id`` (windows over rows and columns of one picture
share that partitioning), so pictures are never gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def grey() -> Column:
    """Luma of a pixel, halves rounded to even."""
    return F.bround(0.299 * F.col("r") + 0.587 * F.col("g") + 0.114 * F.col("b")).cast("int")


def _neighbour(value: str, axis: str, other: str, step: int) -> Column:
    w = Window.partitionBy("img_id", other).orderBy(axis)
    return F.lead(value, step).over(w) if step > 0 else F.lag(value, -step).over(w)


def laplacian(pixels: DataFrame, value: str = "grey") -> DataFrame:
    """Adds ``lap``: the four neighbours minus four times the pixel; at a border the inner neighbour counts twice (0 if there is none)."""
    out = pixels
    for axis, other in (("x", "y"), ("y", "x")):
        back, ahead = _neighbour(value, axis, other, -1), _neighbour(value, axis, other, 1)
        out = out.withColumn(f"__{axis}", F.coalesce(back, ahead, F.col(value)) + F.coalesce(ahead, back, F.col(value)))
    return out.withColumn("lap", (F.col("__x") + F.col("__y") - 4 * F.col(value)).cast("double")).drop("__x", "__y")


def sharpness(pixels: DataFrame) -> DataFrame:
    """``img_id``, ``sharpness``: population variance of the Laplacian of the grey picture."""
    return laplacian(pixels.withColumn("grey", grey())).groupBy("img_id").agg(F.var_pop("lap").alias("sharpness"))


def face_sharpness(pixels: DataFrame, boxes: DataFrame) -> DataFrame:
    """Sharpness inside a picture's face box (``img_id``, ``x0``, ``y0``, ``x1``, ``y1``, ends excluded); 0 if it is empty.

    The box's left and upper ends are moved to 0 if negative, its other ends stay.
    The stencil's border is that of the box. Joins never broadcast: Spark takes a long table
    for no larger than the table its pictures come from.
    """
    inside = pixels.join(boxes.hint("shuffle_hash"), "img_id").where((F.col("x") >= F.greatest("x0", F.lit(0))) & (F.col("x") < F.col("x1")) & (F.col("y") >= F.greatest("y0", F.lit(0))) & (F.col("y") < F.col("y1")))
    found = sharpness(inside.select("img_id", "y", "x", "b", "g", "r")).withColumnRenamed("sharpness", "face_sharpness")
    return boxes.select("img_id").join(found.hint("shuffle_hash"), "img_id", "left").select("img_id", F.coalesce("face_sharpness", F.lit(0.0)).alias("face_sharpness"))


def exposure(pixels: DataFrame) -> DataFrame:
    """``exposure_score``: share of grey values that are neither below 15 nor from 240 on."""
    off = F.avg(F.when((grey() < 15) | (grey() >= 240), 1.0).otherwise(0.0))
    return pixels.groupBy("img_id").agg(F.greatest(F.lit(0.0), 1.0 - off).alias("exposure_score"))


def contrast(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("img_id").agg(F.stddev_pop(grey().cast("double")).alias("contrast"))


def colorfulness(pixels: DataFrame) -> DataFrame:
    """Spread and mean of the absolute opponent colours."""
    rg = F.abs(F.col("r") - F.col("g")).cast("double")
    yb = F.abs(0.5 * (F.col("r") + F.col("g")) - F.col("b"))
    spread, mean = F.sqrt(F.var_pop(rg) + F.var_pop(yb)), F.sqrt(F.avg(rg) * F.avg(rg) + F.avg(yb) * F.avg(yb))
    return pixels.groupBy("img_id").agg((spread + 0.3 * mean).alias("colorfulness"))


def noise(pixels: DataFrame) -> DataFrame:
    """Mean absolute difference from the median of the 3 x 3 surroundings; borders repeat the edge pixel."""
    rows = pixels.select("img_id", "y", "x", grey().alias("c"))
    rows = rows.withColumn("l", F.coalesce(_neighbour("c", "x", "y", -1), F.col("c"))).withColumn("r", F.coalesce(_neighbour("c", "x", "y", 1), F.col("c")))
    triple = rows.withColumn("t", F.array("l", "c", "r"))
    nine = triple.withColumn("up", F.coalesce(_neighbour("t", "y", "x", -1), F.col("t"))).withColumn("down", F.coalesce(_neighbour("t", "y", "x", 1), F.col("t")))
    median = F.array_sort(F.concat("up", "t", "down"))[4]
    return nine.groupBy("img_id").agg(F.avg(F.abs(F.col("c") - median)).alias("noise"))


def letterbox(pixels: DataFrame, sizes: DataFrame) -> DataFrame:
    """Whether more than half of the outer 4 % of rows, on both ends, or of columns are nearly black.

    ``sizes`` has ``img_id``, ``width``, ``height``. A picture without pixels is not letterboxed.
    """
    level = (F.col("b") + F.col("g") + F.col("r")) / 3.0
    rows = pixels.select("img_id", F.lit("row").alias("axis"), F.col("y").alias("at"), level.alias("level"))
    cols = pixels.select("img_id", F.lit("col").alias("axis"), F.col("x").alias("at"), level.alias("level"))
    lines = rows.unionByName(cols).groupBy("img_id", "axis", "at").agg(F.avg("level").alias("level")).join(sizes, "img_id")
    size = F.when(F.col("axis") == "row", F.col("height")).otherwise(F.col("width"))
    band = F.greatest(F.lit(1), (size * 0.04).cast("int"))
    dark = (F.col("level") < 18).cast("int")
    share = lines.groupBy("img_id", "axis", band.alias("band")).agg(
        F.sum(F.when(F.col("at") < band, dark)).alias("head"), F.sum(F.when(F.col("at") >= size - band, dark)).alias("tail"))
    both = (F.coalesce("head", F.lit(0)) / F.col("band") > 0.5) & (F.coalesce("tail", F.lit(0)) / F.col("band") > 0.5)
    found = share.groupBy("img_id").agg(F.bool_or(both).alias("letterboxed"))
    return sizes.select("img_id").join(found, "img_id", "left").select("img_id", F.coalesce("letterboxed", F.lit(False)).alias("letterboxed"))


def dark_glasses(eye_mean: Column, skin_mean: Column, eye_distance: Column) -> Column:
    """Whether eye patches are dark, and much darker than the skin below them; small or missing faces are not judged."""
    return F.coalesce((eye_distance > 5) & (skin_mean > 50) & (eye_mean < 70) & (F.try_divide(eye_mean, skin_mean) < 0.55), F.lit(False))


def eye_patches(pixels: DataFrame, eyes: DataFrame) -> DataFrame:
    """``img_id``, ``has_sunglasses`` from grey patches around both eyes and below the nose.

    ``eyes`` has pixel positions ``rx, ry, lx, ly, nx, ny``. The patch radius is 22 % of the
    distance between the eyes, at least 2; a patch without pixels means no judgement. Joins
    never broadcast, as in ``face_sharpness``.
    """
    d = F.hypot(F.col("lx") - F.col("rx"), F.col("ly") - F.col("ry"))
    facts = eyes.withColumn("d", d).withColumn("rad", F.greatest(F.lit(2), (d * 0.22).cast("int")))

    def near(cx: str, cy: str) -> Column:
        return (F.col("x") >= F.col(cx) - F.col("rad")) & (F.col("x") < F.col(cx) + F.col("rad")) & (F.col("y") >= F.col(cy) - F.col("rad")) & (F.col("y") < F.col(cy) + F.col("rad"))

    skin = (F.col("y") >= F.col("ny")) & (F.col("y") < F.col("ny") + (F.col("d") * 0.4).cast("int")) & (F.col("x") >= F.col("nx") - F.col("rad")) & (F.col("x") < F.col("nx") + F.col("rad"))
    means = pixels.join(facts.hint("shuffle_hash"), "img_id").groupBy("img_id", "d").agg(*[F.avg(F.when(c, grey())).alias(n) for n, c in (("right", near("rx", "ry")), ("left", near("lx", "ly")), ("skin", skin))])
    judged = means.select("img_id", dark_glasses((F.col("right") + F.col("left")) * 0.5, F.col("skin"), F.col("d")).alias("has_sunglasses"))
    return eyes.select("img_id").join(judged.hint("shuffle_hash"), "img_id", "left").select("img_id", F.coalesce("has_sunglasses", F.lit(False)).alias("has_sunglasses"))
