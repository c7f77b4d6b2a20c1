"""Export plan: names, formats, sizes, crops and blur boxes of the selected pictures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions import geometry
from framewright.operators.filters import with_order

FORMATS = {"jpg": ("JPEG", ".jpg"), "png": ("PNG", ".png"), "webp": ("WEBP", ".webp")}


def suffix(path: Column) -> Column:
    """Lower-case suffix with its dot, '' without one."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.lower(F.regexp_extract(name, r"(?U)^.+(\.[^.]*)$", 1))


def output_format(path: Column, wanted: str = "jpg") -> Column:
    """struct<format, ext, discouraged>: the wanted format, or the source's with 'preserve'; unknown ones become JPEG."""
    if wanted != "preserve":
        name, ext = FORMATS.get(wanted, FORMATS["jpg"])
        return F.struct(F.lit(name).alias("format"), F.lit(ext).alias("ext"), F.lit(name == "WEBP").alias("discouraged"))
    end = suffix(path)
    name = F.when(end == ".png", "PNG").when(end == ".webp", "WEBP").otherwise("JPEG")
    ext = F.when(end == ".png", ".png").when(end == ".webp", ".webp").otherwise(".jpg")
    return F.struct(name.alias("format"), ext.alias("ext"), F.coalesce(end == ".webp", F.lit(False)).alias("discouraged"))


def export_plan(selected: DataFrame, boxes: DataFrame, trigger: str, wanted: str = "jpg", preserve_aspect_ratio: bool = True, drop_watermarked: bool = False, order: str = "seat") -> DataFrame:
    """What to write for each readable picture: ``out_name``, size, crop and blur boxes.

    ``selected`` has ``path``, ``width``, ``height``, ``face_box`` and a unique ``order``; pictures without a
    size are unreadable and left out. Numbers run over the rows that remain, so they have no gaps.
    """
    rows = selected.where("width > 0 and height > 0").join(boxes.dropDuplicates(["path"]).select("path", "boxes"), "path", "left")
    rows = rows.withColumn("blur", geometry.blur_boxes(F.col("boxes"), F.col("width"), F.col("height"))).drop("boxes")
    if drop_watermarked:
        rows = rows.where(F.size("blur") == 0)
    rows = with_order(rows, [order], "__n")
    form = output_format(F.col("path"), wanted)
    number = (F.col("__n") + 1).cast("string")
    name = F.concat(F.lit(f"{trigger}_"), F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number), form["ext"])
    size = geometry.aspect_bucket(F.col("width"), F.col("height")) if preserve_aspect_ratio else geometry.square_crop(F.col("width"), F.col("height"), F.col("face_box"))
    return rows.select("path", name.alias("out_name"), form["format"].alias("format"), size.alias("target"), "blur")
