"""Row filters of the first pass and of the era window."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions import geometry


def large_enough(width: Column, height: Column, least: int = 1024) -> Column:
    return F.coalesce(F.least(width, height) >= least, F.lit(False))


def first_pass(candidates: DataFrame, least: int = 1024) -> DataFrame:
    """Accepted candidates with box, composition, hands and pose.

    ``candidates`` has ``path``, ``width``, ``height``, ``letterboxed``, and the detectors'
    tables joined on: ``faces`` (array<struct<score, x, y, w, h, keypoints>>, relative) and
    ``hands`` (array<array<point>>). The cheap conditions come first; a null detector result
    refuses the picture. Other columns are kept.
    """
    rows = candidates.where(large_enough(F.col("width"), F.col("height"), least) & ~F.coalesce("letterboxed", F.lit(False)))
    rows = rows.where(geometry.face_accepted(F.col("faces")))
    face = F.try_element_at("faces", F.lit(1))
    points = face["keypoints"]
    rows = rows.withColumn("face_box", geometry.native_box(face, F.col("width"), F.col("height")))
    rows = rows.where("face_box.w > 0 and face_box.h > 0")
    pose = geometry.head_pose(*[F.try_element_at(points, F.lit(i))["x"] for i in (1, 2, 3)])
    facts = geometry.hand_facts(F.col("hands"))
    return rows.withColumn("composition", geometry.composition_class(F.col("face_box"), F.col("width"), F.col("height"))).withColumn("head_pose", pose).select("*", facts["hand_count"].alias("hand_count"), facts["hands_truncated"].alias("hands_truncated"), facts["hand_status"].alias("hand_status"))


def rejection(candidates: DataFrame, least: int = 1024) -> DataFrame:
    """``path`` and ``reason``: the first rule of the first pass that refuses a picture, null if none does."""
    face = F.try_element_at("faces", F.lit(1))
    points = face["keypoints"]
    box = geometry.native_box(face, F.col("width"), F.col("height"))
    small = ~large_enough(F.col("width"), F.col("height"), least)
    reason = (
        F.when(F.col("width").isNull() | F.col("height").isNull(), "unreadable")
        .when(small, "resolution")
        .when(F.coalesce("letterboxed", F.lit(False)), "letterbox")
        .when(F.coalesce(F.size("faces"), F.lit(0)) != 1, "not one face")
        .when(F.coalesce(face["score"], F.lit(0.0)) < 0.65, "uncertain face")
        .when(face["y"] > 0.48, "face too low")
        .when(F.coalesce(F.size(points), F.lit(0)) < 4, "missing keypoints")
        .when(~geometry.face_accepted(F.col("faces")), "implausible face")
        .when(~F.coalesce((box["w"] > 0) & (box["h"] > 0), F.lit(False)), "empty face box")
    )
    return candidates.select("path", reason.alias("reason"))


def require_survivors(records: DataFrame, wanted: int = 30) -> tuple[int, bool]:
    """Number of records and whether it is below ``wanted``; raises if there are none."""
    n = records.count()
    if n == 0:
        raise TooFewImages("no image passed")
    return n, n < wanted


def parse_era(window: str | None) -> tuple[int, int] | None:
    """First and last year of ``YYYY`` or ``YYYY-YYYY``; None for no window, 'all' or anything else."""
    found = re.fullmatch(r"\s*(\d{4})(?:\s*-\s*(\d{4}))?\s*", window or "")
    return (int(found[1]), int(found[2] or found[1])) if found else None


def era_window(records: DataFrame, window: str | None, year: str = "year") -> DataFrame:
    """Rows whose year lies in the window, both ends included; null years are outside.

    If no row lies inside, or the window cannot be read, all rows come back. Whether
    any row lies inside is one global count, broadcast as a single row.
    """
    era = parse_era(window)
    if era is None:
        return records
    inside = F.coalesce(F.col(year).between(*era), F.lit(False))
    any_row = records.agg(F.coalesce(F.bool_or(inside), F.lit(False)).alias("__any"))
    return records.crossJoin(F.broadcast(any_row)).where(inside | ~F.col("__any")).drop("__any")


class TooFewImages(ValueError):
    """The input cannot give the wanted number of pictures."""


def require_images(images: DataFrame, target: int) -> int:
    """Number of pictures; raises if there are none or fewer than one and a half times the target."""
    n = images.count()
    if n == 0:
        raise TooFewImages("no images found")
    if n < int(target * 1.5):
        raise TooFewImages(f"{n} images are too few for {target}")
    return n


def distinct_paths(images: DataFrame) -> DataFrame:
    """One row per path with its place ``ord`` from 0 in path order.

    The place is needed for ties only. It is made without a global window: rows are
    range-partitioned by path, and each partition's offset is the size of those before it.
    """
    rows = images.dropDuplicates(["path"])
    return with_order(rows, ["path"])


def with_order(rows: DataFrame, keys: list[str], name: str = "ord") -> DataFrame:
    """Adds the place from 0 in the order of ``keys`` (unique), by range partitions and their counts.

    The ranges come from a sample, so they must be drawn once: ranged rows are written to the
    shared folder before they are counted and numbered.
    """
    from pyspark.sql import Window

    from framewright.storage import materialize

    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = rows.repartitionByRange(parts, *keys).withColumn("__part", F.spark_partition_id())
    ranged = materialize(ranged, "ordered")
    sizes = {r["__part"]: r["n"] for r in ranged.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    offsets, before = [], 0
    for part in sorted(sizes):
        offsets.append((part, before))
        before += sizes[part]
    table = F.broadcast(spark.createDataFrame(offsets, "__part int, __before long"))
    inside = Window.partitionBy("__part").orderBy(*keys)
    return ranged.join(table, "__part").withColumn(name, F.col("__before") + F.row_number().over(inside) - 1).drop("__part", "__before")
