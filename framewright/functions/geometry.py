"""Geometry of faces, hands, crops and text boxes as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits of the face, hand, framing and export rules.
MAX_DETECTION = 4000
CANONICAL = 1024
TARGET_AREA = 1024 * 1024
EDGE = 0.02
MARGIN = 0.15
PAD = 5


def whole(x: Column) -> Column:
    """Cut towards zero."""
    return x.cast("int")


def detection_size(width: Column, height: Column) -> Column:
    """struct<w, h> of a picture scaled to at most 4000 on its longer side for detection."""
    longest = F.greatest(width, height)
    scale = F.lit(float(MAX_DETECTION)) / longest
    return F.struct(
        F.when(longest > MAX_DETECTION, whole(width * scale)).otherwise(width).alias("w"),
        F.when(longest > MAX_DETECTION, whole(height * scale)).otherwise(height).alias("h"),
    )


def native_box(rel: Column, width: Column, height: Column) -> Column:
    """Relative box struct<x, y, w, h> in whole native pixels."""
    return F.struct(*[whole(rel[c] * (width if c in "xw" else height)).alias(c) for c in "xywh"])


def composition_class(box: Column, width: Column, height: Column) -> Column:
    """close-up from 4 % face area, medium from 2.5 %, else full-body; null without a face or area."""
    ratio = F.try_divide((box["w"].cast("long") * box["h"]).cast("double"), (width.cast("long") * height).cast("double"))
    return F.when(ratio >= 0.040, "close-up").when(ratio >= 0.025, "medium").when(ratio.isNotNull(), "full-body")


def head_pose(right_eye_x: Column, left_eye_x: Column, nose_x: Column) -> Column:
    right, left = F.abs(nose_x - right_eye_x), F.abs(nose_x - left_eye_x)
    span = right + left
    ratio = F.try_divide(right, span)
    return (
        F.when(F.coalesce(span <= 1e-5, F.lit(True)), "frontal")
        .when((ratio < 0.25) | (ratio > 0.75), "profile")
        .when(ratio < 0.40, "three-quarter-right")
        .when(ratio > 0.60, "three-quarter-left")
        .otherwise("frontal")
    )


def face_accepted(faces: Column) -> Column:
    """Whether exactly one plausible upright face was found.

    ``faces`` is array<struct<score, y, keypoints: array<struct<x, y>>>> with the
    order right eye, left eye, nose, mouth. Null (no detector) is refused.
    """
    face = F.try_element_at(faces, F.lit(1))
    points = face["keypoints"]
    re, le, nose, mouth = (F.try_element_at(points, F.lit(i)) for i in (1, 2, 3, 4))
    eyes = (re["y"] + le["y"]) * 0.5
    good = (
        (F.size(faces) == 1)
        & (F.coalesce(face["score"], F.lit(0.0)) >= 0.65)
        & (face["y"] <= 0.48)
        & (F.size(points) >= 4)
        & (F.hypot(le["x"] - re["x"], le["y"] - re["y"]) >= 0.040)
        & (mouth["y"] > eyes + 0.025)
        & (nose["y"] >= eyes - 0.03)
        & (nose["y"] <= mouth["y"] + 0.03)
    )
    return F.coalesce(good, F.lit(False))


def hand_facts(hands: Column) -> Column:
    """struct<hand_count, hands_truncated, hand_status> of array<array<struct<x, y>>> (21 landmarks a hand)."""

    def inside(p: Column) -> Column:
        return (p["x"] > EDGE) & (p["x"] < 1 - EDGE) & (p["y"] > EDGE) & (p["y"] < 1 - EDGE)

    def cut(hand: Column) -> Column:
        tips = F.array(*[F.try_element_at(hand, F.lit(i + 1)) for i in (4, 8, 12, 16, 20)])
        return inside(F.try_element_at(hand, F.lit(1))) & F.exists(tips, lambda p: ~inside(p))

    count = F.coalesce(F.size(hands), F.lit(0))
    truncated = F.coalesce(F.exists(hands, cut), F.lit(False))
    status = F.when(count == 0, F.lit(None)).when(truncated, "hands partially cropped at image edge").otherwise(F.concat(count.cast("string"), F.lit(" hands visible")))
    return F.struct(F.greatest(count, F.lit(0)).alias("hand_count"), ((count > 0) & truncated).alias("hands_truncated"), status.alias("hand_status"))


def canonical_size(width: Column, height: Column) -> Column:
    """struct<w, h, scale>: longer side at most 1024, halves rounded to even."""
    longest = F.greatest(width, height)
    scale = F.when(longest > CANONICAL, F.lit(float(CANONICAL)) / longest).otherwise(F.lit(1.0))
    side = lambda x: F.greatest(F.lit(1), F.bround(x * scale).cast("int"))
    return F.struct(side(width).alias("w"), side(height).alias("h"), scale.alias("scale"))


def aspect_bucket(width: Column, height: Column) -> Column:
    """struct<w, h>: about 1024 * 1024 pixels at the same aspect, sides multiples of 64, never enlarged first."""
    area = width.cast("long") * height
    new_h = whole(F.sqrt(F.lit(float(TARGET_AREA)) / F.try_divide(width.cast("double"), height.cast("double"))))
    new_w = whole(new_h * F.try_divide(width.cast("double"), height.cast("double")))
    snap = lambda x: F.greatest(F.lit(64), (F.bround(x / 64.0) * 64).cast("int"))
    large = area > TARGET_AREA
    return F.struct(snap(F.when(large, new_w).otherwise(width)).alias("w"), snap(F.when(large, new_h).otherwise(height)).alias("h"))


def square_crop(width: Column, height: Column, box: Column) -> Column:
    """struct<w, h, x, y>: size after scaling the shorter side to 1024, and the corner of the 1024 square.

    Wide pictures are cut around the face, tall ones so that the face's middle is 35 %
    down; without a face the middle is kept.
    """
    wide = height < width
    scale = F.lit(1024.0) / F.when(wide, height).otherwise(width)
    w = F.when(wide, F.bround(width * scale).cast("int")).otherwise(F.lit(1024))
    h = F.when(wide, F.lit(1024)).otherwise(F.bround(height * scale).cast("int"))
    face = box.isNotNull()
    cx = F.when(face, (box["x"] + box["w"] / 2.0) * scale).otherwise(w / 2.0)
    cy = F.when(face, (box["y"] + box["h"] / 2.0) * scale).otherwise(h / 2.0)
    x = F.when(w > 1024, F.greatest(F.lit(0), F.least(w - 1024, whole(cx - 512.0)))).otherwise(0)
    down = F.when(face, whole(cy - 1024 * 0.35)).otherwise(whole(cy - 512.0))
    y = F.when((w <= 1024) & (h > 1024), F.greatest(F.lit(0), F.least(h - 1024, down))).otherwise(0)
    return F.struct(w.alias("w"), h.alias("h"), x.alias("x"), y.alias("y"))


def is_watermark(box: Column) -> Column:
    """Text that was read with some certainty and has two characters or more."""
    return F.coalesce((box["prob"] > 0.3) & (F.length(F.trim(box["text"])) >= 2), F.lit(False))


def blur_boxes(boxes: Column, width: Column, height: Column) -> Column:
    """array<struct<x0, y0, x1, y1>> to blur: watermark boxes in the top or bottom 15 %, clamped to the margin and padded.

    Boxes are in picture coordinates. A box belongs to the margin that holds its middle.
    Boxes of no area after clamping are left out; null boxes give an empty array.
    """
    margin = whole(height * MARGIN)

    def place(b: Column) -> Column:
        xs, ys = F.transform(b["poly"], lambda p: p["x"]), F.transform(b["poly"], lambda p: p["y"])
        low, high = whole(F.array_min(ys)), whole(F.array_max(ys))
        top = (F.array_min(ys) + F.array_max(ys)) / 2.0 < margin
        first = F.when(top, F.lit(0)).otherwise(height - margin)
        last = F.when(top, margin).otherwise(height)
        x0 = F.greatest(F.lit(0), F.greatest(F.lit(0), whole(F.array_min(xs))) - PAD)
        x1 = F.least(width, F.least(width, whole(F.array_max(xs))) + PAD)
        y0 = F.greatest(first, F.greatest(first, low) - PAD)
        y1 = F.least(last, F.least(last, high) + PAD)
        return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))

    def in_margin(b: Column) -> Column:
        ys = F.transform(b["poly"], lambda p: p["y"])
        middle = (F.array_min(ys) + F.array_max(ys)) / 2.0
        return F.coalesce((middle < margin) | (middle >= height - margin), F.lit(False))

    hits = F.filter(F.coalesce(boxes, F.array().cast("array<struct<poly:array<struct<x:double,y:double>>,text:string,prob:double>>")), lambda b: is_watermark(b) & in_margin(b))
    return F.filter(F.transform(hits, place), lambda r: (r["x1"] > r["x0"]) & (r["y1"] > r["y0"]))
