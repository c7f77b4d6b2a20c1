"""The candidate record: one row per picture, nullable where a detector may not have spoken."""

from __future__ import annotations

from pyspark.sql import types as T

FACE_BOX = T.StructType([T.StructField(c, T.IntegerType()) for c in ("x", "y", "w", "h")])
POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
OCR_BOXES = T.ArrayType(T.StructType([T.StructField("poly", T.ArrayType(POINT)), T.StructField("text", T.StringType()), T.StructField("prob", T.DoubleType())]))

#: Metrics that a detector, a scorer or a model fills in; the key is ``path``, ``ord`` is the scan order.
RECORD = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("ord", T.LongType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("face_box", FACE_BOX),
        T.StructField("composition", T.StringType()),
        T.StructField("sharpness", T.DoubleType()),
        T.StructField("exposure_score", T.DoubleType()),
        T.StructField("face_sharpness", T.DoubleType()),
        T.StructField("contrast", T.DoubleType()),
        T.StructField("colorfulness", T.DoubleType()),
        T.StructField("noise", T.DoubleType()),
        T.StructField("hand_count", T.IntegerType()),
        T.StructField("hands_truncated", T.BooleanType()),
        T.StructField("hand_status", T.StringType()),
        T.StructField("total_score", T.DoubleType()),
        T.StructField("lighting_condition", T.StringType()),
        T.StructField("feature_vector", T.ArrayType(T.FloatType())),
        T.StructField("captured_at", T.TimestampNTZType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("head_pose", T.StringType()),
        T.StructField("has_sunglasses", T.BooleanType()),
        T.StructField("has_face_occlusion", T.BooleanType()),
    ]
)

COMPOSITIONS = ("close-up", "medium", "full-body")
