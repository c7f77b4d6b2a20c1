"""Audits of captions that arrive as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.operators.captions import audit


def audited_stream(stream: DataFrame, caption: str, trigger: Column) -> DataFrame:
    """The stream with ``violations`` and ``passed``; stateless, so late rows need no watermark."""
    return audit(stream, caption, trigger)


def pass_rates(stream: DataFrame, caption: str, trigger: Column, at: str, window: str = "1 day", late: str = "7 days") -> DataFrame:
    """``window_start``, ``total`` and ``passed_count`` per window of event time; rows later than ``late`` are dropped."""
    rows = audit(stream, caption, trigger).withColumn("__at", F.col(at).cast("timestamp")).withWatermark("__at", late)
    counts = rows.groupBy(F.window("__at", window).alias("w")).agg(F.count("*").alias("total"), F.count_if("passed").alias("passed_count"))
    return counts.select(F.col("w.start").alias("window_start"), "total", "passed_count")
