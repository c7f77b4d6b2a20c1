"""Pixels of files: decoding, scaling by area, blurring, PNG writing.

Decoding uses Spark's image source (the JVM's decoders: JPEG, PNG, BMP, GIF; WebP needs another
table of pixels). Scaling and blurring are numpy in Arrow batches, one picture at a time.
"""

from __future__ import annotations

import base64
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLUR_SIGMA = 15
THUMBNAIL = 1024


def decoded(spark: SparkSession, folder: str) -> DataFrame:
    """``path``, ``height``, ``width``, ``channels`` and ``data`` (rows of B, G, R) of the pictures that can be read."""
    rows = spark.read.format("image").option("dropInvalid", "true").load(folder).select("image.*")
    return rows.select(F.col("origin").alias("path"), "height", "width", F.col("nChannels").alias("channels"), "data")


def array_of(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Height x width x 3, B G R; grey is repeated, transparency dropped."""
    a = np.frombuffer(data, "u1").reshape(height, width, channels)
    return np.repeat(a, 3, axis=2) if channels == 1 else a[..., :3]


def long_pixels(pictures: DataFrame) -> DataFrame:
    """``path``, ``y``, ``x``, ``b``, ``g``, ``r``, one row per pixel, for ``functions.pixels`` (with path as img_id)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                a = array_of(row.data, row.height, row.width, row.channels).astype("i4")
                y, x = np.divmod(np.arange(row.height * row.width), row.width)
                yield pd.DataFrame({"path": row.path, "y": y.astype("i4"), "x": x.astype("i4"), "b": a[..., 0].ravel(), "g": a[..., 1].ravel(), "r": a[..., 2].ravel()})

    return pictures.select("path", "height", "width", "channels", "data").mapInPandas(run, "path string, y int, x int, b int, g int, r int")


def _shares(old: int, new: int) -> np.ndarray:
    """new x old matrix: which part of each old cell lies in each new one, as a mean."""
    edge = np.arange(new + 1) * old / new
    cell = np.arange(old)
    cover = np.minimum(edge[1:, None], cell + 1) - np.maximum(edge[:-1, None], cell)
    return np.clip(cover, 0, None) * new / old


def scaled(a: np.ndarray, width: int, height: int) -> np.ndarray:
    """Every new pixel is the mean of the area it covers."""
    if a.shape[:2] == (height, width):
        return a
    rows = np.tensordot(_shares(a.shape[0], height), a.astype("f8"), axes=(1, 0))
    return np.rint(np.einsum("wx,hxc->hwc", _shares(a.shape[1], width), rows)).clip(0, 255).astype("u1")


def blurred(a: np.ndarray, boxes: list) -> np.ndarray:
    """Gaussian blur inside the boxes (x0, y0, x1, y1), borders reflected."""
    out = a.copy()
    reach = 3 * BLUR_SIGMA
    kernel = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2.0 * BLUR_SIGMA**2))
    kernel /= kernel.sum()
    for x0, y0, x1, y1 in boxes:
        part = out[y0:y1, x0:x1].astype("f8")
        if part.size:
            for axis in (0, 1):
                width = [(0, 0)] * 3
                width[axis] = (reach, reach)
                part = np.apply_along_axis(lambda v: np.convolve(v, kernel, "valid"), axis, np.pad(part, width, mode="symmetric"))
            out[y0:y1, x0:x1] = np.rint(part).clip(0, 255).astype("u1")
    return out


def png(a: np.ndarray) -> bytes:
    """A PNG file of a B G R array."""
    height, width = a.shape[:2]
    lines = np.concatenate([np.zeros((height, 1), "u1"), a[..., ::-1].reshape(height, -1)], axis=1).tobytes()

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def thumbnail(a: np.ndarray) -> str:
    """Base64 of the picture as PNG, fitted into 1024 x 1024 without enlarging."""
    scale = min(1.0, THUMBNAIL / max(a.shape[:2]))
    return base64.b64encode(png(scaled(a, max(1, int(a.shape[1] * scale)), max(1, int(a.shape[0] * scale))))).decode()


def thumbnails(pictures: DataFrame) -> DataFrame:
    """``path`` and ``picture`` (base64 PNG) for a model that is asked about the pictures."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "picture": [thumbnail(array_of(r.data, r.height, r.width, r.channels)) for r in pdf.itertuples()]})

    return pictures.select("path", "height", "width", "channels", "data").mapInPandas(run, "path string, picture string")


def rendered(pictures: DataFrame, plan: DataFrame) -> DataFrame:
    """``out_name`` and ``content`` (PNG) of the export plan's pictures, blurred, scaled and cut.

    ``plan`` comes from ``export.export_plan``; a square crop's target has a corner ``x``, ``y``. Names
    end in ``.png`` whatever the plan's format, as only PNG can be written without an image library.
    """
    square = "x" in plan.schema["target"].dataType.fieldNames()
    rows = pictures.join(plan, "path").select("out_name", "height", "width", "channels", "data", "blur", F.struct("target.w", "target.h", *(["target.x", "target.y"] if square else [])).alias("target"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            names, files = [], []
            for r in pdf.itertuples():
                a = blurred(array_of(r.data, r.height, r.width, r.channels), [(b["x0"], b["y0"], b["x1"], b["y1"]) for b in r.blur])
                a = scaled(a, r.target["w"], r.target["h"])
                if square:
                    a = scaled(a[r.target["y"] : r.target["y"] + 1024, r.target["x"] : r.target["x"] + 1024], 1024, 1024)
                names.append(r.out_name.rsplit(".", 1)[0] + ".png")
                files.append(png(a))
            yield pd.DataFrame({"out_name": names, "content": files})

    return rows.mapInPandas(run, "out_name string, content binary")
