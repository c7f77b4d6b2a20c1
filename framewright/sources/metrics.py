"""All pixel metrics of a picture in one Arrow pass: one row a picture, no shuffle.

The same values as the long-form queries of ``functions.pixels``, for whole files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.sources.raster import array_of, scaled

CANONICAL = 1024
COLUMNS = "sharpness double, face_sharpness double, exposure_score double, contrast double, colorfulness double, noise double, letterboxed boolean"


def grey(a: np.ndarray) -> np.ndarray:
    """Luma of a B G R array, halves rounded to even."""
    b, g, r = (a[..., i].astype("f8") for i in range(3))
    return np.rint(0.299 * r + 0.587 * g + 0.114 * b).astype("i4")


def sharpness(c: np.ndarray) -> float:
    """Population variance of the Laplacian; 0 for an empty part. At a border the inner neighbour counts twice."""
    if not c.size:
        return 0.0
    lap = -4 * c
    for axis in (0, 1):
        wide = np.pad(c, [(1, 1) if k == axis else (0, 0) for k in (0, 1)], mode="reflect" if c.shape[axis] > 1 else "edge")
        n = c.shape[axis]
        lap = lap + np.take(wide, range(n), axis) + np.take(wide, range(2, n + 2), axis)
    return float(lap.astype("f8").var())


def noise(c: np.ndarray) -> float:
    """Mean absolute difference from the median of the 3 x 3 surroundings, line by line to keep memory small."""
    wide, total = np.pad(c, 1, mode="edge"), 0.0
    h, w = c.shape
    for y in range(0, h, 256):
        n = min(256, h - y)
        nine = np.stack([wide[y + i : y + i + n, j : j + w] for i in range(3) for j in range(3)])
        total += float(np.abs(c[y : y + n] - np.partition(nine, 4, axis=0)[4]).sum())
    return total / c.size


def colorfulness(a: np.ndarray) -> float:
    b, g, r = (a[..., i].astype("f8") for i in range(3))
    rg, yb = np.abs(r - g), np.abs(0.5 * (r + g) - b)
    return float(np.sqrt(rg.var() + yb.var()) + 0.3 * np.sqrt(rg.mean() ** 2 + yb.mean() ** 2))


def letterboxed(a: np.ndarray) -> bool:
    """Whether more than half of the outer 4 % of rows, on both ends, or of columns are nearly black."""
    level = a.astype("f8").sum(axis=2) / 3.0
    for axis in (0, 1):
        dark = level.mean(axis=1 - axis) < 18
        band = max(1, int(len(dark) * 0.04))
        if dark[:band].mean() > 0.5 and dark[-band:].mean() > 0.5:
            return True
    return False


def measured(a: np.ndarray, box: tuple[int, int, int, int] | None = None) -> dict:
    """Metrics of one B G R array; ``box`` (x, y, w, h) is the face's, without one its sharpness is 0."""
    c = grey(a)
    face = c[:0]
    if box is not None:
        x, y, w, h = box
        face = c[max(y, 0) : max(y + h, 0), max(x, 0) : max(x + w, 0)]
    return {
        "sharpness": sharpness(c), "face_sharpness": sharpness(face), "exposure_score": max(0.0, 1.0 - float(((c < 15) | (c >= 240)).mean())),
        "contrast": float(c.std()), "colorfulness": colorfulness(a), "noise": noise(c), "letterboxed": letterboxed(a),
    }


def picture_metrics(pictures: DataFrame, key: str = "path", box: str | None = None, canonical: bool = True) -> DataFrame:
    """``key`` and the metrics of every decoded picture (``height``, ``width``, ``channels``, ``data``).

    Pictures are first scaled down to a long side of 1,024 (``canonical``), and the face box (struct<x, y, w, h>
    in the picture's own pixels) with them. A picture without pixels has null metrics, a null box a face sharpness of 0.
    """
    kind = pictures.schema[key].dataType.simpleString()
    face = F.col(box) if box else F.lit(None).cast("struct<x:int,y:int,w:int,h:int>")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                if not r.height or not r.width or r.data is None:
                    out.append({"key": r.key})
                    continue
                a, scale = array_of(r.data, r.height, r.width, r.channels), 1.0
                if canonical and max(a.shape[:2]) > CANONICAL:
                    scale = CANONICAL / max(a.shape[:2])
                    a = scaled(a, max(1, round(r.width * scale)), max(1, round(r.height * scale)))
                own = None if r.face is None else tuple(int(r.face[k] * scale) for k in ("x", "y", "w", "h"))
                out.append({"key": r.key, **measured(a, own)})
            yield pd.DataFrame(out, columns=["key", *[c.split()[0] for c in COLUMNS.split(", ")]])

    rows = pictures.select(F.col(key).alias("key"), "height", "width", "channels", "data", face.alias("face"))
    return rows.mapInPandas(run, f"key {kind}, {COLUMNS}").withColumnRenamed("key", key)
