"""Vector expressions, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine, between 0 and 2; a zero vector is at distance 1 from everything."""
    similarity = F.coalesce(dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0)), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(2.0), F.lit(1.0) - similarity))


def usable(a: Column, dims: int) -> Column:
    """Whether the vector has ``dims`` finite numbers."""
    return F.coalesce((F.size(a) == dims) & F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
