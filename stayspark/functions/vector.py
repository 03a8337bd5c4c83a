"""Vector expressions over array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _d(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(_d(a), _d(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(_d(a), F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either vector is zero, null when the lengths differ."""
    scale = norm(a) * norm(b)
    value = F.when(scale == 0, F.lit(0.0)).otherwise(dot(a, b) / scale)
    return F.when(F.size(a) == F.size(b), value)


def preview(a: Column, n: int = 8) -> Column:
    return F.slice(a, 1, n)


def word_bucket(word: Column, dimensions: int) -> Column:
    """Stable bucket of a word in [0, dimensions)."""
    head = F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long")
    return (head % dimensions).cast("int")
