"""Vector arithmetic as column expressions over ``array<float|double>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Sum of products."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x
    )


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def unit(a: Column) -> Column:
    """The vector divided by its length; the zero vector stays as it is."""
    length = norm(a)
    return F.transform(a, lambda x: F.when(length == 0, F.lit(0.0)).otherwise(x.cast("double") / length))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors of one row; 0 when one of them is zero."""
    lengths = norm(a) * norm(b)
    return F.when(lengths == 0, F.lit(0.0)).otherwise(dot(a, b) / lengths)
