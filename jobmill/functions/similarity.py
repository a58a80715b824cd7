"""Vector similarity and grades."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A grade needs a similarity strictly above its bound.
GRADE_BOUNDS = [("A", 0.85), ("B", 0.75), ("C", 0.65), ("D", 0.55)]


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null when a vector is zero or the sizes differ."""
    length = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (length > 0), dot(a, b) / length)


def grade(similarity: Column) -> Column:
    result = None
    for letter, bound in GRADE_BOUNDS:
        test = similarity > bound
        result = F.when(test, letter) if result is None else result.when(test, letter)
    return F.when(similarity.isNotNull(), result.otherwise("F"))
