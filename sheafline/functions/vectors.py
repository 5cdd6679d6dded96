"""Vector expressions."""

from pyspark.sql import functions as F


def dot(left, right):
    """Inner product of two equally long arrays, accumulated in double."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(vector):
    return F.sqrt(dot(vector, vector))
