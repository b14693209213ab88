"""Vector columns (arrays of floats)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.columns import col

GUARD = 1e-12


def inner_product(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def squared_distance(a: Column | str, b: Column | str) -> Column:
    def diff(x: Column, y: Column) -> Column:
        return x.cast("double") - y.cast("double")

    squares = F.zip_with(col(a), col(b), lambda x, y: diff(x, y) * diff(x, y))
    return F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v)


def norm(v: Column | str) -> Column:
    return F.sqrt(inner_product(v, v))


def l2_normalize(v: Column | str) -> Column:
    """Vector divided by its length plus a tiny guard, so that a zero vector stays zero."""
    length = norm(v) + F.lit(GUARD)
    return F.transform(col(v), lambda x: (x.cast("double") / length).cast("float"))
