"""Vector expressions for aligned pairs. Searches use ``operators.search`` instead."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def normalize(a: Column | str) -> Column:
    """Unit vector; a zero vector stays zero."""
    # The one-element outer array binds the length once instead of once per dimension.
    def scaled(length: Column) -> Column:
        safe = F.when(length == 0, F.lit(1.0)).otherwise(length)
        return F.transform(col(a), lambda x: (x.cast("double") / safe).cast("float"))

    return F.get(F.transform(F.array(norm(a)), scaled), F.lit(0))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity in double precision; 0 when one side is a zero vector."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / size)
