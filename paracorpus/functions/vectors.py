"""Vectors as array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a, b) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalize(a) -> Column:
    """Unit length; a zero vector stays as it is."""
    n = norm(a)
    return F.when(n == 0, F.transform(a, lambda x: x.cast("double"))).otherwise(F.transform(F.array(n), lambda m: F.transform(a, lambda x: x.cast("double") / m))[0])


def rounded(x, places: int = 6) -> Column:
    """Rounded to decimal places as SQL does it: what is negative, or a negative zero, and rounds to zero stays a negative zero."""
    x = F.col(x) if isinstance(x, str) else x
    r = F.round(x, places)
    return F.when(r == 0, x * F.lit(0.0)).otherwise(r)


def mean_by(df, key: str, vector: str):
    """(key, vector): mean vectors by key.  Each place of the vector is averaged on its own, combined before rows move, so
    that no group's vectors meet in one list."""
    places = df.select(key, F.posexplode(vector).alias("_at", "_x")).groupBy(key, "_at").agg(F.avg(F.col("_x").cast("double")).alias("_x"))
    return places.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_x"))), lambda p: p["_x"]).alias(vector))


def mean_pool(vectors) -> Column:
    """Element-wise mean of an array of vectors; it is not made unit length again."""
    total = F.aggregate(vectors, F.transform(F.get(vectors, F.lit(0)), lambda _: F.lit(0.0)), lambda s, v: F.zip_with(s, v, lambda x, y: x + y.cast("double")))
    return F.transform(total, lambda x: x / F.size(vectors))
