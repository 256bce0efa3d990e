"""Dense numbering in document order without one partition for all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import stash

#: Documents whose counts are summed together before the only global step.
RANGE = 4096


def dense_index(df: DataFrame, doc: str, within: list[str], name: str = "idx", start: int = 0, written: bool = False, span: int = RANGE) -> DataFrame:
    """``name``: the place of each row in (doc, within) order, from ``start``.

    Rows are numbered inside their document; counts are summed by ranges of documents, and only one
    number a range of ``span`` document numbers meets in one task.  ``doc`` is a whole number.  The rows are written
    once, unless they are ``written``, since counts and numbers are two readings."""
    df = df if written else stash(df, "rows")
    counts = df.groupBy(doc).agg(F.count("*").alias("_n")).withColumn("_range", F.floor(F.col(doc) / span))
    ranges = counts.groupBy("_range").agg(F.sum("_n").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_range").orderBy(doc).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.join(ranges, "_range").select(F.col(doc), (F.col("_first") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("_offset"))
    row = F.row_number().over(Window.partitionBy(doc).orderBy(*within))
    return df.join(offsets, doc).withColumn(name, F.col("_offset") + row - 1 + start).drop("_offset")
