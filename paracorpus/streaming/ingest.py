"""Resumable page processing: each file is handled once, whatever happens between runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

BINARY = "path string, modificationTime timestamp, length long, content binary"


def ingest_images(spark: SparkSession, source: str, sink: str, checkpoint: str, recognise: Callable[[DataFrame], DataFrame], limit: int | None = None, glob: str = "*.png") -> None:
    """Take all new page images of ``source`` through ``recognise`` into parquet ``sink``, then stop.

    The checkpoint knows the files that are done, so a second run does only new ones.  ``limit`` bounds the
    files of a micro-batch.  Rows with an error go to ``sink``_failed, to be retried by ``failed_pages``."""
    reader = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", glob)
    if limit:
        reader = reader.option("maxFilesPerTrigger", limit)
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    key, page = T.page_of_image(name)
    images = reader.load(source).select(key.alias("volume"), page.alias("page"), "content")

    def write(batch: DataFrame, epoch: int) -> None:
        # one folder a batch: a batch that is run again replaces its own output and nothing else
        done = recognise(batch).persist()
        done.where("error is null").drop("error").write.mode("overwrite").parquet(f"{sink}/batch={epoch}")
        done.where("error is not null").write.mode("overwrite").parquet(f"{sink}_failed/batch={epoch}")
        done.unpersist()

    query = images.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def failed_pages(spark: SparkSession, sink: str) -> DataFrame:
    """(volume, page) of pages that failed and have no output since."""
    failed = spark.read.parquet(f"{sink}_failed").select("volume", "page").distinct()
    return failed.join(spark.read.parquet(sink).select("volume", "page"), ["volume", "page"], "left_anti")
