"""Incremental ingest of page files on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plafond.functions.keys import citation_page, citation_volume


def ingest_new_pages(spark: SparkSession, root: str, out: str, checkpoint: str) -> None:
    """Every page file not seen before, read once and appended to ``out`` as parquet; then it ends.

    The checkpoint remembers files, so a second run takes only new ones. Unlike a test for existing outputs, a
    page whose output was deleted is not read again.
    """
    raw = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.wiki").load(root)
    t = F.col("value")
    pages = raw.select(F.col("_metadata.file_path").alias("path"), citation_volume(t).alias("volume"), citation_page(t).alias("top"), t.alias("text"))
    pages.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def page_counts_stream(events: DataFrame, delay: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Arrivals per volume and window of event time (``received_at``, ``source``); rows later than ``delay`` are left out."""
    at = events.withColumn("at", F.col("received_at").cast("timestamp")).withWatermark("at", delay)
    return at.groupBy(F.window("at", window), "source").agg(F.count("*").alias("pages")).select(F.col("window.start").alias("from"), "source", "pages")
