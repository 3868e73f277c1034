"""Operators over scanned pages: missing pages, back-filled metadata, page index, continuity of ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plafond.operators import slices


def only_in(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys of the left side that the right side lacks."""
    return left.select(*key).distinct().join(right.select(*key).distinct(), key, "left_anti")


def missing_in_series(pages: DataFrame, group: str, chunk: str, page: str, per_chunk: int = 25) -> DataFrame:
    """Pages 1 to ``per_chunk`` that a chunk lacks; the last chunk of a group may be short and is left out."""
    chunks = pages.groupBy(group, chunk).agg(F.collect_set(page).alias("has"))
    last = F.max(chunk).over(Window.partitionBy(group))
    full = chunks.withColumn("last", last).where(F.col(chunk) < F.col("last"))
    return full.select(group, chunk, F.explode(F.array_except(F.sequence(F.lit(1), F.lit(per_chunk)), "has")).alias(page))


def page_index(pages: DataFrame, band: str, file: str, top: str, bottom: str) -> DataFrame:
    """Printed page -> the files that hold it, sorted; a file stands once under each of its pages."""
    rows = pages.select(band, file, F.explode(F.array_distinct(F.filter(F.array(top, bottom), lambda x: x.isNotNull()))).alias("printed_page")).distinct()
    return rows.groupBy(band, "printed_page").agg(F.array_sort(F.collect_set(file)).alias("files"))


def continuity(rows: DataFrame, band: str, order: list[str], start: str, end: str) -> DataFrame:
    """Adds ``issue`` and ``size``, comparing every range with the one before it in its volume.

    SAME start, else OVERLAP (starts before the end before), else GAP (starts after the next page); a shared
    page is no issue. Rows with unreadable pages are left out beforehand. The first of ``order`` is a number; a hot
    volume is compared in slices of it.
    """
    both = slices.neighbours(rows, [band], order, [start, end])
    before, upto, at = F.col(f"_before.{start}"), F.col(f"_before.{end}"), F.col(start)
    issue = F.when(before == at, "SAME").when(at < upto, "OVERLAP").when(at > upto + 1, "GAP")
    size = F.when(before == at, F.lit(None)).when(at < upto, upto - at + 1).when(at > upto + 1, at - upto - 1)
    return both.withColumn("issue", issue).withColumn("size", size.cast("int")).withColumn("inverted", F.col(end) < at).drop("_before", "_behind")


def neighbours(rows: DataFrame, band: str, order: list[str], name: str) -> DataFrame:
    """The entries before and after each in its volume; the first of ``order`` is a number."""
    beside = slices.neighbours(rows, [band], order, [name])
    return beside.withColumn("davor", F.col(f"_before.{name}")).withColumn("danach", F.col(f"_behind.{name}")).drop("_before", "_behind")


def last_writer(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Of rows for one key the last written, and how many there were.

    One aggregate with partial maxima, so a key with very many rows is no hot task.
    """
    rest = [c for c in rows.columns if c not in key]
    best = F.max(F.struct(*[F.struct(*order).alias("_o")], F.struct(*rest).alias("_r"))).alias("_m")
    return rows.groupBy(*key).agg(best, F.count("*").alias("written")).select(*key, "_m._r.*", "written")


def move_plan(source: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """``moved`` for files whose target is free, ``skipped`` for the others."""
    there = target.select(*key).distinct().withColumn("_there", F.lit(True))
    return source.join(there, key, "left").withColumn("status", F.when(F.col("_there"), "skipped").otherwise("moved")).drop("_there")
