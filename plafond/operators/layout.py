"""Operators over layout regions: kept images, captions, reading order, page markup, projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plafond.functions.text import dehyphenated, strip

#: Labels of the layout model.
IMAGE_LABELS = ["Picture", "Figure"]
TEXT_LABELS = ["Text", "Caption", "Section-header", "SectionHeader", "Page-header", "PageHeader", "Page-footer", "PageFooter", "Footnote", "List-item", "Table"]

PAGE = ["band_prefix", "chunk", "page"]


def width(box: str = "bbox") -> Column:
    return F.col(f"{box}.x2") - F.col(f"{box}.x1")


def height(box: str = "bbox") -> Column:
    return F.col(f"{box}.y2") - F.col(f"{box}.y1")


def kept_images(regions: DataFrame, least: int = 150) -> DataFrame:
    """Images with both sides of ``least`` or more, numbered within their page in reading order."""
    big = regions.where(F.col("label").isin(IMAGE_LABELS) & (width() >= least) & (height() >= least))
    return big.withColumn("image_no", F.row_number().over(Window.partitionBy(*PAGE).orderBy("reading_pos", "region_id")))


def text_regions(regions: DataFrame, least_width: int = 20, least_height: int = 10) -> DataFrame:
    """regions of a text label that are large enough to be read."""
    return regions.where(F.col("label").isin(TEXT_LABELS) & (width() >= least_width) & (height() >= least_height))


def crop(margin: int, page_width: Column, page_height: Column, box: str = "bbox") -> Column:
    """A box widened by a margin, within the page."""
    b = F.col(box)
    return F.struct(F.greatest(F.lit(0), b["x1"] - margin).alias("x1"), F.greatest(F.lit(0), b["y1"] - margin).alias("y1"), F.least(page_width, b["x2"] + margin).alias("x2"), F.least(page_height, b["y2"] + margin).alias("y2"))


def matched_captions(regions: DataFrame) -> DataFrame:
    """Page key, caption, image, distance: every caption with text and the image nearest in height.

    Equal distances go to the first image in reading order. A join within pages, followed by argmin.
    """
    middle = (F.col("bbox.y1") + F.col("bbox.y2")) / F.lit(2.0)
    captions = regions.where((F.col("label") == "Caption") & (strip(F.col("text")) != "")).select(*PAGE, F.col("region_id").alias("caption_id"), F.col("reading_pos").alias("caption_pos"), "text", middle.alias("cy"))
    images = regions.where(F.col("label").isin(IMAGE_LABELS)).select(*PAGE, F.col("region_id").alias("image_id"), F.col("reading_pos").alias("image_pos"), middle.alias("iy"))
    both = captions.join(images, PAGE).withColumn("distance", F.abs(F.col("cy") - F.col("iy")))
    best = F.min_by(F.struct("image_id", "distance"), F.struct("distance", "image_pos", "image_id"))
    return both.groupBy(*PAGE, "caption_id", "caption_pos", "text").agg(best.alias("b")).select(*PAGE, "caption_id", "caption_pos", "text", "b.image_id", "b.distance")


def image_captions(matched: DataFrame) -> DataFrame:
    """The caption each image ends up with: of several, the last in reading order."""
    return matched.groupBy(*PAGE, "image_id").agg(F.max_by("text", F.struct("caption_pos", "caption_id")).alias("caption"), F.count("*").alias("captions"))


def markup(folder: Column, text: Column) -> Column:
    """The markup of one region by its label and joined text; null where it gives none."""
    label = F.col("label")
    none = F.lit(None).cast("string")
    link = F.concat(F.lit("\n[[File:"), F.col("image_path"), F.lit("|thumb"), F.when(F.coalesce("caption", F.lit("")) != "", F.concat(F.lit("|"), F.col("caption"))).otherwise(""), F.lit("]]\n"))
    number = text.rlike(r"\A[0-9]{1,4}\z") & text.try_cast("int").between(1, 1000)
    cells = F.transform(F.filter("lines", lambda x: strip(x) != ""), lambda x: F.concat(F.lit("| "), strip(x)))
    rows = F.concat(F.lit('\n{| class="wikitable"\n|-\n'), F.array_join(cells, "\n|-\n"), F.lit("\n|}\n"))
    return (
        F.when(label.isin(IMAGE_LABELS), link)
        .when((label == "Table"), F.when(F.size("lines") > 0, rows))
        .when(text == "", none)
        .when(label == "Caption", F.when(~F.coalesce("caption_matched", F.lit(False)), F.concat(F.lit("\n'''"), text, F.lit("'''\n"))))
        .when(label.isin("Section-header", "SectionHeader"), F.concat(F.lit("\n== "), text, F.lit(" ==\n")))
        .when(label.isin("Page-header", "PageHeader"), F.concat(F.lit("<!-- header: "), text, F.lit(" -->")))
        .when(label.isin("Page-footer", "PageFooter", "Footnote"), F.when(number, F.concat(F.lit("<!-- "), folder, F.lit(" Original Page "), text, F.lit(" -->"))).otherwise(F.concat(F.lit("\n----\n"), text, F.lit("\n"))))
        .otherwise(text)
    )


def assembled_pages(regions: DataFrame) -> DataFrame:
    """One text per page from its regions in reading order; pages without any markup have the empty text."""
    folder = F.concat("band_prefix", F.lit("_chunk"), F.lpad(F.col("chunk").cast("string"), 3, "0"))
    joined = regions.withColumn("_text", dehyphenated(F.col("lines"))).withColumn("_folder", folder)
    parts = joined.select(*PAGE, F.col("_folder").alias("folder"), "reading_pos", "region_id", markup(F.col("_folder"), F.col("_text")).alias("m"))
    ordered = F.array_sort(F.collect_list(F.when(F.col("m") != "", F.struct("reading_pos", "region_id", "m"))))
    pages = parts.groupBy(*PAGE, "folder").agg(F.transform(ordered, lambda x: x["m"]).alias("parts"))
    head = F.concat(F.lit("<!-- "), "folder", F.lit(" Page "), F.col("page").cast("string"), F.lit(" -->\n\n"))
    return pages.select(*PAGE, F.when(F.size("parts") > 0, F.concat(head, F.array_join("parts", "\n\n"), F.lit("\n"))).otherwise("").alias("text"))


def runs_over(values: Column, threshold: int, longer_than: int) -> Column:
    """(from, to) of the runs above a threshold, ends excluded, that are longer than a length.

    A run open at the end closes there. If none is long enough but the sum is over 100, the whole array is one.
    A fold within the row: a projection never leaves it.
    """
    state = "struct<runs:array<struct<a:int,b:int>>,open:int,i:int>"
    start = F.struct(F.array().cast("array<struct<a:int,b:int>>").alias("runs"), F.lit(-1).alias("open"), F.lit(0).alias("i")).cast(state)

    def close(acc: Column, at: Column) -> Column:
        return F.when((acc["open"] >= 0) & (at - acc["open"] > longer_than), F.array_append(acc["runs"], F.struct(acc["open"].alias("a"), at.alias("b")))).otherwise(acc["runs"])

    def step(acc: Column, v: Column) -> Column:
        over = v > threshold
        return F.struct(
            F.when(over, acc["runs"]).otherwise(close(acc, acc["i"])).alias("runs"),
            F.when(over, F.when(acc["open"] >= 0, acc["open"]).otherwise(acc["i"])).otherwise(-1).alias("open"),
            (acc["i"] + 1).alias("i"),
        ).cast(state)

    runs = F.aggregate(values, start, step, lambda acc: close(acc, acc["i"]))
    total = F.aggregate(values, F.lit(0).cast("bigint"), lambda a, v: a + v)
    whole = F.array(F.struct(F.lit(0).alias("a"), F.size(values).alias("b")))
    return F.when((F.size(runs) == 0) & (total > 100), whole).otherwise(runs)


def white_strip(mins: Column, white: int = 150) -> Column:
    """Leading values of ``white`` or more; all of them if the whole line is white."""
    return (F.coalesce(F.nullif(F.array_position(F.transform(mins, lambda x: x < white), True), F.lit(0)) - 1, F.size(mins).cast("bigint"))).cast("int")


def trimmed(images: DataFrame, row_mins: str, col_mins: str, padding: int = 3) -> DataFrame:
    """Adds x1, y1, x2, y2: the box left when white margins go, with padding; the whole image if nothing were left."""
    h, w = F.size(row_mins), F.size(col_mins)
    step = images
    for name, at in (("_top", F.col(row_mins)), ("_bottom", F.reverse(row_mins)), ("_left", F.col(col_mins)), ("_right", F.reverse(col_mins))):
        step = step.withColumn(name, white_strip(at))
    step = step.withColumn("x1", F.greatest(F.lit(0), F.col("_left") - padding)).withColumn("y1", F.greatest(F.lit(0), F.col("_top") - padding))
    step = step.withColumn("x2", F.least(w, w - F.col("_right") + padding)).withColumn("y2", F.least(h, h - F.col("_bottom") + padding))
    step = step.withColumn("_bad", (F.col("x1") >= F.col("x2")) | (F.col("y1") >= F.col("y2")))
    for name, whole in (("x1", F.lit(0)), ("y1", F.lit(0)), ("x2", w), ("y2", h)):
        step = step.withColumn(name, F.when(F.col("_bad"), whole).otherwise(F.col(name)))
    return step.drop("_top", "_bottom", "_left", "_right", "_bad")
