"""Operators over the comments that tie a scanned page to its printed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plafond.functions.keys import only_digits, printed_page
from plafond.functions.text import lines_of, strip
from plafond.session import broadcast_if_small

#: Format of the comment that recognition leaves for a page's own printed number.
ORIGINAL_MARK = r"<!-- \S+_chunk[0-9]+ Original Page [0-9]+ -->"


def without_original_pages(text: Column) -> Column:
    """Without the marks of printed numbers, each with the line ends right before and behind it."""
    parts = F.split(text, ORIGINAL_MARK)

    def piece(x: Column, i: Column) -> Column:
        left = F.when((i > 0) & x.startswith("\n"), F.substr(x, F.lit(2))).otherwise(x)
        return F.when((i < F.size(parts) - 1) & left.endswith("\n"), F.substr(left, F.lit(1), F.length(left) - 1)).otherwise(left)

    return F.array_join(F.transform(parts, piece), "")


def comment(line: Column) -> Column:
    """(key, value) of a line that is nothing but a page comment; nulls for any other line.

    ``<!-- key: value -->`` gives both; ``<!-- Band01_chunk002 Page 3 -->`` has the key ``page`` and its words as value.
    """
    t = F.btrim(line, F.lit(" \t\r"))
    inner = F.trim(F.substr(t, F.lit(5), F.length(t) - 7))
    is_one = t.startswith("<!--") & t.endswith("-->") & (F.length(t) >= 7)
    words = F.split(inner, r"\s+")
    raw = (F.size(words) == 3) & (F.get(words, F.lit(1)) == "Page")
    key = F.when(raw, "page").when(inner.contains(": "), F.substring_index(inner, ": ", 1))
    value = F.when(raw, inner).otherwise(F.substr(inner, F.locate(": ", inner) + 2))
    return F.struct(F.when(is_one, key).alias("key"), F.when(is_one, value).alias("value"))


def folder_of(path: Column) -> Column:
    """The folder name of a chunk at the end of a path without its suffix; null if the name is none."""
    name = F.substring_index(path, "/", -1)
    chunk = F.substring_index(name, "_chunk", -1)
    return F.when(name.contains("_chunk") & only_digits(chunk) & ~name.rlike(r"[^\w-]") & ~name.startswith("_chunk"), name)


def relinked(pages: DataFrame, text: str, volumes: DataFrame, base_url: str) -> DataFrame:
    """Pages with their link and printed pages written anew; adds ``changed``.

    A page begins with comments in one of three forms, told by their keys: a link with the page in it and the
    printed page (1); a link, the page, and the printed page (2); the raw mark of folder and page, blank lines
    before it allowed (3). A page in none of them, an empty and a null page stay as they are. In the first two, a
    comment on the printed page at the very end goes too. A volume that the catalogue lacks is its own label,
    without an offset. Applied twice it changes nothing.
    """
    t = F.col(text)
    step = pages.withColumn("_lines", F.split(t, "\n"))
    step = step.withColumn("_blank", F.coalesce(F.nullif(F.array_position(F.transform("_lines", lambda x: F.trim(F.translate(x, "\t\r", "  ")) != ""), True), F.lit(0)) - 1, F.lit(0)).cast("int"))
    step = step.withColumn("_head", F.transform(F.slice("_lines", 1, 3), comment)).withColumn("_mark", comment(F.get("_lines", F.col("_blank"))))
    key = lambda i: F.get("_head", F.lit(i))["key"]
    value = lambda i: F.get("_head", F.lit(i))["value"]
    linked = folder_of(F.substring_index(value(0), ".pdf#page=", 1))
    linked_page = F.when(value(0).contains(".pdf#page="), F.substring_index(value(0), "#page=", -1))
    old = F.when(value(0).endswith(".pdf"), folder_of(F.substr(value(0), F.lit(1), F.length(value(0)) - 4)))
    words = F.split(F.col("_mark.value"), r"\s+")
    ways = [
        ((key(0) == "dropbox") & (key(1) == "citation-page-top"), linked, linked_page, F.lit(2)),
        ((key(0) == "dropbox") & (key(1) == "chunk-page") & (key(2) == "citation-page-top"), old, value(1), F.lit(3)),
        (F.col("_mark.key") == "page", folder_of(F.get(words, F.lit(0))), F.get(words, F.lit(2)), F.col("_blank") + 1),
    ]
    form = F.lit(None).cast("struct<folder:string,page:int,lines:int,linked:boolean>")
    for k, (fits, folder, page, n) in reversed(list(enumerate(ways))):
        ok = fits & folder.isNotNull() & only_digits(page)
        form = F.when(ok, F.struct(folder.alias("folder"), page.try_cast("int").alias("page"), n.cast("int").alias("lines"), F.lit(k < 2).alias("linked"))).otherwise(form)
    step = step.withColumn("_form", form).withColumn("_folder", F.col("_form.folder")).withColumn("_page", F.col("_form.page"))
    rest = F.slice("_lines", F.coalesce(F.col("_form.lines"), F.lit(0)) + 1, F.size("_lines"))
    step = step.withColumn("_rest", F.when(F.col("_form").isNotNull(), rest))
    # The comment on the last printed page, with or without a line end behind it.
    end = F.when(F.get("_rest", F.size("_rest") - 1) == "", F.size("_rest") - 1).otherwise(F.size("_rest"))
    last = F.get("_rest", end - 1).startswith("<!-- citation-page-bottom:")
    kept = F.when(F.col("_form.linked") & (end > 0) & last, F.slice("_rest", 1, F.greatest(end - 1, F.lit(0)))).otherwise(F.col("_rest"))
    step = step.withColumn("_body", F.regexp_replace(without_original_pages(F.array_join(kept, "\n")), r"\n+\z", ""))
    step = step.withColumn("_vol", F.regexp_replace("_folder", r"_chunk[0-9]+\z", "")).withColumn("_chunk", F.substring_index("_folder", "_chunk", -1).try_cast("int"))
    names = volumes.select(F.col("band_prefix").alias("_vol"), F.regexp_replace("citation_label", " ", "").alias("_label"), F.col("chunk_offset").alias("_offset"))
    step = step.join(broadcast_if_small(names), "_vol", "left").withColumn("_top", printed_page(F.col("_chunk"), F.col("_page"), F.col("_offset")))
    label = F.coalesce("_label", "_vol")
    link = F.concat(F.lit(f"<!-- dropbox: {base_url}/"), "_folder", F.lit(".pdf#page="), F.col("_page").cast("string"), F.lit(" -->\n<!-- citation-page-top: "), label, F.lit(" p"), F.col("_top").cast("string"), F.lit(" -->\n"))
    new = F.concat(link, "_body", F.lit("\n<!-- citation-page-bottom: "), label, F.lit(" p"), (F.col("_top") + 1).cast("string"), F.lit(" -->\n"))
    out = step.withColumn("_new", F.coalesce(new, t)).withColumn("changed", ~F.col("_new").eqNullSafe(t)).withColumn(text, F.col("_new"))
    return out.select(*pages.columns, "changed")


def shifted(text: Column, first: int, by: int) -> Column:
    """Every citation comment from a printed page on moved by a number; one pass over the lines.

    Not idempotent by itself: keep a flag of what was moved, or put the shift into the catalogue's offsets.
    """
    form = r"<!-- citation-page-(?:top|bottom): \S+ p([0-9]+) -->"

    def line(x: Column) -> Column:
        n = F.regexp_extract(x, form, 1).try_cast("int")
        return F.when(n >= first, F.regexp_replace(x, r"(?<= p)[0-9]+(?= -->)", (n + by).cast("string"))).otherwise(x)

    return F.array_join(F.transform(F.split(text, "\n"), line), "\n")


def changed_lines(old: Column, new: Column) -> Column:
    """The number of lines that differ between two texts of equally many lines."""
    return F.size(F.filter(F.zip_with(F.split(old, "\n"), F.split(new, "\n"), lambda a, b: ~a.eqNullSafe(b)), lambda x: x))


def with_metadata(pages: DataFrame, text: str, source: str) -> DataFrame:
    """Metadata missing in ``text`` copied from the sibling text ``source``; adds ``copied``.

    Without a comment on the top page, the sibling's first run of page comments (links and printed pages, blank
    lines between them left out) goes to the front with an empty line behind it; other lines may stand before the
    run. Without one on the bottom page, the sibling's first such comment becomes the last line. What the sibling
    lacks stays missing; a null text stays null.
    """
    blank = lambda x: F.trim(F.translate(x, "\t\r", "  ")) == ""
    notes = lambda x: strip(x).startswith("<!--") & (x.contains("citation-page") | x.contains("dropbox:"))
    t = F.col(text)
    step = pages.withColumn("_lines", F.coalesce(lines_of(F.col(source)), F.array().cast("array<string>")))
    step = step.withColumn("_from", F.array_position(F.transform("_lines", notes), True).cast("int"))
    step = step.withColumn("_rest", F.when(F.col("_from") > 0, F.slice("_lines", F.greatest("_from", F.lit(1)), F.size("_lines"))).otherwise(F.array().cast("array<string>")))
    step = step.withColumn("_stop", F.array_position(F.transform("_rest", lambda x: ~notes(x) & ~blank(x)), True).cast("int"))
    run = F.when(F.col("_stop") > 0, F.slice("_rest", 1, F.greatest(F.col("_stop") - 1, F.lit(0)))).otherwise(F.col("_rest"))
    step = step.withColumn("_run", F.filter(run, notes))
    low = F.get(F.filter("_lines", lambda x: x.rlike(r"<!--\s*citation-page-bottom:.*-->")), F.lit(0))
    # From the sign that opens the comment to the first that closes it.
    opened = F.concat(F.lit("<!--"), F.substring_index(F.substring_index(low, "citation-page-bottom:", 1), "<!--", -1), F.lit("citation-page-bottom:"))
    behind = F.substr(low, F.locate("citation-page-bottom:", low) + len("citation-page-bottom:"))
    bottom = F.concat(opened, F.substring_index(behind, "-->", 1), F.lit("-->"))
    step = step.withColumn("_t", F.when(~t.contains("citation-page-top:") & (F.size("_run") > 0), F.concat(F.array_join("_run", "\n"), F.lit("\n\n"), t)).otherwise(t))
    end = F.when(~t.contains("citation-page-bottom:") & bottom.isNotNull(), F.concat(F.regexp_replace("_t", r"\s+\z", ""), F.lit("\n"), bottom, F.lit("\n"))).otherwise(F.col("_t"))
    step = step.withColumn("_new", end).withColumn("copied", ~F.col("_new").eqNullSafe(t))
    return step.withColumn(text, F.col("_new")).select(*pages.columns, "copied")
