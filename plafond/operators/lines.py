"""Operators over lines of text: explode and rejoin, runs of table lines, searches above and below a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plafond.functions.text import is_heading, lines_of, strip, table_of_pipes
from plafond.operators.slices import first_after


def exploded(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """``key, line_no, line``, numbered from 1. A null text has no line, an empty one has one."""
    return df.select(*key, F.posexplode(lines_of(F.col(text))).alias("_i", "line")).select(*key, (F.col("_i") + 1).alias("line_no"), "line")


def rejoined(lines: DataFrame, key: list[str], line: str = "line", order: str = "line_no", name: str = "text") -> DataFrame:
    """Lines as one text again, in their order; null lines are left out."""
    ordered = F.array_sort(F.collect_list(F.struct(order, line)))
    return lines.groupBy(*key).agg(F.array_join(F.transform(ordered, lambda x: x[line]), "\n").alias(name))


def pipe_tables(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """One wiki table per run of lines with pipes, with its numbers of rows and columns.

    Runs go on across blank lines. ``first_line`` counts from 1 in the text. A text is cut up within its row, so
    nothing is shuffled; a null text has no table.
    """
    numbered = F.transform(lines_of(F.col(text)), lambda x, i: F.struct((i + 1).alias("n"), x.alias("line")))
    step = df.select(*key, F.filter(numbered, lambda x: strip(x["line"]) != "").alias("_full"))
    step = step.withColumn("_has", F.transform("_full", lambda x: x["line"].contains("|")))
    edge = lambda k: F.filter(F.transform("_has", lambda h, i: F.when(h & ~F.coalesce(F.get("_has", i + k), F.lit(False)), i)), lambda i: i.isNotNull())
    step = step.withColumn("_from", edge(-1)).withColumn("_to", edge(1))
    runs = F.zip_with("_from", "_to", lambda a, z: F.slice("_full", a + 1, z - a + 1))
    each = step.select(*key, F.posexplode(runs).alias("_g", "_run"))
    each = each.select(*key, (F.col("_g") + 1).cast("bigint").alias("grp"), F.col("_run")[0]["n"].cast("bigint").alias("first_line"), F.transform("_run", lambda x: x["line"]).alias("lines"))
    return each.select(*key, "grp", "first_line", F.size("lines").cast("bigint").alias("n_rows"), F.array_max(F.transform("lines", lambda x: F.size(F.split(x, r"\|")))).cast("bigint").alias("n_cols"), table_of_pipes(F.col("lines")).alias("wikitable"))


def marker(line: Column) -> Column:
    """lines that mark an article's beginning."""
    return strip(line).rlike(r"\A'''(Patrozinium|Zum Bauwerk):")


def paragraph_starts(lines: DataFrame, key: list[str]) -> DataFrame:
    """Per marker line, the line where the paragraph above it begins (numbers from 1).

    Blank lines right above the marker are skipped. Going up from there, the search stops below a blank line, a
    page comment or a file link, or at a heading of level 2; else at the first line. With nothing above the
    marker it is the marker itself.
    """
    t = strip(F.col("line"))
    below = (t == "") | (t.startswith("<!--") & (t.contains("citation-page") | t.contains("header:"))) | t.startswith("[[File:") | t.startswith("[[Datei:")
    heading = t.rlike(r"\A==\s+.*\s+==\z")
    # Marks instead of lines go through the shuffle.
    stop = F.when(heading, F.col("line_no")).when(below, F.col("line_no") + 1)
    marks = lines.select(*key, "line_no", stop.alias("stop"), (t != "").alias("full"), marker(F.col("line")).alias("marked"))
    up = Window.partitionBy(*key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    # At every line that is not blank: where a paragraph that contains it begins.
    own = F.coalesce("stop", F.max("stop").over(upto), F.lit(1))
    above = F.last(F.when(F.col("full"), F.col("own")), ignorenulls=True).over(up)
    return marks.withColumn("own", own).withColumn("start", F.coalesce(above, F.col("line_no"))).where("marked").select(*key, "line_no", F.col("start").cast("int").alias("paragraph_line"))


def paired(events: DataFrame, key: list[str], order: str, is_start: Column, is_end: Column) -> DataFrame:
    """Every start with the first end after it, and the next start; null where there is none.

    Overlaps stay: two starts may share an end. ``order`` is a number; a hot key is searched in slices of it.
    """
    marked = events.withColumn("_s", is_start)
    out = first_after(marked, key, order, {"end_at": is_end, "next_start": is_start}, 4096)
    return out.where("_s").select(*key, F.col(order).alias("start_at"), "end_at", "next_start")


def without_footer(pages: DataFrame, text: str, most: int = 18) -> DataFrame:
    """``text`` without the rule and what follows it before the last citation comment at the bottom, the
    number of characters ``removed``, and whether that was ``applied``.

    The rule must stand within the 14 lines above the comment; blank lines above the rule go with it. More than
    ``most`` characters are only reported: the text then stays as it was.
    """
    step = pages.withColumn("_lines", F.split(text, "\n")).withColumn("_n", F.size("_lines"))
    step = step.withColumn("_bottom", F.col("_n") - F.array_position(F.transform(F.reverse("_lines"), lambda x: x.contains("citation-page-bottom:")), True).cast("int"))
    step = step.withColumn("_low", F.greatest(F.lit(0), F.col("_bottom") - 14))
    step = step.withColumn("_near", F.when(F.col("_bottom") < F.col("_n"), F.slice("_lines", F.col("_low") + 1, F.col("_bottom") - F.col("_low"))))
    step = step.withColumn("_up", F.array_position(F.transform(F.reverse("_near"), lambda x: strip(x).startswith("----")), True).cast("int"))
    step = step.withColumn("_head", F.when(F.col("_up") > 0, F.slice("_lines", 1, F.col("_bottom") - F.col("_up"))))
    # The last line above the rule that is not blank; everything below it goes.
    step = step.withColumn("_full", F.array_max(F.transform("_head", lambda x, i: F.when(strip(x) != "", i + 1).otherwise(0))))
    kept = F.array_join(F.concat(F.slice("_head", 1, F.coalesce("_full", F.lit(0))), F.slice("_lines", F.col("_bottom") + 1, F.col("_n"))), "\n")
    step = step.withColumn("_cut", F.coalesce(F.when(F.col("_up") > 0, kept), F.col(text)))
    out = step.withColumn("removed", F.length(text) - F.length("_cut")).withColumn("applied", F.col("removed").between(1, most))
    out = out.withColumn(text, F.when(F.col("applied"), F.col("_cut")).otherwise(F.col(text)))
    return out.drop("_lines", "_n", "_bottom", "_low", "_near", "_up", "_head", "_full", "_cut")


def fuzzy_lines(lines: DataFrame, target: str, most: int = 3) -> DataFrame:
    """Lines that, without heading signs, are up to ``most`` edits from the target."""
    bare = strip(F.regexp_replace(strip(F.col("line")), r"\A=+|=+\z", ""))
    cand = lines.withColumn("bare", bare).where((F.col("bare") != "") & (F.abs(F.length("bare") - len(target)) <= most))
    return cand.withColumn("distance", F.levenshtein("bare", F.lit(target), most)).where("distance >= 0").withColumn("in_heading", is_heading(F.col("line")))


def rewritten_headings(df: DataFrame, text: str, target: str, most: int = 3) -> DataFrame:
    """Lines that are up to ``most`` edits from the target, with or without heading signs, become its heading.

    Adds ``fixed``, the number of lines changed. Lines that are that heading already stay as they are, and so do
    texts without others. A line end at the end of the text is kept. All within the row.
    """
    heading = f"== {target} =="
    bare = lambda x: strip(F.btrim(strip(x), F.lit("=")))
    near = lambda x: (bare(x) != "") & (F.abs(F.length(bare(x)) - len(target)) <= most) & (F.levenshtein(bare(x), F.lit(target), most) >= 0) & (strip(x) != heading)
    step = df.withColumn("_lines", lines_of(F.col(text))).withColumn("_hit", F.transform("_lines", near))
    new = F.array_join(F.zip_with("_lines", "_hit", lambda x, h: F.when(h, heading).otherwise(x)), "\n")
    step = step.withColumn("fixed", F.size(F.filter("_hit", lambda h: h)))
    return step.withColumn(text, F.when(F.col("fixed") > 0, F.concat(new, F.when(F.col(text).endswith("\n"), "\n").otherwise(""))).otherwise(F.col(text))).drop("_lines", "_hit")
