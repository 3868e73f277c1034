"""Column expressions that rewrite and measure text. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space for word counts, also of the kinds that \s leaves out.
SPACE = r"\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, r"\A\s+|\s+\z", "")


def words(text: Column) -> Column:
    """A4: number of runs of characters that are no white space."""
    return F.regexp_count(text, F.lit(f"[^{SPACE}]+")).cast("bigint")


def embeds(text: Column) -> Column:
    """A5: opened file links in any case."""
    return F.regexp_count(text, F.lit(r"(?i)\[\[File:")).cast("bigint")


def closed_embeds(text: Column) -> Column:
    """A5: file links with an end, in any case; the stricter of the two counters."""
    return F.regexp_count(text, F.lit(r"(?i)\[\[File:[^\]]+\]\]")).cast("bigint")


def lines_of(text: Column) -> Column:
    """The lines of a text; one line end at its end opens no further line."""
    return F.split(F.regexp_replace(text, r"\r?\n\z|\r\z", ""), r"\r\n|\n|\r")


def no_space_before_mark(text: Column) -> Column:
    """T5."""
    return F.regexp_replace(text, r"[ \t]+([,.;:!?])", "$1")


def trim_blank_lines(text: Column) -> Column:
    """T4: without blank lines at both ends."""
    return F.regexp_replace(F.regexp_replace(text, r"\A(?:[ \t\r\f\x{b}]*\n)+", ""), r"(?:\n[ \t\r\f\x{b}]*)+\z", "")


def is_heading2(line: Column) -> Column:
    """a heading of level 2."""
    t = strip(line)
    return t.startswith("== ") & t.endswith(" ==") & ~t.startswith("=== ")


def is_heading(line: Column) -> Column:
    """a heading of any level, loosely."""
    t = strip(line)
    return t.startswith("==") & t.endswith("==")


def heading_text(line: Column) -> Column:
    """the text of a heading of any depth, also with unequal sides; null for other lines.

    A line of five or more signs and nothing else is a heading whose text is one of them.
    """
    t = strip(line)
    inner = F.btrim(t, F.lit("="))
    signs = (inner == "") & (F.length(t) >= 5)
    return F.when(t.startswith("==") & t.endswith("=="), F.when(signs, "=").when(inner != "", strip(inner)))


def all_caps(text: Column) -> Column:
    """at least one letter, and every letter a capital."""
    return text.rlike(r"\p{L}") & ~text.rlike(r"[\p{Ll}\p{Lt}\p{Lm}\p{Lo}]")


def normal_body(text: Column) -> Column:
    """No space before marks, no white space at line ends, no doubled blank lines, one blank line around
    headings of level 2, none at the ends."""
    lines = F.transform(lines_of(no_space_before_mark(text)), lambda x: F.regexp_replace(x, r"\s+\z", ""))
    wide = F.flatten(F.transform(lines, lambda x: F.when(is_heading2(x), F.array(F.lit(""), x, F.lit(""))).otherwise(F.array(x))))
    joined = F.array_join(wide, "\n")
    return F.regexp_replace(F.regexp_replace(joined, r"\n{3,}", "\n\n"), r"\A\n+|\n+\z", "")


def dehyphenated(lines: Column) -> Column:
    """The lines as one text: ``¬`` joins, a hyphen joins before a small letter, everything else gets a space.

    Blank lines are skipped, but a hyphen looks at the very next line, blank or not. The last hyphen stays.
    """
    tight = lambda x: F.regexp_replace(x, r"\s+\z", "")

    def piece(x: Column, i: Column) -> Column:
        t = tight(x)
        after = F.regexp_replace(F.get(lines, i + 1), r"\A\s+", "")
        return (
            F.when(t == "", "")
            .when(t.endswith("¬"), tight(F.regexp_replace(t, "¬+\\z", "")))
            .when(t.endswith("-") & after.rlike(r"\A\p{Ll}"), tight(F.regexp_replace(t, r"-\z", "")))
            .otherwise(F.concat(t, F.lit(" ")))
        )

    return F.coalesce(strip(F.array_join(F.transform(lines, piece), "")), F.lit(""))


def paragraphs(text: Column) -> Column:
    return F.split(text, r"\n\s*\n")


def packed(parts: Column, limit: int, glue: str = "\n\n") -> Column:
    """Parts packed in order into texts of up to ``limit``; each part counts its length plus the glue's.

    A part that is too long by itself is a text of its own. One left fold over the array, inside the row.
    """
    state = "struct<done:array<string>,cur:array<string>,n:int>"
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("done"), none.alias("cur"), F.lit(0).alias("n")).cast(state)

    def step(acc: Column, p: Column) -> Column:
        n = F.length(p) + len(glue)
        full = (F.size(acc["cur"]) > 0) & (acc["n"] + n > limit)
        return F.when(
            full, F.struct(F.array_append(acc["done"], F.array_join(acc["cur"], glue)).alias("done"), F.array(p).alias("cur"), n.alias("n"))
        ).otherwise(F.struct(acc["done"].alias("done"), F.array_append(acc["cur"], p).alias("cur"), (acc["n"] + n).alias("n"))).cast(state)

    def end(acc: Column) -> Column:
        return F.when(F.size(acc["cur"]) > 0, F.array_append(acc["done"], F.array_join(acc["cur"], glue))).otherwise(acc["done"])

    return F.aggregate(parts, start, step, end)


def prompt(head: str, chunk: Column, tail: str = "\n\nBereinigter Text:\n") -> Column:
    """T18."""
    return F.concat(F.lit(head), chunk, F.lit(tail))


def squeezed(text: Column) -> Column:
    """At most one blank line in a row, no white space at the ends, one line end."""
    return F.concat(strip(F.regexp_replace(text, r"\n{3,}", "\n\n")), F.lit("\n"))


def size_band(n: Column, small: int = 1_000, large: int = 50_000) -> Column:
    """F8."""
    return F.when(n < small, "small").when(n > large, "large").otherwise("normal")


def table_of_pipes(lines: Column) -> Column:
    """Lines with pipes as one wiki table; short rows are filled up, cells trimmed."""
    cells = F.transform(lines, lambda x: F.transform(F.split(x, r"\|"), strip))
    widest = F.array_max(F.transform(cells, lambda c: F.size(c)))
    rows = F.transform(cells, lambda c: F.concat(F.lit("|-\n| "), F.array_join(F.concat(c, F.array_repeat(F.lit(""), widest - F.size(c))), " || ")))
    return F.concat(F.lit('{| class="wikitable"\n'), F.array_join(rows, "\n"), F.lit("\n|}"))
