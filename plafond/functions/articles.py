"""Column expressions for article files: template block, fields, body, boxes and categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plafond.functions.keys import extract, first_number
from plafond.functions.text import all_caps, strip


def lemma_of(block: Column) -> Column:
    """The first lemma with a value."""
    return extract(block, r"(?m)^\|Lemma=[ \t]*(\S.*?)[ \t]*$")


def meta_of(text: Column) -> Column:
    """P10: the value of the Meta field, empty without one."""
    return strip(F.regexp_extract(text, r"(?m)^\s*\|Meta=(.*)$", 1))


def template_block(band: Column, chunk: Column, page: Column, page_from: Column, page_to: Column, lemma: Column, kind: Column, place: Column, before: Column, after: Column, authors: Column) -> Column:
    """The metadata block of an article; nulls give empty values, each author a numbered line."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    # The template's field names, in its order.
    fields = [("Band", first_number(band)), ("Chunk", chunk), ("Chunkseite", page), ("Originalseitenvon", page_from), ("Originalseitenbis", page_to), ("Lemma", lemma), ("Typ", kind), ("Ort", place), ("davor", before), ("danach", after)]
    head = F.array(F.lit("{{Artikel"), *[F.concat(F.lit(f"|{k}="), text(v)) for k, v in fields])
    named = F.transform(F.coalesce(authors, F.array().cast("array<string>")), lambda x, i: F.concat(F.lit("|AutorIn"), (i + 1).cast("string"), F.lit("="), text(x)))
    return F.array_join(F.concat(head, named, F.array(F.lit("}}"))), "\n")


def article_text(block: Column, content: Column) -> Column:
    """P23."""
    return F.concat(block, F.lit("\n\n"), content, F.lit("\n"))


def joined_names(names: Column) -> Column:
    """P25: names joined by commas and a last ``und``; empty for none."""
    n = F.size(names)
    return F.when(n <= 0, "").when(n == 1, F.get(names, F.lit(0))).otherwise(F.concat(F.array_join(F.slice(names, 1, F.greatest(n - 1, F.lit(1))), ", "), F.lit(" und "), F.get(names, n - 1)))


def page_range(page_from: Column, page_to: Column) -> Column:
    """P25: ``S. 5–7``; one number if both are the same."""
    return F.concat(F.lit("S. "), page_from, F.when(page_from == page_to, "").otherwise(F.concat(F.lit("–"), page_to)))


def category_names(band: Column, fields: Column, names: Column) -> Column:
    """The categories of an article: the fixed one, its volume, and every field with a value."""
    some = [fields[k] for k in ("Meta", "Typ", "Ort")]
    return F.concat(F.array(F.lit("CBD"), F.concat(F.lit("Band_"), band)), F.filter(F.concat(F.array(*some), names), lambda x: x.isNotNull() & (x != "")))


def without_leading_caps(body: Column) -> Column:
    """The body without a first heading in capitals and the blank lines around it; others unchanged."""
    form = r"\A(?:[ \t]*\n)*==+[ \t]*([^\n]*?)[ \t]*==+[ \t]*(?:\n|\z)(?:[ \t]*\n)*"
    return F.when(all_caps(F.regexp_extract(body, form, 1)), F.concat(F.lit("\n"), F.regexp_replace(body, form, ""))).otherwise(body)
