"""Queries of text, layout and payload operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plafond.functions import articles as fa
from plafond.functions import text as ft
from plafond.operators import citations, layout, lines, payloads
from plafond.plans import reference as r
from plafond.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: Section names of the corpus.
CANONICAL = ("Befund", "Beschreibung und Ikonologie", "Beschreibung und Ikonographie", "Quellen und Literatur", "Rekonstruierende Beschreibung und Ikonographie", "Zur Ikonologie")
NAMES = str(CANONICAL)


def bodies(spark: SparkSession, d: str) -> DataFrame:
    return r.latest_articles(spark, d, "body").where("body is not null")


BODY_LINES = rf"SELECT article_id, unnest(string_split(regexp_replace(body, '\n$', ''), chr(10))) AS line, unnest(range(1, len(string_split(regexp_replace(body, '\n$', ''), chr(10))) + 1))::INTEGER AS line_no FROM ({r.ARTICLES}) WHERE body IS NOT NULL"
ST = r"regexp_replace(line, '^[\s\x{b}]+|[\s\x{b}]+$', '', 'g')"


@query(rf"""
WITH l AS ({BODY_LINES}), f AS (SELECT *, contains(line, '|') AS has FROM l WHERE {ST} <> ''),
s AS (SELECT *, (has AND NOT coalesce(lag(has) OVER (PARTITION BY article_id ORDER BY line_no), false))::INT AS start FROM f),
g AS (SELECT *, sum(start) OVER (PARTITION BY article_id ORDER BY line_no) AS grp FROM s),
t AS (SELECT article_id, grp, line_no, list_transform(string_split(line, '|'), lambda c: regexp_replace(c, '^\s+|\s+$', '', 'g')) AS cells FROM g WHERE has),
m AS (SELECT *, max(len(cells)) OVER (PARTITION BY article_id, grp) AS widest FROM t)
SELECT article_id, grp::BIGINT AS grp, min(line_no)::BIGINT AS first_line, count(*)::BIGINT AS n_rows, max(widest)::BIGINT AS n_cols,
 '{{| class="wikitable"' || chr(10) || string_agg('|-' || chr(10) || '| ' || array_to_string(list_resize(cells, widest, ''), ' || '), chr(10) ORDER BY line_no) || chr(10) || '|}}' AS wikitable FROM m GROUP BY 1, 2
""".replace("{{|", "{|").replace("|}}", "|}"))
def pipe_tables(spark: SparkSession, d: str) -> DataFrame:
    """Runs of lines with pipes as wiki tables."""
    return lines.pipe_tables(bodies(spark, d), ["article_id"], "body")


@query(rf"""
WITH l AS (SELECT *, {ST} AS t FROM ({BODY_LINES})),
m AS (SELECT article_id, line_no FROM l WHERE regexp_matches(t, '^''''''(Patrozinium|Zum Bauwerk):')),
a AS (SELECT m.article_id, m.line_no, (SELECT max(l.line_no) FROM l WHERE l.article_id = m.article_id AND l.line_no < m.line_no AND t <> '') AS above FROM m),
s AS (SELECT a.*, (SELECT max(CASE WHEN regexp_matches(t, '^==\s+.*\s+==$') THEN l.line_no ELSE l.line_no + 1 END) FROM l WHERE l.article_id = a.article_id AND l.line_no <= a.above
  AND (regexp_matches(t, '^==\s+.*\s+==$') OR t = '' OR (starts_with(t, '<!--') AND (contains(t, 'citation-page') OR contains(t, 'header:'))) OR starts_with(t, '[[File:') OR starts_with(t, '[[Datei:'))) AS stop FROM a)
SELECT article_id, line_no, CASE WHEN above IS NULL THEN line_no ELSE coalesce(stop, 1) END::INTEGER AS paragraph_line FROM s
""")
def paragraph_start(spark: SparkSession, d: str) -> DataFrame:
    """Where the paragraph above each marker begins."""
    return lines.paragraph_starts(lines.exploded(bodies(spark, d), ["article_id"], "body"), ["article_id"])


@query(rf"""
WITH x AS (SELECT article_id, regexp_replace(body, '\n$', '') || chr(10) || ' === ' || file_stem || ' ==' AS body FROM ({r.ARTICLES}) WHERE body IS NOT NULL),
l AS (SELECT article_id, unnest(string_split(body, chr(10))) AS line, unnest(range(1, len(string_split(body, chr(10))) + 1))::INTEGER AS line_no FROM x), h AS (SELECT *, {ST} AS t FROM l),
n AS (SELECT *, CASE WHEN trim(t, '=') = '' THEN CASE WHEN length(t) >= 5 THEN '=' END ELSE regexp_replace(trim(t, '='), '^\s+|\s+$', '', 'g') END AS heading FROM h WHERE starts_with(t, '==') AND ends_with(t, '=='))
SELECT article_id, line_no, heading, starts_with(t, '== ') AND ends_with(t, ' ==') AND NOT starts_with(t, '=== ') AS level2, regexp_extract(line, '^\s*') || heading AS plain FROM n
WHERE heading IS NOT NULL AND heading NOT IN {NAMES}
""")
def noncanonical_heading(spark: SparkSession, d: str) -> DataFrame:
    """Headings outside a set of names, and their lines without the heading signs. Both sides append one."""
    rows = r.latest_articles(spark, d, "file_stem", "body").where("body is not null")
    text = F.concat(F.regexp_replace("body", r"\n\z", ""), F.lit("\n === "), "file_stem", F.lit(" =="))
    each = lines.exploded(rows.select("article_id", text.alias("body")), ["article_id"], "body").withColumn("heading", ft.heading_text(F.col("line")))
    return each.where(F.col("heading").isNotNull() & ~F.col("heading").isin(*CANONICAL)).select("article_id", "line_no", "heading", ft.is_heading2(F.col("line")).alias("level2"), F.concat(F.regexp_extract("line", r"\A\s*", 0), "heading").alias("plain"))


@query(rf"""
WITH l AS ({BODY_LINES}), h AS (SELECT article_id, line_no, line, {ST} AS t FROM l),
b AS (SELECT *, regexp_replace(regexp_replace(t, '^=+|=+$', '', 'g'), '^\s+|\s+$', '', 'g') AS bare FROM h),
c AS (SELECT *, levenshtein(regexp_replace(bare, '[^\x01-\x7f]', '?', 'g'), 'Befund') AS dist FROM b WHERE bare <> '' AND abs(length(bare) - 6) <= 3)
SELECT CASE WHEN dist = 0 THEN 'exact' ELSE 'fuzzy' END AS match_kind, starts_with(t, '==') AND ends_with(t, '==') AS in_heading, count(*)::BIGINT AS n FROM c WHERE dist <= 3 GROUP BY 1, 2
""")
def fuzzy_heading(spark: SparkSession, d: str) -> DataFrame:
    """Exact and near spellings of a heading, counted over lines of any characters.

    The SQL counts bytes, so it puts one sign for every character beyond ASCII; the heading has none of them.
    """
    return heading_counts(near_headings(spark, d))


def near_headings(spark: SparkSession, d: str) -> DataFrame:
    return lines.fuzzy_lines(lines.exploded(bodies(spark, d), ["article_id"], "body"), "Befund")


def heading_counts(near: DataFrame) -> DataFrame:
    return near.groupBy(F.when(F.col("distance") == 0, "exact").otherwise("fuzzy").alias("match_kind"), "in_heading").agg(F.count("*").alias("n"))


@query(rf"""
WITH x AS (SELECT article_id, body || chr(10) || CASE article_id % 4 WHEN 0 THEN '= Befünd ==' WHEN 1 THEN 'Refnd' WHEN 2 THEN '== Befund ==' ELSE 'Böfüde' END || CASE WHEN article_id % 3 = 0 THEN chr(10) ELSE '' END AS body FROM ({r.ARTICLES}) WHERE body IS NOT NULL),
l AS (SELECT article_id, unnest(string_split(regexp_replace(body, '\n$', ''), chr(10))) AS line, unnest(range(1, len(string_split(regexp_replace(body, '\n$', ''), chr(10))) + 1)) AS line_no FROM x),
b AS (SELECT *, {ST} AS t, regexp_replace(trim({ST}, '='), '^\s+|\s+$', '', 'g') AS bare FROM l),
h AS (SELECT *, bare <> '' AND abs(length(bare) - 6) <= 3 AND levenshtein(regexp_replace(bare, '[^\x01-\x7f]', '?', 'g'), 'Befund') <= 3 AND t <> '== Befund ==' AS hit FROM b),
n AS (SELECT article_id, string_agg(CASE WHEN hit THEN '== Befund ==' ELSE line END, chr(10) ORDER BY line_no) AS new, count(*) FILTER (WHERE hit)::INTEGER AS fixed FROM h GROUP BY 1)
SELECT article_id, CASE WHEN fixed > 0 THEN new || CASE WHEN ends_with(body, chr(10)) THEN chr(10) ELSE '' END ELSE body END AS text, fixed FROM n JOIN x USING (article_id)
""")
def heading_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """Near spellings of a heading become that heading. Both sides append one to every body, some with umlauts."""
    k = F.col("article_id") % 4
    said = F.when(k == 0, "= Befünd ==").when(k == 1, "Refnd").when(k == 2, "== Befund ==").otherwise("Böfüde")
    rows = bodies(spark, d).select("article_id", F.concat("body", F.lit("\n"), said, F.when(F.col("article_id") % 3 == 0, "\n").otherwise("")).alias("text"))
    return lines.rewritten_headings(rows, "text", "Befund")


@query(rf"""
WITH l AS ({BODY_LINES}), h AS (SELECT article_id, line_no, replace(line, 'Befund', 'BEFUND') AS line FROM l)
SELECT article_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM h GROUP BY 1
""")
def lines_rejoined(spark: SparkSession, d: str) -> DataFrame:
    """Bodies cut into lines, changed, and joined again in order."""
    each = lines.exploded(bodies(spark, d), ["article_id"], "body")
    return lines.rejoined(each.withColumn("line", F.replace("line", F.lit("Befund"), F.lit("BEFUND"))), ["article_id"])


@query(rf"""
WITH c AS (SELECT article_id, regexp_replace(replace(body, '. ', ' . '), '[ \t]+([,.;:!?])', '\1', 'g') AS t FROM ({r.ARTICLES}) WHERE body IS NOT NULL),
l AS (SELECT article_id, list_transform(string_split(regexp_replace(t, '\n$', ''), chr(10)), lambda x: regexp_replace(x, '\s+$', '')) AS ls FROM c),
w AS (SELECT article_id, array_to_string(list_transform(ls, lambda x: CASE WHEN starts_with(trim(x), '== ') AND ends_with(trim(x), ' ==') AND NOT starts_with(trim(x), '=== ') THEN chr(10) || x || chr(10) ELSE x END), chr(10)) AS t FROM l)
SELECT article_id, regexp_replace(regexp_replace(t, '\n\n\n+', chr(10) || chr(10), 'g'), '^\n+|\n+$', '', 'g') AS body FROM w
""")
def body_normalise(spark: SparkSession, d: str) -> DataFrame:
    """Normal form of bodies; both sides put spaces before full stops first."""
    rows = bodies(spark, d).select("article_id", F.replace("body", F.lit(". "), F.lit(" . ")).alias("body"))
    return rows.select("article_id", ft.normal_body(F.col("body")).alias("body"))


@query(rf"""
WITH x AS (SELECT article_id, chr(10) || '== ' || CASE WHEN article_id % 2 = 0 THEN upper(regexp_replace(band_prefix, '[^A-Za-z]', '', 'g')) ELSE band_prefix END || ' ==' || chr(10) || chr(10) || body AS body FROM ({r.ARTICLES}) WHERE body IS NOT NULL)
SELECT article_id, CASE WHEN article_id % 2 = 0 THEN chr(10) || regexp_replace(substr(body, 13), '^(?:[ \t]*\n)+', '') ELSE body END AS body FROM x
""")
def all_caps_heading(spark: SparkSession, d: str) -> DataFrame:
    """A leading heading in capitals goes; half the bodies are given one, the others one in mixed case."""
    name = F.when(F.col("article_id") % 2 == 0, F.upper(F.regexp_replace("band_prefix", "[^A-Za-z]", ""))).otherwise(F.col("band_prefix"))
    rows = r.latest_articles(spark, d, "band_prefix", "body").where("body is not null")
    return rows.select("article_id", fa.without_leading_caps(F.concat(F.lit("\n== "), name, F.lit(" ==\n\n"), "body")).alias("body"))


@query(r"""
WITH RECURSIVE p AS (SELECT doc_id, regexp_split_to_array(text, '\n\s*\n') AS ps FROM documents WHERE text IS NOT NULL),
f(doc_id, i, chunk, n) AS (
  SELECT doc_id, 1, 1, length(ps[1]) + 2 FROM p
  UNION ALL
  SELECT f.doc_id, f.i + 1, CASE WHEN f.n + length(p.ps[f.i + 1]) + 2 > 1000 THEN f.chunk + 1 ELSE f.chunk END, CASE WHEN f.n + length(p.ps[f.i + 1]) + 2 > 1000 THEN length(p.ps[f.i + 1]) + 2 ELSE f.n + length(p.ps[f.i + 1]) + 2 END
  FROM f JOIN p USING (doc_id) WHERE f.i < len(p.ps)
)
SELECT f.doc_id, chunk::INTEGER AS chunk_no, 'Text:' || chr(10) || string_agg(p.ps[f.i], chr(10) || chr(10) ORDER BY f.i) || chr(10) || chr(10) || 'Bereinigter Text:' || chr(10) AS prompt FROM f JOIN p USING (doc_id) GROUP BY 1, 2
""")
def greedy_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs packed into prompts of up to 1,000 characters."""
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(ft.packed(ft.paragraphs(F.col("text")), 1000)).alias("i", "c"))
    return docs.select("doc_id", (F.col("i") + 1).alias("chunk_no"), ft.prompt("Text:\n", F.col("c")).alias("prompt"))


@query(r"""
WITH w AS (SELECT doc_id, string_split(regexp_replace(text, '[^a-z ]', '', 'g'), ' ') AS ws FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN array_to_string(ws[1 : doc_id % 7 + 1], '') ELSE array_to_string(ws, '') END AS response FROM w
""")
def ndjson_concat(spark: SparkSession, d: str) -> DataFrame:
    """Streams of JSON lines, built word by word from whole texts, one in three with an early end; bad lines.

    The end stands at one of the first seven words. Lines between are blank or no objects.
    """
    words = F.split(F.regexp_replace("text", "[^a-z ]", ""), " ")
    early = F.col("doc_id") % 3 == 2
    line = lambda w, i: F.concat(F.lit('{"response":"'), w, F.lit('","done":'), F.when(early & (i == F.col("doc_id") % 7), "true").otherwise("false"), F.lit("}\nbad\n\n5"))
    payload = F.array_join(F.transform("w", line), "\n")
    return table(spark, d, "documents").where("text is not null").select("doc_id", words.alias("w")).select("doc_id", payload.alias("p")).transform(payloads.responses, "p")


@query(r"""
WITH f AS (SELECT doc_id, text, CASE doc_id % 4 WHEN 0 THEN chr(10) || '----' || chr(10) || '12' WHEN 1 THEN chr(10) || chr(10) || '---- ' || chr(10) || chr(10) WHEN 2 THEN chr(10) || '----' || chr(10) || repeat('zu lang', 9) ELSE chr(10) || '----' || repeat(chr(10) || 'x', 14) END AS foot FROM documents WHERE text IS NOT NULL),
x AS (SELECT doc_id, CASE WHEN contains(text, 'citation-page-bottom:') THEN text ELSE regexp_replace(text, '\s+$', '') || foot || chr(10) || '<!-- citation-page-bottom: B p1 -->' END AS t FROM f),
l AS (SELECT *, string_split(t, chr(10)) AS ls FROM x),
b AS (SELECT *, list_max(list_filter(range(1, len(ls) + 1), lambda i: contains(ls[i], 'citation-page-bottom:'))) AS low FROM l),
r AS (SELECT *, list_max(list_filter(range(greatest(low - 14, 1), low), lambda i: regexp_matches(ls[i], '^\s*----'))) AS rule FROM b),
k AS (SELECT *, coalesce(list_max(list_filter(range(1, rule), lambda i: NOT regexp_full_match(ls[i], '\s*'))), 0) AS kept FROM r),
c AS (SELECT doc_id, t, CASE WHEN rule IS NULL THEN t ELSE array_to_string(ls[1:kept] || ls[low:], chr(10)) END AS cut FROM k)
SELECT doc_id, CASE WHEN length(t) - length(cut) BETWEEN 1 AND 18 THEN cut ELSE t END AS text, (length(t) - length(cut))::INTEGER AS removed, length(t) - length(cut) BETWEEN 1 AND 18 AS applied FROM c
""")
def footer_trim(spark: SparkSession, d: str) -> DataFrame:
    """Footers taken off all texts. Texts with comments at the bottom are taken as they are, all others with
    a footer appended."""
    docs = table(spark, d, "documents").where("text is not null")
    text = F.when(F.contains("text", F.lit("citation-page-bottom:")), F.col("text")).otherwise(with_footer())
    return lines.without_footer(docs.select("doc_id", text.alias("text")), "text").select("doc_id", "text", "removed", "applied")


def with_footer() -> Column:
    """The text with one of four footers and a comment at the bottom."""
    k = F.col("doc_id") % 4
    foot = F.when(k == 0, "\n----\n12").when(k == 1, "\n\n---- \n\n").when(k == 2, "\n----\n" + "zu lang" * 9).otherwise("\n----" + "\nx" * 14)
    return F.concat(F.regexp_replace("text", r"\s+\z", ""), foot, F.lit("\n<!-- citation-page-bottom: B p1 -->"))


@query(r"""
WITH l AS (SELECT doc_id, regexp_extract(text, '^<!-- citation-page-top: (\S+) p([0-9]+) -->\n', 1) AS v, regexp_extract(text, '^<!-- citation-page-top: (\S+) p([0-9]+) -->\n', 2) AS p FROM documents)
SELECT doc_id, v AS volume, p::INTEGER AS page FROM l WHERE v <> ''
""")
def page_comment_parse(spark: SparkSession, d: str) -> DataFrame:
    """Page comments at the very beginning of documents; texts without one are left alone."""
    form = r"\A<!-- citation-page-top: (\S+) p([0-9]+) -->\n"
    return table(spark, d, "documents").where(F.col("text").rlike(form)).select("doc_id", F.regexp_extract("text", form, 1).alias("volume"), F.regexp_extract("text", form, 2).cast("int").alias("page"))


@query(r"""
WITH x AS (SELECT d.doc_id, d.text, d.source || '_chunk' || lpad((d.doc_id // 25 + 1)::VARCHAR, 3, '0') AS folder, (d.doc_id % 25 + 1) AS page, coalesce(replace(v.citation_label, ' ', ''), d.source) AS label,
  (coalesce(v.chunk_offset, 0) + d.doc_id // 25) * 50 + (d.doc_id % 25 + 1) * 2 - 2 AS top FROM documents d LEFT JOIN volumes v ON v.band_prefix = d.source WHERE d.text IS NOT NULL)
SELECT doc_id, '<!-- dropbox: https://example.org/scans/' || folder || '.pdf#page=' || page || ' -->' || chr(10) || '<!-- citation-page-top: ' || label || ' p' || top || ' -->' || chr(10) || regexp_replace(text, '\n+$', '') ||
  chr(10) || '<!-- citation-page-bottom: ' || label || ' p' || (top + 1) || ' -->' || chr(10) AS text, true AS changed, false AS changed_again FROM x
""")
def page_relink(spark: SparkSession, d: str) -> DataFrame:
    """Raw pages (built from texts and keys) linked, and linked again without a change."""
    docs = table(spark, d, "documents").where("text is not null")
    folder = F.concat("source", F.lit("_chunk"), F.lpad(F.expr("doc_id div 25 + 1").cast("string"), 3, "0"))
    page = F.concat(F.lit("<!-- "), folder, F.lit(" Page "), (F.col("doc_id") % 25 + 1).cast("string"), F.lit(" -->\n<!-- x_chunk1 Original Page 3 -->\n"), "text")
    volumes, url = table(spark, d, "volumes"), "https://example.org/scans"
    once = citations.relinked(docs.select("doc_id", page.alias("text")), "text", volumes, url)
    twice = citations.relinked(once.withColumnRenamed("changed", "first"), "text", volumes, url)
    return twice.select("doc_id", "text", F.col("first").alias("changed"), F.col("changed").alias("changed_again"))


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL),
n AS (SELECT doc_id, i, line, try_cast(regexp_extract(line, '<!-- citation-page-(?:top|bottom): \S+ p([0-9]+) -->', 1) AS INTEGER) AS n FROM l),
s AS (SELECT doc_id, i, line, CASE WHEN n >= 100 THEN regexp_replace(line, ' p[0-9]+ -->', ' p' || (n + 2) || ' -->') ELSE line END AS new FROM n)
SELECT doc_id, string_agg(new, chr(10) ORDER BY i) AS text, count(*) FILTER (WHERE new <> line)::INTEGER AS changed_lines FROM s GROUP BY 1
""")
def page_shift_text(spark: SparkSession, d: str) -> DataFrame:
    """Texts with their citation comments moved, and the number of lines changed."""
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "text", citations.shifted(F.col("text"), 100, 2).alias("new"))
    return docs.select("doc_id", F.col("new").alias("text"), citations.changed_lines(F.col("text"), F.col("new")).alias("changed_lines"))


# ------------------------------------------------------------------ layout


JOINED = r"""
r AS (SELECT region_id, band_prefix, chunk, page, label, reading_pos, image_path, caption, caption_matched, lines FROM (SELECT DISTINCT ON (region_id) * FROM layout_regions ORDER BY region_id)),
u AS (SELECT region_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM r),
n AS (SELECT region_id, i, regexp_replace(line, '\s+$', '') AS t, lead(regexp_replace(line, '^\s+', '')) OVER (PARTITION BY region_id ORDER BY i) AS nxt FROM u),
j AS (SELECT region_id, regexp_replace(string_agg(CASE WHEN t = '' THEN '' WHEN ends_with(t, '¬') THEN regexp_replace(regexp_replace(t, '¬+$', ''), '\s+$', '') WHEN ends_with(t, '-') AND regexp_matches(nxt, '^\p{Ll}') THEN regexp_replace(left(t, length(t) - 1), '\s+$', '') ELSE t || ' ' END, '' ORDER BY i), '^\s+|\s+$', '', 'g') AS text FROM n GROUP BY 1)
"""


@query("WITH " + JOINED + "SELECT r.region_id, coalesce(j.text, '') AS text FROM r LEFT JOIN j USING (region_id)")
def dehyphenate(spark: SparkSession, d: str) -> DataFrame:
    """Lines of every region joined."""
    return r.regions(spark, d, "lines").select("region_id", ft.dehyphenated(F.col("lines")).alias("text"))


#: The pages assembled from their regions: ends in the table ``pages``.
PAGE_TEXTS = JOINED + r""",
k AS (SELECT r.*, coalesce(j.text, '') AS t, band_prefix || '_chunk' || lpad(chunk::VARCHAR, 3, '0') AS folder FROM r LEFT JOIN j USING (region_id)),
m AS (SELECT *, CASE WHEN label IN ('Picture', 'Figure') THEN chr(10) || '[[File:' || image_path || '|thumb' || CASE WHEN coalesce(caption, '') <> '' THEN '|' || caption ELSE '' END || ']]' || chr(10)
 WHEN label = 'Table' THEN CASE WHEN len(lines) > 0 THEN chr(10) || '{| class="wikitable"' || chr(10) || '|-' || chr(10) || array_to_string(list_transform(list_filter(lines, lambda x: trim(x) <> ''), lambda x: '| ' || regexp_replace(x, '^\s+|\s+$', '', 'g')), chr(10) || '|-' || chr(10)) || chr(10) || '|}' || chr(10) END
 WHEN t = '' THEN NULL WHEN label = 'Caption' THEN CASE WHEN NOT coalesce(caption_matched, false) THEN chr(10) || '''''''' || t || '''''''' || chr(10) END
 WHEN label IN ('Section-header', 'SectionHeader') THEN chr(10) || '== ' || t || ' ==' || chr(10) WHEN label IN ('Page-header', 'PageHeader') THEN '<!-- header: ' || t || ' -->'
 WHEN label IN ('Page-footer', 'PageFooter', 'Footnote') THEN CASE WHEN regexp_full_match(t, '[0-9]{1,4}') AND try_cast(t AS INTEGER) BETWEEN 1 AND 1000 THEN '<!-- ' || folder || ' Original Page ' || t || ' -->' ELSE chr(10) || '----' || chr(10) || t || chr(10) END
 ELSE t END AS m FROM k),
pages AS (SELECT band_prefix, chunk, page, CASE WHEN count(*) FILTER (WHERE m <> '') > 0 THEN '<!-- ' || any_value(folder) || ' Page ' || page || ' -->' || chr(10) || chr(10) || string_agg(m, chr(10) || chr(10) ORDER BY reading_pos, region_id) FILTER (WHERE m <> '') || chr(10) ELSE '' END AS text FROM m GROUP BY 1, 2, 3)
"""


@query("WITH " + PAGE_TEXTS + "SELECT * FROM pages")
def region_render(spark: SparkSession, d: str) -> DataFrame:
    """Pages assembled from their regions."""
    return layout.assembled_pages(r.regions(spark, d, "band_prefix", "chunk", "page", "label", "reading_pos", "image_path", "caption", "caption_matched", "lines"))


@query(rf"""
WITH r AS ({r.REGIONS}), c AS (SELECT *, (bbox['y1'] + bbox['y2']) / 2.0::DOUBLE AS cy FROM r WHERE label = 'Caption' AND regexp_replace(text, '^\s+|\s+$', '', 'g') <> ''), i AS (SELECT *, (bbox['y1'] + bbox['y2']) / 2.0::DOUBLE AS iy FROM r WHERE label IN ('Picture', 'Figure'))
SELECT c.band_prefix, c.chunk, c.page, c.region_id AS caption_id, i.region_id AS image_id, abs(cy - iy)::DOUBLE AS distance FROM c JOIN i USING (band_prefix, chunk, page)
QUALIFY row_number() OVER (PARTITION BY c.region_id ORDER BY abs(cy - iy), i.reading_pos, i.region_id) = 1
""")
def nearest_match(spark: SparkSession, d: str) -> DataFrame:
    """The image nearest to every caption of a page."""
    found = layout.matched_captions(r.regions(spark, d, "band_prefix", "chunk", "page", "label", "reading_pos", "bbox", "text"))
    return found.select("band_prefix", "chunk", "page", "caption_id", "image_id", "distance")


@query(rf"""
SELECT region_id, row_number() OVER (PARTITION BY band_prefix, chunk, page ORDER BY reading_pos, region_id)::INTEGER AS image_no, greatest(0, bbox['x1'] - 5)::INTEGER AS x1, greatest(0, bbox['y1'] - 5)::INTEGER AS y1, least(2000, bbox['x2'] + 5)::INTEGER AS x2, least(3000, bbox['y2'] + 5)::INTEGER AS y2
FROM ({r.REGIONS}) WHERE label IN ('Picture', 'Figure') AND bbox['x2'] - bbox['x1'] >= 150 AND bbox['y2'] - bbox['y1'] >= 150
""")
def kept_ordinal(spark: SparkSession, d: str) -> DataFrame:
    """Kept images, their number on the page and their crop."""
    kept = layout.kept_images(r.regions(spark, d, "band_prefix", "chunk", "page", "label", "reading_pos", "bbox"))
    return kept.select("region_id", "image_no", layout.crop(5, F.lit(2000), F.lit(3000)).alias("c")).select("region_id", "image_no", "c.*")


@query(rf"SELECT label, count(*)::BIGINT AS n FROM ({r.REGIONS}) WHERE label IN ('Text', 'Caption', 'Section-header', 'SectionHeader', 'Page-header', 'PageHeader', 'Page-footer', 'PageFooter', 'Footnote', 'List-item', 'Table') AND bbox['x2'] - bbox['x1'] >= 20 AND bbox['y2'] - bbox['y1'] >= 10 GROUP BY 1")
def text_region_counts(spark: SparkSession, d: str) -> DataFrame:
    """F11."""
    return layout.text_regions(r.regions(spark, d, "label", "bbox")).groupBy("label").agg(F.count("*").alias("n"))


@query("""
WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: trunc(abs(x) * 100::FLOAT)::INTEGER) AS h FROM embeddings),
u AS (SELECT vec_id, unnest(h) AS v, unnest(range(0, len(h))) AS i, len(h) AS n FROM p),
f AS (SELECT *, (v > 5 AND NOT coalesce(lag(v > 5) OVER (PARTITION BY vec_id ORDER BY i), false))::INT AS s FROM u),
g AS (SELECT *, sum(s) OVER (PARTITION BY vec_id ORDER BY i) AS g FROM f),
r AS (SELECT vec_id, g, min(i) AS a, max(i) + 1 AS b FROM g WHERE v > 5 GROUP BY 1, 2 HAVING max(i) + 1 - min(i) > 2)
SELECT vec_id, a::INTEGER AS run_from, b::INTEGER AS run_to FROM r
UNION ALL SELECT vec_id, 0, len(h)::INTEGER FROM p WHERE vec_id NOT IN (SELECT vec_id FROM r) AND list_sum(h) > 100
""")
def projection_runs(spark: SparkSession, d: str) -> DataFrame:
    """Text lines as runs of a projection taken from numeric arrays (threshold 5, longer than 2)."""
    h = F.transform("embedding", lambda x: (F.abs(x) * F.lit(100).cast("float")).cast("int"))
    rows = table(spark, d, "embeddings").select("vec_id", h.alias("h")).select("vec_id", F.explode(layout.runs_over(F.col("h"), 5, 2)).alias("r"))
    return rows.select("vec_id", F.col("r.a").alias("run_from"), F.col("r.b").alias("run_to"))


@query("""
WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: trunc(abs(x) * 1000::FLOAT)::INTEGER) AS m FROM embeddings),
w AS (SELECT vec_id, len(m) AS n, coalesce(list_position(list_transform(m, lambda x: x < 150), true) - 1, len(m)) AS a, coalesce(list_position(list_reverse(list_transform(m, lambda x: x < 150)), true) - 1, len(m)) AS z FROM p),
t AS (SELECT vec_id, n, a::INTEGER AS lead_white, greatest(0, a - 3) AS lo, least(n, n - z + 3) AS hi FROM w)
SELECT vec_id, lead_white, (CASE WHEN lo >= hi THEN 0 ELSE lo END)::INTEGER AS x1, (CASE WHEN lo >= hi THEN 0 ELSE lo END)::INTEGER AS y1, (CASE WHEN lo >= hi THEN n ELSE hi END)::INTEGER AS x2, (CASE WHEN lo >= hi THEN n ELSE hi END)::INTEGER AS y2 FROM t
""")
def white_strip(spark: SparkSession, d: str) -> DataFrame:
    """White margins of projections taken from numeric arrays."""
    m = F.transform("embedding", lambda x: (F.abs(x) * F.lit(1000).cast("float")).cast("int"))
    rows = layout.trimmed(table(spark, d, "embeddings").select("vec_id", m.alias("m")), "m", "m")
    return rows.select("vec_id", layout.white_strip(F.col("m")).alias("lead_white"), "x1", "y1", "x2", "y2")
