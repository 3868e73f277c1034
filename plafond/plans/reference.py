"""Queries of the document pipeline's own operators, with the SQL that gives the same rows.

Each query runs over its whole tables. Where the tables lack the markup an operator reads (footers, JSON
lines, file names), both sides build it from columns with the same expression; the docstrings say so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plafond.functions import keys as fk
from plafond.functions import text as ft
from plafond.operators import lines, reports
from plafond.operators.intervals import latest_by
from plafond.session import broadcast_if_small, once, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def latest_articles(spark: SparkSession, d: str, *columns: str | Column) -> DataFrame:
    """The latest delivery of every article, with only the columns needed.

    Columns may be expressions: measures are computed in the scan, and their rows are ranked. Bodies themselves do not
    go through a shuffle: their repeats are told by narrow rows.
    """
    rows = table(spark, d, "articles")
    if any(isinstance(c, str) and c == "body" for c in columns):
        return once(rows, "article_id", "delivered_at", "article_id", *columns)
    latest = Window.partitionBy("article_id").orderBy(F.desc("delivered_at"))
    ranked = rows.select("article_id", "delivered_at", *columns).withColumn("_r", F.row_number().over(latest))
    return ranked.where("_r = 1").drop("_r", "delivered_at")


def regions(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Layout regions, each once, with only the columns needed; texts are not shuffled."""
    if not {"lines", "text"} & set(columns):
        return table(spark, d, "layout_regions").select("region_id", *columns).dropDuplicates(["region_id"])
    return once(table(spark, d, "layout_regions"), "region_id", "ingested_at", "region_id", *columns)


ARTICLES = "SELECT DISTINCT ON (article_id) * FROM articles ORDER BY article_id, delivered_at DESC"
REGIONS = "SELECT DISTINCT ON (region_id) * FROM layout_regions ORDER BY region_id"
SP = r"\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
N_WORDS = f"len(regexp_extract_all(body, '[^{SP}]+'))"
N_EMBEDS = r"len(regexp_extract_all(body, '(?i)\[\[File:'))"


# ------------------------------------------------------------------ statistics


@query(rf"""
WITH a AS ({ARTICLES}), m AS (
  SELECT CASE WHEN coalesce(fields['Meta'], '') <> '' THEN 'meta' ELSE 'content' END AS grp,
         length(body) AS chars, {N_WORDS} AS words, {N_EMBEDS} AS embeds FROM a WHERE body IS NOT NULL
)
SELECT CASE WHEN grouping(grp) = 1 THEN 'total' ELSE grp END AS grp, count(*)::BIGINT AS articles, sum(chars)::BIGINT AS chars, sum(words)::BIGINT AS words,
       sum(embeds)::BIGINT AS embeds, (sum(chars) // 4)::BIGINT AS tokens, sum(chars)::DOUBLE / count(*) AS avg_chars, sum(words)::DOUBLE / count(*) AS avg_words, sum(embeds)::DOUBLE / count(*) AS avg_embeds
FROM m GROUP BY ROLLUP (grp)
""")
def corpus_stats_rollup(spark: SparkSession, d: str) -> DataFrame:
    """A1-A4, P10: articles, characters, words, embeds and tokens by kind of article, with a total."""
    meta = F.coalesce(F.col("fields")["Meta"], F.lit(""))
    rows = latest_articles(spark, d, meta.alias("meta"), F.length("body").cast("bigint").alias("chars"), ft.words(F.col("body")).alias("words"), ft.embeds(F.col("body")).alias("embeds")).where("chars is not null")
    return reports.corpus_stats(rows, F.when(F.col("meta") != "", "meta").otherwise("content"))


@query(rf"""
SELECT CASE WHEN grouping(source) = 1 THEN 'TOTAL' ELSE source END AS source, count(*)::BIGINT AS files, sum(length(text))::BIGINT AS chars,
       sum(len(regexp_extract_all(text, '[^{SP}]+')))::BIGINT AS words FROM documents WHERE text IS NOT NULL GROUP BY ROLLUP (source)
""")
def file_counts_total(spark: SparkSession, d: str) -> DataFrame:
    """Files, words and characters per volume and in total."""
    rows = table(spark, d, "documents").where("text is not null").select("source", F.length("text").cast("bigint").alias("c"), ft.words(F.col("text")).alias("w"))
    return rows.rollup("source").agg(F.grouping("source").alias("g"), F.count("*").alias("files"), F.sum("c").alias("chars"), F.sum("w").alias("words")).select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("source")).alias("source"), "files", "chars", "words")


@query(rf"""
SELECT article_id, {N_EMBEDS}::BIGINT AS opened, len(regexp_extract_all(body, '(?i)\[\[File:[^\]]+\]\]'))::BIGINT AS closed FROM ({ARTICLES}) WHERE body IS NOT NULL
""")
def embed_counters(spark: SparkSession, d: str) -> DataFrame:
    """A5: the two counters of file links per article."""
    return latest_articles(spark, d, ft.embeds(F.col("body")).alias("opened"), ft.closed_embeds(F.col("body")).alias("closed")).where("opened is not null")


@query(f"SELECT article_id, CASE WHEN length(body) < 1000 THEN 'small' WHEN length(body) > 50000 THEN 'large' ELSE 'normal' END AS size_band FROM ({ARTICLES}) WHERE body IS NOT NULL")
def size_bands(spark: SparkSession, d: str) -> DataFrame:
    """F8."""
    return latest_articles(spark, d, F.length("body").alias("n")).where("n is not null").select("article_id", ft.size_band(F.col("n")).alias("size_band"))


@query("SELECT DISTINCT band_prefix FROM layout_regions ORDER BY 1")
def volumes_present(spark: SparkSession, d: str) -> DataFrame:
    """Volumes that have any page."""
    return table(spark, d, "layout_regions").select("band_prefix").distinct().orderBy("band_prefix")


# ------------------------------------------------------------------ keys


@query(r"""
WITH b AS (SELECT row_id, delivered_at, band, regexp_extract(band, '^Band\s+([0-9]+)(?:,\s*(I+))?', 1) AS no, regexp_extract(band, '^Band\s+([0-9]+)(?:,\s*(I+))?', 2) AS part FROM liste_baende WHERE band IS NOT NULL)
SELECT DISTINCT row_id, delivered_at, CASE WHEN no = '' THEN '' ELSE 'Band' || CASE WHEN length(no::BIGINT::VARCHAR) < 2 THEN '0' ELSE '' END || no::BIGINT::VARCHAR ||
  CASE part WHEN '' THEN '' WHEN 'II' THEN '-2' WHEN 'III' THEN '-3' ELSE '-1' END END AS prefix,
  coalesce(nullif(regexp_extract(band, '[0-9]+'), ''), band) AS first_number FROM b
""")
def volume_prefix(spark: SparkSession, d: str) -> DataFrame:
    """Directory prefix and first number of volume names."""
    rows = table(spark, d, "liste_baende").where("band is not null")
    return rows.select("row_id", "delivered_at", fk.strict_volume_prefix(F.col("band")).alias("prefix"), fk.first_number(F.col("band")).alias("first_number")).distinct()


@query(r"""
WITH f AS (SELECT DISTINCT band_prefix || '_chunk' || lpad(chunk::VARCHAR, 3, '0') AS folder, 'p' || lpad(page::VARCHAR, 3, '0') || '.wiki' AS file FROM layout_regions)
SELECT folder, file, regexp_extract(folder, '^(Band[0-9-]+)_chunk([0-9]+)', 1) AS band, regexp_extract(folder, '_chunk([0-9]+)', 1)::INTEGER AS chunk, regexp_extract(file, '^p([0-9]+)\.wiki$', 1)::INTEGER AS page,
  regexp_extract(folder, '^Band([0-9]+)', 1)::INTEGER AS key_band, coalesce(nullif(regexp_extract(folder, '^Band[0-9]+-([0-9]+)', 1), ''), '0')::INTEGER AS key_part, true AS is_folder FROM f
""")
def folder_key_parse(spark: SparkSession, d: str) -> DataFrame:
    """Folder and file names (built from the page keys) parsed back."""
    folder = F.concat("band_prefix", F.lit("_chunk"), F.lpad(F.col("chunk").cast("string"), 3, "0"))
    file = F.concat(F.lit("p"), F.lpad(F.col("page").cast("string"), 3, "0"), F.lit(".wiki"))
    names = table(spark, d, "layout_regions").select(folder.alias("folder"), file.alias("file")).distinct()
    parts, key = fk.folder_parts(F.col("folder")), fk.folder_key(F.col("folder"))
    return names.select("folder", "file", parts["band"].alias("band"), parts["chunk"].alias("chunk"), fk.page_number(F.col("file")).alias("page"), key["band"].alias("key_band"), key["part"].alias("key_part"), fk.is_folder_name(F.col("folder")).alias("is_folder"))


@query(r"""
SELECT doc_id, nullif(regexp_extract(text, '<!--\s*citation-page-top:\s*(\S+)\s+p([0-9]+)\s*-->', 1), '') AS volume,
  nullif(regexp_extract(text, '<!--\s*citation-page-top:\s*\S+\s+p([0-9]+)\s*-->', 1), '')::INTEGER AS top, nullif(regexp_extract(text, '<!--\s*citation-page-bottom:\s*\S+\s+p([0-9]+)\s*-->', 1), '')::INTEGER AS bottom FROM documents
""")
def citation_extract(spark: SparkSession, d: str) -> DataFrame:
    """Printed pages and volume of every document's citation comments."""
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", fk.citation_volume(t).alias("volume"), fk.citation_page(t, "top").alias("top"), fk.citation_page(t, "bottom").alias("bottom"))


@query("""
SELECT DISTINCT r.band_prefix, r.chunk, r.page, v.citation_label, ((coalesce(v.chunk_offset, 0) + r.chunk - 1) * 50 + r.page * 2 - 2)::INTEGER AS top, ((coalesce(v.chunk_offset, 0) + r.chunk - 1) * 50 + r.page * 2 - 1)::INTEGER AS bottom,
  '<!-- citation-page-top: ' || v.citation_label || ' p' || ((coalesce(v.chunk_offset, 0) + r.chunk - 1) * 50 + r.page * 2 - 2) || ' -->' AS header
FROM layout_regions r LEFT JOIN volumes v USING (band_prefix)
""")
def printed_page(spark: SparkSession, d: str) -> DataFrame:
    """Printed pages and page comments from scan keys and the catalogue of volumes."""
    keys = table(spark, d, "layout_regions").select("band_prefix", "chunk", "page").distinct()
    top = fk.printed_page(F.col("chunk"), F.col("page"), F.col("chunk_offset"))
    joined = keys.join(broadcast_if_small(table(spark, d, "volumes")), "band_prefix", "left").withColumn("top", top.cast("int"))
    return joined.select("band_prefix", "chunk", "page", "citation_label", "top", (F.col("top") + 1).alias("bottom"), F.concat(F.lit("<!-- citation-page-top: "), "citation_label", F.lit(" p"), F.col("top").cast("string"), F.lit(" -->")).alias("header"))


@query(r"""
WITH v AS (SELECT source AS moving FROM documents WHERE source IS NOT NULL GROUP BY 1 ORDER BY count(*), 1 LIMIT 1), l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, source, line, nullif(regexp_extract(line, '^<!-- citation-page-(?:top|bottom): \S+ p([0-9]+) -->', 1), '')::INTEGER AS n FROM l)
SELECT doc_id, n AS page_before, CASE WHEN source = moving AND n >= 14 THEN n + 2 ELSE n END::INTEGER AS page_after, (source = moving AND n >= 14) AS changed FROM p, v WHERE n IS NOT NULL
""")
def page_shift(spark: SparkSession, d: str) -> DataFrame:
    """Citation pages of one volume, that with the fewest documents, moved by 2 from page 14 on, every citation
    line of every document."""
    docs = table(spark, d, "documents")
    volume = docs.where("source is not null").groupBy("source").count().orderBy("count", "source").first()
    each = lines.exploded(docs.where("text is not null"), ["doc_id", "source"], "text")
    n = fk.extract(F.col("line"), r"\A<!-- citation-page-(?:top|bottom): \S+ p([0-9]+) -->").cast("int")
    moved = (F.col("source") == (volume["source"] if volume else None)) & (F.col("n") >= 14)
    return each.withColumn("n", n).where("n is not null").select("doc_id", F.col("n").alias("page_before"), F.when(moved, F.col("n") + 2).otherwise(F.col("n")).alias("page_after"), moved.alias("changed"))


@query(rf"""
SELECT article_id, trim(regexp_replace(regexp_replace(replace(replace(replace(n, '/', '-'), '\', '-'), ':', ' -'), '[<>"|?*]', '', 'g'), '\s+', ' ', 'g'), ' ') AS safe
FROM (SELECT article_id, file_stem || '/' || coalesce(fields['Typ'], '?') || ': "' || coalesce(fields['Ort'], '*') || '"  \' || article_id AS n FROM ({ARTICLES}))
""")
def filename_sanitize(spark: SparkSession, d: str) -> DataFrame:
    """Safe file names; the unsafe characters are put in from other fields on both sides."""
    f = F.col("fields")
    n = F.concat("file_stem", F.lit("/"), F.coalesce(f["Typ"], F.lit("?")), F.lit(': "'), F.coalesce(f["Ort"], F.lit("*")), F.lit('"  \\'), F.col("article_id").cast("string"))
    return latest_articles(spark, d, "file_stem", "fields").select("article_id", fk.safe_file_name(n).alias("safe"))


LATEST_LIST = "SELECT DISTINCT ON (row_id) * FROM liste_baende ORDER BY row_id, delivered_at DESC, band, bauwerk"


def latest_list(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return latest_by(table(spark, d, "liste_baende").select("row_id", "delivered_at", *columns), "row_id", F.col("delivered_at")).drop("delivered_at")


@query(rf"""
WITH x AS (SELECT row_id, bauwerk, unnest(list_filter(list_transform(string_split('Zu Turm: ' || literaturangabe || chr(10) || '& ' || literaturangabe, chr(10)), lambda x: trim(regexp_replace(trim(x), '^&+', ''))), lambda x: x <> '')) AS part FROM ({LATEST_LIST}) WHERE literaturangabe IS NOT NULL AND bauwerk IS NOT NULL)
SELECT row_id, part, CASE WHEN fine THEN ends[1] ELSE '' END AS page_from, CASE WHEN fine THEN ends[len(ends)] ELSE '' END AS page_to,
  CASE WHEN strpos(bauwerk, ',') > 0 THEN left(bauwerk, strpos(bauwerk, ',') - 1) ELSE bauwerk END AS place,
  CASE WHEN strpos(part, ': ') > 0 THEN substr(part, strpos(part, ': ') + 2) ELSE part END AS bare,
  CASE WHEN starts_with(part, 'Zu ') AND strpos(part, ':') > 0 AND trim(substr(split_part(part, ':', 1), 3)) <> '' THEN bauwerk || ', ' || trim(substr(split_part(part, ':', 1), 3)) ELSE bauwerk END AS building
FROM (SELECT *, contains(part, 'S') AND len(ends) <= 2 AND len(list_filter(ends, lambda e: NOT regexp_full_match(e, '[0-9]+'))) = 0 AS fine
  FROM (SELECT *, list_transform(string_split(replace(ltrim(CASE WHEN starts_with(tail, '.') THEN substr(tail, 2) ELSE tail END), '–', '-'), '-'), lambda e: CASE WHEN contains(tail, '-') OR contains(tail, '–') THEN trim(e) ELSE e END) AS ends
    FROM (SELECT *, CASE WHEN ends_with(rtrim(string_split(part, 'S')[-1]), '.') THEN left(rtrim(string_split(part, 'S')[-1]), length(rtrim(string_split(part, 'S')[-1])) - 1) ELSE rtrim(string_split(part, 'S')[-1]) END AS tail FROM x)))
""")
def citation_range(spark: SparkSession, d: str) -> DataFrame:
    """Citations taken apart; each cell is given a second citation by the same expression."""
    rows = latest_list(spark, d, "bauwerk", "literaturangabe").where("literaturangabe is not null and bauwerk is not null")
    cell = F.concat(F.lit("Zu Turm: "), "literaturangabe", F.lit("\n& "), "literaturangabe")
    each = rows.select("row_id", "bauwerk", F.explode(fk.citation_parts(cell)).alias("part"))
    span = fk.citation_range(F.col("part"))
    return each.select("row_id", "part", span["page_from"].alias("page_from"), span["page_to"].alias("page_to"), fk.place_of(F.col("bauwerk")).alias("place"), fk.without_lead(F.col("part")).alias("bare"), fk.sub_building(F.col("bauwerk"), F.col("part")).alias("building"))


@query(r"""
WITH k AS (SELECT DISTINCT row_id, delivered_at, regexp_extract(band, '^Band\s+([0-9]+)(?:,\s*(I+))?', 1) AS b, regexp_extract(band, '^Band\s+([0-9]+)(?:,\s*(I+))?', 2) AS p, trim(seite_von, ' ') AS v FROM liste_baende)
SELECT row_id, delivered_at, coalesce(nullif(b, '')::INTEGER, 999) AS band, CASE p WHEN 'I' THEN 1 WHEN 'II' THEN 2 WHEN 'III' THEN 3 ELSE 0 END::INTEGER AS part, coalesce(CASE WHEN regexp_full_match(v, '[0-9]+') THEN try_cast(v AS INTEGER) END, 9999)::INTEGER AS page_from FROM k
""")
def row_order(spark: SparkSession, d: str) -> DataFrame:
    """The sort key of metadata rows."""
    key = fk.sort_key(F.col("band"), F.col("seite_von"))
    return table(spark, d, "liste_baende").select("row_id", "delivered_at", key.alias("k")).select("row_id", "delivered_at", "k.*").distinct()


@query("""
SELECT vec_id, trunc(least(embedding[1], embedding[3]) * 100)::INTEGER AS x1, trunc(least(embedding[2], embedding[4]) * 100)::INTEGER AS y1, trunc(greatest(embedding[1], embedding[3]) * 100)::INTEGER AS x2, trunc(greatest(embedding[2], embedding[4]) * 100)::INTEGER AS y2 FROM embeddings
""")
def bbox(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of two points taken from numeric arrays."""
    e = lambda i: F.col("embedding")[i] * F.lit(100).cast("float")
    box = fk.bbox_of(F.array(F.array(e(0), e(1)), F.array(e(2), e(3))))
    return table(spark, d, "embeddings").select("vec_id", box.alias("b")).select("vec_id", "b.*")


@query(r"""
WITH n AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN source || '_chunk' || doc_id || '.PDF' WHEN 1 THEN 'Index_chunk' || doc_id || '.pdf' WHEN 2 THEN source || '_p' || doc_id || '.jpeg' ELSE source || '.txt' END AS name FROM documents)
SELECT doc_id, name, regexp_matches(name, '^(Band[0-9-]+|Index)_chunk[0-9]+\.(?i:pdf)$') AS is_pdf, coalesce(lower(regexp_extract(name, '\.([^.]*)$', 1)) IN ('jpg', 'jpeg', 'png', 'tif', 'tiff'), false) AS is_image FROM n
""")
def source_files(spark: SparkSession, d: str) -> DataFrame:
    """File name filters over names built from document keys."""
    i, s = F.col("doc_id").cast("string"), F.col("source")
    kind = F.col("doc_id") % 4
    name = F.when(kind == 0, F.concat(s, F.lit("_chunk"), i, F.lit(".PDF"))).when(kind == 1, F.concat(F.lit("Index_chunk"), i, F.lit(".pdf"))).when(kind == 2, F.concat(s, F.lit("_p"), i, F.lit(".jpeg"))).otherwise(F.concat(s, F.lit(".txt")))
    return table(spark, d, "documents").select("doc_id", name.alias("name")).select("doc_id", "name", fk.is_source_pdf(F.col("name")).alias("is_pdf"), fk.is_image(F.col("name")).alias("is_image"))
