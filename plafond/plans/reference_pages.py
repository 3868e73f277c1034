"""Queries of page, list and join operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plafond.functions import articles as fa
from plafond.functions import keys as fk
from plafond.operators import pages
from plafond.operators.articles import parsed
from plafond.operators.lines import paired
from plafond.plans import reference as r
from plafond.session import broadcast_if_small, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


CITED = r"SELECT doc_id, source, stage, text, nullif(regexp_extract(text, '<!--\s*citation-page-top:\s*\S+\s+p([0-9]+)\s*-->', 1), '')::INTEGER AS top, nullif(regexp_extract(text, '<!--\s*citation-page-bottom:\s*\S+\s+p([0-9]+)\s*-->', 1), '')::INTEGER AS bottom FROM documents"


def cited(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", "source", "stage", *columns, fk.citation_page(t, "top").alias("top"), fk.citation_page(t, "bottom").alias("bottom"))


@query(f"""
WITH c AS ({CITED}), w AS (SELECT DISTINCT source, top FROM c WHERE stage = 'wiki' AND top IS NOT NULL), p AS (SELECT DISTINCT source, top FROM c WHERE stage = 'pass1' AND top IS NOT NULL),
m AS (SELECT source FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.source = w.source AND p.top = w.top))
SELECT CASE WHEN grouping(source) = 1 THEN 'TOTAL' ELSE source END AS source, count(*)::BIGINT AS missing FROM m GROUP BY ROLLUP (source)
""")
def missing_stage(spark: SparkSession, d: str) -> DataFrame:
    """Pages of the first stage that the second lacks, per volume and in total."""
    c = cited(spark, d).where("top is not null")
    gone = pages.only_in(c.where("stage = 'wiki'"), c.where("stage = 'pass1'"), ["source", "top"])
    return gone.rollup("source").agg(F.grouping("source").alias("g"), F.count("*").alias("missing")).select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("source")).alias("source"), "missing")


@query("""
WITH p AS (SELECT DISTINCT band_prefix, chunk, page FROM layout_regions WHERE label = 'Caption'), c AS (SELECT DISTINCT band_prefix, chunk FROM p), l AS (SELECT band_prefix, max(chunk) AS last FROM c GROUP BY 1),
e AS (SELECT c.band_prefix, c.chunk, unnest(range(1, 26))::INTEGER AS page FROM c JOIN l USING (band_prefix) WHERE c.chunk < l.last)
SELECT e.* FROM e ANTI JOIN p USING (band_prefix, chunk, page)
""")
def expected_series_gap(spark: SparkSession, d: str) -> DataFrame:
    """Pages without a caption in chunks of 25, the last chunk of a volume left out (no page is missing outright)."""
    return pages.missing_in_series(table(spark, d, "layout_regions").where("label = 'Caption'").select("band_prefix", "chunk", "page").distinct(), "band_prefix", "chunk", "page")


@query(f"""
WITH c AS ({CITED}), w AS (SELECT source, top, min(doc_id) AS wiki_id, min(bottom) AS wiki_bottom FROM c WHERE stage = 'wiki' AND top IS NOT NULL GROUP BY 1, 2)
SELECT c.doc_id, CASE WHEN c.bottom IS NULL AND w.wiki_bottom IS NOT NULL THEN 'copied' WHEN c.bottom IS NULL THEN 'missing' ELSE 'present' END AS status, coalesce(c.bottom, w.wiki_bottom)::INTEGER AS bottom, w.wiki_id
FROM c LEFT JOIN w ON c.source = w.source AND c.top = w.top WHERE c.stage = 'pass1'
""")
def stage_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Metadata of second-stage pages filled from the first stage's page of the same key."""
    c = cited(spark, d)
    wiki = c.where("stage = 'wiki' and top is not null").groupBy("source", "top").agg(F.min("doc_id").alias("wiki_id"), F.min("bottom").alias("wiki_bottom"))
    both = c.where("stage = 'pass1'").join(wiki, ["source", "top"], "left")
    status = F.when(F.col("bottom").isNull() & F.col("wiki_bottom").isNotNull(), "copied").when(F.col("bottom").isNull(), "missing").otherwise("present")
    return both.select("doc_id", status.alias("status"), F.coalesce("bottom", "wiki_bottom").alias("bottom"), "wiki_id")


@query(f"""
WITH c AS ({CITED}), k AS (SELECT DISTINCT source, unnest([top, bottom]) AS printed_page, doc_id FROM c)
SELECT source, printed_page, list_sort(list(doc_id)) AS files FROM k WHERE printed_page IS NOT NULL GROUP BY 1, 2
""")
def inverted_page_index(spark: SparkSession, d: str) -> DataFrame:
    """Printed page to the documents that hold it."""
    return pages.page_index(cited(spark, d), "source", "doc_id", "top", "bottom")


@query("""
WITH e AS (SELECT user_id, event_id, event_type FROM events), s AS (SELECT user_id, event_id FROM e WHERE event_type = (SELECT min(event_type) FROM events)), t AS (SELECT user_id, event_id FROM e WHERE event_type = (SELECT max(event_type) FROM events))
SELECT s.user_id, s.event_id AS start_at, (SELECT min(t.event_id) FROM t WHERE t.user_id = s.user_id AND t.event_id > s.event_id) AS end_at,
  (SELECT min(n.event_id) FROM s n WHERE n.user_id = s.user_id AND n.event_id > s.event_id) AS next_start FROM s
""")
def start_end_pairing(spark: SparkSession, d: str) -> DataFrame:
    """Every start event with the next end event of its user."""
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    ends = F.broadcast(e.agg(F.min("event_type").alias("a"), F.max("event_type").alias("z")))  # one row
    e = e.join(ends, F.col("event_type").isin(F.col("a"), F.col("z")))
    return paired(e, ["user_id"], "event_id", F.col("event_type") == F.col("a"), F.col("event_type") == F.col("z"))


@query("""
WITH n AS (SELECT band_prefix, article_id, delivered_at, trim(regexp_replace(regexp_replace(replace(replace(replace(file_stem, '/', '-'), '\\', '-'), ':', ' -'), '[<>"|?*]', '', 'g'), '\\s+', ' ', 'g'), ' ') AS file FROM articles)
SELECT band_prefix, file, max(article_id) AS article_id, count(*)::BIGINT AS written FROM n GROUP BY 1, 2
""".replace("\\\\", "\\"))
def last_writer_wins(spark: SparkSession, d: str) -> DataFrame:
    """Of articles with one file name the last written stays; the number of writes tells collisions."""
    rows = table(spark, d, "articles").select("band_prefix", fk.safe_file_name(F.col("file_stem")).alias("file"), "article_id")
    return pages.last_writer(rows, ["band_prefix", "file"], ["article_id"])


RANGES = rf"""
WITH l AS ({r.LATEST_LIST}), k AS (SELECT row_id, upper(regexp_replace(band, '[\s\x{{a0}}]+', '', 'g')) AS b, CASE WHEN regexp_full_match(trim(seite_von, ' '), '[0-9]+') THEN try_cast(trim(seite_von, ' ') AS INTEGER) END AS von,
  CASE WHEN regexp_full_match(trim(seite_bis, ' '), '[0-9]+') THEN try_cast(trim(seite_bis, ' ') AS INTEGER) END AS bis, bauwerk FROM l),
p AS (SELECT *, regexp_extract(b, '^(?:BAND|BD\.?)0*([1-9][0-9]*)(?:[,/-]0*([1-9][0-9]*|I{{1,3}}|IV))?$', 1) AS no, regexp_extract(b, '^(?:BAND|BD\.?)0*([1-9][0-9]*)(?:[,/-]0*([1-9][0-9]*|I{{1,3}}|IV))?$', 2) AS part FROM k),
q AS (SELECT row_id, bauwerk, von, bis, 'Band' || CASE WHEN length(no) < 2 THEN '0' || no ELSE no END || CASE part WHEN '' THEN '' WHEN 'I' THEN '-1' WHEN 'II' THEN '-2' WHEN 'III' THEN '-3' WHEN 'IV' THEN '-4' ELSE '-' || part END AS band_prefix FROM p WHERE no <> '')
"""


def ranges(spark: SparkSession, d: str) -> DataFrame:
    rows = r.latest_list(spark, d, "band", "seite_von", "seite_bis", "bauwerk")
    return rows.select("row_id", "bauwerk", fk.volume_prefix(F.col("band")).alias("band_prefix"), fk.plain_int(F.col("seite_von")).alias("von"), fk.plain_int(F.col("seite_bis")).alias("bis")).where("band_prefix is not null")


@query(RANGES + """
, s AS (SELECT * FROM q WHERE von IS NOT NULL AND bis IS NOT NULL),
x AS (SELECT *, lag(von) OVER w AS pv, lag(bis) OVER w AS pb FROM s WINDOW w AS (PARTITION BY band_prefix ORDER BY von, row_id))
SELECT row_id, band_prefix, von, bis, CASE WHEN pv = von THEN 'SAME' WHEN von < pb THEN 'OVERLAP' WHEN von > pb + 1 THEN 'GAP' END AS issue,
  CASE WHEN pv = von THEN NULL WHEN von < pb THEN pb - von + 1 WHEN von > pb + 1 THEN von - pb - 1 END::INTEGER AS size, bis < von AS inverted FROM x
""")
def range_continuity(spark: SparkSession, d: str) -> DataFrame:
    """Continuity of the page ranges of each volume."""
    rows = ranges(spark, d).where("von is not null and bis is not null").drop("bauwerk")
    return pages.continuity(rows, "band_prefix", ["von", "row_id"], "von", "bis")


@query(RANGES + """
SELECT band_prefix, count(*)::BIGINT AS rows, count(*) FILTER (WHERE von IS NULL OR bis IS NULL)::BIGINT AS invalid, count(*) FILTER (WHERE bis < von)::BIGINT AS inverted FROM q GROUP BY 1
""")
def metadata_validity(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each volume whose pages cannot be read or run backwards."""
    bad = F.col("von").isNull() | F.col("bis").isNull()
    return ranges(spark, d).groupBy("band_prefix").agg(F.count("*").alias("rows"), F.count_if(bad).alias("invalid"), F.count_if(F.col("bis") < F.col("von")).alias("inverted"))


@query(RANGES + """
SELECT row_id, lag(bauwerk) OVER w AS davor, lead(bauwerk) OVER w AS danach FROM q WINDOW w AS (PARTITION BY band_prefix ORDER BY von NULLS LAST, row_id)
""")
def prev_next(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours of every building in its volume."""
    rows = ranges(spark, d).withColumn("o", F.coalesce("von", F.lit(2147483647)))
    return pages.neighbours(rows, "band_prefix", ["o", "row_id"], "bauwerk").select("row_id", "davor", "danach")


@query(f"""
WITH a AS ({r.ARTICLES}), o AS (SELECT DISTINCT ON (ort_key) ort_key, bauwerk FROM (SELECT bauwerk AS ort_key, bauwerk FROM ({r.LATEST_LIST}) WHERE bauwerk IS NOT NULL))
SELECT article_id, o.bauwerk IS NOT NULL AS has_row, coalesce(fields['Ort'], '') AS ort, (coalesce(fields['Ort'], '') <> '' AND strpos(body, fields['Ort']) = 0) AS place_missing, length(body) < 1000 AS small
FROM a LEFT JOIN o ON a.file_stem = o.ort_key WHERE body IS NOT NULL
""")
def place_missing(spark: SparkSession, d: str) -> DataFrame:
    """Articles joined with the metadata list; does the body name its place?"""
    ort = F.coalesce(F.col("fields")["Ort"], F.lit(""))
    a = r.latest_articles(spark, d, "file_stem", ort.alias("ort"), ((ort != "") & ~F.contains("body", ort)).alias("place_missing"), (F.length("body") < 1000).alias("small")).where("small is not null")
    listed = r.latest_list(spark, d, "bauwerk").select(F.col("bauwerk").alias("file_stem"), F.lit(True).alias("has_row")).where("file_stem is not null").distinct()
    return a.join(listed, "file_stem", "left").select("article_id", F.coalesce("has_row", F.lit(False)).alias("has_row"), "ort", "place_missing", "small")


@query("""
WITH done AS (SELECT DISTINCT source, doc_id // 2 AS k FROM documents WHERE stage = 'pass1') SELECT d.doc_id FROM documents d WHERE d.stage = 'wiki' AND NOT EXISTS (SELECT 1 FROM done WHERE done.source = d.source AND done.k = d.doc_id // 2)
""")
def incremental_ingest(spark: SparkSession, d: str) -> DataFrame:
    """First-stage documents whose output (same volume, same pair of ids) does not exist yet."""
    docs = table(spark, d, "documents").withColumn("k", F.expr("doc_id div 2"))
    done = docs.where("stage = 'pass1'").select("source", "k").distinct()
    return docs.where("stage = 'wiki'").join(done, ["source", "k"], "left_anti").select("doc_id")


@query("""
SELECT a.doc_id, CASE WHEN EXISTS (SELECT 1 FROM documents b WHERE b.stage = 'pass2' AND b.source = a.source AND b.n_chars = a.n_chars) THEN 'skipped' ELSE 'moved' END AS status FROM documents a WHERE a.stage = 'pass1'
""")
def move_plan(spark: SparkSession, d: str) -> DataFrame:
    """Which files would move and which are there already (same volume and size)."""
    docs = table(spark, d, "documents")
    return pages.move_plan(docs.where("stage = 'pass1'").select("doc_id", "source", "n_chars"), docs.where("stage = 'pass2'").select("source", "n_chars"), ["source", "n_chars"]).select("doc_id", "status")


@query(f"""
SELECT article_id, coalesce(v.citation, 'Band ' || band_prefix) || ', S. ' || (fields['Originalseitenvon']) || CASE WHEN fields['Originalseitenvon'] = fields['Originalseitenbis'] THEN '' ELSE '–' || (fields['Originalseitenbis']) END ||
  CASE WHEN len(n) = 0 THEN '' WHEN len(n) = 1 THEN ', geschrieben von ' || n[1] ELSE ', geschrieben von ' || array_to_string(n[1:len(n) - 1], ', ') || ' und ' || n[len(n)] END AS box
FROM (SELECT *, list_filter([fields['AutorIn1'], fields['AutorIn2'], fields['AutorIn3'], fields['AutorIn4'], fields['AutorIn5'], fields['AutorIn6']], lambda x: x IS NOT NULL AND x <> '') AS n FROM ({r.ARTICLES})) LEFT JOIN volumes v USING (band_prefix)
""")
def citation_box(spark: SparkSession, d: str) -> DataFrame:
    """The citation of an article: volume, pages, authors."""
    f = F.col("fields")
    names = F.filter(F.array(*[f[f"AutorIn{i}"] for i in range(1, 7)]), lambda x: x.isNotNull() & (x != ""))
    rows = r.latest_articles(spark, d, "band_prefix", "fields").join(broadcast_if_small(table(spark, d, "volumes").select("band_prefix", "citation")), "band_prefix", "left")
    said = F.when(F.size(names) > 0, F.concat(F.lit(", geschrieben von "), fa.joined_names(names))).otherwise("")
    return rows.select("article_id", F.concat(F.coalesce("citation", F.concat(F.lit("Band "), "band_prefix")), F.lit(", "), fa.page_range(f["Originalseitenvon"], f["Originalseitenbis"]), said).alias("box"))


@query(f"""
SELECT article_id, unnest(list_concat(['CBD', 'Band_' || (fields['Band'])], list_filter([fields['Meta'], fields['Typ'], fields['Ort'], fields['AutorIn1'], fields['AutorIn2'], fields['AutorIn3'], fields['AutorIn4'], fields['AutorIn5'], fields['AutorIn6']], lambda x: x IS NOT NULL AND x <> ''))) AS category FROM ({r.ARTICLES})
""")
def categories(spark: SparkSession, d: str) -> DataFrame:
    """Category edges of every article."""
    f = F.col("fields")
    names = F.array(*[f[f"AutorIn{i}"] for i in range(1, 7)])
    return r.latest_articles(spark, d, "fields").select("article_id", F.explode(fa.category_names(f["Band"], f, names)).alias("category"))


@query(f"""
WITH t AS (SELECT article_id, fields, body, '{{{{Artikel' || chr(10) || '|Band=' || (fields['Band']) || chr(10) || '|Chunk=' || coalesce(fields['Chunk'], '') || chr(10) || '|Chunkseite=' || coalesce(fields['Chunkseite'], '') || chr(10) ||
  '|Originalseitenvon=' || coalesce(fields['Originalseitenvon'], '') || chr(10) || '|Originalseitenbis=' || coalesce(fields['Originalseitenbis'], '') || chr(10) || '|Lemma=' || coalesce(fields['Lemma'], '') || chr(10) ||
  '|Typ=' || coalesce(fields['Typ'], '') || chr(10) || '|Ort=' || coalesce(fields['Ort'], '') || chr(10) || '|davor=' || coalesce(fields['davor'], '') || chr(10) || '|danach=' || coalesce(fields['danach'], '') ||
  coalesce(array_to_string(list_transform(list_filter([fields['AutorIn1'], fields['AutorIn2'], fields['AutorIn3'], fields['AutorIn4'], fields['AutorIn5'], fields['AutorIn6']], lambda x: x <> ''), lambda x, i: chr(10) || '|AutorIn' || i || '=' || x), ''), '') || chr(10) || '}}}}' AS block FROM ({r.ARTICLES}) WHERE body IS NOT NULL)
SELECT article_id, block, block || chr(10) || chr(10) || body || chr(10) AS file FROM t
""")
def template_build(spark: SparkSession, d: str) -> DataFrame:
    """Metadata block and article file from fields, with all authors."""
    f = F.col("fields")
    authors = F.filter(F.array(*[f[f"AutorIn{i}"] for i in range(1, 7)]), lambda x: x.isNotNull() & (x != ""))
    rows = r.latest_articles(spark, d, "fields", "body").where("body is not null")
    block = fa.template_block(f["Band"], f["Chunk"], f["Chunkseite"], f["Originalseitenvon"], f["Originalseitenbis"], f["Lemma"], f["Typ"], f["Ort"], f["davor"], f["danach"], authors)
    return rows.select("article_id", block.alias("block"), "body").select("article_id", "block", fa.article_text(F.col("block"), F.col("body")).alias("file"))


@query(f"""
WITH a AS (SELECT *, article_id % 5 = 0 AS cut_off, article_id % 5 = 1 AS bare FROM ({r.ARTICLES}) WHERE body IS NOT NULL),
w AS (SELECT *, CASE WHEN bare THEN body ELSE 'davor' || chr(10) || '{{{{Artikel' || chr(10) || '|Band=' || (fields['Band']) || chr(10) || '|Notiz=einmal' || chr(10) || '|Lemma= ' || coalesce(fields['Lemma'], '') || ' ' || chr(10) || '|Meta=' || coalesce(fields['Meta'], '') || chr(10) || '|Notiz=zweimal' ||
  CASE WHEN cut_off THEN '' ELSE chr(10) || '}}}}' END || chr(10) || chr(10) || body END AS file FROM a)
SELECT article_id, CASE WHEN NOT bare THEN fields['Band'] END AS band, CASE WHEN NOT bare THEN trim(coalesce(fields['Lemma'], '')) END AS lemma, CASE WHEN NOT bare THEN 'zweimal' END AS note, CASE WHEN bare THEN '' ELSE coalesce(fields['Meta'], '') END AS meta,
  CASE WHEN NOT bare THEN nullif(trim(fields['Lemma']), '') END AS lemma_line, CASE WHEN bare OR cut_off THEN file ELSE chr(10) || body END AS body FROM w
""")
def template_fields(spark: SparkSession, d: str) -> DataFrame:
    """Fields and body parsed from article files built from the fields. One field comes twice; of five files
    one has a block that does not end and one has none."""
    f = F.col("fields")
    empty, k = F.lit(""), F.col("article_id") % 5
    block = F.concat(F.lit("davor\n{{Artikel\n|Band="), f["Band"], F.lit("\n|Notiz=einmal\n|Lemma= "), F.coalesce(f["Lemma"], empty), F.lit(" \n|Meta="), F.coalesce(f["Meta"], empty), F.lit("\n|Notiz=zweimal"), F.when(k == 0, "\n\n").otherwise("\n}}\n\n"))
    text = F.when(k == 1, F.col("body")).otherwise(F.concat(block, "body"))
    files = r.latest_articles(spark, d, "fields", "body").where("body is not null").select("article_id", text.alias("file"), F.col("body").alias("orig"))
    rows = parsed(files, "file")
    # The line end at the end of a file opens no line, so it is given back for the comparison where the body is what
    # follows the block; the body of other files is the whole text.
    body = F.when((F.col("article_id") % 5 > 1) & (F.col("orig").endswith("\n") | (F.col("orig") == "")), F.concat("body", F.lit("\n"))).otherwise(F.col("body"))
    return rows.select("article_id", F.col("fields")["Band"].alias("band"), F.col("fields")["Lemma"].alias("lemma"), F.col("fields")["Notiz"].alias("note"), fa.meta_of(F.col("block")).alias("meta"), fa.lemma_of(F.col("block")).alias("lemma_line"), body.alias("body"))
