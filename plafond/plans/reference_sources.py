"""Queries of the sources and sinks, with their SQL: tables are written in the shared folder and read back."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plafond.functions import keys as fk
from plafond.functions import text as ft
from plafond.operators import citations, layout
from plafond.plans import reference as r
from plafond.plans.reference_texts import PAGE_TEXTS
from plafond.session import cut, scratch, table
from plafond.sources import external, files

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ------------------------------------------------------------------ trees of files


def page_texts(spark: SparkSession, d: str) -> DataFrame:
    """The pages assembled from their regions, those with any text."""
    return layout.assembled_pages(r.regions(spark, d, "band_prefix", "chunk", "page", "label", "reading_pos", "image_path", "caption", "caption_matched", "lines")).where("text <> ''")


@query("WITH " + PAGE_TEXTS + """
SELECT band_prefix, chunk, page, 'wiki' AS stage, text, row_number() OVER (PARTITION BY band_prefix ORDER BY chunk, page)::INTEGER AS position FROM pages WHERE text <> ''
""")
def page_tree(spark: SparkSession, d: str) -> DataFrame:
    """Pages written as files of a tree and read back from it, with their position in the volume."""
    root = scratch(spark)
    name = lambda c: F.lpad(F.col(c).cast("string"), 3, "0")
    path = F.concat("band_prefix", F.lit("_chunk"), name("chunk"), F.lit("/wiki/p"), name("page"), F.lit(".wiki"))
    files.write_files(page_texts(spark, d).select(path.alias("path"), "text"), root, "path", "text")
    return files.ordered_pages(files.read_pages(spark, root).drop("path"))


@query(f"SELECT article_id::VARCHAR AS file_stem, band_prefix AS folder, body AS text FROM ({r.ARTICLES}) WHERE body <> '' AND band_prefix = 'Band07'")
def article_tree(spark: SparkSession, d: str) -> DataFrame:
    """Articles written as files in a folder per volume; the largest volume is read back."""
    root = scratch(spark)
    rows = r.latest_articles(spark, d, "band_prefix", "body").where("body <> ''")
    files.write_files(rows.select(F.concat("band_prefix", F.lit("/"), F.col("article_id").cast("string"), F.lit(".wiki")).alias("path"), "body"), root, "path", "body")
    return files.read_wiki_tree(spark, root, "Band07").drop("path")


@query("WITH " + PAGE_TEXTS + "SELECT band_prefix, string_agg(text, chr(10) ORDER BY chunk, page) || chr(10) AS text FROM pages WHERE text <> '' GROUP BY 1")
def volume_text(spark: SparkSession, d: str) -> DataFrame:
    """The text of every volume from its pages in order."""
    return files.volume_texts(page_texts(spark, d))


@query("WITH " + PAGE_TEXTS + "SELECT band_prefix, count(*)::BIGINT AS lines, sum(length(line))::BIGINT AS chars FROM (SELECT band_prefix, unnest(string_split(text, chr(10))) AS line FROM pages WHERE text <> '') GROUP BY 1")
def volume_sink(spark: SparkSession, d: str) -> DataFrame:
    """Pages written in order into a folder per volume, and the lines read back."""
    root = scratch(spark)
    files.write_volume_texts(page_texts(spark, d), root)
    return spark.read.text(root).groupBy("band_prefix").agg(F.count("*").alias("lines"), F.sum(F.length("value").cast("bigint")).alias("chars"))


# ------------------------------------------------------------------ lists


LIST = ["band", "bauwerk", "modul", "eigenschaft", "literaturangabe", "autor", "notiz", "seite_von", "seite_bis", "ort"]


@query("SELECT row_id::VARCHAR AS row_id, " + ", ".join(f"nullif({c}, '') AS {c}" for c in LIST) + ", 'Band' || lpad((row_id % 7)::VARCHAR, 2, '0') AS band_prefix FROM liste_baende")
def list_by_volume(spark: SparkSession, d: str) -> DataFrame:
    """The metadata list written as CSV files in folders and read back; quotes, white space and line ends stay,
    nulls and empty values both come back as nulls."""
    root = scratch(spark)
    rows = table(spark, d, "liste_baende").select("row_id", *LIST, "delivered_at")
    prefix = F.concat(F.lit("Band"), F.lpad((F.col("row_id") % 7).cast("string"), 2, "0"))
    files.write_by_volume(rows.withColumn("band_prefix", prefix).withColumnRenamed("delivered_at", "_delivered"), root)
    return files.read_list(spark, root)


@query(f"""
WITH l AS ({r.LATEST_LIST}) SELECT 'Blatt ' || (row_id % 6) AS band, row_id::INTEGER AS row_idx, bauwerk, modul, eigenschaft, literaturangabe, autor, eingabe_komplett, NULL::VARCHAR AS datenbankeintrag, NULL::VARCHAR AS notiz,
 CASE WHEN strpos(bauwerk, ',') > 0 THEN left(bauwerk, strpos(bauwerk, ',') - 1) ELSE bauwerk END AS ort
FROM l WHERE row_id % 6 <> 0 AND coalesce(eigenschaft, '') <> ''
""")
def sheets_to_list(spark: SparkSession, d: str) -> DataFrame:
    """The list from the cells of six sheets, built from its rows, with a header and rows before it; rows end early."""
    names = ["bauwerk", "modul", "eigenschaft", "literaturangabe", "autor", "eingabe_komplett"]
    rows = r.latest_list(spark, d, *names)
    sheet = lambda n: [F.concat(F.lit("Blatt "), n.cast("string")).alias("sheet"), n.cast("int").alias("sheet_idx")]
    cells = rows.select(*sheet(F.col("row_id") % 6), F.col("row_id").cast("int").alias("row_idx"), F.array(F.lit(None).cast("string"), *names).alias("cells"))
    head = spark.range(6).select(*sheet(F.col("id")), F.explode(F.array(F.lit(-2), F.lit(-1))).alias("row_idx"))
    titles = F.when(F.col("row_idx") == -1, F.array(F.lit(None).cast("string"), F.lit("Bauwerk"), F.lit("Modul"))).otherwise(F.array(F.lit("Titel")))
    return files.list_of_cells(cells.unionByName(head.withColumn("cells", titles)))


@query(f"""
WITH k AS (SELECT *, CASE WHEN regexp_full_match(trim(seite_von, ' '), '[0-9]+') THEN try_cast(trim(seite_von, ' ') AS INTEGER) END AS v FROM ({r.LATEST_LIST}))
SELECT row_id::VARCHAR AS row_id, band, seite_von, row_number() OVER (ORDER BY coalesce(v, 9999), row_id) AS position FROM k
""")
def ordered_list(spark: SparkSession, d: str) -> DataFrame:
    """O2: the metadata list written in the order of its first page and read back in the order of its files."""
    root = scratch(spark)
    files.write_ordered_list(r.latest_list(spark, d, "band", "seite_von"), root, F.coalesce(fk.plain_int(F.col("seite_von")), F.lit(9999)), F.col("row_id"))
    back = spark.read.csv(root, header=True, escape='"', inferSchema=False).select("row_id", "band", "seite_von", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i"))
    first = back.groupBy("f").agg(F.min("i").alias("at"), F.count("*").alias("n"))
    starts = {x["f"]: x for x in first.collect()}  # one row per file of the sink
    before, total = {}, 0
    for f in sorted(starts):
        before[f] = total - starts[f]["at"] + 1
        total += starts[f]["n"]
    shift = F.create_map(*[F.lit(x) for kv in before.items() for x in kv]) if before else F.create_map()
    return back.select("row_id", "band", "seite_von", (F.col("i") + shift[F.col("f")]).alias("position"))


@query("SELECT DISTINCT band_prefix, chunk, page FROM layout_regions WHERE page IN (13, 14, 15)")
def page_subset(spark: SparkSession, d: str) -> DataFrame:
    """An explicit list of pages."""
    return files.page_subset(table(spark, d, "layout_regions").select("band_prefix", "chunk", "page"), ["p013", "p014", "p015"]).distinct()


@query(rf"""
WITH c AS (SELECT article_id, body, regexp_replace(body, '[ \t]+([,.;:!?])', '\1', 'g') AS t FROM ({r.ARTICLES}) WHERE body IS NOT NULL),
l AS (SELECT article_id, body, list_transform(string_split(regexp_replace(t, '\n$', ''), chr(10)), lambda x: regexp_replace(x, '\s+$', '')) AS ls FROM c),
w AS (SELECT article_id, body, array_to_string(list_transform(ls, lambda x: CASE WHEN starts_with(trim(x), '== ') AND ends_with(trim(x), ' ==') AND NOT starts_with(trim(x), '=== ') THEN chr(10) || x || chr(10) ELSE x END), chr(10)) AS t FROM l),
n AS (SELECT article_id, body, regexp_replace(regexp_replace(t, '\n\n\n+', chr(10) || chr(10), 'g'), '^\n+|\n+$', '', 'g') AS new FROM w)
SELECT article_id, length(new)::INTEGER AS chars FROM n WHERE new <> body
""")
def rewrite_plan(spark: SparkSession, d: str) -> DataFrame:
    """The articles that a normal form would change, the only ones to be written."""
    rows = r.latest_articles(spark, d, "body").where("body is not null").withColumn("new", ft.normal_body(F.col("body")))
    return files.changed_only(rows, "body", "new").select("article_id", F.length("new").alias("chars"))


@query(r"""
WITH p AS (SELECT doc_id, regexp_split_to_array(text, '\n\s*\n') AS ps FROM documents WHERE text IS NOT NULL)
SELECT doc_id, regexp_replace(regexp_replace(array_to_string(ps, chr(10) || chr(10)), '\n\n\n+', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') || chr(10) AS text FROM p
""")
def answers_joined(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of every document, one row each, joined again in order and squeezed."""
    parts = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(ft.paragraphs(F.col("text"))).alias("i", "text"))
    return files.appended(parts, "doc_id", "i", "text")


# ------------------------------------------------------------------ metadata


@query(r"""
WITH k AS (SELECT doc_id, source, stage, text, nullif(regexp_extract(text, '<!--\s*citation-page-top:\s*\S+\s+p([0-9]+)\s*-->', 1), '')::INTEGER AS top FROM documents WHERE text IS NOT NULL),
w AS (SELECT DISTINCT ON (source) source, 'Vorspann' || chr(10) || text AS wiki FROM k WHERE stage = 'wiki' AND top IS NOT NULL ORDER BY source, doc_id),
b AS (SELECT k.doc_id, k.text, w.wiki, string_split(w.wiki, chr(10)) AS ls FROM k LEFT JOIN w USING (source) WHERE k.stage = 'pass1'),
n AS (SELECT *, list_transform(ls, lambda x: starts_with(trim(x), '<!--') AND (contains(x, 'citation-page') OR contains(x, 'dropbox:'))) AS note, list_transform(ls, lambda x: regexp_full_match(x, '[ \t\r]*')) AS blank FROM b),
f AS (SELECT *, list_position(note, true) AS a FROM n),
e AS (SELECT *, coalesce(list_min(list_filter(range(1, len(ls) + 1), lambda i: i > a AND NOT note[i] AND NOT blank[i])), len(ls) + 1) AS z FROM f),
h AS (SELECT *, array_to_string(list_transform(list_filter(range(1, len(ls) + 1), lambda i: i >= a AND i < z AND note[i]), lambda i: ls[i]), chr(10)) AS head, nullif(regexp_extract(wiki, '<!--\s*citation-page-bottom:.*?-->'), '') AS foot FROM e),
t AS (SELECT doc_id, text, CASE WHEN NOT contains(text, 'citation-page-top:') AND a > 0 THEN head || chr(10) || chr(10) || text ELSE text END AS t, foot FROM h)
SELECT doc_id, CASE WHEN NOT contains(text, 'citation-page-bottom:') AND foot IS NOT NULL THEN regexp_replace(t, '\s+$', '') || chr(10) || foot || chr(10) ELSE t END AS text,
  (CASE WHEN NOT contains(text, 'citation-page-bottom:') AND foot IS NOT NULL THEN regexp_replace(t, '\s+$', '') || chr(10) || foot || chr(10) ELSE t END) <> text AS copied FROM t
""")
def metadata_copy(spark: SparkSession, d: str) -> DataFrame:
    """Page comments that second-stage pages lack, copied from the volume's first first-stage page that has any."""
    docs = table(spark, d, "documents").where("text is not null")
    cited = docs.where((F.col("stage") == "wiki") & fk.citation_page(F.col("text")).isNotNull())
    wiki = cut(cited.groupBy("source").agg(F.min_by("text", "doc_id").alias("wiki")).select("source", F.concat(F.lit("Vorspann\n"), "wiki").alias("wiki")))
    pages = docs.where("stage = 'pass1'").join(wiki, "source", "left").select("doc_id", "text", "wiki")
    return citations.with_metadata(pages, "text", "wiki").select("doc_id", "text", "copied")


# ------------------------------------------------------------------ injected callables, with deterministic ones in their place


def _bytes(values):
    """Bytes of an array of numbers from 0 to 255."""
    return F.unhex(F.array_join(F.transform(values, lambda x: F.lpad(F.hex(x), 2, "0")), ""))


GREY = "list_transform(embedding, lambda x: trunc(abs(x) * 1000::FLOAT)::INTEGER % 256)"


def images(spark: SparkSession, d: str) -> DataFrame:
    """id, image: grey images eight pixels wide, their bytes taken from numeric arrays."""
    grey = F.transform("embedding", lambda x: (F.abs(x) * F.lit(1000).cast("float")).cast("int") % 256)
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), _bytes(grey).alias("image"))


@query(f"""
WITH g AS (SELECT vec_id, {GREY} AS v FROM embeddings)
SELECT vec_id AS id, list_transform(range(0, len(v) // 8), lambda i: len(list_filter(v[i * 8 + 1 : i * 8 + 8], lambda x: x < 180)))::INTEGER[] AS h_proj FROM g
""")
def image_projection(spark: SparkSession, d: str) -> DataFrame:
    """Dark pixels per row of images."""
    return external.row_projection(images(spark, d), lambda b: np.frombuffer(bytes(b), np.uint8).reshape(-1, 8))


@query(f"""
WITH g AS (SELECT vec_id, {GREY} AS v FROM embeddings)
SELECT vec_id AS region_id, [list_sum(v)::BIGINT::VARCHAR, len(v)::VARCHAR] AS lines FROM g
""")
def recognised_lines(spark: SparkSession, d: str) -> DataFrame:
    """Results of a recogniser that works in batches, put beside their regions; it reads the sum and number of bytes."""
    return external.read_regions(images(spark, d).withColumnRenamed("id", "region_id"), lambda batch: [[str(sum(b)), str(len(b))] for b in batch])


@query(f"""
WITH g AS (SELECT vec_id, {GREY} AS v FROM embeddings), p AS (SELECT vec_id, v, unnest(range(0, (len(v) + 15) // 16)) AS k FROM g)
SELECT vec_id || '_p' || lpad((k + 1)::VARCHAR, 3, '0') AS page_name, len(v[k * 16 + 1 : k * 16 + 16])::INTEGER AS bytes, list_sum(v[k * 16 + 1 : k * 16 + 16])::BIGINT AS total FROM p
""")
def rendered_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of documents, here sixteen bytes each, numbered from 1."""
    pdfs = images(spark, d).select(F.col("id").cast("string").alias("name"), F.col("image").alias("content"))
    pages = external.rendered_pages(pdfs, lambda c: [bytes(c)[k : k + 16] for k in range(0, len(c), 16)])
    digits = F.split(F.regexp_replace(F.hex("image"), "(..)", "$1 "), " ")
    total = F.aggregate(F.filter(digits, lambda x: x != ""), F.lit(0).cast("bigint"), lambda a, x: a + F.conv(x, 16, 10).cast("bigint"))
    return pages.select("page_name", F.length("image").alias("bytes"), total.alias("total"))


@query("""
SELECT doc_id AS id, CASE WHEN doc_id % 11 = 0 THEN 0 ELSE 200 END::INTEGER AS status, CASE WHEN doc_id % 11 = 0 THEN '' ELSE upper(regexp_replace(text, '[^a-z ]', '', 'g')) END AS response FROM documents WHERE text IS NOT NULL
""")
def model_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers of a model that shouts, and fails for one prompt in eleven; failed calls have an empty answer."""
    from plafond.operators.payloads import responses

    prompts = table(spark, d, "documents").where("text is not null").select(F.col("doc_id").alias("id"), F.concat(F.col("doc_id").cast("string"), F.lit("|"), F.regexp_replace("text", "[^a-z ]", "")).alias("prompt"))

    def post(prompt: str) -> tuple[int, str]:
        no, said = prompt.split("|", 1)
        if int(no) % 11 == 0:
            raise OSError("no answer")
        half = len(said) // 2
        return 200, f'{{"response":"{said[:half].upper()}","done":false}}\n{{"response":"{said[half:].upper()}","done":true}}'

    return responses(external.answered(prompts, post), "payload").select("id", "status", "response")


@query("SELECT band_prefix || '_' || k AS image1_description_link, 'https://example.org/' || band_prefix || '/' || k AS image1_url FROM volumes, unnest(range(0, 3)) AS t(k)")
def wiki_files(spark: SparkSession, d: str) -> DataFrame:
    """Files listed by a client, three for each prefix."""
    return external.listed_files(table(spark, d, "volumes").select(F.col("band_prefix").alias("prefix")), lambda p: [(f"{p}_{k}", f"https://example.org/{p}/{k}") for k in range(3)])
