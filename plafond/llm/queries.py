"""Queries of the problems tagged llm and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plafond.llm import bpe, canonical, langid, packing, repeated, scanned, split
from plafond.session import once, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.found(table(spark, sf_dir, "articles"), "article_id", "body")


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = once(table(spark, sf_dir, "articles"), "article_id", "delivered_at", "article_id", "body")
    return split.split_oversized(articles, "article_id", "body").drop("cut_blocks")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = canonical.vocabulary(table(spark, sf_dir, "wortliste"))
    return canonical.found(table(spark, sf_dir, "layout_regions"), table(spark, sf_dir, "articles"), words)


def p3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = canonical.vocabulary(table(spark, sf_dir, "wortliste"))
    regions = once(table(spark, sf_dir, "layout_regions"), "region_id", "ingested_at", "region_id", "lines")
    articles = once(table(spark, sf_dir, "articles"), "article_id", "delivered_at", "article_id", "body")
    return canonical.canonical_lines(canonical.region_lines(regions).unionByName(canonical.body_lines(articles)), words)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated.found(table(spark, sf_dir, "layout_regions"))


def p4_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "layout_regions")
    regions = once(raw, "region_id", "ingested_at", "region_id", "band_prefix", "chunk", "page", "label", "reading_pos", "text", "lines")
    return repeated.without_boilerplate(regions, raw)


def _scan_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [table(spark, sf_dir, t) for t in ("layout_regions", "articles", "liste_baende", "wortliste", "lang_samples")]


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned.found(*_scan_tables(spark, sf_dir))


def p5_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned.paragraphs(*_scan_tables(spark, sf_dir))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), "doc_id", "text")


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = langid.samples_of(table(spark, sf_dir, "lang_samples"))
    return langid.found(table(spark, sf_dir, "documents"), samples)


def p8_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = langid.samples_of(table(spark, sf_dir, "lang_samples"))
    return langid.languages(table(spark, sf_dir, "documents"), samples)


QUERIES = {"p1_found": p1_found, "p1_pieces": p1_pieces, "p3_found": p3_found, "p3_lines": p3_lines, "p4_found": p4_found, "p4_regions": p4_regions, "p5_found": p5_found, "p5_paragraphs": p5_paragraphs, "p6_ids": p6_ids, "p7_containers": p7_containers, "p8_found": p8_found, "p8_languages": p8_languages}

SQL = {
    "p1_found": r"""
WITH a AS (SELECT DISTINCT article_id, body FROM articles WHERE length(body) > 8000),
l AS (SELECT article_id, body, unnest(string_split(body, chr(10))) AS line, unnest(range(1, len(string_split(body, chr(10))) + 1)) AS n FROM a),
b AS (SELECT *, regexp_full_match(line, '[ \t\r]*') AS blank FROM l),
f AS (SELECT *, NOT blank AND coalesce(lag(blank) OVER (PARTITION BY article_id, body ORDER BY n), true) AS fresh FROM b),
g AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY article_id, body ORDER BY n) AS k FROM f),
s AS (SELECT article_id, k, sum(length(line)) + count(*) - 1 AS size FROM g WHERE NOT blank GROUP BY article_id, body, k)
SELECT article_id, 0::INTEGER AS block_no FROM a
UNION SELECT article_id, k::INTEGER FROM s WHERE size > 8000
""",
}
