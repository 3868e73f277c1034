"""p2: continuous page runs of each volume and the missing pages between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plafond.functions.keys import plain_int, volume_prefix
from plafond.operators.intervals import covered_and_gaps, latest_by
from plafond.session import table


def page_ranges(rows: DataFrame) -> DataFrame:
    """Readable page ranges of the metadata list: the row of latest delivery per row_id, volume and pages parsed."""
    need = rows.select("row_id", "band", "seite_von", "seite_bis", "delivered_at")
    last = latest_by(need, "row_id", F.col("delivered_at"))
    parsed = last.select("row_id", volume_prefix(F.col("band")).alias("band_prefix"), plain_int(F.col("seite_von")).alias("page_from"), plain_int(F.col("seite_bis")).alias("page_to"))
    return parsed.where("band_prefix is not null and page_from <= page_to")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covered_and_gaps(page_ranges(table(spark, sf_dir, "liste_baende")), "band_prefix", "page_from", "page_to")


P2_SQL = r"""
WITH last AS (
  SELECT DISTINCT ON (row_id) row_id, band, seite_von, seite_bis FROM liste_baende
  ORDER BY row_id, delivered_at DESC
), named AS (
  SELECT upper(regexp_replace(band, '[\s\x{a0}]+', '', 'g')) AS b, trim(seite_von, ' ') AS v, trim(seite_bis, ' ') AS w FROM last
), parsed AS (
  SELECT regexp_extract(b, '^(?:BAND|BD\.?)0*([1-9][0-9]*)(?:[,/-]0*([1-9][0-9]*|I{1,3}|IV))?$', 1) AS no,
         regexp_extract(b, '^(?:BAND|BD\.?)0*([1-9][0-9]*)(?:[,/-]0*([1-9][0-9]*|I{1,3}|IV))?$', 2) AS part,
         CASE WHEN regexp_full_match(v, '[0-9]+') THEN try_cast(v AS INTEGER) END AS lo,
         CASE WHEN regexp_full_match(w, '[0-9]+') THEN try_cast(w AS INTEGER) END AS hi FROM named
), good AS (
  SELECT 'Band' || CASE WHEN length(no) < 2 THEN '0' || no ELSE no END ||
         CASE part WHEN '' THEN '' WHEN 'I' THEN '-1' WHEN 'II' THEN '-2' WHEN 'III' THEN '-3' WHEN 'IV' THEN '-4' ELSE '-' || part END AS band_prefix, lo, hi
  FROM parsed WHERE no <> '' AND lo <= hi
), marked AS (
  SELECT *, CASE WHEN lo <= max(hi) OVER (PARTITION BY band_prefix ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM good
), grouped AS (
  SELECT *, sum(fresh) OVER (PARTITION BY band_prefix ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM marked
), periods AS (
  SELECT band_prefix, min(lo) AS page_from, max(hi) AS page_to FROM grouped GROUP BY band_prefix, g
), gaps AS (
  SELECT band_prefix, page_to + 1 AS page_from, lead(page_from) OVER (PARTITION BY band_prefix ORDER BY page_from) - 1 AS page_to FROM periods
)
SELECT band_prefix, 'period' AS kind, page_from::INTEGER AS page_from, page_to::INTEGER AS page_to FROM periods
UNION ALL SELECT band_prefix, 'gap', page_from::INTEGER, page_to::INTEGER FROM gaps WHERE page_to IS NOT NULL
"""

QUERIES = {"p2_found": p2_found}
SQL = {"p2_found": P2_SQL}
