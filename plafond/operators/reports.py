"""Corpus statistics: grouped measures with totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def corpus_stats(rows: DataFrame, group: Column) -> DataFrame:
    """A1-A4: measures per group and in total (``grp`` = total). Tokens are characters div 4 after summing.

    ``rows`` has chars, words and embeds. One rollup: partial sums are formed before the shuffle.
    """
    sums = rows.withColumn("grp", group).rollup("grp").agg(F.count("*").alias("articles"), F.sum("chars").alias("chars"), F.sum("words").alias("words"), F.sum("embeds").alias("embeds"), F.grouping("grp").alias("g"))
    per = lambda c: F.when(F.col("articles") > 0, F.col(c) / F.col("articles"))
    return sums.select(F.when(F.col("g") == 1, "total").otherwise(F.col("grp")).alias("grp"), "articles", "chars", "words", "embeds", F.expr("chars div 4").alias("tokens"), per("chars").alias("avg_chars"), per("words").alias("avg_words"), per("embeds").alias("avg_embeds"))
