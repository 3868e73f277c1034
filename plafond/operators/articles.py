"""Operators over article files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plafond.functions.text import lines_of, strip

_FIELD = r"\A\|(\w+)=(.*)\z"


def parsed(files: DataFrame, text: str) -> DataFrame:
    """Adds ``block``, ``fields`` and ``body`` of article files and drops ``text``.

    The block goes from the first line that begins ``{{Artikel`` to the next line that is ``}}``. Of a field
    given twice the last value counts. Without a block, or with one that does not end, the body is the whole
    text. Text before the block is in neither. A null text gives nulls.

    The steps are columns of their own, so that each is computed once per row.
    """
    t, none = F.col(text), F.array().cast("array<string>")
    step = files.withColumn("_lines", lines_of(t))
    step = step.withColumn("_start", F.array_position(F.transform("_lines", lambda x: strip(x).startswith("{{Artikel")), True).cast("int"))
    step = step.withColumn("_rest", F.when(F.col("_start") > 0, F.slice("_lines", F.greatest("_start", F.lit(1)), F.size("_lines"))).otherwise(none))
    step = step.withColumn("_end", F.array_position(F.transform("_rest", lambda x: strip(x) == "}}"), True).cast("int"))
    step = step.withColumn("_block", F.when(F.col("_end") > 0, F.slice("_rest", 1, F.greatest("_end", F.lit(1)))).otherwise(F.col("_rest")))
    step = step.withColumn("_named", F.filter(F.transform("_block", strip), lambda x: x.rlike(_FIELD)))
    step = step.withColumn("_keys", F.transform("_named", lambda x: F.regexp_extract(x, _FIELD, 1)))
    step = step.withColumn("_values", F.transform("_named", lambda x: strip(F.regexp_extract(x, _FIELD, 2))))
    step = step.withColumn("_pairs", F.filter(F.zip_with("_keys", "_values", lambda k, v: F.struct(k.alias("k"), v.alias("v"))), lambda p, i: ~F.array_contains(F.slice("_keys", i + 2, F.size("_keys")), p["k"])))
    body = F.when(F.col("_end") > 0, F.array_join(F.slice("_rest", F.greatest("_end", F.lit(1)) + 1, F.size("_rest")), "\n")).otherwise(t)
    out = step.withColumn("block", F.array_join("_block", "\n")).withColumn("fields", F.map_from_entries("_pairs")).withColumn("body", body)
    return out.drop(text, "_lines", "_start", "_rest", "_end", "_block", "_named", "_keys", "_values", "_pairs")
