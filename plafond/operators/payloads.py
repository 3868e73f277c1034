"""Operators over payloads of language-model calls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OBJECT = "struct<response:string,done:boolean>"


def responses(df: DataFrame, payload: str, name: str = "response") -> DataFrame:
    """Replaces ``payload``, a stream of JSON lines, by its joined ``response`` strings.

    Reading stops with the first object that is done. Lines that are blank or no JSON objects are skipped. If
    nothing was collected, the whole payload is tried as one object; a null payload gives the empty string.

    The lines that may be objects are parsed as one array, with one parser for a payload instead of one for a line.
    Only a payload where that does not give one object for each line is parsed line by line.
    """
    # Lines that cannot be objects are left out before parsing: a failed parse costs far more than a good one.
    lines = F.filter(F.split(payload, r"\r\n|\n|\r"), lambda x: F.btrim(x, F.lit(" \t")).startswith("{"))
    step = df.withColumn("_lines", lines)
    step = step.withColumn("_array", F.from_json(F.concat(F.lit("["), F.array_join("_lines", ","), F.lit("]")), f"array<{_OBJECT}>"))
    each = F.transform("_lines", lambda x: F.from_json(x, _OBJECT))
    step = step.withColumn("_objects", F.when(F.size("_array") == F.size("_lines"), F.col("_array")).otherwise(each))
    step = step.withColumn("_end", F.array_position(F.transform("_objects", lambda o: F.coalesce(o["done"], F.lit(False))), True).cast("int"))
    step = step.withColumn("_kept", F.when(F.col("_end") > 0, F.slice("_objects", 1, F.greatest("_end", F.lit(1)))).otherwise(F.col("_objects")))
    step = step.withColumn("_said", F.filter(F.transform("_kept", lambda o: o["response"]), lambda r: r.isNotNull()))
    whole = F.coalesce(F.from_json(payload, _OBJECT)["response"], F.lit(""))
    out = F.when(F.size("_said") > 0, F.array_join("_said", "")).otherwise(whole)
    return step.withColumn("_out", out).drop(payload, "_lines", "_array", "_objects", "_end", "_kept", "_said").withColumnRenamed("_out", name)
