"""Sweep-line operators over closed integer intervals: continuous periods and the gaps between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions per slice of the line. One task sums one slice, so an entity with a very long line is split.
SLICE = 4096


def covered_and_gaps(df: DataFrame, entity: str, start: str, end: str, width: int = SLICE) -> DataFrame:
    """Merge closed intervals per entity into continuous periods and list the gaps between them.

    Returns ``entity, kind, page_from, page_to`` with kind ``period`` or ``gap``. Both ends belong to an
    interval; n and n+1 are continuous. Rows with a null entity or bound, or start > end, take no part.
    Repeated, nested and touching intervals merge; an empty input gives an empty result. Other columns of
    ``df``, whatever their names, are ignored.

    Sweep line: every interval gives +1 at its start and -1 behind its end. The events are summed by
    (entity, position) before anything else, so a hot entity shrinks to its distinct positions on the map
    side. Active counts are prefix sums in two levels: within slices of ``width`` positions, plus the sum of
    all earlier slices. Periods and gaps are read off where the count leaves or reaches zero.
    """
    lo, hi = F.col(start).cast("long"), F.col(end).cast("long")
    rows = df.select(F.col(entity).alias("_e"), lo.alias("_lo"), hi.alias("_hi")).where("_e is not null and _lo <= _hi")
    marks = F.array(F.struct(F.col("_lo").alias("at"), F.lit(1).alias("d")), F.struct((F.col("_hi") + 1).alias("at"), F.lit(-1).alias("d")))
    events = rows.select("_e", F.explode(marks).alias("m")).groupBy("_e", F.col("m.at").alias("at")).agg(F.sum("m.d").alias("d")).where("d <> 0")
    events = events.withColumn("slice", F.floor(F.col("at") / width))

    before = Window.partitionBy("_e").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = events.groupBy("_e", "slice").agg(F.sum("d").alias("s")).select("_e", "slice", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("off"))
    within = Window.partitionBy("_e", "slice").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    counts = events.join(offsets, ["_e", "slice"]).withColumn("active", F.col("off") + F.sum("d").over(within))

    # An edge is where the count leaves zero (opens) or reaches it (closes); the two alternate per entity.
    opens = F.col("active") == F.col("d")
    edges = counts.where(opens | (F.col("active") == 0)).select("_e", "slice", "at", opens.alias("opens"))
    nxt = F.lead("at").over(Window.partitionBy("_e", "slice").orderBy("at"))
    firsts = edges.groupBy("_e", "slice").agg(F.min("at").alias("first"))
    after = firsts.select("_e", "slice", F.lead("first").over(Window.partitionBy("_e").orderBy("slice")).alias("later"))
    paired = edges.withColumn("nxt", nxt).join(after, ["_e", "slice"]).withColumn("nxt", F.coalesce("nxt", "later")).where("nxt is not null")
    return paired.select(
        F.col("_e").alias(entity),
        F.when(F.col("opens"), "period").otherwise("gap").alias("kind"),
        F.col("at").cast("int").alias("page_from"),
        (F.col("nxt") - 1).cast("int").alias("page_to"),
    )


def latest_by(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per key, the last by ``order``; nulls come first and full ties are broken by the whole row.

    An aggregate instead of a window: partial maxima are formed on the map side, so a key that was delivered
    very often costs no more than the others. Rows with a null key are one group of their own.
    """
    best = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.struct(*[F.col(f"`{c}`") for c in df.columns if c != key]).alias("row"))
    return df.groupBy(key).agg(F.max(best).alias("_best")).select(key, "_best.row.*")
