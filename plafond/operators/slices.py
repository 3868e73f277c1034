"""Windows over ordered rows of an entity, cut into slices: no task sees a hot entity whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions per slice.
WIDTH = 64


def slice_of(order: str, width: int = WIDTH) -> Column:
    """The slice of a numeric position."""
    return F.floor(F.col(order) / width)


def neighbours(rows: DataFrame, entity: list[str], order: list[str], names: list[str], width: int = WIDTH) -> DataFrame:
    """Adds ``_before`` and ``_behind``, structs of ``names`` from the rows beside in the entity; null at its ends.

    The first of ``order`` must be a number without nulls; slices are stretches of it. Within a slice these are
    windows; at its borders the last row of the nearest earlier slice that has any, and the first of the next. Only
    one row per slice goes through a window over the whole entity. What is not used of the two is not computed.
    """
    cut = rows.withColumn("_slice", slice_of(order[0], width)).withColumn("_order", F.struct(*order)).withColumn("_row", F.struct(*names))
    within = Window.partitionBy(*entity, "_slice").orderBy("_order")
    ends = cut.groupBy(*entity, "_slice").agg(F.max_by("_row", "_order").alias("_last"), F.min_by("_row", "_order").alias("_first"))
    across = Window.partitionBy(*entity).orderBy("_slice")
    border = ends.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate([*entity, "_slice"])], F.lag("_last").over(across).alias("_earlier"), F.lead("_first").over(across).alias("_later"))
    near = cut.withColumn("_up", F.lag("_row").over(within)).withColumn("_down", F.lead("_row").over(within))
    joined = near.join(border, _equal([*entity, "_slice"]), "left")
    return joined.select(*rows.columns, F.coalesce("_up", "_earlier").alias("_before"), F.coalesce("_down", "_later").alias("_behind"))


def _equal(columns: list[str]) -> Column:
    on = F.lit(True)
    for i, c in enumerate(columns):
        on = on & F.col(c).eqNullSafe(F.col(f"_b{i}"))
    return on


def first_after(rows: DataFrame, entity: list[str], order: str, marks: dict[str, Column], width: int = WIDTH) -> DataFrame:
    """Adds for every mark the first position strictly behind the row where it holds, within the entity.

    ``order`` is a number. Within a slice a window runs backwards, so its frame only grows; from later slices the
    first marked position of each is taken, one row per slice.
    """
    cut = rows.withColumn("_slice", slice_of(order, width))
    for k, c in marks.items():
        cut = cut.withColumn(f"_m_{k}", F.when(c, F.col(order)))
    after = Window.partitionBy(*entity, "_slice").orderBy(F.desc(order)).rangeBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*entity).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    ends = cut.groupBy(*entity, "_slice").agg(*[F.min(f"_m_{k}").alias(f"_f_{k}") for k in marks])
    border = ends.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate([*entity, "_slice"])], *[F.min(f"_f_{k}").over(later).alias(f"_l_{k}") for k in marks])
    near = cut.select("*", *[F.min(f"_m_{k}").over(after).alias(f"_n_{k}") for k in marks])
    joined = near.join(border, _equal([*entity, "_slice"]), "left")
    return joined.select(*rows.columns, *[F.coalesce(f"_n_{k}", f"_l_{k}").alias(k) for k in marks])


def last_before(rows: DataFrame, entity: list[str], order: str, value: str, width: int = 4096) -> DataFrame:
    """Adds ``_before``, the last value that is not null in the rows before, within the entity; ``order`` is a number."""
    cut = rows.withColumn("_slice", slice_of(order, width))
    before = Window.partitionBy(*entity, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*entity).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = cut.groupBy(*entity, "_slice").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_v"))
    border = ends.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate([*entity, "_slice"])], F.last("_v", ignorenulls=True).over(earlier).alias("_l"))
    joined = cut.withColumn("_n", F.last(value, ignorenulls=True).over(before)).join(border, _equal([*entity, "_slice"]), "left")
    return joined.withColumn("_before", F.coalesce("_n", "_l")).select(*rows.columns, "_before")


def numbered(rows: DataFrame, entity: list[str], order: list[str], name: str, width: int = WIDTH) -> DataFrame:
    """Adds ``name``, the position of each row in its entity from 1; the first of ``order`` is a number."""
    cut = rows.withColumn("_slice", slice_of(order[0], width))
    sizes = cut.groupBy(*entity, "_slice").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*entity).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    border = sizes.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate([*entity, "_slice"])], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    own = F.row_number().over(Window.partitionBy(*entity, "_slice").orderBy(*order))
    return cut.withColumn("_own", own).join(border, _equal([*entity, "_slice"])).select(*rows.columns, (F.col("_own") + F.col("_off")).cast("int").alias(name))
