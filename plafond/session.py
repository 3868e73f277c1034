"""Session helpers: table access, rows taken once, lineage cuts and checked broadcasts."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A side of a join is broadcast only if its size, as the optimiser knows it from (compressed) files, stays at or below
#: this. In memory that is some tens of MB.
BROADCAST_BYTES = 4 << 20
#: Tables of up to this size (of their files) are shuffled whole to drop repeats, which spreads the work on a few files.
SHUFFLED_BYTES = 24 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the cluster's spark.checkpoint.dir.

    Where none is set, a local session gets a temporary folder of its own; a cluster, whose executors could not see
    such a folder, an error.
    """
    sc = spark.sparkContext
    there = sc.getCheckpointDir()
    if there:
        return os.path.dirname(there.rstrip("/"))
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="plafond-")
    sc.setCheckpointDir(shared)
    return shared


_WRITTEN: list[tuple[SparkSession, str]] = []


@atexit.register
def _remove_written() -> None:
    """Remove the tables that this process wrote to cut lineages."""
    for spark, path in _WRITTEN:
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(at, True)
        except Exception:  # the session and its JVM may be gone
            return


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, removed when the process ends."""
    path = f"{shared_dir(spark)}/plafond-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows as a table in the shared folder and read them from there.

    What follows reads files that survive a lost executor, only the columns it needs, and knows their size. The
    tables are removed when the process ends.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def size_of(df: DataFrame) -> int:
    """Bytes of a frame as the optimiser estimates them: from file sizes for tables, too high for most other plans."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if the estimated size is within the limit; a larger side joins by shuffle.

    Meant for tables and frames that ``cut`` wrote, whose size is that of their files. Nothing is computed for it.
    """
    return F.broadcast(df) if size_of(df) <= limit else df


def once(rows: DataFrame, key: str, order: str, *columns) -> DataFrame:
    """The latest row per key (nulls in ``order`` come first) of a table of files, with only the columns named.

    Columns may be expressions. Among equals the last in the files counts; rows with a null key are repeats of each
    other. Repeated deliveries are few: only key, order and place of the rows are shuffled to find them, and the rows
    of such keys are then told by their place. Texts stay where they are as long as the repeated keys are small enough
    to be broadcast. Tables of up to SHUFFLED_BYTES are ranked whole instead, with the same result.
    """
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    if size_of(rows) <= SHUFFLED_BYTES:
        latest = Window.partitionBy("_key").orderBy(F.desc("_order"), F.desc("_file"), F.desc("_row"))
        ranked = rows.select(F.col(key).alias("_key"), F.col(order).alias("_order"), *place, *columns).withColumn("_rank", F.row_number().over(latest))
        return ranked.where("_rank = 1").drop("_key", "_order", "_file", "_row", "_rank")
    known = F.struct(F.col(order).alias("o"), F.col("_file").alias("f"), F.col("_row").alias("r"))
    tagged = rows.select(F.col(key).alias("_key"), *place, *columns)
    narrow = rows.select(F.col(key).alias("_key"), *place, F.col(order)).groupBy("_key").agg(F.count("*").alias("_n"), F.max(known).alias("_best"))
    several = cut(narrow.where("_n > 1").select(F.col("_key").alias("_k"), "_best"))
    told = tagged.join(broadcast_if_small(several), F.col("_key").eqNullSafe(F.col("_k")), "left")
    keep = F.col("_best").isNull() | ((F.col("_best.f") == F.col("_file")) & (F.col("_best.r") == F.col("_row")))
    return told.where(keep).drop("_key", "_file", "_row", "_k", "_best")
