"""Sources and sinks over the file tree: wholetext pages and articles, CSV lists, cell tables, per-volume files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs as pa_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plafond.functions.keys import extract, place_of
from plafond.functions.text import squeezed
from plafond.operators.slices import numbered


def _path():
    return F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))


def read_wiki_tree(spark: SparkSession, root: str, volume: str | None = None) -> DataFrame:
    """Every ``*.wiki`` file under a root as one row: path, file_stem, folder, text.

    A volume restricts the scan by a predicate on the file path, which prunes files before they are read. Files of no
    bytes give no row.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.wiki").text(root, wholetext=True)
    rows = raw.select(_path().alias("path"), F.col("value").alias("text")).dropDuplicates(["path"])
    if volume:
        rows = rows.where(F.col("path").contains(f"/{volume}/") | F.col("path").contains(f"/{volume}_chunk"))
    return rows.select("path", F.regexp_extract("path", r"([^/]*)\.wiki\z", 1).alias("file_stem"), F.regexp_extract("path", r"([^/]*)/[^/]*\z", 1).alias("folder"), "text")


def read_pages(spark: SparkSession, root: str, volume: str | None = None) -> DataFrame:
    """Page files ``.../Band01_chunk002/<stage>/p003.wiki``: volume, chunk, stage, page, text. Unordered."""
    rows = read_wiki_tree(spark, root, volume)
    form = r"/(Band[0-9-]+)_chunk([0-9]+)/([^/]+)/p([0-9]+)\.wiki\z"
    part = lambda k: extract(F.col("path"), form, k)
    return rows.select(part(1).alias("band_prefix"), part(2).cast("int").alias("chunk"), part(3).alias("stage"), part(4).cast("int").alias("page"), "path", "text").where("band_prefix is not null")


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """A CSV list, header-driven, every column a string, quoted line ends kept."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False, encoding="UTF-8")


COLUMNS = ["bauwerk", "modul", "eigenschaft", "literaturangabe", "autor", "eingabe_komplett", "datenbankeintrag", "notiz"]


def list_of_cells(cells: DataFrame) -> DataFrame:
    """The metadata list from raw cells (sheet, sheet_idx, row_idx, cells array<string>).

    The first sheet is skipped. On each other sheet the first row with a cell ``Bauwerk`` is the header and fixes
    the first column; rows up to it are skipped, eight cells taken by position and filled up with nulls. Rows of
    nothing but nulls and rows without ``eigenschaft`` are left out. The sheet's title becomes ``band``.
    """
    rows = cells.where("sheet_idx > 0").withColumn("at", F.array_position("cells", "Bauwerk"))
    head = rows.where("at > 0").groupBy("sheet_idx").agg(F.min_by(F.struct("row_idx", "at"), "row_idx").alias("h"))
    body = rows.drop("at").join(head, "sheet_idx").where(F.col("row_idx") > F.col("h.row_idx"))
    picked = [F.get("cells", (F.col("h.at") + i - 1).cast("int")).alias(c) for i, c in enumerate(COLUMNS)]
    out = body.select(F.col("sheet").alias("band"), "row_idx", *picked)
    some = F.coalesce(*[F.col(c) for c in COLUMNS]).isNotNull()
    return out.where(some & (F.coalesce("eigenschaft", F.lit("")) != "")).withColumn("ort", place_of(F.col("bauwerk")))


def volume_texts(pages: DataFrame) -> DataFrame:
    """One text per volume: its pages in order, joined by line ends, and a last line end.

    For volumes that fit into a row; ``write_volume_texts`` writes any.
    """
    ordered = F.array_sort(F.collect_list(F.struct("chunk", "page", "text")))
    return pages.groupBy("band_prefix").agg(F.concat(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n"), F.lit("\n")).alias("text"))


def write_volume_texts(pages: DataFrame, path: str) -> None:
    """A folder of text files per volume whose lines, file after file by name, are its pages in order.

    Pages are dealt out by ranges of volume, chunk and page and stay rows, so a volume may be of any length.
    """
    ordered = pages.repartitionByRange("band_prefix", "chunk", "page").sortWithinPartitions("band_prefix", "chunk", "page")
    ordered.select("band_prefix", F.col("text").alias("value")).write.mode("overwrite").partitionBy("band_prefix").text(path)


def write_by_volume(rows: DataFrame, path: str) -> None:
    """CSV files in a folder per volume; columns that begin with an underscore stay behind.

    Quotes are doubled and white space and line ends kept, so ``read_list`` gives the same values back.
    """
    kept = rows.drop(*[c for c in rows.columns if c.startswith("_")])
    kept.write.mode("overwrite").partitionBy("band_prefix").csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_files(rows: DataFrame, root: str, path: str, text: str) -> None:
    """Every row as a file of its own: ``text`` at ``root``/``path``, in UTF-8; rows without either are left out.

    Written by the tasks themselves, wherever ``root`` is (a URI, or a path that all of them see). A file that is
    written twice, by a task that is run again, is the same.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = pa_fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
        for pdf in batches:
            for at, t in zip(pdf["path"].tolist(), pdf["text"].tolist()):
                fs.create_dir(f"{base}/{at}".rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(f"{base}/{at}") as f:
                    f.write(t.encode())
            yield pd.DataFrame({"n": [len(pdf)]})

    rows.select(F.col(path).alias("path"), F.col(text).alias("text")).where("path is not null and text is not null").mapInPandas(write, "n bigint").agg(F.sum("n")).collect()


def changed_only(rows: DataFrame, old: str, new: str) -> DataFrame:
    """The plan of a rewrite: rows whose text would change. Apply it by writing this frame."""
    return rows.where(~F.col(new).eqNullSafe(F.col(old)))


def ordered_pages(pages: DataFrame) -> DataFrame:
    """S3, O3: pages with their position in the volume; the order itself is left to the sink."""
    return numbered(pages, ["band_prefix"], ["chunk", "page"], "position")


def page_subset(pages: DataFrame, names: list[str]) -> DataFrame:
    """The pages of an explicit list of names such as ``p013``."""
    return pages.where(F.concat(F.lit("p"), F.lpad(F.col("page").cast("string"), 3, "0")).isin(names))


def write_ordered_list(rows: DataFrame, path: str, *order: Column) -> None:
    """O2: a CSV list in a given order, its files in order of their names."""
    rows.orderBy(*order).write.mode("overwrite").csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def appended(chunks: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """Answers joined in order, squeezed."""
    ordered = F.array_sort(F.collect_list(F.struct(order, text)))
    return chunks.groupBy(key).agg(squeezed(F.array_join(F.transform(ordered, lambda x: x[text]), "\n\n")).alias(text))


def with_model(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """S14, S17, S18, T22 and the models: an injected function over batches of rows (iterator of pandas frames).

    The function loads its model once per worker process; batches follow spark.sql.execution.arrow.maxRecordsPerBatch.
    """
    return df.mapInPandas(run, schema)
