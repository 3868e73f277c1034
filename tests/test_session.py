"""Rows taken once, lineage cuts and the shared folder."""

from __future__ import annotations

import types

import pytest
from pyspark.sql import functions as F

from plafond import session
from plafond.sources import files


@pytest.mark.parametrize("whole", [0, 1 << 30])
def test_once_keeps_the_latest_row_of_each_key(spark, tmp_path, monkeypatch, whole):
    monkeypatch.setattr(session, "SHUFFLED_BYTES", whole)
    rows = [(1, 1, "alt"), (1, 2, "neu"), (2, None, "ohne Zeit"), (3, None, "x"), (3, 5, "y"), (4, 7, "gleich"), (4, 7, "gleich"), (None, 1, "a"), (None, 2, "b"), (5, 1, None)]
    spark.createDataFrame(rows, "k int, at int, t string").repartition(4).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    want = [(None, "b"), (1, "neu"), (2, "ohne Zeit"), (3, "y"), (4, "gleich"), (5, None)]
    assert sorted(map(tuple, session.once(table, "k", "at", "k", "t").collect()), key=str) == sorted(want, key=str)
    # Columns may be expressions, and the order need not be among them.
    assert sorted(r.n or 0 for r in session.once(table, "k", "at", F.length("t").alias("n")).collect()) == [0, 1, 1, 3, 6, 9]
    spark.createDataFrame([], "k int, at int, t string").write.parquet(str(tmp_path / "e"))
    assert session.once(spark.read.parquet(str(tmp_path / "e")), "k", "at", "k", "t").count() == 0


def test_once_without_a_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "broadcast_if_small", lambda df: df)
    monkeypatch.setattr(session, "SHUFFLED_BYTES", 0)
    spark.createDataFrame([(i % 7, i, f"t{i}") for i in range(40)], "k int, at int, t string").write.parquet(str(tmp_path / "t"))
    got = session.once(spark.read.parquet(str(tmp_path / "t")), "k", "at", "k", "t")
    assert {(r.k, r.t) for r in got.collect()} == {(i % 7, f"t{i}") for i in range(33, 40)}


def test_cut_reads_what_it_wrote(spark):
    df = spark.createDataFrame([(1, ["a", None], {"k": 1.5}), (None, None, None)], "i int, a array<string>, m map<string,double>")
    again = session.cut(df)
    assert again.schema == df.schema and sorted(map(str, again.collect())) == sorted(map(str, df.collect()))
    assert session.cut(df.limit(0)).count() == 0 and session.size_of(again) < session.BROADCAST_BYTES


def test_a_cluster_must_name_its_shared_folder():
    context = types.SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    conf = types.SimpleNamespace(get=lambda key, default: default)
    with pytest.raises(RuntimeError):
        session.shared_dir(types.SimpleNamespace(sparkContext=context, conf=conf))
    context.getCheckpointDir = lambda: "hdfs://n/shared/uuid"
    assert session.shared_dir(types.SimpleNamespace(sparkContext=context, conf=conf)) == "hdfs://n/shared"


def test_files_of_rows(spark, tmp_path):
    rows = [("Band01/a b.wiki", "x\ny"), ("Band01/ü.wiki", ""), ("Band02/c.wiki", None), (None, "z")]
    files.write_files(spark.createDataFrame(rows, "p string, t string"), str(tmp_path), "p", "t")
    got = {(r.file_stem, r.folder, r.text) for r in files.read_wiki_tree(spark, str(tmp_path)).collect()}
    assert got == {("a b", "Band01", "x\ny")}  # the reader leaves empty files out
    assert sorted(f.name for f in tmp_path.rglob("*.wiki")) == ["a b.wiki", "ü.wiki"]


def test_volume_sink_keeps_the_order(spark, tmp_path):
    pages = spark.createDataFrame([("A", c, p, f"{c}-{p}\nzwei") for c in range(1, 9) for p in range(1, 6)], "band_prefix string, chunk int, page int, text string").repartition(5)
    files.write_volume_texts(pages, str(tmp_path / "v"))
    said = "".join(f.read_text() for f in sorted((tmp_path / "v" / "band_prefix=A").glob("*.txt")))
    assert said == "".join(f"{c}-{p}\nzwei\n" for c in range(1, 9) for p in range(1, 6)) == files.volume_texts(pages).first().text
    positions = files.ordered_pages(pages).orderBy("position").collect()
    assert [(r.chunk, r.page, r.position) for r in positions] == [(1 + i // 5, 1 + i % 5, i + 1) for i in range(40)]
    assert {r.page for r in files.page_subset(pages, ["p003", "p005"]).collect()} == {3, 5}
