from __future__ import annotations

import numpy as np

from plafond.sources import external, files
from plafond.streaming.ingest import ingest_new_pages, page_counts_stream


def tree(tmp_path):
    for band, chunk, page in [("Band01", 1, 1), ("Band01", 1, 2), ("Band03-1", 2, 1)]:
        d = tmp_path / "extracted" / f"{band}_chunk{chunk:03d}" / "wiki"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"p{page:03d}.wiki").write_text(f"<!-- citation-page-top: {band} p{page} -->\nText {page}\n", encoding="utf-8")
    d = tmp_path / "formatted" / "Band01"
    d.mkdir(parents=True)
    (d / "Ort (Büchl), St. Anna + 1.wiki").write_text("{{Artikel\n|Band=1\n}}\nkurz", encoding="utf-8")
    return tmp_path


def test_trees(spark, tmp_path):
    root = tree(tmp_path)
    rows = files.read_pages(spark, str(root / "extracted")).orderBy("band_prefix", "page").collect()
    assert [(r.band_prefix, r.chunk, r.stage, r.page) for r in rows] == [("Band01", 1, "wiki", 1), ("Band01", 1, "wiki", 2), ("Band03-1", 2, "wiki", 1)]
    assert files.read_pages(spark, str(root / "extracted"), "Band03-1").count() == 1
    assert files.read_wiki_tree(spark, str(root / "formatted")).first().file_stem == "Ort (Büchl), St. Anna + 1"
    text = files.volume_texts(files.read_pages(spark, str(root / "extracted"))).where("band_prefix = 'Band01'").first().text
    assert text.index("Text 1") < text.index("Text 2") and text.endswith("\n")


def test_ingest_takes_new_files_only(spark, tmp_path):
    root = tree(tmp_path)
    args = (spark, str(root / "extracted"), str(tmp_path / "out"), str(tmp_path / "cp"))
    ingest_new_pages(*args)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    ingest_new_pages(*args)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    d = root / "extracted" / "Band01_chunk001" / "wiki"
    (d / "p003.wiki").write_text("neu", encoding="utf-8")
    ingest_new_pages(*args)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_stream_counts(spark, tmp_path):
    spark.sql("select timestamp_ntz'2024-01-01 10:05:00' as received_at, 'Band07' as source union all select timestamp_ntz'2024-01-01 10:50:00', 'Band07' union all select timestamp_ntz'2024-01-02 00:00:00', 'Band08'").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("received_at timestamp_ntz, source string").parquet(str(tmp_path / "in"))
    q = page_counts_stream(stream).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.source, r.pages) for r in spark.table("counts").collect()} == {("Band07", 2), ("Band08", 1)}


def test_lists_and_cells(spark, tmp_path):
    (tmp_path / "l.csv").write_text('Band,Bauwerk\n"Band 1","a\nb"\n', encoding="utf-8")
    assert files.read_list(spark, str(tmp_path / "l.csv")).first().Bauwerk == "a\nb"
    cells = [("Deckblatt", 0, 0, ["Bauwerk"]), ("Band 1", 1, 0, ["x"]), ("Band 1", 1, 1, [None, "Bauwerk", "Modul"]), ("Band 1", 1, 2, [None, "Ort, Kirche", "1", "Sakral", "S. 1"]), ("Band 1", 1, 3, [None] * 4), ("Band 1", 1, 4, [None, "B", "1", None])]
    got = files.list_of_cells(spark.createDataFrame(cells, "sheet string, sheet_idx int, row_idx int, cells array<string>")).collect()
    assert [(r.band, r.bauwerk, r.ort, r.autor) for r in got] == [("Band 1", "Ort, Kirche", "Ort", None)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("Band01", 1, "x"), ("Band02", 2, "y")], "band_prefix string, n int, _hidden string")
    files.write_by_volume(df, str(tmp_path / "o"))
    assert set(spark.read.csv(str(tmp_path / "o"), header=True).columns) == {"n", "band_prefix"}
    plan = files.changed_only(spark.createDataFrame([("a", "a"), ("a", "b"), (None, None), (None, "x")], "o string, n string"), "o", "n")
    assert plan.count() == 2
    chunks = spark.createDataFrame([(1, 2, "b\n\n\n\n"), (1, 1, "a")], "d int, i int, t string")
    assert files.appended(chunks, "d", "i", "t").first().t == "a\n\nb\n"


def test_injected(spark):
    def post(p):
        if p == "bad":
            raise OSError("weg")
        return 200, p.upper()

    got = {r.id: (r.status, r.payload) for r in external.answered(spark.createDataFrame([(1, "a"), (2, "bad")], "id bigint, prompt string"), post).collect()}
    assert got == {1: (200, "A"), 2: (0, "")}
    pdfs = spark.createDataFrame([("B_chunk1", bytearray(b"xy"))], "name string, content binary")
    assert [r.page_name for r in external.rendered_pages(pdfs, lambda c: [bytes([b]) for b in c]).collect()] == ["B_chunk1_p001", "B_chunk1_p002"]
    img = spark.createDataFrame([(1, bytearray([0, 200, 0, 0]))], "id bigint, image binary")
    assert external.row_projection(img, lambda b: np.frombuffer(bytes(b), np.uint8).reshape(2, 2)).first().h_proj == [1, 2]
    crops = spark.createDataFrame([(i, bytearray([i])) for i in range(5)], "region_id bigint, image binary")
    assert {r.region_id: r.lines for r in external.read_regions(crops, lambda b: [[str(x[0])] for x in b], 2).collect()} == {i: [str(i)] for i in range(5)}
    titles = spark.createDataFrame([("A",)], "prefix string")
    assert external.listed_files(titles, lambda p: [(p, "u")]).first().image1_url == "u"
