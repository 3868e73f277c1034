"""Hand-traced goldens of the column expressions."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from plafond.functions import articles as fa
from plafond.functions import keys as fk
from plafond.functions import text as ft
from plafond.operators import articles, citations, layout, lines, pages, payloads
from plafond.operators.intervals import covered_and_gaps, latest_by


def values(spark, rows, f, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x")).alias("y")).collect()]


def test_volume_names(spark):
    assert values(spark, ["Band 1", "Band 3, I", "Band 12, II", "Band 5, IIII", "Index"], fk.strict_volume_prefix) == ["Band01", "Band03-1", "Band12-2", "Band05-1", ""]
    names = ["Band 7", " band 07 ", "BD. 7", "Bd.12-2", "Band\xa012 , II", "Band12/I", "Band 123", "Index", "Band 0", "", None, "Band", "Band 7a"]
    assert values(spark, names, fk.volume_prefix) == ["Band07", "Band07", "Band07", "Band12-2", "Band12-2", "Band12-1", "Band123", None, None, None, None, None, None]


def test_numbers_and_citations(spark):
    assert values(spark, [" 12 ", "0011", "l20l", "12.5", "", None, "99999999999", "٣"], fk.plain_int) == [12, 11, None, None, None, None, None, None]
    assert values(spark, ["p007.wiki", "x.wiki"], fk.page_number) == [7, -1]
    assert values(spark, ["<!-- citation-page-top: Band01 p158 -->", "<!-- citation-page-top: Band II p0 -->"], fk.citation_page) == [158, None]
    assert values(spark, ["A/B: C?  D"], fk.safe_file_name) == ["A-B - C D"]
    assert values(spark, ["Bauer 1976, S. 19–21.", "S. 5, S. 19", "ohne"], fk.citation_range) == [Row("19", "21"), Row("19", "19"), Row("", "")]
    assert values(spark, ["Zu Stiegenhaus: Siehe X"], fk.without_lead) == ["Siehe X"]
    assert values(spark, ["Zu Stiegenhaus: S. 5", "S. 5"], lambda x: fk.sub_building(F.lit("Schloss A"), x)) == ["Schloss A, Stiegenhaus", "Schloss A"]
    assert values(spark, ["a\n& b\n\n&&c", "&"], fk.citation_parts) == [["a", "b", "c"], ["&"]]
    assert values(spark, [6], lambda x: fk.printed_page(x, F.lit(2), F.lit(0)), "int") == [252]
    assert values(spark, [1], lambda x: fk.printed_page(x, F.lit(3), F.lit(6)), "int") == [304]


def test_text(spark):
    assert values(spark, ["LEEDER", "Befund", "123", "ÄÖ 1", "GROßE"], ft.all_caps) == [True, False, False, True, False]
    join = values(spark, [["ge-", "bildet"], ["Bauer-", "Wild"], ["Decken¬", "bild"], ["Ende-"], ["Stich-", "", "kappe"], []], ft.dehyphenated, "array<string>")
    assert join == ["gebildet", "Bauer- Wild", "Deckenbild", "Ende-", "Stich- kappe", ""]
    assert values(spark, ["\n \n a\n\nb\n \n"], ft.trim_blank_lines) == [" a\n\nb"]
    assert values(spark, ["Text , a\n\n\n== Befund ==\nx"], ft.normal_body) == ["Text, a\n\n== Befund ==\n\nx"]
    assert values(spark, ["\n== LEEDER ==\n\nText\n", "\n== Befund ==\nx"], fa.without_leading_caps) == ["\nText\n", "\n== Befund ==\nx"]
    assert values(spark, [["aaaa", "bbbb", "cc"], []], lambda x: ft.packed(x, 10), "array<string>") == [["aaaa", "bbbb\n\ncc"], []]
    assert values(spark, [["a|b", "c|d|e"]], ft.table_of_pipes, "array<string>") == ['{| class="wikitable"\n|-\n| a || b || \n|-\n| c || d || e\n|}']
    assert values(spark, [["A"], ["A", "B"], ["A", "B", "C"], []], fa.joined_names, "array<string>") == ["A", "A und B", "A, B und C", ""]
    assert values(spark, ["a\n\n\n\nb \n"], ft.squeezed) == ["a\n\nb\n"]
    assert values(spark, ["Befund", "=== A ==", "== B ==", "text"], ft.heading_text) == [None, "A", "B", None]


def test_normal_body_is_idempotent(spark):
    texts = ["a .\n\n\nb", "== H ==\ntext\n== I ==", "\n\n", "", "x  \n \n y ;"]
    once = values(spark, texts, ft.normal_body)
    assert values(spark, once, ft.normal_body) == once


def test_template(spark):
    block = values(spark, [["A", "B"]], lambda x: fa.template_block(F.lit("Band 3, I"), *[F.lit(None)] * 9, x), "array<string>")[0]
    assert block.split("\n")[0:2] == ["{{Artikel", "|Band=3"] and block.endswith("|AutorIn1=A\n|AutorIn2=B\n}}")
    df = spark.createDataFrame([(1, "{{Artikel\n|Band=1\n|Band=2\n|Lemma= X \n}}\nbody"), (2, "nur Text"), (3, "{{Artikel\n|Band=1\nx"), (4, None), (5, "")], "i int, t string")
    got = {r.i: r for r in articles.parsed(df, "t").collect()}
    assert got[1].fields == {"Band": "2", "Lemma": "X"} and got[1].body == "body"
    assert got[2].fields == {} and got[2].body == "nur Text"
    assert got[3].fields == {"Band": "1"} and got[3].body == "{{Artikel\n|Band=1\nx"
    assert got[4].body is None and got[5].body == ""


def test_payload(spark):
    text = '{"response":"Ha","done":false}\nbad\n\n5\n{"response":"llo","done":true}\n{"response":"X"}'
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, '{"response":\n"ganz"}'), (5, '{"response":"a"}')], "i int, p string")
    assert {r.i: r.response for r in payloads.responses(df, "p").collect()} == {1: "Hallo", 2: "", 3: "", 4: "ganz", 5: "a"}


def test_footer(spark):
    end = "<!-- citation-page-bottom: Band01 p3 -->"
    rows = [(1, f"body\n\n----\n12\n{end}"), (2, f"body\n{end}"), (3, "----\nkein Fuß"), (4, None), (5, "body\n----\n" + "x\n" * 14 + end)]
    got = {r.i: (r.t, r.removed) for r in lines.without_footer(spark.createDataFrame(rows, "i int, t string"), "t").collect()}
    assert got[1] == (f"body\n{end}", 9) and got[2] == (rows[1][1], 0) and got[3] == (rows[2][1], 0) and got[4] == (None, None) and got[5][1] == 0
    long = spark.createDataFrame([(1, f"body\n----\n{'x' * 40}\n{end}")], "i int, t string")
    r = lines.without_footer(long, "t").first()
    assert r.removed > 18 and not r.applied and "x" * 40 in r.t


def test_citations(spark):
    volumes = spark.createDataFrame([("Band12-2", "Band 12", 6)], "band_prefix string, citation_label string, chunk_offset int")
    old = "<!-- dropbox: u/Band12-2_chunk001.pdf -->\n<!-- chunk-page: 3 -->\n<!-- citation-page-top: x p1 -->\nText\n<!-- citation-page-bottom: x p2 -->\n"
    rows = [(1, "<!-- Band12-2_chunk001 Page 3 -->\nText\n\n"), (2, old), (3, "ohne"), (4, ""), (5, None), (6, "<!-- Band14_chunk006 Page 2 -->\n")]
    got = {r.i: r for r in citations.relinked(spark.createDataFrame(rows, "i int, t string"), "t", volumes, "u").collect()}
    want = "<!-- dropbox: u/Band12-2_chunk001.pdf#page=3 -->\n<!-- citation-page-top: Band12 p304 -->\nText\n<!-- citation-page-bottom: Band12 p305 -->\n"
    assert got[1].t == want and got[2].t == want and not any(got[i].changed for i in (3, 4, 5)) and "Band14 p252" in got[6].t
    again = spark.createDataFrame([(1, want)], "i int, t string")
    assert not citations.relinked(again, "t", volumes, "u").first().changed
    both = [(1, "Text\n", want), (2, want, "x"), (3, "Text", "ohne")]
    filled = {r.i: r.t for r in citations.with_metadata(spark.createDataFrame(both, "i int, t string, s string"), "t", "s").collect()}
    assert filled[1].startswith("<!-- dropbox") and filled[1].endswith("p305 -->\n") and "\nText\n" in filled[1] and filled[2] == want and filled[3] == "Text"


def test_layout(spark):
    assert values(spark, [[[1.9, -2.5], [3.2, 4.9]], []], fk.bbox_of, "array<array<double>>") == [Row(1, -2, 3, 4), Row(None, None, None, None)]
    runs = values(spark, [[0] + [6] * 9 + [0, 9, 9, 0], [200], [0, 1], [6] * 9], lambda x: layout.runs_over(x, 5, 8), "array<int>")
    assert runs == [[Row(1, 10)], [Row(0, 1)], [], [Row(0, 9)]]
    assert values(spark, [[200, 180, 149, 200], [200, 200], [10]], layout.white_strip, "array<int>") == [2, 2, 0]
    box = "struct<x1:int,y1:int,x2:int,y2:int>"
    rows = [(1, "B", 1, 1, "Picture", 1, (0, 0, 9, 0), None), (2, "B", 1, 1, "Picture", 2, (0, 100, 9, 100), None), (3, "B", 1, 1, "Caption", 3, (0, 50, 9, 50), "a"), (4, "B", 1, 1, "Caption", 4, (0, 100, 9, 100), "b"), (5, "B", 1, 1, "Caption", 5, (0, 0, 9, 9), " "), (6, "B", 1, 2, "Caption", 0, (0, 0, 9, 9), "allein")]
    df = spark.createDataFrame(rows, f"region_id bigint, band_prefix string, chunk int, page int, label string, reading_pos int, bbox {box}, text string")
    found = layout.matched_captions(df)
    assert {(r.caption_id, r.image_id) for r in found.collect()} == {(3, 1), (4, 2)}
    assert layout.image_captions(found).count() == 2 and layout.matched_captions(df.limit(0)).count() == 0


def test_pairing_and_continuity(spark):
    events = spark.createDataFrame([("u", i, "s") for i in (1, 4, 6, 12)] + [("u", i, "e") for i in (3, 9)], "u string, i int, k string")
    got = {r.start_at: r.end_at for r in lines.paired(events, ["u"], "i", F.col("k") == "s", F.col("k") == "e").collect()}
    assert got == {1: 3, 4: 9, 6: 9, 12: None}
    rows = spark.createDataFrame([("A", 1, 10, 12), ("A", 2, 12, 14), ("A", 3, 16, 18), ("A", 4, 17, 20), ("A", 5, 17, 16)], "b string, o int, von int, bis int")
    got = [(r.issue, r.size, r.inverted) for r in pages.continuity(rows, "b", ["o"], "von", "bis").orderBy("o").collect()]
    assert got == [(None, None, False), (None, None, False), ("GAP", 1, False), ("OVERLAP", 2, False), ("SAME", None, True)]


def test_page_operators(spark):
    p = spark.createDataFrame([("A", 1, n) for n in range(1, 25)] + [("A", 2, 1)], "b string, c int, p int")
    assert [tuple(r) for r in pages.missing_in_series(p, "b", "c", "p").collect()] == [("A", 1, 25)]
    files = spark.createDataFrame([("A", 1, 5, 6), ("A", 2, 6, 7), ("A", 2, 6, 7), ("A", 3, None, 7), ("A", 4, 5, 5)], "b string, f int, top int, bottom int")
    assert {r.printed_page: r.files for r in pages.page_index(files, "b", "f", "top", "bottom").collect()} == {5: [1, 4], 6: [1, 2], 7: [2, 3]}
    w = pages.last_writer(spark.createDataFrame([("k", 1, "a"), ("k", 2, "b")], "k string, o int, v string"), ["k"], ["o"]).first()
    assert (w.v, w.written) == ("b", 2)
    text = "a|b\n\nc|d|e\nx\n|\n\nz"
    df = spark.createDataFrame([(1, text)], "i int, t string")
    got = lines.pipe_tables(df, ["i"], "t").orderBy("grp").collect()
    assert [(r.first_line, r.n_rows, r.n_cols) for r in got] == [(1, 2, 3), (5, 1, 2)]


def brute_runs(rows):
    covered = sorted({p for a, b in rows if a <= b for p in range(a, b + 1)})
    out = []
    for p in covered:
        if out and out[-1][1] == p - 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    gaps = [("gap", x[1] + 1, y[0] - 1) for x, y in zip(out, out[1:])]
    return {("period", *x) for x in out} | set(gaps)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 60), st.integers(-5, 60)), max_size=25))
def test_sweep_line_against_brute_force(spark, rows):
    df = spark.createDataFrame([("v", a, b) for a, b in rows], "v string, a int, b int")
    assert {tuple(r)[1:] for r in covered_and_gaps(df, "v", "a", "b", width=7).collect()} == brute_runs(rows)


def test_sweep_line_corner_cases(spark):
    df = spark.createDataFrame([("A", 1, 5, 1), ("A", 6, 9, 2), ("A", 12, 12, 3), ("A", None, 5, 4), (None, 1, 2, 5), ("B", 7, 3, 6), ("A", 1, 5, 1)], "v string, a int, b int, at int")
    assert {tuple(r) for r in covered_and_gaps(df, "v", "a", "b").collect()} == {("A", "period", 1, 9), ("A", "gap", 10, 11), ("A", "period", 12, 12)}
    assert covered_and_gaps(df.limit(0), "v", "a", "b").count() == 0


def test_latest(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "b"), (2, None, "c"), (None, 1, "d")], "k int, at int, row string")
    assert {tuple(r) for r in latest_by(df, "k", F.col("at")).collect()} == {(1, 2, "b"), (2, None, "c"), (None, 1, "d")}


PAGES = [
    # (page, sibling, page with what it lacked)
    ("Text\n", "Vorspann\n<!-- dropbox: u -->\n\n<!-- citation-page-top: B p1 -->\nInhalt\n<!-- citation-page-bottom: B p2 -->", "<!-- dropbox: u -->\n<!-- citation-page-top: B p1 -->\n\nText\n<!-- citation-page-bottom: B p2 -->\n"),
    ("<!-- citation-page-top: B p1 -->\nText  \n\n", "x\n  a <!--  citation-page-bottom: B p2 --> b -->", "<!-- citation-page-top: B p1 -->\nText\n<!--  citation-page-bottom: B p2 -->\n"),
    ("Text", "ohne", "Text"),
    ("Text", None, "Text"),
    (None, "<!-- dropbox: u -->", None),
    ("T\n<!-- citation-page-bottom: B p9 -->", "<!-- dropbox: u -->\nx\n<!-- citation-page-top: B p1 -->", "<!-- dropbox: u -->\n\nT\n<!-- citation-page-bottom: B p9 -->"),
    ("", "", ""),
]


def test_metadata_copy(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(PAGES)], "i int, t string, s string")
    got = citations.with_metadata(df, "t", "s").orderBy("i").collect()
    assert [r.t for r in got] == [x[2] for x in PAGES] and [bool(r.copied) for r in got] == [x[0] != x[2] for x in PAGES]


def test_headings_rewritten(spark):
    rows = ["a\n= Befünd ==\nb\n", "Befnd", "== Befund ==\n", "ohne\n\n", None, "", "  Befund  \r\nx\n", "Befundungen"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    got = [(r.t, r.fixed) for r in lines.rewritten_headings(df, "t", "Befund").orderBy("i").collect()]
    assert got[0] == ("a\n== Befund ==\nb\n", 1) and got[1] == ("== Befund ==", 1) and got[2] == (rows[2], 0) and got[3] == (rows[3], 0)
    assert got[4][0] is None and got[5] == ("", 0) and got[6] == ("== Befund ==\nx\n", 1) and got[7] == (rows[7], 0)


def test_headings_of_signs(spark):
    lines_in = ["== ==", "====", "=====", "=== a = ==", "== =a ==", "==a", "", None, " == B ===\t"]
    assert values(spark, lines_in, ft.heading_text) == ["", None, "=", "a =", "=a", None, None, None, "B"]


def test_citations_of_all_kinds(spark):
    said = ["S.5-7", "S 5 – 7.", "S. 5-", "S. 5-6-7", "S. 5 .", "Seite 5", "S. a5", None, "12", "S.\n 12"]
    assert values(spark, said, fk.citation_range) == [Row("5", "7"), Row("5", "7"), Row("", ""), Row("", ""), Row("", ""), Row("", ""), Row("", ""), Row("", ""), Row("", ""), Row("12", "12")]
    named = ["Zu A: x", "Zu  A B : C: x", "ZuA: x", "Zu : x", "Zu A", None, "Zur A: x"]
    assert values(spark, named, lambda x: fk.sub_building(F.lit("H"), x)) == ["H, A", "H, A B", "H", "H", "H", "H", "H"]


def test_original_page_marks(spark):
    mark = "<!-- Band01_chunk002 Original Page 7 -->"
    texts = [f"a\n{mark}\nb", f"a {mark} b", f"{mark}\n\n{mark}", f"a\n{mark}\n{mark}\nb", "a", "", None]
    assert values(spark, texts, citations.without_original_pages) == ["ab", "a  b", "", "ab", "a", "", None]


def test_payload_streams_of_any_kind(spark):
    rows = ['{"response":"a"}\n{"response":"b","done":true}\n{"response":"c"}', '{"response":"a"}\n{kaputt\n{"response":"b"}', '{"response":"a"},{"response":"x"}\n{"response":"b"}', '{"done":false}\n{"response":null}', "[1]\n5\n", '{"response":"ä\\n"}\r\n  {"response":"b"}', '{"response":"a","done":true}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, p string")
    assert [r.response for r in payloads.responses(df, "p").orderBy("i").collect()] == ["ab", "ab", "ab", "", "", "ä\nb", "a"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 30), st.booleans()), max_size=25), st.integers(1, 9))
def test_slices_against_whole_windows(spark, rows, width):
    from pyspark.sql import Window

    from plafond.operators import slices

    df = spark.createDataFrame([(e, n, i, f"v{i}" if i % 3 else None, m) for i, (e, n, m) in enumerate(rows)], "e string, n int, i int, v string, m boolean")
    w = Window.partitionBy("e").orderBy("n", "i")
    want = {r.i: (r.a, r.b, r.c) for r in df.select("i", F.lag("v").over(w).alias("a"), F.lead("v").over(w).alias("b"), F.row_number().over(w).alias("c")).collect()}
    beside = slices.neighbours(df, ["e"], ["n", "i"], ["v"], width).collect()
    a, b = {r.i: r._before and r._before.v for r in beside}, {r.i: r._behind and r._behind.v for r in beside}
    c = {r.i: r.c for r in slices.numbered(df, ["e"], ["n", "i"], "c", width).collect()}
    assert {i: (a[i], b[i], c[i]) for i in a} == want
    first = {r.i: r.x for r in slices.first_after(df, ["e"], "n", {"x": F.col("m")}, width).collect()}
    assert first == {i: min((n2 for e2, n2, m2 in rows if e2 == e and m2 and n2 > n), default=None) for i, (e, n, m) in enumerate(rows)}
    one = df.dropDuplicates(["e", "n"])
    last = {r.i: r._before for r in slices.last_before(one, ["e"], "n", "v", width).collect()}
    assert last == {r.i: r.x for r in one.select("i", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("x")).collect()}
