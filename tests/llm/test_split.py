from __future__ import annotations

import string

from hypothesis import given, settings
from hypothesis import strategies as st

from plafond.llm import split

TEXTS = st.text(alphabet=string.ascii_letters + "      \n\n.!?=ä", max_size=400)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(5, 80), st.integers(0, 4))
def test_pieces_cover_the_text_within_the_limit(text, limit, overlap):
    got = split.pieces(text, limit, overlap)
    assert got[0][0] == 0 and got[-1][1] == len(text)
    for (a, b), (c, d) in zip(got, got[1:]):
        assert a < c <= b < d and b - c <= overlap
    assert all(b - a <= limit for a, b in got)


def test_cuts_stand_between_sections_paragraphs_sentences():
    text = "Satz eins hier. " * 30 + "\n\n== Befund ==\n\n" + "Satz zwei dort. " * 30
    got = [text[a:b] for a, b in split.pieces(text, 520, 40)]
    assert len(got) == 2 and "== Befund ==" in got[1] and got[0].rstrip().endswith("hier.")
    parts = [text[a:b] for a, b in split.pieces("Ein Satz steht hier. " * 60, 300, 50) for text in ["Ein Satz steht hier. " * 60]]
    assert all(p.startswith("Ein Satz") for p in parts)


def test_whole_overlap_inside_a_long_word():
    got = split.pieces("x" * 100, 40, 10)
    assert got == [(0, 40), (30, 70), (60, 100)]


def test_blocks_are_runs_of_lines_that_are_not_blank():
    text = "\n a\nb\n \t\r\n\nc\n"
    assert [text[a:b] for a, b in split.blocks(text)] == [" a\nb", "c"]
    assert split.blocks("") == []


def test_frame_with_nulls_empty_repeats_and_clashing_columns(spark):
    long = ("Wort " * 2000).strip()
    rows = [(1, "kurz", "x"), (2, None, "x"), (3, "", None), (4, long, None), (4, long, None), (None, long, "y")]
    df = spark.createDataFrame(rows, "article_id bigint, body string, piece string")
    got = split.split_oversized(df, "article_id", "body").collect()
    by = {}
    for r in got:
        by.setdefault(r.article_id, []).append(r)
    assert [r.piece for r in by[1]] == ["kurz"] and [r.piece for r in by[2]] == [None] and [r.piece for r in by[3]] == [""]
    assert len(by[4]) == 4 and len(by[None]) == 2 and all(len(r.piece) <= 8000 for r in by[4])
    assert {tuple(r) for r in split.found(df, "article_id", "body").collect()} == {(4, 0), (4, 1), (None, 0), (None, 1)}
    assert split.split_oversized(df.limit(0), "article_id", "body").count() == 0


def test_every_border_has_an_overlap():
    """The second unit would nearly fill a piece: it is cut one level lower."""
    text = "a" * 3000 + ".\n\n" + " ".join(f"Satz{i:04d}." for i in range(780)) + "\n\n" + "Ende. " * 500
    got = split.pieces(text)
    assert len(got) > 1 and all(0 < b - c <= 200 for (_, b), (c, _) in zip(got, got[1:])) and max(b - a for a, b in got) <= 8000


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(8, 60), st.integers(1, 6))
def test_cuts_tell_the_blocks_beyond_the_limit(text, limit, overlap):
    spans = split.pieces(text, limit, overlap)
    assert split.cut_blocks(text, spans, limit) == [k for k, (a, b) in enumerate(split.blocks(text), 1) if b - a > limit]
    assert all(c < b for (_, b), (c, _) in zip(spans, spans[1:]))


def test_without_cuts_there_are_no_cut_blocks():
    assert split.cut_blocks("x" * 9000, [(0, 9000)]) == [] and split.cut_blocks("x" * 9000, split.pieces("x" * 9000)) == [1]
