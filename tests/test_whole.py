"""Queries that SQL does not express, by brute force over texts of a fixture."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from plafond.plans import reference_texts as rt

TEXTS = [None, "", "Kurz", "ein wort und noch eins", "lange reihe von worten " * 60, "Öl auf Holz, " * 90, "abc  def\n" * 200]


@pytest.fixture
def documents(spark, tmp_path):
    """A data directory with a table of documents: each text three times, under ids of every remainder by 3."""

    def write(texts):
        rows = [(3 * i + k, t) for i, t in enumerate(texts) for k in range(3)]
        spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path), dict(rows)

    return write


def test_whole_streams(spark, documents):
    d, texts = documents(TEXTS)
    want = {}
    for i, t in texts.items():
        if t is not None:
            words = re.sub("[^a-z ]", "", t).split(" ")
            want[i] = "".join(words[: i % 7 + 1] if i % 3 == 2 else words)
    assert max(map(len, want.values())) > 400
    assert {r.doc_id: r.response for r in rt.QUERIES["ndjson_concat"](spark, d).collect()} == want


def trimmed(text):
    """(text, removed, applied) of a page, line by line."""
    rows = text.split("\n")
    bottoms = [i for i, x in enumerate(rows) if "citation-page-bottom:" in x]
    cut = text
    if bottoms:
        rules = [i for i in range(max(0, bottoms[-1] - 14), bottoms[-1]) if rows[i].strip().startswith("----")]
        if rules:
            head = rows[: rules[-1]]
            while head and not head[-1].strip():
                head.pop()
            cut = "\n".join(head + rows[bottoms[-1] :])
    removed = len(text) - len(cut)
    return (cut if 1 <= removed <= 18 else text), removed, 1 <= removed <= 18


def test_footers_of_all_texts(spark, documents):
    end = "<!-- citation-page-bottom: Band01 p3 -->"
    own = [f"a\n----\n7\n{end}", f"a\n{end}\nb\n\n ----\n9\n{end}\nc", f"{end}\nb\n----\n8", f"----\n{end}", f"a\n----\nb\n----\n{end}", f"a\n----\n{'y' * 30}\n{end}", f"a\n----{'\nz' * 14}\n{end}"]
    d, texts = documents([*TEXTS, "   ", "a\n----\nb", *own, *own[:3]])
    feet = ["\n----\n12", "\n\n---- \n\n", "\n----\n" + "zu lang" * 9, "\n----" + "\nx" * 14]
    want = {i: trimmed(t if "citation-page-bottom:" in t else re.sub(r"\s+\Z", "", t) + feet[i % 4] + "\n<!-- citation-page-bottom: B p1 -->") for i, t in texts.items() if t is not None}
    assert {r.doc_id: (r.text, r.removed, r.applied) for r in rt.QUERIES["footer_trim"](spark, d).collect()} == want
    assert want[max(want)] == (own[2], 0, False) and any(x[2] and texts[i].count(end) == 2 for i, x in want.items())


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_near_headings_of_any_characters(spark, monkeypatch):
    bare = ["Befund", "Befünd", "Be\u00a0fund", "Bëfünd", "Bäföüd", "Befunde", "Grund", "Ölbild", "Bild"]
    body = "\n".join([*bare, *(f"== {x} ==" for x in bare)])
    rows = spark.createDataFrame([(1, body)], "article_id bigint, body string")
    monkeypatch.setattr(rt, "bodies", lambda spark, d: rows)
    want = Counter(("exact" if x == "Befund" else "fuzzy", h) for x in bare for h in (False, True) if edits(x, "Befund") <= 3)
    assert {(r.match_kind, r.in_heading): r.n for r in rt.QUERIES["fuzzy_heading"](spark, "").collect()} == dict(want)
