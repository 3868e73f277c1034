from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plafond.llm import canonical as c

TRIE = c.Trie(["Kuppel", "Spitalkirche", "Himmelsöffnung", "Hilfe", "profilierter"])


@pytest.mark.parametrize(
    "line, form",
    [
        ("Ｓｐｉｔａｌｋｉｒｃｈｅ St. Wolfhild", "Spitalkirche St. Wolfhild"),
        ("Κuppel und Hіlfe", "Kuppel und Hilfe"),
        ("Himmelsöffnung", "Himmelsöffnung"),
        ("Schrift\xa0ro​lle ein", "Schrift rolle ein".replace(" rolle", " rolle")),
        ("proﬁlierter", "profilierter"),
        ("weiter\xadhin", "weiterhin"),
        ("WОLFSFЕLDING", "WOLFSFELDING"),
    ],
)
def test_look_alikes(line, form):
    assert c.canonical(line, TRIE) == form and c.canonical(form, TRIE) == form


@pytest.mark.parametrize("line", ["„ἀρχή“ und ФИЛИП, יהוה", "Größe – „Maß“ ¬", "Bleizinn¬", "a\tb", "", "ΙΧΘΥΣ"])
def test_no_cases(line):
    assert c.canonical(line, TRIE) == line


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="aeoKup lfiΚοеНѕ̈​\xad\xa0ﬁＡａ１„“–", max_size=30))
def test_idempotent_and_the_trie_agrees_with_the_table_on_its_look_alikes(line):
    once = c.canonical(line)
    assert c.canonical(once) == once
    assert c.canonical(line, TRIE) == once


def test_automaton_budget():
    assert c.Trie(["Kuppel"]).match(list("Kupel"), 1) == "Kuppel"
    assert c.Trie(["Kuppel"]).match(list("Kupel"), 0) is None
    assert c.Trie(["Kuppel"]).match(list("Kuxpel"), 1) == "Kuppel"
    assert c.Trie(["Kuppel"]).match(list("Kuppxel"), 1) == "Kuppel"


SPELLED = c.Trie(["Evangelist", "Maria", "Kapelle", "Marta", "Marka", "größer", "Eva", "Euangelium", "Taufe"])


@pytest.mark.parametrize(
    "line, form, without",
    [
        ("Eυangelist", "Evangelist", "Euangelist"),  # another letter that it looks like
        ("Euangeliυm", "Euangeliυm".replace("υ", "u"), "Euangelium"),  # the table's letter, known to the vocabulary
        ("KapeΙle", "Kapelle", "KapeIle"),
        ("Maгia", "Maria", "Maгia"),  # a letter that the table lacks
        ("MAГIA", "MARIA", "MAГIA"),
        ("Marгa", "Marгa", "Marгa"),  # Marta or Marka: the vocabulary decides nothing
        ("grцßer", "größer", "grцßer"),
        ("Tauгe und Mагia", "Taufe und Maria", "Tauгe und Mагia"),
        ("Evе", "Eve", "Eve"),  # plain letters are never changed to meet a word
    ],
)
def test_the_vocabulary_decides_between_spellings(line, form, without):
    assert c.canonical(line, SPELLED) == form and c.canonical(line) == without
    assert c.canonical(form, SPELLED) == form


@pytest.mark.parametrize("line", ["ἀρχή Μαρία", "Мария и Ева", "גלוריה", "ΕΥΑ", "маг"])
def test_words_wholly_in_another_script_stay(line):
    assert c.canonical(line, SPELLED) == line


def test_a_large_vocabulary_gives_the_same_spellings(spark):
    words = spark.createDataFrame([(w,) for w in ["Evangelist", "Maria", "Kapelle", "Marta", "Marka", "größer", "Straße", None, ""]], "word string")
    said = ["Eυangelist", "Maгia!", "MAГIA", "KapeΙle", "Marгa", "grцßer", "Ѕtraße, цtraßц", "STRAßЕ", "plain", "Κuppel ﬁ", None, "", "Eυangelist", "ἀρχή"]
    lines = spark.createDataFrame([(x, k) for k, x in enumerate(said)], "line string, line_no int")
    known = c.vocabulary(words)
    small, large = ({tuple(r) for r in c.canonical_lines(lines, known, rows=n).collect()} for n in (100, 0))
    assert small == large and ("Evangelist", 0, True) in small and ("Maria!", 1, True) in small and ("Marгa", 4, False) in small
    salted = {r.raw: r.said for r in c.spellings(lines.where("line is not null").select("line").distinct(), known, 3).collect()}
    assert salted["Eυangelist"] == "Evangelist" and "Marгa" not in salted


def test_frames(spark):
    regions = spark.createDataFrame([(1, ["gut", "Κuppel", None, ""]), (1, ["gut", "Κuppel", None, ""]), (2, None), (3, []), (4, ["​"])], "region_id bigint, lines array<string>")
    words = spark.createDataFrame([("Kuppel",)], "word string")
    articles = spark.createDataFrame([(1, "a\nЅtein b\n"), (2, None), (3, "")], "article_id bigint, body string")
    got = {tuple(r) for r in c.found(regions, articles, c.vocabulary(words)).collect()}
    assert got == {("region", 1, 2), ("region", 4, 1), ("article", 1, 2)}
    lines = spark.createDataFrame([("x\xa0y", 1), (None, 2), ("", 3)], "line string, line_no int")
    assert [tuple(r) for r in c.canonical_lines(lines, words.limit(0)).orderBy("line_no").collect()] == [("x y", 1, True), (None, 2, False), ("", 3, False)]
    clash = lines.withColumn("changed", c.F.lit("clash"))
    assert [r.changed for r in c.canonical_lines(clash, words).orderBy("line_no").collect()] == [True, False, False]
    assert c.found(regions.limit(0), articles.limit(0), words).count() == 0
