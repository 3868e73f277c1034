from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plafond.llm import scanned as s

REGION = "region_id bigint, band_prefix string, chunk int, page int, label string, reading_pos int, lines array<string>, kind string"


def edits(word: str, entry: str) -> bool:
    """One substituted, lost or added character, by trying all."""
    if abs(len(word) - len(entry)) > 1 or word == entry:
        return False
    i = 0
    while i < min(len(word), len(entry)) and word[i] == entry[i]:
        i += 1
    return word[i + 1 :] == entry[i + 1 :] or word[i:] == entry[i + 1 :] or word[i + 1 :] == entry[i:]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abcr", min_size=1, max_size=6), max_size=12), st.text(alphabet="abcr", min_size=1, max_size=6))
def test_automaton_against_brute_force(words, word):
    near = set(s.Automaton(words).near(word))
    assert near >= {w for w in words if edits(word, w)}
    assert all(edits(word, w) or s.difference(word, w)[1:] in s._CONFUSED for w in near)


@pytest.mark.parametrize("word, entry", [("darurn", "darum"), ("clas", "das"), ("turm", "turrn"), ("fiir", "für")])
def test_two_letters_for_one(word, entry):
    assert s.Automaton([entry, "anders"]).near(word) == [entry]


@pytest.mark.parametrize("line, yes", [("12", True), ("– 24 –", True), ("|9", True), ("4l9", True), ("S. 360", True), ("Seite 360", True), ("1745.", False), ("", False), ("Holz", False), ("12 cm", False)])
def test_page_numbers(line, yes):
    assert s.is_page_number(line) is yes
    assert s.is_page_number("1745.", {1745})


def test_mending_keeps_case_and_marks():
    assert s.mended("Vcrgleich,", "vcrgleich", "vergleich") == "Vergleich,"
    assert s.mended("gro8flächig", "gro8flächig", "grossflächig").startswith("gro")
    assert s.mended("Schlosskape1le.", "schlosskape1le", "schlosskapelle") == "Schlosskapelle."
    assert s.mended("weißc", "weissc", "weisse") == "weiße"
    assert s.mend_paragraph("Die ver wahrt Schloßc heute", [("ver wahrt", "verwahrt"), ("schlossc", "schlosse")]) == "Die verwahrt Schloße heute"


@pytest.fixture(scope="module")
def tables(spark):
    body = ("Der Turmbau ruhen. Die Bruchstücke verwahrt das Heimatmuseum. Szenen sind heute erhalten. Das Deckengemälde zeigt eine Himmelsöffnung. " * 30).strip()
    regions = [
        (1, "Band01", 1, 1, "SectionHeader", 0, ["Salmdorf, Pfarrhof"], None),
        (2, "Band01", 1, 1, "Text", 1, ["Die Bruchstücke ver wahrt das Heimat-", "museum. Szenen sind hente", "Salmdorf, Pfarrhof  12", "erhalten. Das Decken¬", "gemälde zeigt eine Himmels"], None),
        (3, "Band01", 1, 1, "Picture", 2, None, None),
        (4, "Band01", 1, 1, "Text", 3, ["öffnung. Haupt- und", "Nebenszenen sind erhal!ten."], None),
        (4, "Band01", 1, 1, "Text", 3, ["öffnung. Haupt- und", "Nebenszenen sind erhal!ten."], None),
        (5, "Band01", 1, 2, "Text", 0, [None, "", "13", "Der Turmbau ruhen."], None),
        (6, "Band01", 1, 2, None, 1, ["Der Turrnbau"], None),
        (7, None, None, None, "Text", 0, ["Der Turrnbau"], None),
    ]
    return [
        spark.createDataFrame(regions, REGION),
        spark.createDataFrame([(body,), (None,)], "body string"),
        spark.createDataFrame([("Salmdorf, Pfarrhof", None, "Salmdorf", None)], "bauwerk string, autor string, ort string, literaturangabe string"),
        spark.createDataFrame([("Haupt-",), ("Nebenszenen",), ("und",)], "word string"),
        spark.createDataFrame([("de", "Szenen sind heute erhalten.")], "lang string, text string"),
    ]


def test_cases(tables):
    got = {tuple(r) for r in s.found(*tables).collect()}
    assert got == {
        (2, 1, "misread"), (2, 1, "hyphen"), (2, 2, "misread"), (2, 3, "furniture"), (2, 4, "hyphen"), (2, 5, "hyphen"),
        (4, 2, "misread"), (5, 3, "furniture"), (6, 1, "misread"),
    }


def test_paragraphs(tables):
    rows = {r.region_id: r for r in s.paragraphs(*tables).collect()}
    assert rows[2].text == "Die Bruchstücke verwahrt das Heimatmuseum. Szenen sind heute erhalten. Das Deckengemälde zeigt eine Himmelsöffnung. Haupt- und Nebenszenen sind erhalten."
    assert rows[2].regions == [2, 4] and 4 not in rows and rows[5].text == "Der Turmbau ruhen." and rows[6].text == "Der Turmbau"


def test_empty(tables):
    assert s.found(*[t.limit(0) for t in tables]).count() == 0
    assert s.paragraphs(*[t.limit(0) for t in tables]).count() == 0


@pytest.mark.parametrize("token, looked_at", [("i3s", True), ("ap5is", True), ("lä5st", True), ("sa|nd", True), ("au.ch", True), ("1st", True), ("12", False), ("5er", False), ("12cm", False), ("a1", False), ("b.", False), ("2b3", False)])
def test_short_words_with_other_characters(token, looked_at):
    assert s.Reader(s.Known([])).token(token)[3] is not looked_at


def test_short_misread_words(spark, tables):
    words = ["ve|rs", "lä5st", "au.ch", "z.B.", "5er", "u.a."]
    regions = spark.createDataFrame([(n, "Band01", 1, n, "Text", 0, [f"Es {w} so"], None) for n, w in enumerate(words, 1)], REGION)
    empty = [t.limit(0) for t in tables]
    articles = spark.createDataFrame([("Es so auch der vers lässt läst " * 60,)], "body string")
    got = s.scan_cases(regions, articles, empty[2], empty[3], empty[4]).collect()
    assert {(r.region_id, r.wrong, r.entry) for r in got} == {(1, "ve|rs", "vers"), (2, "lä5st", "lässt"), (3, "au.ch", "auch")}


@pytest.mark.parametrize("usual", [0, 5, 30_000])
def test_the_bound_on_usual_words_changes_no_row(spark, tables, monkeypatch, usual):
    """A rarer word broken into two usual ones is found whether it is among the words sent to the workers or not."""
    body = "Das vor dem stand im Raum. " * 80 + "Der Vorstand tagt. " * 45 + "Im Vorraum zu gleich. Zugleich " * 30
    lines = ["Der vor stand tagt. zu gleich", "Das vor dem stand im Raum.", "im Vor- raum und Vor", "stand tagt. Vorstcnd", "Das Heimat museum"]
    regions = spark.createDataFrame([(1, "Band01", 1, 1, "Text", 0, lines, None), *[tuple(r) for r in tables[0].collect()[1:]]], REGION)
    articles = tables[1].unionByName(spark.createDataFrame([(body,)], "body string"))
    monkeypatch.setattr(s, "USUAL_WORDS", usual)
    monkeypatch.setattr(s, "USUAL_PAIRS", usual)
    got = {tuple(r) for r in s.scan_cases(regions, articles, *tables[2:]).where("region_id = 1").collect()}
    assert got == {
        (1, 1, "misread", "vor stand", "vorstand"), (1, 3, "hyphen", None, None), (1, 4, "misread", "vorstcnd", "vorstand"),
        (1, 5, "misread", "heimat museum", "heimatmuseum"),
    }


def test_the_filter_knows_every_word(spark):
    words = [f"wort{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000)]
    known = s.Known([], s.bloom_of(spark.createDataFrame([(w,) for w in words], "word string"), len(words)))
    assert all(map(known.maybe, words)) and sum(known.maybe(w + "x") for w in words) < 100
    assert s.Known(["a"]).maybe("a") and not s.Known(["a"]).maybe("b")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcrnmiu", min_size=3, max_size=14), st.data())
def test_a_misread_word_meets_its_entry_in_a_shard(entry, data):
    """Words one place away, and long ones two confused places away, share a shard with their entry."""
    for places in (1, 2):
        word = entry
        for _ in range(places):
            i = data.draw(st.integers(0, len(word) - 1))
            kind = data.draw(st.sampled_from("sla"))
            word = word[:i] + {"s": "x" + word[i + 1 :], "l": word[i + 1 :], "a": "x" + word[i:]}[kind]
            for a, b in [("m", "rn"), ("u", "ii")]:
                if kind == "s" and a in word:
                    word = word.replace("x", "", 1).replace(a, b, 1)
                    break
        if len(word) >= 3 and (places == 1 or len(entry) >= s.LONG_WORD - 2) and abs(len(word) - len(entry)) <= places:
            if word in s.Automaton([word]).root or s.Automaton([entry]).near(word, places):
                assert set(s._ends(word, True, places)) & set(s._ends(entry, False, places))


def test_two_confused_places():
    trie = s.Automaton(["kirchenschiff", "klosterhof"])
    assert trie.near("kirchcnschiif", 2, True) == [] and trie.near("klrchcnschiff", 2, True) == ["kirchenschiff"]
    assert trie.near("kirchemschif", 2) == ["kirchenschiff"] and trie.near("kirchemschif", 1) == []
    assert trie.near("klosterhöfe", 2, True) == []  # an ending is no misreading


@pytest.mark.parametrize("line, yes", [("A. Berg", True), ("A. Bcrg 12", True), ("Holz", False), ("12 A. Berg", True), ("A. Berg.", False)])
def test_running_titles_are_folded_before_their_ends_are_taken(line, yes):
    names = s.names_of("A. Berg, Kirche")
    assert s._is_running_title(line, names, s.name_ends(names)) is yes


def test_rare_misreadings_in_two_places(spark, tables):
    regions = spark.createDataFrame([(1, "Band01", 1, 1, "Text", 0, ["Das klrchcnschiff ist hoch"], None)], REGION)
    articles = spark.createDataFrame([("Das Kirchenschiff ist hoch. " * 60,)], "body string")
    empty = [t.limit(0) for t in tables]
    assert [tuple(r)[2:] for r in s.scan_cases(regions, articles, *empty[2:]).collect()] == [("misread", "klrchcnschiff", "kirchenschiff")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=2), min_size=2, max_size=6), st.text(alphabet="ab -.,\n", max_size=60))
def test_pairs_are_found_as_by_looking_at_neighbours(words, text):
    pairs = {f"{a} {b}" for a, b in zip(words, words[1:])}
    assert sorted(s.finder(pairs)(text)) == sorted(p for p in s._neighbours(text) if p in pairs)
    assert list(s.finder([])(text)) == []


def test_neighbours_choose_between_candidates(spark, tables):
    """A word with two entries one place away is mended by what stands beside it, not by what is more frequent."""
    body = "Der Saal ist hoch. " * 300 + "Am Tor steht die Säule. Die Säule trägt. " * 120 + "Die Seele schwebt. Eine Seele steigt. " * 60
    regions = [(1, "Band01", 1, 1, "Text", 0, ["Am Tor steht die Sänle und", "Sänle trägt viel"], None)]
    articles = spark.createDataFrame([(body + "Die Sähle und. " * 250,)], "body string")
    empty = [t.limit(0) for t in tables]
    got = s.paragraphs(spark.createDataFrame(regions, REGION), articles, *empty[2:]).collect()
    assert [r.text for r in got] == ["Am Tor steht die Säule und Säule trägt viel"]
