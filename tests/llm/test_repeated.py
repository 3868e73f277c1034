from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plafond.llm import repeated as r

SCHEMA = "region_id bigint, band_prefix string, chunk int, page int, label string, reading_pos int, lines array<string>, text string, volume string"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_suffix_array_against_sorting(ids):
    order, common = r.suffix_array(np.asarray(ids, np.int64))
    suffixes = sorted(range(len(ids)), key=lambda i: ids[i:])
    assert [ids[i:] for i in order] == [ids[i:] for i in suffixes]
    for k in range(1, len(ids)):
        a, b = ids[order[k] :], ids[order[k - 1] :]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert common[k] == n


@pytest.mark.parametrize("a, b, same", [("tafel", "tafl", True), ("tafel", "tafcl", True), ("malerei", "malcrei", True), ("darum", "darurn", True), ("tafel", "tefal", False), ("abc", "abcdef", False), ("", "ab", True)])
def test_one_place(a, b, same):
    assert r.one_place(a, b) is same and r.one_place(b, a) is same


def volume(name, pages, every, first=1):
    """A volume whose pages each have a text, and a two-line notice on every so many pages, spelled in many ways."""
    rows, n = [], first
    forms = [["Gedruckt mit Unterstützung 17", "der Freunde"], ["  GEDRUCKT mit Unterstützung", "der Freundc"], ["Gedruckt mit Unterstütznng 3", "der Freunde *"]]
    for p in range(pages):
        lines = [f"Zeile {chr(97 + p % 26)}{chr(97 + p // 26)}{w} steht allein" for w in ("xu", "yo", "za")]
        if p % every == 0:
            lines[1:1] = forms[p // every % 3]
        rows.append((n, name, p // 25 + 1, p % 25 + 1, "Text", 0, lines, "\n".join(lines), "x"))
        rows.append((n + 1, name, p // 25 + 1, p % 25 + 1, "SectionHeader", 1, ["Befund"], "Befund", None))
        n += 2
    return rows


def test_found_and_removal(spark):
    rows = volume("A", 60, 5) + volume("B", 60, 15, 1000) + [(5000, "A", 1, 1, None, None, None, None, None), (5001, "A", 1, 1, "Text", 2, [], "", None), (5002, "A", 1, 2, "Text", 2, [None, ""], None, None), (1, *volume("A", 60, 5)[0][1:])]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {(x[0], k) for x in volume("A", 60, 5) if len(x[6]) == 5 for k in (2, 3)}
    assert {tuple(x) for x in r.found(df).collect()} == want  # 12 of A's 60 pages, but only 4 of B's
    out = {x.region_id: x for x in r.without_boilerplate(df).collect()}
    assert len(out[1].lines) == 3 and out[1].lines_removed == 2 and out[1].text.count("\n") == 2
    assert out[2].lines == ["Befund"] and out[5000].lines is None and out[5001].lines == []
    assert r.found(df.limit(0)).count() == 0


def all_blocks(ids, page):
    """Pages of every block of neighbouring lines, by trying all."""
    pages = {}
    for a in range(len(ids)):
        for b in range(a + 1, len(ids) + 1):
            if page[b - 1] < 0:
                break
            pages.setdefault(tuple(ids[a:b]), set()).add(page[a])
    return {k: len(v) for k, v in pages.items()}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=5), max_size=8), st.integers(1, 4))
def test_maximal_blocks_against_brute_force(runs, least):
    ids, page = [], []
    for k, run in enumerate(runs):
        if k:
            ids.append(100 + k)
            page.append(-1)
        ids += run
        page += [k // 2] * len(run)
    want = all_blocks(ids, page)
    got = {tuple(ids[a : a + n]): c for a, n, c in r.maximal_blocks(np.asarray(ids, np.int64), np.asarray(page, np.int64), least)}
    assert all(want[k] == c >= least for k, c in got.items())
    # Every repeated block, and every line, on enough pages is part of a block on as many.
    for block, n in want.items():
        if n >= max(least, 2 if len(block) > 1 else 1):
            assert any(c == n and any(k[i : i + len(block)] == block for i in range(len(k))) for k, c in got.items())


def test_blocks_across_parts(spark):
    told = r.boilerplate(spark.createDataFrame(volume("A", 500, 5), SCHEMA))
    names = {x.h: x.key for x in told.lines.collect()}
    assert {(tuple(names[h] for h in x.block), x.pages_with) for x in told.blocks.collect()} == {(("gedrucktmitunterstützung", "derfreunde"), 100)}  # in three spellings


def test_a_block_goes_as_a_whole(spark):
    """A line of a block that no single misread place explains goes with its block, but not one that only stands there."""
    plain = ["Gedruckt mit Unterstützung", "der Freunde der Musik", "in der Stadt am Fluss"]
    rows = []
    for p in range(40):
        lines = [f"Zeile {chr(97 + p % 26)}{chr(97 + p // 26)} steht allein", *(plain if p % 4 == 0 else [])]
        rows.append((p + 1, "A", p // 25 + 1, p % 25 + 1, "Text", 0, lines, "\n".join(lines), None))
    garbled = [*rows[1][6], plain[0], "dcr Frcunde dcr Nusik", plain[2]]
    other = [*rows[2][6], plain[0], "eine Zeile für sich allein"]
    behind = [*rows[3][6], plain[1], "ln dcr Stadl am FIuss"]
    for k, lines in ((1, garbled), (2, other), (3, behind)):
        rows[k] = (*rows[k][:6], lines, "\n".join(lines), None)
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(x) for x in r.found(df).collect()} >= {(2, 2), (2, 4), (3, 2), (4, 2)} and (2, 3) not in {tuple(x) for x in r.found(df).collect()}
    out = {x.region_id: x for x in r.without_boilerplate(df).collect()}
    assert out[2].lines == garbled[:1] and out[2].lines_removed == 3
    assert out[3].lines == [other[0], other[2]] and out[4].lines == behind[:1] and len(out[5].lines) == 1


def test_repeated_deliveries_count_once(spark):
    rows = volume("A", 60, 15)
    df = spark.createDataFrame(rows + rows + rows, SCHEMA)
    assert r.found(df).count() == 0


def test_a_line_scattered_over_misread_spellings(spark):
    """No spelling stands on half the required pages, but together they are a tenth of all pages."""
    said = ["Gedruckt mit Unterstützung", *(f"Gedruckt mit Unterst{x}tzung" for x in "uoae")]
    rows = []
    for p in range(100):
        lines = [f"Zeile {chr(97 + p % 26)}{chr(97 + p // 26)} steht allein"]
        if p % 10 == 0:
            lines.append(said[0] if p // 10 < 4 else said[1 + p // 10 % 4])
        rows.append((p + 1, "A", p // 25 + 1, p % 25 + 1, "Text", 0, lines, "", None))
    assert {tuple(x) for x in r.found(spark.createDataFrame(rows, SCHEMA)).collect()} == {(p + 1, 2) for p in range(0, 100, 10)}
