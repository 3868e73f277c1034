from __future__ import annotations

import os
import random

import pytest

from plafond.llm import langid

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def samples(spark):
    if not os.path.exists(DATA):
        pytest.skip("no test tables")
    return langid.samples_of(spark.read.parquet(f"{DATA}/lang_samples.parquet"))


def test_held_out_sentences(samples):
    rows = list(samples)
    random.Random(0).shuffle(rows)
    wrong = 0
    for k in range(4):
        p = langid.Profiles(rows[:k] + [x for i, x in enumerate(rows[k:]) if i % 4])
        wrong += sum(p.langs[int(p.distances(t).argmin())] != l for l, t in rows[k::4])
    assert wrong <= len(rows) * 0.02


def test_documents_and_blocks(spark, samples):
    de = "Der Raum ist ein barocker Zentralbau; der Dachreiter wurde erneuert. " * 4
    la = "Virgo sancta adorat altare maius in hac domo et calicem aureum ostendit. "
    rows = [(1, de, "de"), (2, de, "DE"), (3, de + "\n \t\n" + la, "de"), (4, None, "de"), (5, "kurz", None), (6, "", "x"), (None, la, None), (2, de, "DE"), (7, de.upper(), "de"), (8, la + "\r\n\r\n" + de, "la")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {tuple(r) for r in langid.found(df, samples).collect()}
    assert got == {(2, 0, "de"), (3, 2, "la"), (None, 0, "la"), (8, 0, "de"), (8, 1, "la")}
    all_rows = langid.languages(df, samples).collect()
    assert all(r.confidence is None or 0 <= r.confidence <= 1 for r in all_rows)
    assert {r.doc_id for r in all_rows if r.block_no == 0 and r.lang is None} == {4, 5, 6}
    assert langid.found(df.limit(0), samples).count() == 0
    assert langid.found(df, []).count() == 0


def test_many_languages_in_scripts_of_their_own():
    """More n-grams than 16 bits can number; every language is told."""
    letters = lambda k: [chr(0x4E00 + 40 * k + i) for i in range(40)]
    rng = random.Random(1)
    text = lambda k: " ".join("".join(rng.choices(letters(k), k=6)) for _ in range(400))
    samples = [(f"l{k:02d}", text(k)) for k in range(60)]
    p = langid.Profiles(samples)
    assert len(p.number) > 40_000
    assert [p.langs[int(p.distances(text(k)).argmin())] for k in range(60)] == [f"l{k:02d}" for k in range(60)]


def test_counts_of_long_texts_do_not_saturate():
    p = langid.Profiles([("x", "aab aab aac"), ("y", "ccb ccb")])
    assert (p.distances("aab " * 50_000 + "aac " * 40_000) == p.distances("aab " * 5 + "aac " * 4)).all()


def test_samples_are_bounded_by_language(spark):
    rows = [("aa", f"satz {i}") for i in range(50)] + [("zz", f"zeile {i}") for i in range(3)] + [(None, "x"), ("aa", None)]
    got = langid.samples_of(spark.createDataFrame(rows, "lang string, text string"), 10)
    assert sum(l == "aa" for l, _ in got) == 10 and sum(l == "zz" for l, _ in got) == 3
