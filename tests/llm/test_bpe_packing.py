from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plafond.llm import bpe, packing

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def public():
    t = tokenizers.Tokenizer.from_file(bpe.TOKENIZER)
    t.encode_special_tokens = True
    return t


def ids(text):
    return np.frombuffer(bpe.encode_bytes(text, bpe.words(bpe.TOKENIZER)), np.int32).tolist()


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="ab \n\t'st19!ßé", max_size=80))
def test_ids_are_those_of_the_public_tokenizer(public, text):
    assert ids(text) == public.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", " ", "\n\n  x", "a\nb", "<|endoftext|>", "ing" * 700, " " * 300, "x" * 5000, "'ll don't", "a  b \n c "])
def test_ids_of_corner_cases(public, text):
    assert ids(text) == public.encode(text, add_special_tokens=False).ids


def test_encode_frame(spark):
    df = spark.createDataFrame([(1, "Hallo Welt"), (2, ""), (3, None), (None, "x"), (1, "Hallo Welt")], "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    got = bpe.encode(df, "doc_id", "text").collect()
    assert len(got) == 5 and {tuple(r.ids) for r in got if r.doc_id in (2, 3)} == {()} and all(r.ids is not None for r in got)
    assert bpe.encode(df.limit(0), "doc_id", "text").count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=80))
def test_best_fit_keeps_the_capacity(sizes):
    where, fills = packing.best_fit(sizes, 20)
    sums = [0] * len(fills)
    for i, n in enumerate(sizes):
        sums[where[i]] += n
    assert sums == fills and all(f <= 20 for f in fills)
    # No two containers up to half full are left.
    assert sum(f <= 10 for f in fills) <= 1


def test_containers(spark):
    texts = [(i, "wort " * (i * 37 % 400)) for i in range(400)] + [(400, "lang " * 5000), (401, None), (402, ""), (None, "x"), (5, "wort " * 185)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(7)
    got = packing.pack(df, "doc_id", "text").toPandas()
    assert set(got.doc_id.dropna().astype(int)) == set(range(403)) and got.doc_id.isna().sum() == 1
    sums = got.groupby("container").n_tokens.sum()
    assert (sums <= packing.CAPACITY).all() and (got.groupby("container").container_fill.first() == sums).all()
    cut = got[got.part_no > 1]
    assert set(cut.doc_id.astype(int)) == {400}
    big = got[got.doc_id == 400].sort_values("part_no")
    assert (big.n_tokens.iloc[:-1] == packing.CAPACITY).all() and big.token_start.tolist() == [i * packing.CAPACITY for i in range(len(big))]
    # Hardly any room is left over.
    assert len(sums) <= 1.03 * got.n_tokens.sum() / packing.CAPACITY + 1
    assert packing.pack(df.limit(0), "doc_id", "text").count() == 0
