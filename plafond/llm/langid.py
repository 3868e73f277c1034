"""Problem 8: languages of documents and of their blocks by rank-order n-gram profiles."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plafond.llm.canonical import canonical
from plafond.llm.split import blocks

#: Labelled sentences per language that its profile is fitted on at most (chosen by a hash of the text), and the
#: length of a profile.
SAMPLE_ROWS, PROFILE = 5_000, 800
#: n-grams of 1 to LONGEST letters, words padded with a space on either side.
LONGEST = 3
#: Most frequent n-grams of a text that are compared.
COMPARED = 300
#: Blocks with fewer letters have no language.
LEAST_LETTERS = 40
#: A block whose two best distances are closer than this share is judged sentence by sentence.
CLOSE = 0.15

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_MARKUP = re.compile(r"<!--|-->|\[\[(?:File|Datei):[^|\]]*(?:\|thumb)?|\]\]|'''|https?://\S+", re.I)
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_CACHE = 300_000


def ngrams(word: str) -> Iterator[str]:
    padded = f" {word} "
    for n in range(1, LONGEST + 1):
        for i in range(len(padded) - n + 1):
            if (g := padded[i : i + n]) != " ":
                yield g


def _plain_words(text: str) -> list[str]:
    return [w for w in _NOT_LETTERS.split(canonical(text).lower()) if w]


class Profiles(dict):
    """Rank-order profiles of languages; as a dict, a cache: token -> the numbers of its n-grams as int32 bytes.

    Only n-grams of some profile are numbered, in order of overall frequency, so equally frequent n-grams of a
    text rank by that. An n-gram that a language's profile lacks is PROFILE places out.
    """

    def __init__(self, samples: Iterable[tuple[str, str]]) -> None:
        counts: dict[str, Counter] = {}
        for lang, text in samples:
            if lang and text:
                counts.setdefault(lang, Counter()).update(g for w in _plain_words(text) for g in ngrams(w))
        self.langs = sorted(counts)
        ranked = {l: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:PROFILE]] for l, c in counts.items()}
        share = Counter()
        for l, c in counts.items():
            for g in ranked[l]:
                share[g] += c[g] / sum(c.values())
        self.number = {g: i for i, (g, _) in enumerate(sorted(share.items(), key=lambda x: (-x[1], x[0])))}
        self.ranks = np.full((len(self.langs), len(self.number)), PROFILE, np.int32)
        for k, l in enumerate(self.langs):
            for r, g in enumerate(ranked[l]):
                self.ranks[k, self.number[g]] = r

    def __missing__(self, token: str) -> bytes:
        found = [n for w in _plain_words(token) for g in ngrams(w) if (n := self.number.get(g)) is not None]
        ids = np.array(found, np.int32).tobytes()
        if len(token) < 60:
            if len(self) > _CACHE:
                self.clear()
            self[token] = ids
        return ids

    def distances(self, text: str) -> np.ndarray | None:
        """Mean number of places that the text's most frequent n-grams are out, per language; None without any."""
        ids = np.frombuffer(b"".join(map(self.__getitem__, text.lower().split())), np.int32)
        if not len(ids):
            return None
        counts = np.bincount(ids)
        there = np.flatnonzero(counts)
        top = there[np.argsort(-counts[there], kind="stable")[:COMPARED]]
        out = np.abs(self.ranks[:, top] - np.arange(len(top)))
        return out.mean(axis=1)


def letters(text: str) -> int:
    return sum(map(str.isalpha, text))


def _judge(text: str, profiles: Profiles) -> tuple[str, float] | None:
    """Language of most of a block's characters and a confidence from 0 to 1; None if it has no n-grams.

    The confidence is that of the distances: 1 - best / second best, stretched so that a third apart is 1. A
    block whose languages are close is cut into sentences, and the language with most characters wins.
    """
    d = profiles.distances(text)
    if d is None:
        return None
    order = np.argsort(d, kind="stable")
    best = profiles.langs[order[0]]
    if len(order) == 1:
        return best, 1.0
    apart = 1 - d[order[0]] / max(d[order[1]], 1e-9)
    if apart >= CLOSE:
        return best, round(float(min(1.0, 3 * apart)), 4)
    sizes: Counter = Counter()
    for s in _SENTENCE.split(text):
        ds = profiles.distances(s)
        if ds is not None:
            sizes[profiles.langs[int(np.argmin(ds))]] += len(s)
    if sizes:
        best = max(sizes.items(), key=lambda x: (x[1], x[0] == best, x[0]))[0]
    return best, round(float(min(1.0, 3 * apart)), 4)


def languages_of(text: str, profiles: Profiles) -> tuple[tuple[str, float] | None, list[tuple[int, str, float, int]]]:
    """((document language, confidence) or None, [(block_no, language, confidence, characters)]) of a text."""
    found = []
    for no, (a, b) in enumerate(blocks(text), 1):
        block = text[a:b]
        if b - a < LEAST_LETTERS or letters(block) < LEAST_LETTERS:
            continue
        bare = _MARKUP.sub(" ", block) if "[[" in block or "<!--" in block or "'''" in block or "http" in block else block
        judged = _judge(bare, profiles)
        if judged:
            found.append((no, judged[0], judged[1], b - a))
    if not found:
        return None, found
    size: Counter = Counter()
    sure: Counter = Counter()
    for _, lang, conf, n in found:
        size[lang] += n
        sure[lang] += n * conf
    lang = max(size.items(), key=lambda x: (x[1], sure[x[0]], x[0]))[0]
    return (lang, round(sure[lang] / sum(size.values()), 4)), found


def samples_of(rows: DataFrame, most: int = SAMPLE_ROWS) -> list[tuple[str, str]]:
    """At most ``most`` labelled sentences of every language, chosen by a hash of their text.

    The bound holds for each language by itself, so none is lost beside larger ones. Sentences of a language over
    the bound are left out within the partitions first, so no task sees a language whole.
    """
    known = rows.select("lang", "text").where("lang is not null and text is not null").withColumn("h", F.xxhash64("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    return [(r[0], r[1]) for r in known.withColumn("r", rank).where(F.col("r") <= most).select("lang", "text").collect()]


def languages(docs: DataFrame, samples: list[tuple[str, str]], key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """``key, block_no, lang, confidence, label``: block 0 for the document, others for each block with a language.

    A document without a language (null, empty, or no block of enough letters) has one row with block_no 0 and
    null lang and confidence. Repeated rows repeat; a null key or label is kept; other columns are ignored.
    Rows are judged where they lie (no shuffle) and whole, block by block; the profiles are a few hundred kB.
    """
    kinds = {c: docs.schema[c].dataType.simpleString() for c in (key, label)}
    # As text, so that a null among the keys does not turn numbers into floats on the way through pandas.
    rows = docs.select(F.col(key).cast("string").alias("_k"), F.col(text).alias("_t"), F.col(label).alias("_l"))

    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        profiles = Profiles(shared.value)
        for pdf in batches:
            out = []
            for k, t, l in zip(pdf["_k"].tolist(), pdf["_t"].tolist(), pdf["_l"].tolist()):
                doc, parts = languages_of(t, profiles) if t and profiles.langs else (None, [])
                out.append((k, 0, *(doc or (None, None)), l))
                out += [(k, no, lang, conf, l) for no, lang, conf, _ in parts]
            yield pd.DataFrame(out, columns=["_k", "block_no", "lang", "confidence", "label"])

    schema = f"_k string, block_no int, lang string, confidence double, label {kinds[label]}"
    return rows.mapInPandas(run, schema).select(F.col("_k").cast(kinds[key]).alias(key), "block_no", "lang", "confidence", "label")


def found(docs: DataFrame, samples: list[tuple[str, str]]) -> DataFrame:
    """(d, 0, L) where the label of d is not exactly its language L; (d, k, M) for each block of another language."""
    judged = languages(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang"), samples)
    kind = docs.schema["doc_id"].dataType.simpleString()

    # Blocks of one document leave Python in one partition, so the cases are told there, without a shuffle.
    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lang = None
        for pdf in batches:
            out = []
            for k, no, l, label in zip(*(pdf[c].tolist() for c in ("doc_id", "block_no", "lang", "label"))):
                if no == 0:
                    lang = l
                if isinstance(l, str) and l != (label if no == 0 else lang):
                    out.append((k, no, l))
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "block_no", "lang"])

    told = judged.mapInPandas(tell, "doc_id string, block_no int, lang string")
    return told.select(F.col("doc_id").cast(kind).alias("doc_id"), "block_no", "lang").distinct()
