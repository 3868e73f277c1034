"""Problem 1: oversized bodies as ordered, overlapping pieces cut at natural boundaries."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 8_000, 200

_BLANK = re.compile(r"^[ \t\r]*$", re.M)
#: The separator hierarchy, strongest first. Each pattern matches the empty place or white space before which a
#: piece may begin; a cut is made at the match's end.
_SEPARATORS = [
    re.compile(r"\n(?==+[^=\n])"),  # a section begins at its heading line
    re.compile(r"\n(?:[ \t\r]*\n)+"),  # a paragraph begins after blank lines
    re.compile(r"(?<=\w{3}[.!?])[\"'“”»)\]]*\s+|\n"),  # a sentence (not after abbreviations such as St.) or a line
    re.compile(r"\s+"),  # a word
]


def blocks(text: str) -> list[tuple[int, int]]:
    """Spans of the longest runs of lines that are not blank; a block ends before its last line end."""
    out, at, start, end = [], 0, None, 0
    for line in text.split("\n"):
        if line.strip(" \t\r"):
            start, end = (at if start is None else start), at + len(line)
        elif start is not None:
            out.append((start, end))
            start = None
        at += len(line) + 1
    return out + ([(start, end)] if start is not None else [])


def _units(text: str, lo: int, hi: int, limit: int, level: int = 0) -> Iterator[tuple[int, int]]:
    """Consecutive spans of at most ``limit`` characters that make up text[lo:hi]; a span is cut only if it must be."""
    if hi - lo <= limit:
        yield lo, hi
    elif level == len(_SEPARATORS):
        for at in range(lo, hi, limit):
            yield at, min(hi, at + limit)
    else:
        at = lo
        for m in _SEPARATORS[level].finditer(text, lo, hi):
            if at < m.end() < hi:
                yield from _units(text, at, m.end(), limit, level + 1)
                at = m.end()
        yield from _units(text, at, hi, limit, level + 1)


def _overlap_start(text: str, floor: int, end: int) -> int | None:
    """Where in [floor, end) the next piece begins: the first boundary of the strongest kind; None if there is none."""
    for sep in _SEPARATORS:
        m = sep.search(text, max(0, floor - 1), end)
        while m and m.end() < floor:
            m = sep.search(text, m.end(), end)
        if m and m.end() < end:
            return m.end()
    return None


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Spans (start, end) of the pieces of a text: each at most ``limit`` long, together covering every character.

    Units of the separator hierarchy are packed greedily. A piece after the first starts ``overlap`` characters
    before the end of the one before, or later where a boundary in that stretch lets it begin there. A unit that
    would leave no room for that is cut one level lower, so that every border has an overlap.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be from 0 to below the limit")
    out: list[tuple[int, int]] = []
    start = end = 0
    queue = list(_units(text, 0, len(text), limit))[::-1]
    while queue:
        lo, hi = queue.pop()
        if hi - start > limit:
            if hi - max(end - overlap, 0) <= limit:
                begin = _overlap_start(text, end - overlap, end)
                begin = end - overlap if begin is None else begin
            else:
                # Only a part of the overlap fits: enough if a boundary stands there, else the unit is too long.
                begin = _overlap_start(text, hi - limit, end) if hi - limit < end else None
                if begin is None and overlap:
                    queue += list(_units(text, lo, hi, limit - overlap))[::-1]
                    continue
                begin = end if begin is None else begin
            out.append((start, end))
            start = begin
        end = hi
    if end > start or not out:
        out.append((start, end))
    return out


def cut_blocks(text: str, spans: list[tuple[int, int]], limit: int = LIMIT) -> list[int]:
    """Numbers of the blocks that a border between pieces falls into and that exceed the limit by themselves.

    A block beyond the limit can't lie within one piece; a shorter one may be cut too, before a heading or where
    greedy packing ends.
    """
    borders = [b for _, b in spans]
    return [k for k, (a, b) in enumerate(blocks(text), 1) if borders[bisect_right(borders, a)] < b and b - a > limit]


SCHEMA = "piece_no int, piece_start int, piece_end int, piece string, cut_blocks array<int>"


def _cut_rows(rows: DataFrame, limit: int, overlap: int) -> DataFrame:
    """Pieces of the rows (_k, _t) whose text is over the limit; cut_blocks stands on the first."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, t in zip(pdf["_k"].tolist(), pdf["_t"].tolist()):
                spans = pieces(t, limit, overlap)
                inside = cut_blocks(t, spans, limit)
                out += [(k, i, a, b, t[a:b], [] if i > 1 else inside) for i, (a, b) in enumerate(spans, 1)]
            yield pd.DataFrame(out, columns=["_k", "piece_no", "piece_start", "piece_end", "piece", "cut_blocks"])

    return rows.where(F.length("_t") > limit).mapInPandas(cut, f"_k string, {SCHEMA}")


def split_oversized(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of every row: ``key, piece_no, piece_start, piece_end, piece, cut_blocks``.

    piece_no counts from 1; the positions are those of characters in the text. cut_blocks (on the first piece)
    names the blocks that are longer than the limit by themselves and were cut inside. A text within
    the limit is its own only piece, an empty text gives one empty piece, a null text one null piece. Repeated
    rows give repeated pieces. Other columns are ignored, whatever their names.

    Only rows over the limit, found by a JVM filter, reach Python; rows stay where they are (no shuffle).
    """
    # As text, so that a null among the keys does not turn numbers into floats on the way through pandas.
    rows = df.select(F.col(key).cast("string").alias("_k"), F.col(text).alias("_t"))
    kind = df.schema[key].dataType.simpleString()
    over = _cut_rows(rows, limit, overlap)
    none = F.array().cast("array<int>")
    within = rows.where((F.length("_t") <= limit) | F.col("_t").isNull()).select("_k", F.lit(1).alias("piece_no"), F.lit(0).alias("piece_start"), F.length("_t").alias("piece_end"), F.col("_t").alias("piece"), none.alias("cut_blocks"))
    return over.unionByName(within).select(F.col("_k").cast(kind).alias(key), "piece_no", "piece_start", "piece_end", "piece", "cut_blocks")


def found(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(key, 0) for every text that came out in several pieces and (key, k) for every block cut for its own length.

    Read off the pieces; repeated rows give their cases once; a null key is kept.
    """
    kind = df.schema[key].dataType.simpleString()

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, t in zip(pdf["_k"].tolist(), pdf["_t"].tolist()):
                spans = pieces(t, limit, overlap)
                if len(spans) > 1:
                    out += [(k, n) for n in (0, *cut_blocks(t, spans, limit))]
            yield pd.DataFrame(out, columns=["_k", "block_no"])

    rows = df.select(F.col(key).cast("string").alias("_k"), F.col(text).alias("_t")).where(F.length("_t") > limit)
    return rows.mapInPandas(tell, "_k string, block_no int").select(F.col("_k").cast(kind).alias(key), "block_no").distinct()
