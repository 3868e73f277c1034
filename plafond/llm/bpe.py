"""Problem 6: exact byte-level BPE ids by dynamic programming over prefixes."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: Entries of a worker's cache of encoded words; a full cache is emptied, which changes no result.
CACHE = 400_000

_SPLIT = regex.compile(r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: A space before something else than white space always begins a new pre-token, so texts fall apart there.
_SPACE_RUN = re.compile(r" (?=\s|\Z)")
_WORD_START = re.compile(r" (?=\S)")


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in the vocabulary file: itself if printable, else a code from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixEncoder:
    """Encodes pre-tokens by the unique last token of each of their prefixes.

    BPE has one encoding per text, and a prefix of an encoding is the encoding of that prefix. So for every
    prefix exactly one vocabulary token can stand last: a token that ends there (found by an automaton over all
    suffix matches), whose remaining prefix is solved already, and which is compatible with that prefix's last
    token. Two tokens are compatible if BPE on their joined bytes leaves them as they are. The ids come out by
    following the last tokens back. Time is linear in the text, times the matches at a place.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = _byte_letters()
        raw = {t: bytes(letters[c] for c in t) for t in model["vocab"] if all(c in letters for c in t)}
        ids = model["vocab"]
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merged[ids[a], ids[b]] = (rank, ids[a + b])
            self.parts[ids[a + b]] = (rank, ids[a], ids[b])
        self.automaton = ahocorasick.Automaton()
        for t, b in raw.items():
            if len(b) == 1 or self._whole(ids[t]):
                self.automaton.add_word(b.decode("latin-1"), (ids[t], len(b)))
        self.automaton.make_automaton()
        self.joined: dict[tuple[int, int], bool] = {}

    @lru_cache(maxsize=None)
    def _whole(self, token: int) -> bool:
        """Whether BPE on a token's own bytes gives the token."""
        if token not in self.parts:
            return True
        rank, a, b = self.parts[token]
        return self._whole(a) and self._whole(b) and self._apart(a, b, rank)

    def _apart(self, a: int, b: int, below: int) -> bool:
        """Whether no merge of rank < ``below`` joins bytes across the border between tokens a and b.

        Walks back through the states of the border: of the two tokens that meet there, the one made last is
        undone, and the tokens then meeting must not have merged before that moment.
        """
        while True:
            m = self.merged.get((a, b))
            if m and m[0] < below:
                return False
            ra = self.parts[a][0] if a in self.parts else -1
            rb = self.parts[b][0] if b in self.parts else -1
            if ra < 0 and rb < 0:
                return True
            # Merges of one rank are made from left to right: at equal ranks the right one was made last.
            if ra > rb:
                # Before a was made, a merge of the same rank was not yet due, except further left.
                below, a = ra, self.parts[a][2]
            else:
                below, b = rb + 1, self.parts[b][1]

    def _compatible(self, a: int, b: int) -> bool:
        key = (a, b)
        ok = self.joined.get(key)
        if ok is None:
            ok = self.joined[key] = self._apart(a, b, 1 << 60)
        return ok

    def encode(self, data: bytes) -> list[int]:
        last: list[tuple[int, int] | None] = [None] * len(data)
        for end, (token, n) in self.automaton.iter(data.decode("latin-1")):
            if last[end] is None:
                rest = end - n
                if rest < 0 or ((before := last[rest]) is not None and self._compatible(before[0], token)):
                    last[end] = (token, n)
        out, at = [], len(data) - 1
        while at >= 0:
            token, n = last[at]
            out.append(token)
            at -= n
        return out[::-1]


class Words(dict):
    """Cache: a word -> the ids of a space and that word, as int32 bytes."""

    def __init__(self, path: str) -> None:
        self.encoder = PrefixEncoder(path)
        self.tokens: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        self.line_end = self.piece("\n")

    def piece(self, piece: str) -> bytes:
        """Ids of a text that begins at a pre-token border."""
        out = []
        for t in _SPLIT.findall(piece):
            ids = self.tokens.get(t)
            if ids is None:
                ids = np.array(self.encoder.encode(t.encode("utf-8", "surrogatepass")), np.int32).tobytes()
                if len(t) < 64:
                    if len(self.tokens) > CACHE:
                        self.tokens.clear()
                    self.tokens[t] = ids
            out.append(ids)
        return b"".join(out)

    def head(self, word: str) -> bytes:
        """Ids of a word without a space before it."""
        ids = self.heads.get(word)
        if ids is None:
            ids = self.piece(word)
            if len(word) < 40:
                if len(self.heads) > CACHE:
                    self.heads.clear()
                self.heads[word] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        # A single line end between two words is a pre-token of its own.
        before, end, after = word.partition("\n")
        if end and before and after and not before[-1].isspace() and not after[0].isspace():
            return self[before] + self.line_end + (self.head(after) if "\n" not in after else self.piece(after))
        ids = self.piece(" " + word)
        if len(word) < 40:
            if len(self) > CACHE:
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    """The tokenizer of this worker process, loaded once."""
    return Words(path)


def encode_bytes(text: str | None, cache: Words) -> bytes:
    """Ids of a text as int32 bytes; none for an empty or null text."""
    if not text:
        return b""
    first, *rest = _WORD_START.split(text) if _SPACE_RUN.search(text) else text.split(" ")
    return cache.piece(first) + b"".join(map(cache.__getitem__, rest))


def encode(df: DataFrame, key: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``key, ids``: the ids of every text under a public byte-level BPE, without special tokens.

    An empty and a null text have the empty list. Strings of special tokens are ordinary text. Repeated rows
    come out as often as they came in; a null key is kept; other columns are ignored. Whole texts of any length
    are encoded, row by row where they lie: no shuffle, and only an Arrow batch of them in memory.
    """
    rows = df.select(key, text)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = words(tokenizer)
        for batch in batches:
            coded = [encode_bytes(t, cache) for t in batch.column(1).to_pylist()]
            ends = np.zeros(len(coded) + 1, np.int64)
            np.cumsum([len(x) // 4 for x in coded], out=ends[1:])
            flat = pa.array(np.frombuffer(b"".join(coded), np.int32))
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[key, "ids"])

    return rows.mapInArrow(run, f"`{key}` {kind}, ids array<int>")
