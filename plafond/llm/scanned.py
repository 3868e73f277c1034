"""Problem 5: text of scanned pages repaired into continuous paragraphs."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plafond.llm import repeated
from plafond.llm.canonical import canonical
from plafond.llm.repeated import line_key, one_place
from plafond.operators.slices import last_before
from plafond.session import broadcast_if_small, cut

#: Words that are sent to the workers as known, the most frequent of the trusted texts, and pairs of neighbours that are
#: counted there by an automaton. All others go through joins, with the same results; a Bloom filter over all tells
#: which neighbours may be one word, and which pairs may be asked for.
USUAL_WORDS, USUAL_PAIRS = 30_000, 100_000
#: Bits of the Bloom filter per string, and its most bits. Beyond them more strings than needed go through the joins.
BLOOM_BITS, BLOOM_MOST = 12, 1 << 30
#: A word outside the trusted texts is a misreading of a similar word that is so many times as frequent: if the two
#: differ as recognition confuses letters, if a letter is lost, and in any other way.
CONFUSED_TIMES, LOST_TIMES, OTHER_TIMES = 3, 6, 25
#: Share of a word's occurrences that a single misreading of it has at most (of the usual kinds, and of others). A similar word that is more frequent than
#: this share, with three standard deviations and two occurrences to spare, is a word of its own (an old spelling).
MISREAD_SHARE, OTHER_SHARE = 0.004, 0.0005
#: A pair of words is one word with a stray space if the word is so many times as frequent as the pair.
PAIR_TIMES = 20
#: Words outside the trusted texts from this number of occurrences on may be what a misreading stands for.
SEEN_OFTEN = 8
#: Words of the vocabulary for which a shard is made.
SHARD_WORDS = 4_000
#: Words from this length on may be misread in two places, if both are letters that recognition confuses.
LONG_WORD = 9
#: Shorter words are not judged: too many others are one place away.
LEAST_WORD = 3

HYPHENS = "-¬=‐‑­"
_JOINING = {"und", "oder", "sowie", "bzw", "bis", "als", "wie", "noch"}
_WORD = re.compile(r"[^\W\d_]+")
_NUMBER = re.compile(r"\d+(?:er|te|[cdkm]m|kg|ff)")
_OUTER = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()) + "„“”‚‘’»«›‹–—·§°…¬"
_PAGE_NO = re.compile(r"[\s\-–—|\[\]()·.]*(?:S\.\s*)?[0-9lI|OoSBZ]{1,4}[\s\-–—|\[\]()·]*")
_BAND_NOTE = re.compile(r"\(Band [^)]*\)\s*$")

#: Single letters and pairs that recognition takes for each other, in both directions.
CONFUSIONS = [
    "l i", "l t", "l 1", "i 1", "i j", "l !", "t f", "f s", "f t", "c e", "e o", "c o", "o 0", "ö 6", "b h", "b 6", "h n", "n u", "u v", "v y", "a o",
    "g q", "g 9", "q 9", "s 5", "b 8", "z 2", "r n", "k r", "k h", "p r", "n r", "ä a", "ö o", "ü u", "m n", "w v", "x z", "d o", "e 3", "t r", "p f", "ß b",
    "m rn", "d cl", "w vv", "ü ii", "u ii", "h li", "k lc", "n ri", "b lo", "m nn", "m in", "ck dr", "ä ii", "a ci", "ss ß",
]
_CONFUSED = {(a, b) for p in CONFUSIONS for a, b in [p.split(" "), p.split(" ")[::-1]]}


def fold(word: str) -> str:
    return word.casefold()


class Automaton:
    """Vocabulary trie to be intersected with Levenshtein automata.

    A place is one substituted, lost or added character, or one character read as two or two as one where
    recognition confuses them. The automaton of a word has states (letters read, places used); a walk down the
    trie keeps the set of states alive and stops where it is empty, so every candidate is found without
    comparing the word with each entry.
    """

    def __init__(self, words: Iterable[str]) -> None:
        self.root: dict = {}
        for w in words:
            node = self.root
            for ch in w:
                node = node.setdefault(ch, {})
            node[""] = w

    def near(self, word: str, places: int = 1, confused: bool = False) -> list[str]:
        """All other entries that differ from the word in up to ``places`` places; if ``confused``, only in letters
        that recognition takes for each other."""
        n, out = len(word), []
        #: States: (i, used, pending): i letters of the word explained; pending is a letter that the trie owes.
        stack: list[tuple[dict, frozenset]] = [(self.root, frozenset({(0, 0, "")}))]
        while stack:
            node, states = stack.pop()
            if "" in node and node[""] != word and any(not p and (i == n or (not confused and n - i <= places - used)) for i, used, p in states):
                out.append(node[""])
            for ch, child in node.items():
                if not ch:
                    continue
                step = set()
                for i, used, pending in states:
                    if pending:
                        if pending == ch:
                            step.add((i, used, ""))
                        continue
                    if i < n and word[i] == ch:
                        step.add((i + 1, used, ""))
                    if used == places:
                        continue
                    more = used + 1
                    if not confused:
                        step.add((i, more, ""))  # lost from the word
                        # Added characters before a right one, as many as there are places left.
                        step.update((i + k + 1, used + k, "") for k in range(1, places - used + 1) if i + k < n and word[i + k] == ch)
                    if i < n:
                        if not confused or (word[i], ch) in _CONFUSED:
                            step.add((i + 1, more, ""))  # substituted
                        if i + 1 < n and (word[i : i + 2], ch) in _CONFUSED:
                            step.add((i + 2, more, ""))
                        for short, long in _SPLITS.get(word[i], ()):
                            if long[0] == ch:
                                step.add((i + len(short), more, long[1]))
                if step:
                    stack.append((child, frozenset(step)))
        return out


_SPLITS: dict[str, list[tuple[str, str]]] = {}
for _a, _b in _CONFUSED:
    if len(_a) == 1 and len(_b) == 2:
        _SPLITS.setdefault(_a, []).append((_a, _b))


def difference(word: str, entry: str) -> tuple[int, str, str]:
    """Where two words begin to differ, and the different middles of the word and the entry."""
    i = 0
    while i < min(len(word), len(entry)) and word[i] == entry[i]:
        i += 1
    j = 0
    while j < min(len(word), len(entry)) - i and word[-1 - j] == entry[-1 - j]:
        j += 1
    return i, word[i : len(word) - j], entry[i : len(entry) - j]


def times_needed(word: str, entry: str, places: int = 1) -> tuple[float, float]:
    """How many times as frequent an entry must be for the word to be a misreading of it, and the share it may have."""
    if places > 1:
        return OTHER_TIMES, OTHER_SHARE
    _, a, b = difference(word, entry)
    if (a, b) in _CONFUSED or (a and not any(ch.isalpha() for ch in a)):
        return CONFUSED_TIMES, MISREAD_SHARE
    if not a:
        return LOST_TIMES, MISREAD_SHARE
    return OTHER_TIMES, OTHER_SHARE


# --------------------------------------------------------------------------- words of the trusted texts


#: Characters that end a run of neighbouring words.
_MARKS = "\n.,;:!?()[]|„“”\"'»«/="
_RUN = re.compile(f"[{re.escape(_MARKS)}]+")


def _spaced(text: str) -> str:
    """The words of a text with single spaces around them; marks are words of their own, dashes are spaces."""
    out = fold(text).replace("-", " ")
    for m in _MARKS:
        if m in out:
            out = out.replace(m, " \x01 ")
    return f" {' '.join(out.split())} "


def finder(pairs: Iterable[str]) -> Callable[[str], Iterator[str]]:
    """Finds every occurrence of the given pairs of neighbouring words in a text, in one pass over it."""
    automaton = ahocorasick.Automaton()
    for p in pairs:
        automaton.add_word(f" {p} ", p)
    if not len(automaton):
        return lambda text: iter(())
    automaton.make_automaton()
    return lambda text: (p for _, p in automaton.iter(_spaced(text)))


def trusted_texts(articles: DataFrame, lists: DataFrame, glossary: DataFrame, samples: DataFrame) -> DataFrame:
    """t: the texts that did not pass recognition."""
    fields = F.explode(F.array("bauwerk", "autor", "ort", "literaturangabe"))
    parts = [articles.select(F.col("body").alias("t")), lists.select(fields.alias("t")), glossary.select(F.col("word").alias("t")), samples.select(F.col("text").alias("t"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("t is not null")


class Known:
    """A set of strings as the workers know it: the usual ones, and a Bloom filter over all if there are others."""

    def __init__(self, usual: Iterable[str], bits: bytes | None = None) -> None:
        self.usual = set(usual)
        self.bits, self.size = bits, 8 * len(bits or b"")

    def maybe(self, word: str) -> bool:
        """True for every string of the set; false for nearly all others."""
        if word in self.usual:
            return True
        if self.bits is None:
            return False
        h = xxhash.xxh64_intdigest(word.encode(), 42)
        return all(self.bits[at >> 3] >> (at & 7) & 1 for at in (h % self.size, (h >> 32) % self.size, (h ^ h >> 17) % self.size))


def bloom_of(words: DataFrame, n: int) -> bytes:
    """A Bloom filter over the words, made where they lie: each partition sets its bits, block by block of the filter."""
    size = 1 << max(10, min(BLOOM_MOST, BLOOM_BITS * n) - 1).bit_length()
    block = min(size, 1 << 20)

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = set()
            for w in pdf["word"].tolist():
                h = xxhash.xxh64_intdigest(w.encode(), 42)
                at |= {h % size, (h >> 32) % size, (h ^ h >> 17) % size}
            yield pd.DataFrame({"block": [x // block for x in at], "at": [x % block for x in at]})

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(block, np.uint8)
        bits[pdf["at"].to_numpy()] = 1
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    out = bytearray(size // 8)
    rows = words.select("word").mapInPandas(places, "block bigint, at bigint").distinct().groupBy("block").applyInPandas(fill, "block bigint, bits binary")
    for r in rows.collect():
        out[r["block"] * block // 8 : (r["block"] + 1) * block // 8] = r["bits"]
    return bytes(out)


def known_of(words: DataFrame, most: int) -> Known:
    """The ``most`` most frequent strings of (word, n), and a filter over all if there are more."""
    usual = [r[0] for r in words.orderBy(F.desc("n"), "word").limit(most).collect()]
    if len(usual) < most:
        return Known(usual)
    n = words.count()
    return Known(usual, bloom_of(words, n) if n > len(usual) else None)


def _counted(texts: DataFrame, each: Callable[[], Callable[[str], Iterable[str]]], name: str) -> DataFrame:
    """name, n: how often each string comes out of the texts; ``each`` makes the function that takes them from a text.

    Counted within each partition first; a full counter is emitted and begun anew, so memory is bounded.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        taken = each()

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({name: list(counts), "n": list(counts.values())})
            counts.clear()
            return out

        for pdf in batches:
            for t in pdf["t"].tolist():
                counts.update(taken(t))
            if len(counts) > 300_000:
                yield flush()
        if counts:
            yield flush()

    return texts.mapInPandas(run, f"{name} string, n bigint").groupBy(name).agg(F.sum("n").alias("n"))


def _neighbours(text: str) -> Iterator[str]:
    for part in _RUN.split(fold(text)):
        words = part.replace("-", " ").split()
        yield from map(" ".join, zip(words, words[1:]))


def trusted_words(texts: DataFrame) -> DataFrame:
    """word, n of the trusted texts, folded. Words with other characters than plain Latin letters are left out: they
    may be look-alikes."""
    return _counted(texts, lambda: lambda t: _spaced(t).split(), "word").where(F.col("word").rlike(r"\A[a-zäöü]+\z"))


def pair_counts(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """pair, n: how often the pairs asked for (``pair``, distinct) stand side by side in the texts; others give no row."""
    known = texts.sparkSession.sparkContext.broadcast(known_of(asked.select(F.col("pair").alias("word"), F.lit(1).alias("n")), USUAL_PAIRS))

    def each() -> Callable[[str], Iterable[str]]:
        pairs = known.value
        return finder(pairs.usual) if pairs.bits is None else lambda t: filter(pairs.maybe, _neighbours(t))

    counted = _counted(texts, each, "pair")
    # The filter lets others through; the automaton finds nothing else.
    return counted if known.value.bits is None else counted.join(broadcast_if_small(asked), "pair", "left_semi")


# --------------------------------------------------------------------------- lines in reading order


def is_page_number(line: str, printed: set[int] | None = None) -> bool:
    """Whether a line holds nothing but a page number, perhaps misread or with signs around it.

    A number with a full stop may end a sentence; it counts only if it is one of the page's printed numbers.
    """
    s = line.strip()
    if len(s) > 16:
        return False
    if s.endswith("."):
        return s[:-1].isascii() and s[:-1].isdigit() and int(s[:-1][:9]) in (printed or ())
    if not any(ch.isdigit() for ch in s):
        return False
    if s[:1] in "Ss" and len(s) < 12 and one_place(line_key(s), "seite"):
        return True
    return bool(_PAGE_NO.fullmatch(s))


def names_of(title: str) -> set[str]:
    """Keys under which a title may run along its pages: all of it, its place, the place without an addition."""
    bare = _BAND_NOTE.sub("", title).strip()
    place = bare.split(",")[0]
    names = {title, bare, place, re.sub(r"\(.*?\)", "", place)}
    if "," not in bare and _BAND_NOTE.search(title):
        names.add(bare.split(" ")[-1])  # a register or preface is named after its place
    return {k for x in names if len(k := line_key(x)) >= 4}


def is_title(line: str) -> bool:
    return "," in line or bool(_BAND_NOTE.search(line))


def name_ends(names: set[str]) -> tuple[set[str], set[str]]:
    return {k[:2] for k in names}, {k[-2:] for k in names}


def _is_running_title(line: str, names: set[str], ends: tuple[set[str], set[str]]) -> bool:
    s = line.strip()
    if s.endswith((".", ";")) or not names:
        return False
    # One misread place leaves one end of a name whole; most lines are told by the ends of their keys.
    a, z = s[:2], s[-2:]
    if a.isalpha() and z.isalpha() and fold(a)[:2] not in ends[0] and fold(z)[-2:] not in ends[1]:
        return False
    key = line_key(s)
    if key[:2] not in ends[0] and key[-2:] not in ends[1]:
        return False
    return len(key) >= 4 and any(abs(len(key) - len(k)) <= 2 and one_place(key, k) for k in names)


class Page:
    """The regions of one page, their lines in consistent form, and what each line is: text, gone, furniture, blank."""

    def __init__(self, rows: list[tuple], gone: set[tuple[int, int]], carried: set[str], printed: set[int]) -> None:
        self.rows = sorted(rows, key=lambda r: (r[2], r[0]))
        names = set(carried)
        self.title: str | None = None
        self.lines: list[list[str]] = []
        for rid, label, _, lines in self.rows:
            forms = [canonical(x) if x else "" for x in lines]
            self.lines.append(forms)
            if label in ("Section-header", "SectionHeader", "Page-header", "PageHeader"):
                for i, x in enumerate(forms, 1):
                    if (rid, i) not in gone and (label.startswith("Page") or is_title(x)):
                        names |= names_of(x)
                        if not label.startswith("Page"):
                            self.title = x
        self.kinds: list[list[str]] = []
        ends = name_ends(names)
        for (rid, label, _, _), forms in zip(self.rows, self.lines):
            kinds = []
            for i, x in enumerate(forms, 1):
                if not x.strip():
                    kinds.append("blank")
                elif (rid, i) in gone:
                    kinds.append("gone")
                elif label in ("Text", "List-item") and (is_page_number(x, printed) or _is_running_title(x, names, ends)):
                    kinds.append("furniture")
                else:
                    kinds.append("text")
            self.kinds.append(kinds)

    def content(self) -> Iterator[tuple[int, int, int, str]]:
        """(region index, line index, index of the region whose first line may continue it or -1, line)."""
        texts = [k for k, r in enumerate(self.rows) if r[1] == "Text" and "text" in self.kinds[k]]
        for k in range(len(self.rows)):
            later = next((t for t in texts if t > k), -1) if self.rows[k][1] == "Text" else -1
            for i, x in enumerate(self.lines[k]):
                if self.kinds[k][i] == "text":
                    yield k, i, later, x

    def next_line(self, k: int, i: int, later: int) -> tuple[int, int] | None:
        for j in range(i + 1, len(self.lines[k])):
            if self.kinds[k][j] == "text":
                return k, j
        if later >= 0:
            return later, self.kinds[later].index("text")
        return None


def pages_of(regions: pa.Table, other: pa.Table) -> Iterator[Page]:
    """The pages of one chunk of a volume; ``other`` has its boilerplate lines and the title carried into it."""
    gone = set(zip(other["region_id"].to_pylist(), other["line_no"].to_pylist()))
    carried: set[str] = set()
    for t in other["title"].to_pylist():
        if t is not None:
            carried |= names_of(canonical(t))
    pages: dict[int, list[tuple]] = {}
    for rid, page, label, pos, lines in zip(*(regions[c].to_pylist() for c in ("region_id", "page", "label", "pos", "lines"))):
        if lines:
            pages.setdefault(page, []).append((rid, label, pos, lines))
    # Printed numbers run along with the pages: what footers of this chunk agree on tells those of every page.
    shifts = Counter(int(x) - 2 * page for page, rows in pages.items() for r in {r[0]: r for r in rows}.values() if r[1] in ("Page-footer", "PageFooter") for x in map(str.strip, filter(None, r[3])) if x.isascii() and x.isdigit() and len(x) < 6)
    agreed = [s for s, n in shifts.items() if n >= 2]
    for page in sorted(pages):
        rows = {r[0]: r for r in pages[page]}
        p = Page(list(rows.values()), gone, carried, {2 * page + s for s in agreed})
        if p.title:
            carried = names_of(p.title)
        yield p


SITE_COLUMNS = ["volume", "chunk", "role", "region_id", "line_no", "region2", "line2", "cut", "a", "b", "ab", "pair", "left", "right"]
SITE_TYPES = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.string()] * 6]
SITE_SCHEMA = "volume string, chunk int, role string, region_id bigint, line_no int, region2 bigint, line2 int, cut int, a string, b string, ab string, pair string, left string, right string"


def _clean(token: str) -> tuple[str, bool, bool]:
    """(folded core, no punctuation before it, none behind it) of a token."""
    left = token.lstrip(_OUTER)
    core = left.rstrip(_OUTER)
    return fold(core), len(left) == len(token), len(core) == len(left)


def _too_short(core: str) -> bool:
    """Whether a word is too short to be judged. Digits and signs that may stand for letters count; a word has two
    letters at least, and a number with a short ending is none."""
    return len(core) < LEAST_WORD or sum(map(len, _WORD.findall(core))) < 2 or bool(_NUMBER.fullmatch(core))


class Reader:
    """Turns pages into cases that are certain and sites that need a look at the vocabulary."""

    def __init__(self, known: Known) -> None:
        self.known = known
        self.memo: dict[str, tuple[str, bool, bool, bool]] = {}

    def token(self, token: str) -> tuple[str, bool, bool, bool]:
        """(core, clean before, clean behind, needs no look)."""
        got = self.memo.get(token)
        if got is None:
            if len(self.memo) > 300_000:
                self.memo.clear()
            usual = self.known.usual
            core, before, behind = _clean(token)
            fine = core in usual or _too_short(core)
            if not fine and "-" in core:
                fine = all(w in usual or len(w) < LEAST_WORD for w in core.split("-"))
            got = self.memo[token] = (core, before, behind, fine)
        return got

    def read(self, page: Page) -> Iterator[tuple]:
        maybe = self.known.maybe if self.known.bits else self.known.usual.__contains__
        memo = self.memo
        for k, kinds in enumerate(page.kinds):
            for i, kind in enumerate(kinds):
                if kind == "furniture":
                    yield ("furniture", page.rows[k][0], i + 1, None, None, None, None, None, None, None, None, None)
        starts: dict[tuple[int, int], bool] = {}  # lines whose first word began on the line before
        opens: dict[tuple[int, int], bool] = {}  # lines whose first word is judged with the line before
        for k, i, later, line in page.content():
            rid, no = page.rows[k][0], i + 1
            tokens = line.split()
            first = 1 if (k, i) in starts or (k, i) in opens else 0
            last = len(tokens)
            at = page.next_line(k, i, later)
            following = page.lines[at[0]][at[1]].split() if at else []
            end = tokens[-1]
            if following and len(end) > 1 and end[-1] in HYPHENS and end[-2].isalpha():
                stem, nxt = end.rstrip(HYPHENS), following[0]
                core, _, _ = _clean(nxt)
                head = _WORD.match(core)
                if head and nxt[0].isalpha():
                    ab = _clean(stem + nxt)[0]
                    sure = end[-1] not in "-‐‑" or (nxt[0].islower() and core not in _JOINING) or (stem.isupper() and nxt[:2].isupper() and len(stem) > 1 and len(nxt) > 1)
                    if sure or core in _JOINING:
                        last -= 1 if sure else 0
                        if len(tokens) == 1 and first:
                            first = 0 if not sure else 1
                        yield ("hyphen" if sure else "joining", rid, no, page.rows[at[0]][0], at[1] + 1, len(fold(stem.lstrip(_OUTER))), None, None, ab if not sure or not self.token(stem + nxt)[3] else None, None, None, None)
                        if sure:
                            starts[at] = True
            elif following and end[-1].isalpha() and following[0][0].islower() and last - first > 0:
                a, _, _, fine_a = self.token(end)
                b, _, _, fine_b = self.token(following[0])
                ab = a + b
                if not (fine_a and fine_b) or maybe(ab):
                    last -= 1
                    opens[at] = True
                    yield ("open", rid, no, page.rows[at[0]][0], at[1] + 1, len(a), a, b, ab, f"{a} {b}", None, None)
            info = [memo.get(t) or self.token(t) for t in tokens]
            for j in range(first, last):
                core, _, _, fine = info[j]
                if not fine:
                    yield ("word", rid, no, None, None, None, core, None, None, None, info[j - 1][0] if j else None, info[j + 1][0] if j + 1 < len(info) else None)
            a, _, behind, fine_a = info[0]
            for b, before, next_behind, fine_b in info[1:]:
                if behind and before and a and b:
                    ab = a + b
                    if maybe(ab) or (not (fine_a and fine_b) and ab.isalpha()):
                        yield ("pair", rid, no, None, None, None, a, b, ab, f"{a} {b}", None, None)
                a, behind, fine_a = b, next_behind, fine_b


def chunk_inputs(regions: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of the grouping by (volume, chunk): the regions, and boilerplate lines with carried titles."""
    rows = regions.select(F.col("band_prefix").alias("volume"), "chunk", "page", "region_id", "label", F.coalesce("reading_pos", F.lit(0)).alias("pos"), "lines").where("volume is not null and chunk is not null and page is not null and region_id is not null")
    titles = rows.where(F.col("label").isin("Section-header", "SectionHeader")).select("volume", "chunk", "page", "pos", F.explode("lines").alias("t")).where(F.col("t").contains(",") | F.col("t").rlike(r"\(Band [^)]*\)\s*\z"))
    last = titles.groupBy("volume", "chunk").agg(F.max(F.struct("page", "pos", "t")).alias("m")).select("volume", "chunk", F.col("m.t").alias("t"))
    chunks = rows.select("volume", "chunk").distinct().join(last, ["volume", "chunk"], "left")
    carried = last_before(chunks, ["volume"], "chunk", "t").select("volume", "chunk", F.col("_before").alias("title")).where("title is not null")
    nothing = [F.lit(None).cast("bigint").alias("region_id"), F.lit(None).cast("int").alias("line_no")]
    other = gone.select("volume", "chunk", "region_id", "line_no", F.lit(None).cast("string").alias("title")).unionByName(carried.select("volume", "chunk", *nothing, "title"))
    return rows.where(F.size("lines") > 0), other


def sites(regions: DataFrame, gone: DataFrame, known: Broadcast) -> DataFrame:
    """Cases and sites of all pages. One shuffle by (volume, chunk); a group is at most one chunk of pages."""
    rows, other = chunk_inputs(regions, gone)

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in SITE_TYPES], names=SITE_COLUMNS)
        reader = _reader(known.value)
        out = [s for p in pages_of(left, right) for s in reader.read(p)]
        columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(SITE_TYPES[2:]), SITE_TYPES[2:])]
        key = [pa.array([left[c][0].as_py()] * len(out), t) for c, t in zip(SITE_COLUMNS[:2], SITE_TYPES[:2])]
        return pa.table(key + columns, names=SITE_COLUMNS)

    return rows.groupBy("volume", "chunk").cogroup(other.groupBy("volume", "chunk")).applyInArrow(read, SITE_SCHEMA)


_READERS: dict[int, Reader] = {}


def _reader(known: Known) -> Reader:
    """One reader per worker and vocabulary, so that its memory of tokens lives on from group to group."""
    if id(known) not in _READERS:
        _READERS.clear()
        _READERS[id(known)] = Reader(known)
    return _READERS[id(known)]


# --------------------------------------------------------------------------- judging words


def _ends(word: str, asked: bool, places: int = 1) -> list[str]:
    """Shards of a word: its length with one of its ends, or with its middle for two places.

    A place takes up to two letters on either side and makes up to one letter of difference in length. One place
    leaves one end of (length - 1) // 2 letters of the entry whole. Two leave whole an end of a third, or what lies
    between them, a letter apart. A word asks for entries of every length that it may stand for.
    """
    out: set[str] = set()
    for size in range(max(LEAST_WORD, len(word) - places), len(word) + places + 1) if asked else [len(word)]:
        k = (size - 1) // 2 if places == 1 else size // 3
        out |= {f"a{size} {word[:k]}", f"z{size} {word[-k:]}"}
        if places > 1:
            out |= {f"m{size} {word[k + 1 + d : size - k - 1 + d]}" for d in ((-1, 0, 1) if asked else (0,))}
    return sorted(out)


def candidates(unknown: DataFrame, known: DataFrame, places: int = 1, shards: int = 96) -> DataFrame:
    """word, entry, score: the words (word, n) that are misreadings, and the known words (word, n) they may stand for.

    Both sides are dealt out by length and ends of the words; each shard of the vocabulary becomes a trie that is
    intersected with the Levenshtein automata of the shard's unknown words. Shards hold different words, not
    occurrences; the ends grow with the words, so frequent endings are many shards. The score is an entry's
    frequency by the required one.
    """

    def dealt(asked: bool):
        return F.pandas_udf(lambda s: s.map(lambda w: sorted({zlib.crc32(e.encode()) % shards for e in _ends(w, asked, places)})), "array<int>")

    ask = unknown.select("word", "n", F.explode(dealt(True)("word")).alias("shard"))
    have = known.select("word", "n", F.explode(dealt(False)("word")).alias("shard"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            count = dict(zip(right["word"].tolist(), right["n"].tolist()))
            trie = Automaton(count)
            for w, n in zip(left["word"].tolist(), left["n"].tolist()):
                for e in trie.near(w, places, places > 1):
                    times, share = times_needed(w, e, places)
                    score, most = count[e] / (n * times), share * count[e]
                    if score >= 1 and n <= most + 3 * most**0.5 + 2:
                        out.append((w, e, score))
        return pd.DataFrame(out, columns=["word", "entry", "score"])

    met = ask.groupBy("shard").cogroup(have.groupBy("shard")).applyInPandas(meet, "word string, entry string, score double")
    return met.distinct()


def _parts_known(words: DataFrame, known: DataFrame) -> DataFrame:
    """Words with hyphens or slashes inside whose every part is known (or short). Two letters, a full stop and two
    letters are no abbreviation."""
    parts = words.where(F.col("word").rlike(r"[-/.–]") & ~F.col("word").rlike(r"\A\p{L}{2}\.\p{L}{2}\z")).select("word", F.explode(F.split("word", r"[-/.–]+")).alias("part"))
    hit = parts.join(known.select(F.col("word").alias("part"), F.lit(True).alias("k")), "part", "left")
    return hit.groupBy("word").agg(F.min(F.coalesce("k", F.length("part") < LEAST_WORD)).alias("all")).where("all").select("word")


def judged_words(found: DataFrame, single: DataFrame) -> DataFrame:
    """word, n_known, entry, others for every word that a site asks about: its frequency if known, or what it is most
    likely a misreading of (by score, ties by the alphabet), with all candidates."""
    nothing = [F.lit(None).cast("string").alias("entry"), F.lit(None).cast("array<struct<score:double,entry:string>>").alias("others")]
    asked = found.select("role", F.explode(F.array(*[F.struct(F.col(c).alias("word"), F.lit(c).alias("part")) for c in ("a", "b", "ab")])).alias("x")).select("role", "x.*").where("word is not null")
    # A joined word counts as an occurrence only where the text itself has it, broken by a hyphen.
    occurs = F.when((F.col("part") == "ab") & (F.col("role") != "hyphen"), 0).when(F.col("role") == "pair", 0).otherwise(1)
    seen = cut(asked.groupBy("word").agg(F.sum(occurs).alias("seen")).join(single, "word", "left"))
    known = seen.where("n is not null").select("word", F.col("n").alias("n_known"), *nothing)
    unknown = cut(seen.where("n is null and seen > 0").select("word", F.col("seen").alias("n")))
    whole = _parts_known(unknown, single)
    unknown = cut(unknown.join(whole, "word", "left_anti"))
    often = unknown.where((F.col("n") >= SEEN_OFTEN) & F.col("word").rlike(r"\A[a-zäöü]+\z"))
    may_be = cut(single.where(F.length("word") >= LEAST_WORD).unionByName(often))
    shards = 96 + may_be.count() // SHARD_WORDS
    once = cut(candidates(unknown.where(F.length("word") >= LEAST_WORD), may_be, 1, shards))
    left = unknown.where(F.length("word") >= LONG_WORD).join(once.select("word"), "word", "left_anti")
    twice = candidates(left, may_be.where(F.length("word") >= LONG_WORD - 2), 2, shards)
    best = cut(once.unionByName(twice).groupBy("word").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("score"), "entry"))).alias("others")))
    bad = best.select("word", F.lit(None).cast("bigint").alias("n_known"), F.col("others")[0]["entry"].alias("entry"), F.col("others").cast("array<struct<score:double,entry:string>>").alias("others"))
    # Words that only the regions have, often enough and no misreading, are known too.
    own = often.join(bad.select("word"), "word", "left_anti").select("word", F.col("n").cast("bigint").alias("n_known"), *nothing)
    return known.unionByName(bad).unionByName(own)


def pairs_asked(found: DataFrame, judged: DataFrame) -> DataFrame:
    """pair: the distinct pairs of neighbours that together are a known word."""
    two = found.where("pair is not null").select("pair", "ab").distinct()
    known = judged.where("n_known is not null").select(F.col("word").alias("ab"))
    return two.join(broadcast_if_small(known), "ab", "left_semi").select("pair")


def cases(found: DataFrame, judged: DataFrame, pairs: DataFrame) -> DataFrame:
    """volume, chunk, region_id, line_no, kind, wrong, entry: every case, with what is wrong and what should stand there.

    The sites are read once and looked up by each of their texts; a site without a text gets a key of its own, so
    that nulls do not meet in one task.
    """
    words = broadcast_if_small(judged.select("word", "n_known", "entry"))
    two = broadcast_if_small(pairs.select(F.col("pair").alias("word"), F.col("n").alias("n_known"), F.lit(None).cast("string").alias("entry")))
    rows = found
    for c, table in (("a", words), ("b", words), ("ab", words), ("pair", two)):
        key = F.coalesce(F.col(c), F.concat(F.lit("\0"), F.col("region_id").cast("string"), F.lit(" "), F.col("line_no").cast("string")))
        rows = rows.join(table.alias("known"), key == F.col("known.word"), "left").select(*rows.columns, F.col("known.n_known").alias(f"{c}_n"), F.col("known.entry").alias(f"{c}_e"))
    at, none = F.struct("region_id", "line_no"), F.lit(None).cast("string")
    behind = F.struct(F.col("region2").alias("region_id"), F.col("line2").alias("line_no"))
    role = lambda *names: F.col("role").isin(*names)

    def case(when: Column, kind: str, wrong: Column = none, entry: Column = none, where: Column = at) -> Column:
        return F.when(when, F.struct(where["region_id"].alias("region_id"), where["line_no"].alias("line_no"), F.lit(kind).alias("kind"), wrong.alias("wrong"), entry.alias("entry")))

    joined = F.coalesce(F.col("ab_n").isNotNull() & (F.coalesce("pair_n", F.lit(0)) * PAIR_TIMES <= F.col("ab_n")), F.lit(False))
    apart = role("open") & ~joined
    # Where a broken word and its entry begin to differ tells whose line the misreading is in.
    same = F.size(F.filter(F.sequence(F.lit(1), F.least(F.length("ab"), F.length("ab_e"))), lambda i: F.substr(F.col("ab"), F.lit(1), i) == F.substr(F.col("ab_e"), F.lit(1), i)))
    wrong = role("hyphen") & F.col("ab_e").isNotNull()
    here = F.when(wrong, same < F.col("cut"))
    all_cases = F.array(
        case(role("furniture"), "furniture"),
        case(role("hyphen") | (role("joining") & F.col("ab_n").isNotNull()) | (role("open") & joined), "hyphen"),
        case((role("word") | apart) & F.col("a_e").isNotNull(), "misread", F.col("a"), F.col("a_e")),
        case(apart & F.col("b_e").isNotNull(), "misread", F.col("b"), F.col("b_e"), behind),
        case(role("pair") & joined, "misread", F.col("pair"), F.col("ab")),
        case(wrong & here, "misread", F.col("ab"), F.col("ab_e")),
        case(wrong & ~here, "misread", F.col("ab"), F.col("ab_e"), behind),
    )
    return rows.select("volume", "chunk", F.explode(F.filter(all_cases, lambda x: x.isNotNull())).alias("x")).select("volume", "chunk", "x.*")


class Scan(NamedTuple):
    """What is known of the regions; every frame is written once."""

    gone: DataFrame
    sites: DataFrame
    judged: DataFrame
    #: pair, n of the pairs asked for by the sites and, for the repair, by the contexts
    pairs: DataFrame
    contexts: DataFrame | None


def scan(regions: DataFrame, articles: DataFrame, lists: DataFrame, glossary: DataFrame, samples: DataFrame, context: bool = False) -> Scan:
    """Boilerplate lines, sites, judged words and counts of pairs; with ``context`` also what stands beside words with
    several candidates.

    Null and empty lines, regions without lines and repeated deliveries do no harm; regions without a volume,
    chunk, page or id are left out; null labels are no Text; an empty table gives no rows. Boilerplate (problem 4)
    is left out before anything else.
    """
    gone = cut(repeated.boilerplate(regions).gone.select("volume", "chunk", "region_id", "line_no"))
    texts = trusted_texts(articles, lists, glossary, samples.where("lang = 'de'"))
    single = cut(trusted_words(texts))
    known = regions.sparkSession.sparkContext.broadcast(known_of(single, USUAL_WORDS))
    met = cut(sites(regions, gone, known))
    judged = cut(judged_words(met, single))
    asked = pairs_asked(met, judged)
    contexts = cut(contexts_of(met, judged)) if context else None
    if contexts is not None:
        asked = asked.unionByName(contexts.where(F.col("pair").contains(" ")).select("pair")).distinct()
    return Scan(gone, met, judged, cut(pair_counts(texts, cut(asked))), contexts)


def scan_cases(regions: DataFrame, articles: DataFrame, lists: DataFrame, glossary: DataFrame, samples: DataFrame) -> DataFrame:
    """Every hyphen, misread word and piece of furniture of the regions: region_id, line_no, kind, wrong, entry."""
    told = scan(regions, articles, lists, glossary, samples)
    return cases(told.sites, told.judged, told.pairs).drop("volume", "chunk")


def found(regions: DataFrame, articles: DataFrame, lists: DataFrame, glossary: DataFrame, samples: DataFrame) -> DataFrame:
    return scan_cases(regions, articles, lists, glossary, samples).select("region_id", "line_no", "kind").distinct()


# --------------------------------------------------------------------------- repair


def contexts_of(met: DataFrame, judged: DataFrame) -> DataFrame:
    """region_id, line_no, a, score, entry, pair: each candidate of a misread word that has several, with the word before
    and the word behind it; without such a neighbour ``pair`` is the candidate alone."""
    several = judged.where(F.size("others") > 1).select(F.col("word").alias("a"), "others")
    asked = met.where("role = 'word'").join(broadcast_if_small(several), "a").select("region_id", "line_no", "a", "left", "right", F.explode("others").alias("o"))
    beside = F.array(F.concat_ws(" ", "left", "o.entry"), F.concat_ws(" ", "o.entry", "right"))
    return asked.select("region_id", "line_no", "a", "o.score", "o.entry", F.explode(beside).alias("pair"))


def in_context(contexts: DataFrame, pairs: DataFrame) -> DataFrame:
    """region_id, line_no, wrong, entry: for single misread words with several candidates, the one that stands most
    often beside the same neighbours in the trusted texts; equal counts go by the score."""
    seen = contexts.join(broadcast_if_small(pairs), "pair", "left").groupBy("region_id", "line_no", "a", "entry", "score").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    return seen.groupBy("region_id", "line_no", F.col("a").alias("wrong")).agg(F.min(F.struct((-F.col("n")).alias("n"), "score", "entry")).alias("m")).select("region_id", "line_no", "wrong", F.col("m.entry").alias("entry"))


def mended(token: str, wrong: str, entry: str) -> str:
    """A token with the misread place put right; its case, punctuation and all other letters stay."""
    left = len(token) - len(token.lstrip(_OUTER))
    i, a, b = difference(wrong, entry)
    at = [k for k, ch in enumerate(token) if k >= left for _ in fold(ch)]  # folding may lengthen letters
    if i + len(a) > len(at):
        return token
    start = at[i] if i < len(at) else len(token.rstrip(_OUTER))
    end = at[i + len(a) - 1] + 1 if a else start
    new = b.upper() if token[start : start + 1].isupper() and (not a or token.isupper()) or (token.isupper() and len(token) > 1) else b.capitalize() if token[start : start + 1].isupper() else b
    if i == 0 and token[:1].isdigit() and len(token) > 1 and token[1].islower():
        new = b
    return token[:start] + new + token[end:]


def mend_paragraph(text: str, fixes: list[tuple[str, str]]) -> str:
    """A paragraph with all its misread words put right: first words with a stray space, then single words."""
    if not fixes:
        return text
    tokens = text.split(" ")
    cores = [_clean(t)[0] for t in tokens]
    pairs = {w for w, _ in fixes if " " in w}
    single = {w: e for w, e in fixes if " " not in w}
    out: list[str] = []
    k = 0
    while k < len(tokens):
        if k + 1 < len(tokens) and f"{cores[k]} {cores[k + 1]}" in pairs:
            out.append(tokens[k] + tokens[k + 1])
            k += 2
            continue
        out.append(mended(tokens[k], cores[k], single[cores[k]]) if cores[k] in single else tokens[k])
        k += 1
    return " ".join(out)


def paragraphs(regions: DataFrame, articles: DataFrame, lists: DataFrame, glossary: DataFrame, samples: DataFrame) -> DataFrame:
    """region_id, band_prefix, chunk, page, label, regions, text: the repaired paragraphs of all regions with text.

    Lines in consistent form (problem 3), without boilerplate (problem 4) and furniture, broken words joined,
    misread ones put right, lines reflowed with single spaces. A paragraph whose last word goes on in the next
    Text region takes that region in; ``regions`` names all of them. Regions left without text give no row.
    """
    told = scan(regions, articles, lists, glossary, samples, context=True)
    chosen = cut(in_context(told.contexts, told.pairs).withColumnRenamed("entry", "better"))
    fixed = cases(told.sites, told.judged, told.pairs).join(broadcast_if_small(chosen), ["region_id", "line_no", "wrong"], "left").withColumn("entry", F.coalesce("better", "entry"))
    right = fixed.select("volume", "chunk", "region_id", "line_no", "kind", "wrong", "entry")
    none = F.lit(None).cast("string")
    gone = told.gone.select("volume", "chunk", "region_id", "line_no", F.lit("gone").alias("kind"), none.alias("wrong"), none.alias("entry"))
    left, _ = chunk_inputs(regions, told.gone)

    def write(pages: pa.Table, fixes: pa.Table) -> pa.Table:
        drop: set[tuple[int, int]] = set()
        broken: set[tuple[int, int]] = set()
        wrong: dict[int, list[tuple[str, str]]] = {}
        for rid, no, kind, w, e in zip(*(fixes[c].to_pylist() for c in ("region_id", "line_no", "kind", "wrong", "entry"))):
            if kind in ("gone", "furniture"):
                drop.add((rid, no))
            elif kind == "hyphen":
                broken.add((rid, no))
            elif w is not None and e is not None:
                wrong.setdefault(rid, []).append((w, e))
        out = []
        by_page: dict[int, dict[int, tuple]] = {}
        for rid, page, label, pos, lines in zip(*(pages[c].to_pylist() for c in ("region_id", "page", "label", "pos", "lines"))):
            by_page.setdefault(page, {})[rid] = (pos, rid, label, lines)
        for page, rows in by_page.items():
            going_on: list | None = None
            for _, rid, label, lines in sorted(rows.values(), key=lambda r: (r[0], r[1])):
                said, cut_off = "", False
                for no, x in enumerate(lines, 1):
                    if (rid, no) in drop or not x or not x.strip():
                        continue
                    form = " ".join(canonical(x).split())
                    cut_off = (rid, no) in broken
                    said += form.rstrip(HYPHENS) if cut_off else form + " "
                if not said.strip():
                    continue
                if going_on is not None and label == "Text":
                    going_on[5].append(rid)
                    going_on[6] += said
                    row = going_on
                else:
                    row = [rid, pages["volume"][0].as_py(), pages["chunk"][0].as_py(), page, label, [rid], said]
                    out.append(row)
                if label == "Text":
                    going_on = row if cut_off else None
        for row in out:
            row[6] = mend_paragraph(row[6].strip(), [f for rid in row[5] for f in wrong.get(rid, [])])
        types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.string()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(types), types)], names=["region_id", "band_prefix", "chunk", "page", "label", "regions", "text"])

    schema = "region_id bigint, band_prefix string, chunk int, page int, label string, regions array<bigint>, text string"
    notes = right.unionByName(gone)
    notes = notes.toDF(*notes.columns)  # columns of its own: both sides come from the regions
    return left.groupBy("volume", "chunk").cogroup(notes.groupBy("volume", "chunk")).applyInArrow(write, schema)
