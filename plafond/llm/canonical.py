"""Problem 3: text that looks the same brought to one consistent form."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plafond.session import broadcast_if_small, cut

#: Words of a vocabulary up to which it is sent to the workers as one trie. A larger one is dealt out in shards with a
#: trie each, which gives the same spellings.
VOCAB_ROWS = 200_000
#: Words of a vocabulary for which one salt is spent on each kind of ends, so that the largest shard stays bounded.
SALTED = 2_000_000

#: Letters of other scripts and the Latin letters that they look like.
LOOK_ALIKES = dict(
    zip(
        "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορυχϲϳАВЕЅІЈКМНОРСТУХаеѕіјорсухԁһԛԝ",
        "ABEZHIKMNOPTYXaiKvopuxcjABESIJKMHOPCTYXaesijopcyxdhqw",
        strict=True,
    )
) | {"Ӏ": "I", "ӏ": "l", "κ": "k", "τ": "t", "ѵ": "v", "Ԛ": "Q", "Ԝ": "W", "к": "k", "т": "t", "м": "m", "н": "h", "в": "b"}

#: Other Latin letters that they may stand for as well, where the vocabulary has such a word.
ALSO_LIKE = {"υ": "v", "у": "v", "Ι": "l", "І": "l", "Ӏ": "l", "ӏ": "I", "β": "ß"}
#: Weights of the automaton: the look-alike of the table, one of the others, and any Latin letter for a letter of
#: another script that resembles none.
LIKE, ALSO, UNLIKE = 0, 1, 2

#: Characters that are always in their consistent form, as the inside of a character class for Python and Java:
#: ASCII, Latin letters in one piece, dashes, quotation marks and a few signs of the German typewriter.
PLAIN = r"\x20-\x7e\t\r¬§°±·«»¡¿¢£¥©®¶×÷À-ÖØ-öø-ÿĀ-ıĴ-ľŁ-ňŊ-ž‐‒-‟‹›†‡€"
_ODD = re.compile(f"[^{PLAIN}]")
_SPACES = re.compile(r"[\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _ignorable(ch: str) -> bool:
    return unicodedata.category(ch) == "Cf" or ch in "\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0" or "\ufe00" <= ch <= "\ufe0f"


@lru_cache(maxsize=4096)
def _script(ch: str) -> str:
    if not unicodedata.category(ch).startswith("L"):
        return ""
    return unicodedata.name(ch, "?").split(" ")[0]


@lru_cache(maxsize=4096)
def _table(unit: str) -> str:
    """NFKC of a base character with its marks, without ignorables; dashes and quotation marks stay."""
    kept = "".join(ch for ch in unit if not _ignorable(ch))
    return kept if kept and unicodedata.category(kept[0]) in ("Pd", "Pi", "Pf", "Ps", "Pe") and kept[0] not in "（）［］｛｝" else unicodedata.normalize("NFKC", kept)


def _units(text: str) -> list[str]:
    """A text cut before every character that is neither a combining mark nor an ignorable."""
    out: list[str] = []
    for ch in text:
        if out and (unicodedata.combining(ch) or unicodedata.category(ch) == "Mn" or _ignorable(ch)):
            out[-1] += ch
        else:
            out.append(ch)
    return out


@lru_cache(maxsize=4096)
def _ways(unit: str) -> tuple[dict[str, int], bool]:
    """Forms that a unit may be read as, with their weights, and whether it is a letter that resembles none."""
    plain = _table(unit)
    if not plain:
        return {"": LIKE}, False
    parts = _units(unicodedata.normalize("NFD", plain))
    like = "".join(unicodedata.normalize("NFC", LOOK_ALIKES.get(p[0], p[0]) + p[1:]) for p in parts)
    ways = {like: LIKE}
    if len(parts) == 1:
        for ch in ALSO_LIKE.get(parts[0][0], ""):
            ways.setdefault(unicodedata.normalize("NFC", ch + parts[0][1:]), ALSO)
    foreign = any(_script(ch) not in ("", "LATIN") for ch in like)
    return ways, foreign and len(parts) == 1 and len(ways) == 1


def _forms(word: str) -> set[str]:
    return {word, word[:1].upper() + word[1:], word.upper()}


class Trie:
    """A vocabulary trie, traversed by a weighted edit automaton.

    Free are: reading a character as the look-alike of the table, skipping an ignorable, reading a compatibility
    form (full width, ligature, base and combining mark) as its consistent form. Another resemblance costs ALSO, a
    letter of another script that resembles nothing may be any letter for UNLIKE. Substituting, inserting or
    deleting any other character costs ``edit``.
    """

    def __init__(self, words: Iterable[str]) -> None:
        self.root: dict = {}
        for w in sorted(set(words)):
            for form in _forms(w):
                node = self.root
                for ch in form:
                    node = node.setdefault(ch, {})
                node[""] = form

    def ends(self, units: list[str], budget: int = 0, edit: int = 1) -> list[tuple[int, str]]:
        """(weight, spelling) of every word of the vocabulary within the budget, the cheapest first."""
        states: list[tuple[int, dict]] = [(0, self.root)]
        for unit in units:
            ways, unlike = _ways(unit)
            step: dict[int, tuple[int, dict]] = {}

            def reach(cost: int, node: dict) -> None:
                if cost <= budget and (id(node) not in step or step[id(node)][0] > cost):
                    step[id(node)] = (cost, node)

            def along(cost: int, node: dict) -> None:
                for way, weight in ways.items():
                    at: dict | None = node
                    for ch in way:
                        at = at.get(ch)
                        if at is None:
                            break
                    else:
                        reach(cost + weight, at)

            for cost, node in states:
                along(cost, node)
                price = UNLIKE if unlike else edit
                if cost + price <= budget:
                    for ch, child in node.items():
                        if ch:
                            reach(cost + price, child)
                if cost + edit <= budget:
                    reach(cost + edit, node)
                    for ch, child in node.items():
                        if ch:
                            along(cost + edit, child)
            states = list(step.values())
            if not states:
                return []
        return sorted((cost, node[""]) for cost, node in states if "" in node)

    def match(self, units: list[str], budget: int = 0, edit: int = 1) -> str | None:
        """The cheapest spelling within the budget; the first in the alphabet of equally cheap ones."""
        ends = self.ends(units, budget, edit)
        return ends[0][1] if ends else None

    def spelling(self, units: list[str]) -> str | None:
        """The spelling of a word with letters of two scripts; its Latin letters stay as they are."""
        return chosen(self.ends(units, *_prices(units)))


class Told(dict):
    """Spellings looked up before: raw word -> spelling."""

    def spelling(self, units: list[str]) -> str | None:
        return self.get("".join(units))


def _prices(units: list[str]) -> tuple[int, int]:
    """(budget, price of an edit): every letter of another script may cost UNLIKE, edits of others are out of reach."""
    budget = UNLIKE * sum(any(_script(ch) not in ("", "LATIN") for ch in u) for u in units)
    return budget, budget + 1


def chosen(ends: list[tuple[int, str]]) -> str | None:
    """The cheapest spelling; None where several are equally cheap, so that the vocabulary decides nothing."""
    best = {word for cost, word in ends if cost == min(ends)[0]}
    return best.pop() if len(best) == 1 else None


def _mixed(units: list[str]) -> bool:
    """Whether a word has Latin letters and letters of another script."""
    scripts = {s for u in units for ch in _table(u) if (s := _script(ch))}
    return "LATIN" in scripts and len(scripts) > 1


def _by_table(units: list[str]) -> str:
    """The form of one word without a vocabulary."""
    plain = "".join(map(_table, units))
    if _mixed(units):
        turned = [LOOK_ALIKES.get(ch, ch) if _script(ch) not in ("", "LATIN") else ch for ch in unicodedata.normalize("NFD", plain)]
        if all(_script(ch) in ("", "LATIN") for ch in turned):
            return unicodedata.normalize("NFC", "".join(turned))
    return plain


def _word(units: list[str], words: Trie | Told | None) -> str:
    """The consistent form of one word: the vocabulary's spelling if its letters are of two scripts, else the table's.

    A word wholly in another script stays, and in one of Latin letters only the table has nothing to choose.
    """
    if words is not None and _mixed(units) and (spelling := words.spelling(units)) is not None:
        return spelling
    return _by_table(units)


def _runs(line: str) -> Iterator[tuple[bool, list[str]]]:
    """The units of a line as words (True) and single units between them (False)."""
    word: list[str] = []
    for unit in _units(_SPACES.sub(" ", line)):
        if _script(unit[0]):
            word.append(unit)
            continue
        if word:
            yield True, word
            word = []
        yield False, [unit]
    if word:
        yield True, word


def canonical(line: str, words: Trie | Told | None = None) -> str:
    """The consistent form of a line. Idempotent; a line of plain characters is returned as it is."""
    if line.isascii() or not _ODD.search(line):
        return line
    out = "".join(_word(units, words) if is_word else _table(units[0]) for is_word, units in _runs(line))
    return unicodedata.normalize("NFC", out) if any(unicodedata.combining(ch) for ch in out) else out


def vocabulary(words: DataFrame, column: str = "word") -> DataFrame:
    """word: the distinct words of a glossary."""
    return words.select(F.col(column).alias("word")).where(F.col("word").isNotNull() & (F.col("word") != "")).distinct()


def odd(text: Column) -> Column:
    """Whether a text holds any character that may have to change (JVM side; null for null)."""
    return text.rlike(f"[^{PLAIN}\n]")


def _kind(size: int, first: str, last: str) -> str:
    return f"{size} {first} {last}"


def _kinds_of(word: str) -> list[str]:
    """Shards in which a word of the vocabulary is found: by length and ends of its forms, an end left open or not."""
    ends = {(len(f), f[0].casefold()[:1], f[-1].casefold()[:1]) for f in _forms(word)}
    return sorted({_kind(n, a, z) for n, first, last in ends for a in (first, "*") for z in (last, "*")})


def _kinds_asked(units: list[str]) -> list[str]:
    """Shards that hold every spelling that a word with letters of two scripts may have."""
    read = [_ways(u) for u in units if _table(u)]
    size = sum(len(next(iter(ways))) for ways, _ in read)

    def letters(k: int) -> set[str]:
        ways, unlike = read[k]
        return {"*"} if unlike else {w[k].casefold()[:1] for w in ways if w}

    return sorted({_kind(size, a, z) for a in letters(0) for z in letters(-1)})


def spellings(texts: DataFrame, words: DataFrame, salts: int = 1) -> DataFrame:
    """line, raw, said: for each line (``texts`` has distinct ones) the words that a vocabulary of any size spells.

    Both sides are dealt out by length and ends of a word; each shard of the vocabulary is a trie of its own. A
    shard is one of ``salts`` parts of the words of one kind. Shards hold different words, not occurrences.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(x, "".join(u)) for x in pdf["line"].tolist() for is_word, u in _runs(x) if is_word and _mixed(u)]
            yield pd.DataFrame(rows, columns=["line", "raw"]).drop_duplicates()

    raw = cut(texts.mapInPandas(ask, "line string, raw string"))
    asked = F.pandas_udf(lambda s: s.map(lambda w: _kinds_asked(_units(w))), "array<string>")
    have = F.pandas_udf(lambda s: s.map(_kinds_of), "array<string>")
    left = raw.select("raw").distinct().select("raw", F.explode(asked("raw")).alias("kind"), F.sequence(F.lit(0), F.lit(salts - 1)).alias("salt")).withColumn("salt", F.explode("salt"))
    right = words.select("word", F.explode(have("word")).alias("kind"), F.pmod(F.xxhash64("word"), F.lit(salts)).cast("int").alias("salt"))

    def meet(unknown: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[str, int, str]] = []
        if len(unknown) and len(known):
            trie = Trie(known["word"].tolist())
            for w in unknown["raw"].tolist():
                units = _units(w)
                out += [(w, cost, said) for cost, said in trie.ends(units, *_prices(units))]
        return pd.DataFrame(out, columns=["raw", "cost", "said"])

    met = left.groupBy("kind", "salt").cogroup(right.groupBy("kind", "salt")).applyInPandas(meet, "raw string, cost int, said string")
    best = met.groupBy("raw").agg(F.min("cost").alias("cost")).join(met, ["raw", "cost"]).groupBy("raw").agg(F.count_distinct("said").alias("n"), F.min("said").alias("said")).where("n = 1")
    return raw.join(best.select("raw", "said"), "raw").select("line", "raw", "said")


def canonical_lines(lines: DataFrame, words: DataFrame, line: str = "line", rows: int = VOCAB_ROWS) -> DataFrame:
    """``lines`` with its column ``line`` in consistent form and a boolean ``changed``; ``words`` has the vocabulary.

    A null line stays null and is not changed; an empty one is not changed. Only lines with a character outside
    the plain set reach Python (a JVM filter). With up to ``rows`` words nothing is shuffled; a larger vocabulary is
    looked up for the distinct words of these lines that mix scripts. All other columns pass through as they are; one
    that is named ``changed`` is replaced.
    """
    lines = lines.drop("changed")
    is_odd = F.coalesce(odd(F.col(line)), F.lit(False))
    plain = lines.where(~is_odd).withColumn("changed", F.lit(False))
    schema = lines.schema.simpleString()[7:-1] + ",changed:boolean"
    known = words.limit(rows + 1).collect()
    some = lines.where(is_odd)

    if len(known) <= rows:
        shared = lines.sparkSession.sparkContext.broadcast([r[0] for r in known])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            trie = Trie(shared.value)
            for pdf in batches:
                new = [canonical(x, trie) for x in pdf[line].tolist()]
                changed = [a != b for a, b in zip(new, pdf[line].tolist())]
                yield pdf.assign(**{line: new, "changed": changed})

        return plain.unionByName(some.mapInPandas(run, schema))

    n = words.count()
    told = spellings(some.select(F.col(line).alias("line")).distinct(), words, 1 + n // SALTED)
    fixes = cut(told.groupBy(F.col("line").alias("_line")).agg(F.collect_list("raw").alias("_raw"), F.collect_list("said").alias("_said")))

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ways = [Told(zip(a, b)) if a is not None else None for a, b in zip(pdf["_raw"].tolist(), pdf["_said"].tolist())]
            new = [canonical(x, w) for x, w in zip(pdf[line].tolist(), ways)]
            changed = [a != b for a, b in zip(new, pdf[line].tolist())]
            yield pdf.drop(columns=["_raw", "_said"]).assign(**{line: new, "changed": changed})

    joined = some.join(broadcast_if_small(fixes), F.col(line) == F.col("_line"), "left").drop("_line")
    return plain.unionByName(joined.mapInPandas(apply, schema))


def region_lines(regions: DataFrame) -> DataFrame:
    """src, item_id, line_no, line of layout regions, numbered from 1."""
    return regions.select(F.lit("region").alias("src"), F.col("region_id").alias("item_id"), F.posexplode("lines").alias("n", "line")).select("src", "item_id", (F.col("n") + 1).alias("line_no"), "line")


def body_lines(articles: DataFrame) -> DataFrame:
    """src, item_id, line_no, line of article bodies, numbered from 1."""
    return articles.select(F.lit("article").alias("src"), F.col("article_id").alias("item_id"), F.posexplode(F.split("body", "\n")).alias("n", "line")).select("src", "item_id", (F.col("n") + 1).alias("line_no"), "line")


def found(regions: DataFrame, articles: DataFrame, words: DataFrame) -> DataFrame:
    """Every line that is not in its consistent form, once."""
    # Whole rows without an odd character are dropped before they are cut into lines.
    some = regions.where(F.exists("lines", odd)).select("region_id", "lines")
    lines = region_lines(some).unionByName(body_lines(articles.where(odd(F.col("body"))).select("article_id", "body")))
    return canonical_lines(lines.where(odd(F.col("line"))), words).where("changed").select("src", "item_id", "line_no").distinct()
