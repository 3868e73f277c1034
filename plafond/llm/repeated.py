"""Problem 4: lines and blocks of lines repeated across the pages of one volume."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plafond.llm.canonical import canonical
from plafond.session import broadcast_if_small, cut

#: A line is boilerplate from this share of its volume's pages on, and from this number of pages on.
SHARE, LEAST_PAGES = 0.1, 6
#: Share of the required pages on which a line's plain spelling must stand by itself; misread ones are added to it.
PLAIN = 0.25
#: Lines with fewer letters never count; nor do lines of regions with these labels.
LEAST_LETTERS = 5
HEADINGS = ["Section-header", "SectionHeader"]
#: Chunks of a volume that share a suffix array.
PART = 8
#: Letters at either end by which spellings with one misread place are brought together (long and short lines).
LONG_END, SHORT_END, LONG_LINE = 6, 2, 16
#: A line beside a matching one is part of their block if it is up to this share of its length from what the block has
#: there. Only such lines may differ in more than one place.
GARBLED = 1 / 3


def line_key(line: str) -> str:
    """What is left of a line without case, digits, spacing, punctuation and differences of form."""
    form = canonical(line).casefold()
    return form if form.isalpha() else "".join(filter(str.isalpha, form))


def one_place(a: str, b: str) -> bool:
    """Whether two keys differ in one misread place: apart from common ends, at most two letters on either side."""
    if a == b:
        return True
    n = min(len(a), len(b))
    if abs(len(a) - len(b)) > 2:
        return False
    i = 0
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return max(len(a), len(b)) - i - j <= 2


def keyed_lines(regions: DataFrame) -> DataFrame:
    """volume, chunk, page, pos, region_id, line_no, key, h of every line that may count; h is the key's 64-bit hash.

    Null lines and regions without a volume, chunk, page or id are left out; a null label is no heading.
    """
    there = regions.where("band_prefix is not null and chunk is not null and page is not null and region_id is not null")
    rows = there.where(~F.col("label").isin(HEADINGS) | F.col("label").isNull()).where(F.size("lines") > 0).select(F.col("band_prefix").alias("volume"), "chunk", "page", F.coalesce("reading_pos", F.lit(0)).alias("pos"), "region_id", "lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("lines")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            keys = [line_key(x) if x else "" for x in lists.flatten().to_pylist()]
            keep = np.array([len(k) >= LEAST_LETTERS for k in keys], bool)
            row = np.repeat(np.arange(len(sizes)), sizes)
            line_no = np.arange(1, len(row) + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at = pa.array(row[keep])
            columns = [batch.column(c).take(at) for c in ("volume", "chunk", "page", "pos", "region_id")]
            columns += [pa.array(line_no[keep].astype(np.int32)), pa.array([k for k, yes in zip(keys, keep) if yes], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["volume", "chunk", "page", "pos", "region_id", "line_no", "key"])

    return rows.mapInArrow(run, "volume string, chunk int, page int, pos int, region_id bigint, line_no int, key string").withColumn("h", F.xxhash64("key"))


def page_counts(regions: DataFrame) -> DataFrame:
    """volume, pages: the number of its (chunk, page) with any region."""
    return regions.select(F.col("band_prefix").alias("volume"), "chunk", "page").distinct().groupBy("volume").agg(F.count("*").alias("pages"))


def _need(pages: Column) -> Column:
    """Pages on which a line must stand in a volume of so many."""
    return F.greatest(F.lit(LEAST_PAGES), F.ceil(pages * SHARE - F.lit(1e-9)))


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of a sequence of numbers by prefix doubling, and the common prefix of each suffix with the one before."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    levels, step = [rank], 1
    while True:
        second = np.full(n, -1, np.int64)
        second[: max(0, n - step)] = rank[step:]
        order = np.lexsort((second, rank))
        fresh = np.ones(n, np.int64)
        if n > 1:
            a, b = order[1:], order[:-1]
            fresh[1:] = (rank[a] != rank[b]) | (second[a] != second[b])
        new = np.cumsum(fresh) - 1
        rank = np.empty(n, np.int64)
        rank[order] = new
        if n == 0 or new[-1] == n - 1 or step >= n:
            break
        step *= 2
        levels.append(rank)
    # Ranks of level k compare 2**k numbers: the common prefix is made up of such steps, the longest first.
    common = np.zeros(n, np.int64)
    if n > 1:
        a, b, got = order[1:].copy(), order[:-1].copy(), np.zeros(n - 1, np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inside = (a < n) & (b < n)
            same = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
            for x in (a, b, got):
                x[same] += 1 << k
        common[1:] = got
    return order, common


def maximal_blocks(ids: np.ndarray, page: np.ndarray, least: float) -> list[tuple[int, int, int]]:
    """(start, length, pages) of every repeated block that can't be made longer, on at least ``least`` pages.

    ``page`` has the page of each place, -1 where a separator stands. Suffixes with one block are neighbours in the
    suffix array: the blocks are the intervals of its common prefixes, each with the longest prefix of its interval.
    A block that is always preceded by the same line is part of a longer one and left out. Numbers that occur once
    are blocks of length 1.
    """
    order, common = suffix_array(ids)
    order, heights = order.tolist(), [*common.tolist(), 0]
    ids, page = ids.tolist(), page.tolist()
    out: list[tuple[int, int, int]] = []
    # Open intervals: [height, pages, lines before, a start]; an interval closes where a lower prefix follows.
    stack: list[list] = []
    for k, start in enumerate(order):
        if page[start] < 0:
            leaf = None
        else:
            leaf = [0, {page[start]}, {ids[start - 1] if start else None}, start]
            if heights[k] == 0 and heights[k + 1] == 0 and least <= 1:
                out.append((start, 1, 1))
        low = heights[k + 1]
        if leaf is None:
            continue
        carried = leaf
        while stack and stack[-1][0] > low:
            top = stack.pop()
            top[1] |= carried[1]
            top[2] |= carried[2]
            if len(top[1]) >= least and len(top[2]) > 1:
                out.append((top[3], top[0], len(top[1])))
            carried = top
        if low > 0:
            if stack and stack[-1][0] == low:
                stack[-1][1] |= carried[1]
                stack[-1][2] |= carried[2]
            else:
                stack.append([low, carried[1], carried[2], carried[3]])
    return out


def _sequence(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The line identifiers of a part in reading order, the page of each, and the hashes that they number.

    Wherever two lines are not neighbours (another region, page, or a line between them that does not count) a
    number that occurs once stands between them. Repeated deliveries count once.
    """
    at = [pdf[c].to_numpy() for c in ("line_no", "region_id", "pos", "page", "chunk")]
    order = np.lexsort(at)
    line, region, _, page, chunk = (x[order] for x in at)
    new = np.ones(len(order), bool)
    new[1:] = (line[1:] != line[:-1]) | (region[1:] != region[:-1])
    line, region, page, chunk, name = line[new], region[new], page[new], chunk[new], pdf["h"].to_numpy()[order][new]
    apart = np.zeros(len(line), np.int64)
    apart[1:] = (region[1:] != region[:-1]) | (line[1:] != line[:-1] + 1)
    where = np.arange(len(line)) + np.cumsum(apart)
    fresh = np.ones(len(line), np.int64)
    fresh[1:] = (page[1:] != page[:-1]) | (chunk[1:] != chunk[:-1])
    size = int(where[-1]) + 1 if len(where) else 0
    # Numbers from 0 for the lines, those beyond for the separators.
    names, numbers = np.unique(name, return_inverse=True)
    ids = np.arange(len(names), len(names) + size, dtype=np.int64)
    ids[where] = numbers
    pages = np.full(size, -1, np.int64)
    pages[where] = np.cumsum(fresh) - 1
    return ids, pages, names


def repeated_blocks(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """volume, block (array of line hashes), pages_with: blocks that are frequent in some part of a volume.

    Suffix arrays are built over all lines of a volume's PART chunks, so a hot volume is many groups and memory is
    bounded by the lines of so many pages. A line that by itself stands on a share of its volume's pages has, in one
    part at least, that share of the part's pages; so every line with PLAIN of the required pages comes out of some
    part, and none is lost by leaving out what is rare in a part. Only numbers are shuffled.
    """
    share = pages.select("volume", (_need(F.col("pages")) * PLAIN / F.col("pages")).alias("share"))
    rows = lines.join(broadcast_if_small(share), "volume").select("volume", "chunk", "page", "pos", "region_id", "line_no", "h", "share")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, page, names = _sequence(pdf)
        least = float(pdf["share"].iloc[0]) * (int(page.max()) + 1)
        found = maximal_blocks(ids, page, max(1.0, least - 1e-9))
        blocks = pd.Series([names[ids[a : a + n]].tolist() for a, n, _ in found], dtype=object)
        return pd.DataFrame({"volume": pdf["volume"].iloc[0], "block": blocks, "pages_with": pd.Series([c for _, _, c in found], dtype="int64")})

    return rows.groupBy("volume", F.floor(F.col("chunk") / PART).alias("part")).applyInPandas(run, "volume string, block array<bigint>, pages_with bigint")


def line_classes(lines: DataFrame, blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """volume, h, class: the keys of a volume that may stand for a boilerplate line, and their class (a hash).

    A class is a key that by itself stands on at least PLAIN of the required pages, with all keys of the volume that
    differ from it in one misread place; a key goes to its most frequent such centre. There are at most
    (lines per page) / (SHARE * PLAIN) centres per volume; they are among the lines of the blocks. Other keys find them
    by an equi-join on their first or last letters: one misread place leaves one end whole, so no pair is missed
    and no pairs are emitted within a group.
    """
    some = blocks.select("volume", F.explode("block").alias("h")).distinct()
    on = lines.join(broadcast_if_small(some), ["volume", "h"])
    counts = on.groupBy("volume", "h").agg(F.count_distinct("chunk", "page").alias("n"), F.min("key").alias("centre"))
    centres = cut(counts.join(broadcast_if_small(pages), "volume").where(F.col("n") >= _need(F.col("pages")) * PLAIN).select("volume", "centre", F.col("h").alias("class"), "n"))

    def ends(key: Column, n: int) -> Column:
        return F.array(F.concat(F.lit(f"a{n}"), F.substring(key, 1, n)), F.concat(F.lit(f"z{n}"), F.substring(key, -n, n)))

    near = centres.withColumn("end", F.explode(F.when(F.length("centre") >= LONG_LINE, ends(F.col("centre"), LONG_END)).otherwise(ends(F.col("centre"), SHORT_END))))
    # A key meets centres that are up to two letters longer or shorter.
    size, k = F.length("key"), F.col("key")
    own = F.when(size >= LONG_LINE + 2, ends(k, LONG_END)).when(size < LONG_LINE - 2, ends(k, SHORT_END)).otherwise(F.concat(ends(k, LONG_END), ends(k, SHORT_END)))
    keys = lines.select("volume", "h", "key", F.explode(own).alias("end"))
    close = keys.join(broadcast_if_small(near), ["volume", "end"]).where((F.abs(F.length("key") - F.length("centre")) <= 2) & (F.levenshtein("key", "centre", 3) >= 0))
    once = close.select("volume", "h", "key", "class", "centre", "n").distinct()
    same = F.pandas_udf(lambda a, b: pd.Series([one_place(x, y) for x, y in zip(a, b)], dtype=bool), "boolean")
    return once.where(same("key", "centre")).groupBy("volume", "h").agg(F.max(F.struct("n", "centre", "class")).alias("best")).select("volume", "h", F.col("best.class").alias("class"))


class Repeated(NamedTuple):
    """What is known of the lines repeated in each volume."""

    #: volume, chunk, page, pos, region_id, line_no, key, h of every line that may count
    lines: DataFrame
    #: volume, chunk, region_id, line_no, class of the boilerplate lines
    gone: DataFrame
    #: volume, block, pages_with: blocks of several lines, all of them boilerplate, as arrays of classes
    blocks: DataFrame


def boilerplate(regions: DataFrame) -> Repeated:
    """Lines whose class stands on enough pages of their volume, and the blocks they form.

    The parts' suffix arrays give the blocks of lines that may be frequent; of their lines, with all spellings one
    misread place away, the pages are then counted over the whole volume.
    """
    lines = cut(keyed_lines(regions))
    pages = cut(page_counts(regions))
    blocks = cut(repeated_blocks(lines, pages))
    classes = cut(line_classes(lines, blocks, pages))
    wanted = cut(lines.join(broadcast_if_small(classes), ["volume", "h"]).select("volume", "chunk", "page", "region_id", "line_no", "class"))
    total = wanted.groupBy("volume", "class").agg(F.count_distinct("chunk", "page").alias("n")).join(broadcast_if_small(pages), "volume")
    kept = cut(total.where(F.col("n") >= _need(F.col("pages"))).select("volume", "class"))
    gone = wanted.join(broadcast_if_small(kept), ["volume", "class"]).select("volume", "chunk", "region_id", "line_no", "class")
    # Blocks of several lines in classes. A part in which a block is rare does not report it: the sum is a lower bound.
    several = blocks.where(F.size("block") > 1).groupBy("volume", "block").agg(F.sum("pages_with").alias("n"))
    named = several.select("*", F.posexplode("block").alias("i", "h")).join(broadcast_if_small(classes), ["volume", "h"]).join(broadcast_if_small(kept), ["volume", "class"], "left_semi")
    whole = named.groupBy("volume", "block", "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "class"))), lambda x: x["class"]).alias("classes")).where(F.size("classes") == F.size("block"))
    summed = whole.groupBy("volume", F.col("classes").alias("block")).agg(F.sum("n").alias("pages_with")).join(broadcast_if_small(pages), "volume")
    return Repeated(lines, gone, summed.where(F.col("pages_with") * 2 >= _need(F.col("pages"))).select("volume", "block", "pages_with"))


def found(regions: DataFrame) -> DataFrame:
    """region_id, line_no of every boilerplate line, once."""
    return boilerplate(regions).gone.select("region_id", "line_no").distinct()


def garbled_lines(told: Repeated) -> DataFrame:
    """region_id, line_no of lines too badly read to match, where a block says what they are.

    A line right before or behind a boilerplate line, at a place where a block goes on, belongs to the block if it
    is up to GARBLED of its length from the line that the block has there.
    """
    steps = F.flatten(F.transform(F.sequence(F.lit(2), F.size("block")), lambda i: F.array(F.struct(F.get("block", i - 2).alias("class"), F.get("block", i - 1).alias("next"), F.lit(1).alias("step")), F.struct(F.get("block", i - 1).alias("class"), F.get("block", i - 2).alias("next"), F.lit(-1).alias("step")))))
    follows = cut(told.blocks.select("volume", F.explode(steps).alias("s")).select("volume", "s.*").distinct())
    # Places where a block goes on, but no boilerplate line stands: few, as numbers; then what should stand there.
    at = told.gone.join(broadcast_if_small(follows), ["volume", "class"]).select("volume", "region_id", (F.col("line_no") + F.col("step")).alias("line_no"), "next")
    open_at = cut(at.join(told.gone.select("region_id", "line_no"), ["region_id", "line_no"], "left_anti"))
    wanted = open_at.select("volume", "next").distinct()
    said = cut(told.lines.select("volume", F.col("h").alias("next"), "key").join(broadcast_if_small(wanted), ["volume", "next"], "left_semi").groupBy("volume", "next").agg(F.min("key").alias("said")))
    expected = open_at.join(broadcast_if_small(said), ["volume", "next"]).select("region_id", "line_no", "said")
    most = F.greatest(F.length("said"), F.length("key")) * GARBLED
    rest = told.lines.select("region_id", "line_no", "key").join(broadcast_if_small(expected), ["region_id", "line_no"])
    return rest.where(F.levenshtein("key", "said") <= most).select("region_id", "line_no").distinct()


def without_boilerplate(regions: DataFrame, deliveries: DataFrame | None = None) -> DataFrame:
    """The regions with ``lines`` and ``text`` freed of boilerplate, and the number of lines taken out of each.

    Blocks go as a whole: also a line of a block that is too badly read to match alone. Boilerplate is told from
    ``deliveries``, the table before repeated rows were taken out, if it is given.

    Headings stay. A region that is nothing but boilerplate keeps an empty list and text; null lines and texts
    stay null. Repeated deliveries of a region are treated alike. All other columns pass through.
    """
    told = boilerplate(regions if deliveries is None else deliveries)
    lines = told.gone.select("region_id", "line_no").unionByName(garbled_lines(told))
    gone = cut(lines.groupBy("region_id").agg(F.collect_set("line_no").alias("_gone")))
    joined = regions.join(broadcast_if_small(gone), "region_id", "left")
    kept = F.filter("lines", lambda x, i: ~F.array_contains(F.coalesce("_gone", F.array().cast("array<int>")), i + 1))
    out = joined.withColumn("lines", F.when(F.col("_gone").isNull(), F.col("lines")).otherwise(kept))
    out = out.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join("lines", "\n")))
    return out.withColumn("lines_removed", F.coalesce(F.size("_gone"), F.lit(0))).drop("_gone")
