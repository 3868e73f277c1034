"""Problem 7: texts, sized in tokens, packed into containers of fixed capacity by hierarchical best fit."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plafond.llm import bpe
from plafond.session import broadcast_if_small, cut

CAPACITY = 2_048
#: A container filled to this share is done; the others are merged with containers of other partitions.
FULL = 0.98
#: Partitions whose underfull containers meet in one round, and items packed at a time within a partition.
FAN_IN, BATCH = 8, 65_536
#: Underfull containers that a group (or a batch of items) hands on to the next round, the emptiest first; the
#: others are done.
HANDED_ON = 256


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Best fit in decreasing order: (container number of each item, fill of each container).

    An item goes where it leaves the least room. Equal sizes keep their order, so the result is deterministic.
    Items of size 0 take no room and go to container 0. Residuals that occur are kept in a sorted list of at
    most ``capacity`` values, each with its stack of containers.
    """
    order = np.argsort(-np.asarray(sizes, np.int64), kind="stable")
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    free: list[int] = []
    where, fills = [0] * len(sizes), []
    for i in order.tolist():
        n = sizes[i]
        if n == 0:
            if not fills:
                fills.append(0)
                stacks[capacity].append(0)
                insort(free, capacity)
            continue
        k = bisect_left(free, n)
        if k < len(free):
            room = free[k]
            b = stacks[room].pop()
            if not stacks[room]:
                del free[k]
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        where[i] = b
        fills[b] += n
        left = capacity - fills[b]
        if left:
            if not stacks[left]:
                insort(free, left)
            stacks[left].append(b)
    return where, fills


def _local(df: DataFrame, key: str, text: str, capacity: int, tokenizer: str) -> DataFrame:
    """Round 0: token counts, cuts of oversized texts, and best fit within each partition."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, pid = bpe.words(tokenizer), TaskContext.get().partitionId()
        made, key_type = 0, None

        def pack(keys: list, parts: list[int], starts: list[int], sizes: list[int]) -> pa.RecordBatch:
            nonlocal made
            where, fills = best_fit(sizes, capacity)
            base = (pid << 36) + made
            made += len(fills)
            bins, fill = np.asarray(where, np.int64), np.asarray(fills, np.int32)
            # The emptiest of the underfull containers go on to be merged.
            handed = np.zeros(len(fills), bool)
            handed[np.argsort(fill, kind="stable")[:HANDED_ON]] = True
            handed &= fill < FULL * capacity
            columns = [pa.array(keys, key_type), pa.array(parts, pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int32()), pa.array(bins + base), pa.array(fill[bins]), pa.array(handed[bins]), pa.array(np.full(len(keys), pid, np.int32))]
            return pa.RecordBatch.from_arrays(columns, names=[key, "part_no", "token_start", "n_tokens", "bin", "fill", "handed", "pid"])

        keys, parts, starts, sizes = [], [], [], []
        for batch in batches:
            key_type = batch.column(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = len(bpe.encode_bytes(t, cache)) // 4
                for part, at in enumerate(range(0, max(n, 1), capacity), 1):
                    keys.append(k), parts.append(part), starts.append(at), sizes.append(min(capacity, n - at))
            if len(keys) >= BATCH:
                yield pack(keys, parts, starts, sizes)
                keys, parts, starts, sizes = [], [], [], []
        if keys:
            yield pack(keys, parts, starts, sizes)

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, part_no int, token_start bigint, n_tokens int, bin bigint, fill int, handed boolean, pid int")


def _merge(bins: DataFrame, capacity: int) -> DataFrame:
    """One round: underfull containers of FAN_IN neighbouring groups as items of a best fit.

    In and out: ``grp, bin, fill, members, done``. A container is done when it is full enough or not among the
    HANDED_ON emptiest of its group. That bounds a group to FAN_IN * HANDED_ON rows at any size of the corpus
    and costs nearly nothing: best fit leaves at most one container per group that is up to half full, and two
    containers that are both more than half full never go together.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin", kind="stable")
        where, fills = best_fit(pdf["fill"].tolist(), capacity)
        members: list[list[int]] = [[] for _ in fills]
        for b, m in zip(where, pdf["members"].tolist()):
            members[b].extend(m)
        out = pd.DataFrame({"grp": int(pdf["grp"].iloc[0]), "bin": [m[0] for m in members], "fill": fills, "members": members})
        rank = out["fill"].rank(method="first")
        out["done"] = (out["fill"] >= FULL * capacity) | (rank > HANDED_ON)
        return out

    return bins.withColumn("grp", F.floor(F.col("grp") / FAN_IN)).groupBy("grp").applyInPandas(run, "grp bigint, bin bigint, fill int, members array<bigint>, done boolean")


def pack(df: DataFrame, key: str, text: str, capacity: int = CAPACITY, tokenizer: str = bpe.TOKENIZER) -> DataFrame:
    """Containers of texts: ``key, part_no, token_start, n_tokens, container, container_fill``.

    A text of up to ``capacity`` tokens stays whole (part_no 1, token_start 0). A longer one is cut into parts
    of exactly ``capacity`` tokens and a last part; only such texts have a part_no above 1. Empty and null texts
    have 0 tokens and take no room, but are assigned like any other. Repeated rows are separate items; a null
    key is kept; an empty table gives no rows. No container's fill exceeds the capacity.

    Hierarchical residual packing: each partition packs its own items by best fit and its nearly full
    containers are done. The underfull ones, as items, meet those of neighbouring partitions in a tree of
    rounds, FAN_IN groups at a time. Texts never move: only (container, fill) pairs are shuffled, and the items
    are joined with the few renamed containers at the end. The item table is written once (checkpoint), so that
    a lost executor can't change container names between rounds.
    """
    items = cut(_local(df, key, text, capacity, tokenizer))
    under = items.where("handed").groupBy("bin").agg(F.first("fill").alias("fill"), F.first("pid").alias("grp"))
    worst = under.select("bin", "fill", F.col("grp").cast("bigint").alias("grp"), F.array("bin").alias("members"))
    groups = (items.agg(F.max("pid")).first()[0] or 0) + 1
    done = None
    while True:
        merged = cut(_merge(worst, capacity))
        groups = -(-groups // FAN_IN)
        final = merged if groups == 1 else merged.where("done")
        done = final if done is None else done.unionByName(final)
        if groups == 1:
            break
        worst = merged.where("not done").drop("done")
    renamed = done.select(F.explode("members").alias("bin"), F.col("bin").alias("container"), F.col("fill").alias("container_fill"))
    out = items.join(broadcast_if_small(renamed), "bin", "left")
    return out.select(key, "part_no", "token_start", "n_tokens", F.coalesce("container", "bin").alias("container"), F.coalesce("container_fill", "fill").alias("container_fill"))
