"""Pairs of keys that are alike: every pair with an indel ratio of at least a limit, and no other.

Blocks of keys meet all blocks whose lengths can reach the limit. In a block the letters that two keys have in common (an
upper bound of their common subsequence) come from one matrix product; what that leaves gets the exact length of the
subsequence, a bit for each letter, many pairs at once. No key is left out for being common or mistyped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synoptic.functions.text import indel_ratio

#: Keys of a block, pairs that are compared at once, lengths that share a block.
BLOCK, AT_ONCE, SPAN = 2048, 1 << 18, 4


def _letters(keys: list[str], number: dict[tuple[str, int], int]) -> list[list[int]]:
    """The numbers of (letter, how often it came before) of each key."""
    out = []
    for key in keys:
        seen: dict[str, int] = {}
        row = []
        for c in key:
            n = seen[c] = seen.get(c, 0) + 1
            row.append(number.setdefault((c, n), len(number)))
        out.append(row)
    return out


def alike_in(one: list[str], two: list[str], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the pairs with indel_ratio >= least."""
    number: dict[tuple[str, int], int] = {}
    rows = _letters(one, number), _letters(two, number)
    bags = [np.zeros((len(r), len(number)), np.float32) for r in rows]
    for bag, r in zip(bags, rows, strict=True):
        bag[np.repeat(np.arange(len(r)), [len(x) for x in r]), np.fromiter((k for x in r for k in x), np.int64)] = 1
    n1, n2 = (np.array([len(k) for k in keys], np.int64) for keys in (one, two))
    i, j = np.nonzero(bags[0] @ bags[1].T >= least / 2 * (n1[:, None] + n2[None, :]) - 1e-4)
    short = n1[i] <= 64
    kept = np.zeros(len(i), bool)
    for p in np.flatnonzero(~short):
        kept[p] = indel_ratio(one[i[p]], two[j[p]]) >= least - 1e-9
    code = {c: n for n, c in enumerate({c for c, _ in number})}
    masks = np.zeros((len(one), len(code) + 1), np.uint64)
    for k, key in enumerate(one):
        if len(key) <= 64:
            for place, c in enumerate(key):
                masks[k, code[c]] |= np.uint64(1 << place)
    chars = np.full((len(two), int(n2.max(initial=0))), len(code), np.int64)
    for k, key in enumerate(two):
        chars[k, : len(key)] = [code[c] for c in key]
    todo = np.flatnonzero(short)
    for lo in range(0, len(todo), AT_ONCE):
        at = todo[lo : lo + AT_ONCE]
        row, a, b = np.full(len(at), np.iinfo(np.uint64).max, np.uint64), i[at], chars[j[at]]
        for k in range(int(n2[j[at]].max(initial=0))):
            hit = row & masks[a, b[:, k]]
            row = (row + hit) | (row - hit)
        common = np.bitwise_count(~row).astype(np.int64)
        kept[at] = 2 * common >= least * (n1[a] + n2[j[at]]) - 1e-9
    return i[kept], j[kept]


def alike(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b): ids that have keys with an indel ratio of at least `least` (over 0), of rows (id, k)."""
    def packed(rows: DataFrame, mark: str) -> DataFrame:
        keys = rows.select("k").where("k <> ''").distinct()
        span = F.floor(F.length("k") / SPAN)
        parts = keys.select("k", span.alias("span"), F.pmod(F.xxhash64("k"), F.lit(max(1, -(-keys.count() // (4 * BLOCK))))).alias("part"))
        return parts.groupBy("span", "part").agg(F.collect_list("k").alias("k" + mark), F.min(F.length("k")).alias("low" + mark), F.max(F.length("k")).alias("high" + mark)).drop("span", "part")

    def reach(low: Column, high: Column) -> Column:
        """The shorter side is the common subsequence at most: 2 * low / (low + high) >= least."""
        return low * (2 - least) + 1e-9 >= high * least

    pairs = packed(left, "1").crossJoin(packed(right, "2")).where(reach(F.col("high1"), F.col("low2")) & reach(F.col("high2"), F.col("low1")))

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for one, two in zip(df["k1"], df["k2"], strict=True):
                one, two = list(one), list(two)
                for x in range(0, len(one), BLOCK):
                    for y in range(0, len(two), BLOCK):
                        i, j = alike_in(one[x : x + BLOCK], two[y : y + BLOCK], least)
                        yield pd.DataFrame({"k1": [one[x + p] for p in i], "k2": [two[y + p] for p in j]}, dtype=object)

    # Spread before the work, as a few large rows would else stay in one task.
    tasks = max(24, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = pairs.select("k1", "k2").repartition(tasks, F.xxhash64("k1", "k2")).mapInPandas(compared, "k1 string, k2 string")
    one, two = left.select(F.col("id").alias("a"), F.col("k").alias("k1")), right.select(F.col("id").alias("b"), F.col("k").alias("k2"))
    return found.join(one, "k1").join(two, "k2").select("a", "b").distinct()
