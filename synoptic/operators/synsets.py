"""Synonym sets: closure of exact matches, splits, expansion to pairs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synoptic.runtime import Scratch

#: So many edges or fewer are joined by one task (some MB).
FEW = 200_000


def _in_one_task(graph: DataFrame) -> DataFrame:
    """(id, synset_id) of at most FEW edges (u, v)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        up: dict = {}

        def top(x):  # noqa: ANN001, ANN202
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for df in batches:
            for u, v in zip(df["u"].tolist(), df["v"].tolist(), strict=True):
                a, b = top(u), top(v)
                if a != b:
                    up[max(a, b)] = min(a, b)
        ids = list(up)
        yield pd.DataFrame({"id": ids, "synset_id": [top(x) for x in ids]})

    kind = graph.schema["u"].dataType.simpleString()
    return graph.repartition(1).mapInPandas(run, f"id {kind}, synset_id {kind}")


def synsets(edges: DataFrame, name: str = "synsets") -> DataFrame:
    """(id, synset_id): connected components of (src, dst) by alternating large and small stars; synset_id is the smallest
    member. Stars are aggregates and joins, so a hub is no single task's list. FEW edges are joined at once."""
    scratch = Scratch(edges.sparkSession, name)
    graph = scratch.write(edges.where("src is not null and dst is not null and src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    if graph.count() <= FEW:
        return scratch.write(_in_one_task(graph))
    before = None
    while True:
        both = graph.union(graph.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = scratch.write(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        after = scratch.write(small)
        size = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(graph, large)
        graph = after
        if size == before:
            break
        before = size
    roots = graph.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("synset_id"))
    return graph.select(F.col("u").alias("id"), F.col("v").alias("synset_id")).union(roots).distinct()


def without(edges: DataFrame, removed: DataFrame) -> DataFrame:
    """Edges less those removed, in either direction: the synsets of what is left are the split ones."""
    gone = removed.select(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y")).distinct()
    return edges.join(gone, (F.least("src", "dst") == F.col("x")) & (F.greatest("src", "dst") == F.col("y")), "left_anti")


def closure_pairs(members: DataFrame) -> DataFrame:
    """(src, dst): each member linked with its synset's representative, in both directions. That says what all pairs of a
    synset say in as many rows as there are members: two are synonyms if they have the same representative."""
    star = members.where(F.col("id") != F.col("synset_id")).select(F.col("id").alias("src"), F.col("synset_id").alias("dst")).distinct()
    return star.union(star.select("dst", "src"))


def with_authority(members: DataFrame, sources: DataFrame) -> DataFrame:
    """Synsets with a member of an authoritative list: members (id, synset_id, source), sources (source)."""
    return members.join(members.join(sources.select("source").distinct(), "source", "left_semi").select("synset_id").distinct(), "synset_id", "left_semi")
