"""Problem 2: consolidating pairwise matches into groups.

`components` finds the connected components of a graph by low-diameter decomposition. On each level every vertex draws an
exponential shift; a vertex joins the cluster whose centre reaches it first, where the clusters of large shifts start
early and grow one hop a round. Clusters contract to super-vertices, the edges between clusters are the next level's
graph, and at the end the assignments of all levels are composed. Whatever a round leaves out is taken up on the next
level: contracting along any edges keeps components, so the result is exact at any number of rounds.

Shifts come from a hash of vertex and level: a task that is run again draws the same ones. Edges and assignments of each
level are written to the shared folder; the graph shrinks geometrically. A hub with a third of all edges is met by
partial aggregation (its cluster offers are minima) and, in joins, by AQE's splitting of skewed partitions.

`link_records` makes the edges: identifiers are brought to one form, each identifier points to its smallest record, so an
identifier that k records share gives k - 1 edges, never k^2.

Nulls: a null record id or identifier links nothing; null or empty arrays neither. Repeated rows count once. An empty
table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synoptic.runtime import Scratch, uniform

#: Words for "no identifier", lower case. Signs alone (no letter or digit) are none either.
NO_IDENTIFIER = ["n/a", "na", "n.a", "none", "null", "nil", "nan", "unknown", "undefined", "unspecified", "not available", "not applicable", "no identifier", "no id", "missing", "tbd", "void"]


def clean_identifier(value: Column) -> Column:
    """Lower case, without surrounding blanks and a final dot; null where it says "no identifier"."""
    kept = F.lower(F.regexp_replace(value, r"^[\s\p{Z}]+|[\s\p{Z}]*\.?[\s\p{Z}]*$", ""))
    return F.when(kept.rlike(r"[\p{L}\p{N}]") & ~kept.isin(NO_IDENTIFIER), kept)


def link_records(record_identifiers: DataFrame) -> DataFrame:
    """(a, b), a > b: from (id, ident), cleaned, each record and the smallest record that has the same identifier."""
    named = record_identifiers.where("id is not null and ident is not null").select("id", F.xxhash64("ident").alias("h1"), F.hash("ident").alias("h2"))
    low = named.groupBy("h1", "h2").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").drop("high")
    return named.join(low, ["h1", "h2"]).where("id > low").select(F.col("id").alias("a"), F.col("low").alias("b")).distinct()


def components(edges: DataFrame, name: str = "components", rate: float = 0.15, rounds: int = 3) -> DataFrame:
    """(id, group_id): every vertex that has an edge (a, b) to another, and the smallest vertex of its component."""
    scratch = Scratch(edges.sparkSession, name)
    graph = scratch.write(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    levels: list[DataFrame] = []
    while graph.count():
        level = len(levels)

        def own(v: str, hops: float, level: int = level) -> Column:
            """The offer of v's own cluster after some hops: (time of arrival, centre). A shift of -log(u) / rate starts
            it early; the earliest offer wins, of two that tie the smaller centre."""
            return F.struct((F.log(uniform(F.col(v), F.lit(level))) / rate + hops).alias("at"), F.col(v).alias("centre"))

        both = graph.select("a", "b").union(graph.select("b", "a")).toDF("u", "v")
        offers = both.select("u", own("v", 1.0).alias("o"), own("u", 0.0).alias("own"))
        joined = offers.groupBy("u").agg(F.least(F.min("o"), F.min("own")).alias("c"))
        hops: list[DataFrame] = []
        for _ in range(rounds - 1):
            held = scratch.write(joined)
            hops.append(held)
            known = held.select(F.col("u").alias("v"), F.struct((F.col("c.at") + 1.0).alias("at"), F.col("c.centre").alias("centre")).alias("c"))
            joined = both.join(known, "v").select("u", "c").union(held).groupBy("u").agg(F.min("c").alias("c"))
        assigned = scratch.write(joined.select(F.col("u").alias("v"), F.col("c.centre").alias("to")))
        levels.append(assigned)
        to_a, to_b = assigned.select(F.col("v").alias("a"), F.col("to").alias("a2")), assigned.select(F.col("v").alias("b"), F.col("to").alias("b2"))
        between = graph.join(to_a, "a").join(to_b, "b").where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct()
        smaller = scratch.write(between)
        scratch.drop(graph, *hops)
        graph = smaller
    if not levels:
        return graph.select(F.col("a").alias("id"), F.col("b").alias("group_id"))
    # Composed from the last level back, so that each join has one large side at most once.
    def compose(above: DataFrame, below: DataFrame) -> DataFrame:
        up = above.select(F.col("v").alias("to"), F.col("to").alias("top"))
        return below.join(up, "to", "left").select("v", F.coalesce("top", "to").alias("to"))

    final = reduce(compose, reversed(levels))
    final = scratch.write(final)
    scratch.drop(*levels)
    lowest = final.groupBy("to").agg(F.min("v").alias("group_id"))
    return final.join(lowest, "to").select(F.col("v").alias("id"), "group_id")


def groups(record_identifiers: DataFrame, name: str = "groups") -> DataFrame:
    """(id, group_id) of all records linked with another, from (id, ident)."""
    return components(link_records(record_identifiers), name)
