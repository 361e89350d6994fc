"""Selection of candidate pairs: ranks, cuts, streaks and one-to-one assignment, under explicit total orders."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from synoptic.runtime import Scratch, running_total

#: So many pairs or fewer that are still open are looked through by one task, in order (some MB).
FEW = 200_000


def top_k(scored: DataFrame, entity: list[str], score: str, tie: list[str], k: int = 10) -> DataFrame:
    """The k best rows of each entity. The rank filter is pushed below the shuffle by Spark's group limit."""
    order = Window.partitionBy(*entity).orderBy(F.desc_nulls_last(score), *tie)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def zscore_cut(scored: DataFrame, score: str, z: float = 0.385) -> DataFrame:
    """Rows over mean + z * standard deviation of the distinct scores."""
    limit = scored.select(score).where(F.col(score).isNotNull()).distinct().agg((F.avg(score) + z * F.stddev_pop(score)).alias("__limit"))
    return scored.crossJoin(F.broadcast(limit)).where(F.col(score) >= F.col("__limit")).drop("__limit")


def until_streak(decisions: DataFrame, group: list[str], order: str, bucket: Column, accepted: str, most: int) -> DataFrame:
    """Decisions up to the `most`-th rejection in a row. Positions and accepts so far are two-level running totals; a row
    belongs to the run of rejections since the last accept."""
    at = running_total(decisions, group, [F.col(order)], bucket, F.lit(1), "__at")
    runs = running_total(at, group, [F.col(order)], bucket, F.col(accepted).cast("int"), "__run")
    rejected = runs.where(~F.col(accepted)).groupBy(*group, "__run").agg(F.count("*").alias("__n"), F.min("__at").alias("__from")).where(F.col("__n") >= most)
    stops = rejected.groupBy(*group).agg(F.min(F.col("__from") + most - 1).alias("__stop"))
    kept = runs.join(stops, group, "left")
    return kept.where(F.col("__stop").isNull() | (F.col("__at") <= F.col("__stop"))).drop("__at", "__run", "__stop")


def _in_order(left: DataFrame, most: int) -> DataFrame:
    """(a, b, score, same, o) of the open pairs (with na and nb, the offers that their entities had) that are offered, one
    after another. For at most FEW pairs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        had: tuple[dict, dict] = ({}, {})
        for df in batches:
            kept = []
            for a, b, same, na, nb in zip(df["a"], df["b"], df["same"], df["na"], df["nb"], strict=True):
                x, y = had[0].get(a, na), had[1].get(b, nb)
                kept.append(x < most and y < most)
                if kept[-1]:
                    more = most if same else 1
                    had[0][a], had[1][b] = x + more, y + more
            yield df.loc[kept, ["a", "b", "score", "same"]]

    kind = lambda c: left.schema[c].dataType.simpleString()
    found = left.select("a", "b", "score", "same", "na", "nb", "o").repartition(1).sortWithinPartitions("o").drop("o").mapInPandas(run, f"a {kind('a')}, b {kind('b')}, score {kind('score')}, same boolean")
    return found.withColumn("o", F.struct((-F.col("score")).alias("s"), "a", "b"))


def one_to_one(scored: DataFrame, name: str = "assign") -> DataFrame:
    """(a, b, score): greedy assignment by descending score, ties by a, then b. Each round takes all pairs that come first
    in this order among the pairs of both their sides (which is what a sequential scan would take) and drops what they
    touch; the last FEW pairs are scanned."""
    scratch = Scratch(scored.sparkSession, name)
    rows = scored.where("a is not null and b is not null and score is not null").groupBy("a", "b").agg(F.max("score").alias("score"))
    left = scratch.write(rows.withColumn("o", F.struct((-F.col("score")).alias("s"), "a", "b")))
    taken: list[DataFrame] = []
    while left.count() > FEW:
        first = lambda side, name: left.groupBy(side).agg(F.min("o").alias(name))  # noqa: E731, B023
        chosen = scratch.write(left.join(first("a", "oa"), "a").join(first("b", "ob"), "b").where("o = oa and o = ob").select("a", "b", "score", "o"))
        taken.append(chosen)
        after = scratch.write(left.join(chosen.select("a"), "a", "left_anti").join(chosen.select("b"), "b", "left_anti"))
        scratch.drop(left)
        left = after
    none = {"same": F.lit(False), "na": F.lit(0), "nb": F.lit(0)}
    out = scratch.write(_in_order(left.withColumns(none), 1).select("a", "b", "score"))
    for t in taken:
        out = out.unionByName(t.select("a", "b", "score"))
    return out


def _first_free(rows: DataFrame) -> DataFrame:
    """(a, b): the assignment of `one_to_one_by_value` for at most FEW rows (id, v, right): the left ones in order take the
    first free right one that has one of their values."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lists: dict = {}
        at: dict = {}
        gone: set = set()
        done = None
        values: list = []

        def take(a) -> list:  # noqa: ANN001
            found = []
            for v in values:
                mine, k = lists.get(v, ()), at.get(v, 0)
                while k < len(mine) and mine[k] in gone:
                    k += 1
                at[v] = k
                if k < len(mine):
                    found.append(mine[k])
            if not found:
                return []
            gone.add(min(found))
            return [(a, min(found))]

        for df in batches:
            kept = []
            for x, v, right in zip(df["id"].tolist(), df["v"].tolist(), df["right"].tolist(), strict=True):
                if right:
                    lists.setdefault(v, []).append(x)
                    continue
                if x != done:
                    kept += take(done)
                    done, values = x, []
                values.append(v)
            yield pd.DataFrame(kept, columns=["a", "b"])
        yield pd.DataFrame(take(done), columns=["a", "b"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "v", "right").repartition(1).sortWithinPartitions(F.desc("right"), "id").mapInPandas(run, f"a {kind}, b {kind}")


def one_to_one_by_value(left: DataFrame, right: DataFrame, name: str = "assign") -> DataFrame:
    """(a, b, score): what `one_to_one` takes of all pairs of a left and a right entity (id, v) that share a value, with the
    score 1, without making the pairs: a value that n and m entities have would make n x m.

    Each round drops values that one side has no more, takes the pairs that come first for both their sides and, of each
    value, the n-th left with the n-th right entity as far as all up to them have no other value; a value that many
    have is one round that way. The last FEW rows are looked through in order. Ranks are two-level running totals, so no
    task sees all entities of a value."""
    scratch = Scratch(left.sparkSession, name)
    rows = left.select("id", "v", F.lit(False).alias("right")).union(right.select("id", "v", F.lit(True))).where("id is not null and v is not null").distinct()

    def shared(rows: DataFrame) -> DataFrame:
        sides = rows.groupBy("v").agg(F.min("right").alias("low"), F.max("right").alias("high")).where("low <> high").select("v")
        return rows.join(sides, "v", "left_semi")

    rows = scratch.write(shared(rows))
    taken: list[DataFrame] = []
    while (size := rows.count()) > FEW:
        parts = max(8, size // 100_000)
        values = rows.groupBy("id", "right").agg(F.count("*").alias("values"))
        placed = rows.join(values, ["id", "right"]).repartitionByRange(parts, "v", "right", "id").withColumn("part", F.spark_partition_id())
        ranked = scratch.write(running_total(scratch.write(placed), ["v", "right"], [F.col("id")], F.col("part"), F.lit(1), "rank"))
        # Of each value: the first on both sides, and the least rank of an entity with other values.
        of = lambda c: F.min(F.when(c, F.col("id")))
        heads = scratch.write(ranked.groupBy("v").agg(of(~F.col("right")).alias("a"), of(F.col("right")).alias("b"), F.min(F.when(F.col("values") > 1, F.col("rank"))).alias("stop")))
        side = lambda x: ranked.where(F.col("right") == x).join(heads, "v")  # noqa: E731, B023
        best = [side(False).groupBy(F.col("id").alias("a")).agg(F.min("b").alias("b")), side(True).groupBy(F.col("id").alias("b")).agg(F.min("a").alias("a"))]
        only = [side(x).where("stop is null or rank < stop").select(F.col("id").alias(c), "v", "rank") for x, c in ((False, "a"), (True, "b"))]
        chosen = scratch.write(best[0].join(best[1], ["a", "b"]).select("a", "b").union(only[0].join(only[1], ["v", "rank"]).select("a", "b")).distinct())
        taken.append(chosen)
        gone = chosen.select(F.col("a").alias("id"), F.lit(False).alias("right")).union(chosen.select("b", F.lit(True)))
        after = scratch.write(shared(rows.join(gone, ["id", "right"], "left_anti")))
        scratch.drop(rows, ranked, heads)
        rows = after
    out = scratch.write(_first_free(rows))
    for t in taken:
        out = out.union(t)
    return out.select("a", "b", F.lit(1.0).alias("score"))


def attempts_within(scored: DataFrame, most: int = 3, cap: int | None = 500, name: str = "attempts") -> DataFrame:
    """(a, b, score): the pairs that are offered for a decision in descending order of score (ties by a, then b), each entity
    at most `most` times, and at most `cap` pairs in all (the length of a session). A pair that is passed over because
    one of its entities had its offers counts for neither. Where `scored` has a column `same`, a pair of which it is true is
    accepted when it is offered, and neither of its entities is offered again.

    Each round offers all pairs that are sure: were all open pairs before it offered, there would still be an offer left on
    both sides. The first open pair always is. Open pairs behind the cap-th offer can't be among the first ones. The last
    FEW pairs are looked through in order."""
    scratch = Scratch(scored.sparkSession, name)
    same = F.coalesce("same", F.lit(False)) if "same" in scored.columns else F.lit(False)
    rows = scored.where("a is not null and b is not null and score is not null").groupBy("a", "b").agg(F.max("score").alias("score"), F.max(same).alias("same"))
    left = scratch.write(rows.select("a", "b", "score", "same", F.struct((-F.col("score")).alias("s"), "a", "b").alias("o"), F.lit(0).alias("na"), F.lit(0).alias("nb")))
    offered = scratch.write(left.limit(0).select("a", "b", "score", "same", "o"))
    while left.count() > FEW:
        # Rows behind the first few of an entity are dropped before the shuffle (a group limit).
        def sure(side: str) -> DataFrame:
            order = Window.partitionBy(side).orderBy("o")
            few = left.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most)  # noqa: B023
            barred = F.max("same").over(order.rowsBetween(Window.unboundedPreceding, -1))
            return few.withColumn("barred", F.coalesce(barred, F.lit(False))).where(~F.col("barred") & (F.col("r") + F.col("n" + side) <= most))

        first, second = sure("a").select("a", "b", "score", "same", "o"), sure("b").select("a", "b")
        offered, before = scratch.write(offered.union(first.join(second, ["a", "b"]))), offered
        scratch.drop(before)
        counts = lambda side: offered.groupBy(side).agg(F.sum(F.when(F.col("same"), most).otherwise(1)).cast("int").alias("n" + side))  # noqa: E731, B023
        rest = left.drop("na", "nb").join(offered.select("a", "b"), ["a", "b"], "left_anti").join(counts("a"), "a", "left").join(counts("b"), "b", "left")
        rest = rest.select("a", "b", "score", "same", "o", F.coalesce("na", F.lit(0)).alias("na"), F.coalesce("nb", F.lit(0)).alias("nb")).where((F.col("na") < most) & (F.col("nb") < most))
        if cap is not None:
            last = offered.orderBy("o").limit(cap).agg(F.count("*").alias("n"), F.max("o").alias("last"))  # one row
            rest = rest.crossJoin(F.broadcast(last)).where((F.col("n") < cap) | (F.col("o") < F.col("last"))).drop("n", "last")
        left, before = scratch.write(rest), left
        scratch.drop(before)
    offered = scratch.write(offered.union(_in_order(left, most).select(*offered.columns)))
    done = offered if cap is None else offered.orderBy("o").limit(cap)
    return done.select("a", "b", "score")
