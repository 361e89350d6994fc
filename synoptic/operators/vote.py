"""Votes over the values of a group, and golden records made of them."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def majority(rows: DataFrame, group: list[str], value: str, lang: str | None = None) -> DataFrame:
    """(group, value, votes): the most frequent value; of equals the longest, then the greatest. With `lang`, English and
    untagged values go before others. Votes are counted with partial aggregation."""
    preferred = F.coalesce(F.col(lang).startswith("en"), F.lit(True)) if lang else F.lit(True)
    counted = rows.where(F.col(value).isNotNull()).withColumn("__p", preferred).groupBy(*group, F.col(value).alias("value")).agg(F.count("*").alias("votes"), F.max("__p").alias("__p"))
    best = F.max_by(F.struct("value", "votes"), F.struct("__p", "votes", F.length(F.col("value").cast("string")), "value"))
    return counted.groupBy(*group).agg(best.alias("b")).select(*group, "b.value", "b.votes")


def rounded_majority(votes: list[tuple[float, int]]) -> float | None:
    """The vote of rounded numbers (value, how often): values, each with the first cluster that holds one it equals at the
    coarser precision of the two; of the largest cluster the one with the most digits, then the greatest. The order of
    values counts. Clusters are found by their values rounded to each precision, so that work grows with the number of
    different values, not with its square."""
    clusters: list[list] = []  # votes, best value
    exact: dict[int, dict[float, int]] = {}
    rounded: dict[tuple[int, float], int] = {}
    for v, n in votes:
        if v is None or v != v:
            continue
        places = len(repr(v).split(".")[-1])
        met = [c for q, own in exact.items() if q <= places and (c := own.get(round(v, q))) is not None]
        if (c := rounded.get((places, round(v, places)))) is not None:
            met.append(c)
        home = min(met, default=len(clusters))
        if home == len(clusters):
            clusters.append([0, v])
        size, best = clusters[home]
        clusters[home] = [size + n, max(best, v, key=lambda x: (len(repr(x)), x))]
        # The first cluster that has a value keeps it.
        exact.setdefault(places, {}).setdefault(round(v, places), home)
        own = exact[places]
        own[round(v, places)] = min(own[round(v, places)], home)
        for p in range(places):
            key = (p, round(v, p))
            rounded[key] = min(rounded.get(key, home), home)
    return max(clusters, key=lambda c: c[0])[1] if clusters else None


@F.pandas_udf(T.DoubleType())
def rounded_vote(votes: pd.Series) -> pd.Series:
    return votes.map(lambda vs: rounded_majority([(v["v"], v["n"]) for v in vs]), na_action="ignore").astype("float64")


def majority_numbers(rows: DataFrame, group: list[str], value: str, order: str) -> DataFrame:
    """(group, value) by `rounded_majority`. Equal numbers of a group are counted first, so that a group is as large as
    its different numbers; votes are then cast in the order of first mention."""
    counted = rows.where(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*group, value).agg(F.count("*").alias("__n"), F.min(order).alias("__o"))
    lists = counted.groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(F.struct("__o", value, "__n"))), lambda x: F.struct(x[value].alias("v"), x["__n"].alias("n"))).alias("__l"))
    return lists.select(*group, rounded_vote("__l").alias("value"))


def majority_dates(rows: DataFrame, group: list[str], date: str) -> DataFrame:
    """(group, dates): the dates of the most frequent years; those with a month and a day other than the first, if any."""
    dated = rows.where(F.col(date).isNotNull()).withColumn("__y", F.year(date)).groupBy(*group, "__y").agg(F.count("*").alias("n"), F.array_sort(F.collect_set(date)).alias("all"))
    most = dated.groupBy(*group).agg(F.max("n").alias("n"))
    kept = dated.join(most, [*group, "n"]).groupBy(*group).agg(F.array_sort(F.flatten(F.collect_list("all"))).alias("all"))
    precise = F.filter("all", lambda d: (F.month(d) != 1) & (F.dayofmonth(d) != 1))
    return kept.select(*group, F.when(F.size(precise) > 0, precise).otherwise(F.col("all")).alias("dates"))


def most_recent(date: Column) -> Column:
    """The latest of dates or of ISO texts; texts are compared in UTC, one without a zone is taken as such (the session's
    zone), one that is no date is left out."""
    return F.max(F.try_to_timestamp(date.cast("string")))


def values_with_sources(rows: DataFrame, group: list[str], value: str, source: str) -> DataFrame:
    """(group, value, prov, mentions): each value once, with all its sources."""
    return rows.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias("value")).agg(F.array_sort(F.collect_set(source)).alias("prov"), F.count("*").alias("mentions"))


def golden(records: DataFrame, group: str, source: str, label: str, numbers: dict[str, str], dates: list[str], texts: list[str], order: str, place: tuple[str, str, str] | None = None, trusted: str | None = None, ids: list[str] | None = None) -> DataFrame:
    """One row for each group: the label and all labels, voted numbers, dates of the most frequent years, all texts, all
    identifiers, and the place.

    The label is that of the `trusted` source (the least, of several), else the vote among labels that are none of the
    group's identifiers, else among all. `place` names latitude, longitude and confidence: the records of the highest
    confidence vote on it. `numbers` maps each number to the order in which its votes are cast."""
    labels = records.where(F.col(label).isNotNull())
    named = labels
    if ids:
        known = [records.where(F.col(c).isNotNull()).select(group, F.col(c).cast("string").alias(label)) for c in ids]
        plain = labels.join(reduce(DataFrame.union, known).distinct(), [group, label], "left_anti")
        named = plain.unionByName(labels.join(plain.select(group).distinct(), group, "left_anti"))
    out = majority(named, [group], label).select(group, F.col("value").alias("label"), "votes")
    if trusted:
        own = labels.where(F.col(source) == trusted).groupBy(group).agg(F.min(label).alias("__own"))
        out = out.join(own, group, "left").withColumn("label", F.coalesce("__own", "label")).drop("__own")
    out = out.join(labels.groupBy(group).agg(F.array_sort(F.collect_set(label)).alias("labels"), F.array_sort(F.collect_set(source)).alias("sources")), group, "full")
    for n, o in numbers.items():
        out = out.join(majority_numbers(records, [group], n, o).withColumnRenamed("value", n), group, "full")
    for d in dates:
        out = out.join(majority_dates(records, [group], d).withColumnRenamed("dates", d), group, "full")
    for t in [*texts, *(ids or [])]:
        out = out.join(records.where(F.col(t).isNotNull()).groupBy(group).agg(F.array_sort(F.collect_set(t)).alias(t)), group, "full")
    if place:
        lat, lon, sure = place
        placed = records.where(F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon))
        best = placed.groupBy(group).agg(F.max(sure).alias("__best"))
        kept = placed.join(best, group).where(F.col(sure).eqNullSafe(F.col("__best")))
        for c in (lat, lon):
            out = out.join(majority_numbers(kept, [group], c, order).withColumnRenamed("value", c), group, "full")
    return out


def merged_entity(older: dict[str, Column], newer: dict[str, Column]) -> dict[str, Column]:
    """The merge of two versions: the newer label, the older one among the alternative labels, sets united."""
    label = F.coalesce(newer["label"], older["label"])
    alts = F.array_union(F.coalesce(older["alt_label"], F.array().cast("array<string>")), F.coalesce(newer["alt_label"], F.array().cast("array<string>")))
    return {"label": label, "alt_label": F.array_sort(F.array_remove(F.array_compact(F.array_distinct(F.concat(alts, F.array(older["label"])))), label))}
