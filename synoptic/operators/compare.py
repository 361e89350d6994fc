"""Comparisons of two entities: filters that a pair must pass, and scores.

Filters are Column expressions over two values; missing data pass. Scores are null where they can't be computed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synoptic.functions.text import digit_score
from synoptic.model import types_compatible
from synoptic.operators.nearby import haversine_km, usable


def _empty(a: Column) -> Column:
    return F.coalesce(F.size(a) < 1, F.lit(True))


def type_filter(types1: Column, conf1: Column, types2: Column, conf2: Column) -> Column:
    """Classes must be compatible if both are certain."""
    return ~F.coalesce((conf1 == 1) & (conf2 == 1), F.lit(False)) | types_compatible(types1, types2)


def overlap_filter(a: Column, b: Column) -> Column:
    """Two arrays must share a value if both have some: years, identifiers, parents."""
    return _empty(a) | _empty(b) | F.coalesce(F.arrays_overlap(a, b), F.lit(False))


def date_filter(pairs: list[tuple[Column, Column]]) -> Column:
    """For each kind of date the years must overlap."""
    return reduce(lambda x, y: x & y, (overlap_filter(a, b) for a, b in pairs))


def years(dates: Column) -> Column:
    """The years of ISO dates, with their sign."""
    return F.array_distinct(F.filter(F.transform(dates, lambda d: F.nullif(F.regexp_extract(d, r"^\+?(-?\d{1,4})", 1), F.lit("")).cast("int")), lambda y: y.isNotNull()))


def distance_filter(lat1: Column, lon1: Column, lat2: Column, lon2: Column, places: list[tuple[Column, Column]], km: float = 10.0) -> Column:
    """Two usable positions decide by distance; else none of the places (continent, country, state) may differ."""
    both = usable(lat1, lon1) & usable(lat2, lon2)
    same = reduce(lambda x, y: x & y, (a.isNull() | b.isNull() | (a == b) for a, b in places), F.lit(True))
    return F.when(both, haversine_km(lat1, lon1, lat2, lon2) <= km).otherwise(same)


def number_filter(numbers1: Column, numbers2: Column) -> Column:
    """Suffix numbers of all labels: none on both sides, or one in common (0 is none)."""
    kept1, kept2 = F.array_remove(numbers1, 0), F.array_remove(numbers2, 0)
    return ((F.size(kept1) == 0) & (F.size(kept2) == 0)) | F.coalesce(F.arrays_overlap(kept1, kept2), F.lit(False))


def aperture_filter(a: Column, b: Column, tolerance: float = 0.05) -> Column:
    """Each size of the smaller set must be near one of the larger."""
    def within(few: Column, many: Column) -> Column:
        return F.forall(few, lambda x: F.exists(many, lambda y: F.abs(x - y) <= tolerance * F.greatest(x, y)))

    return _empty(a) | _empty(b) | F.when(F.size(a) <= F.size(b), within(a, b)).otherwise(within(b, a))


def broader_filter(parents1: Column, parents2: Column) -> Column:
    """Parents, given as the ids of their synsets, must overlap."""
    return overlap_filter(parents1, parents2)


FILTERS = {"type": type_filter, "date": date_filter, "distance": distance_filter, "identifier": overlap_filter, "number": number_filter, "aperture": aperture_filter, "same_broader": broader_filter}


def hybrid_score(parts: dict[str, tuple[Column, float]]) -> tuple[Column, Column]:
    """(score, scores): the weighted mean of the scores that could be computed, and a map of them."""
    stated = [(n, c, w) for n, (c, w) in parts.items()]
    top = sum((F.when(c.isNotNull(), c * w).otherwise(0.0) for _, c, w in stated), F.lit(0.0))
    weight = sum((F.when(c.isNotNull(), F.lit(w)).otherwise(0.0) for _, c, w in stated), F.lit(0.0))
    scores = F.map_filter(F.create_map(*[x for n, c, _ in stated for x in (F.lit(n), c.cast("double"))]), lambda _, v: v.isNotNull())
    return F.when(weight > 0, top / weight), scores


def threshold(score: Column, operator: str, value: float) -> Column:
    return {">=": score >= value, "<=": score <= value, "==": score == value, ">": score > value, "<": score < value}[operator]


def softmax(score: Column, over) -> Column:
    """A score's share among those of a window."""
    e = F.exp(score - F.max(score).over(over))
    return e / F.sum(e).over(over)


def high_scores(scored: DataFrame, score: str, deviations: float = 0.3, least: float = 0.6) -> DataFrame:
    """Rows whose logistic score is over mean + deviations * standard deviation of all; over `least` where all are alike."""
    soft = scored.withColumn("__s", 1 / (1 + F.exp(-F.col(score))))
    limits = soft.agg(F.avg("__s").alias("__m"), F.stddev_pop("__s").alias("__d"))
    return soft.crossJoin(F.broadcast(limits)).where(F.col("__s") >= F.when(F.col("__d") < 0.01, F.lit(least)).otherwise(F.col("__m") + deviations * F.col("__d"))).drop("__s", "__m", "__d")


digits = digit_score
