"""Reading recorded answers of validators: decisions on pairs, best candidates, categories.

The answers come as a table of texts; what is not recognised is null, so that a caller can fall back.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from synoptic.functions.text import without_tags

DECISIONS = ("same", "distinct", "narrow", "broad")
#: Words of free categories and the classes they mean.
CATEGORIES = {"ground observatory": "ground observatory", "observatory network": "ground observatory", "telescope": "telescope", "radio telescope": "telescope", "spacecraft": "spacecraft", "satellite": "spacecraft", "space mission": "investigation", "mission": "investigation", "airborne": "airborne", "balloon": "airborne", "survey": "survey", "instrument": "instrument"}


def decision(answer: Column) -> Column:
    """The first of same, distinct, narrow and broad that the answer names, outside tags."""
    return F.nullif(F.regexp_extract(F.lower(without_tags(answer)), r"\b(" + "|".join(DECISIONS) + r")\b", 1), F.lit(""))


def relation(kind: Column) -> Column:
    """The mapping relation of a decision."""
    names = {"same": "exactMatch", "narrow": "narrowMatch", "broad": "broadMatch", "distinct": "differentFrom"}
    return F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), kind)


def best_candidate(answer: Column) -> Column:
    """(at, why): the number of the candidate that is chosen and the text behind it; null where none is."""
    text = without_tags(answer)
    at = F.nullif(F.regexp_extract(text, r"(?i)\b(?:match|candidate|index)\D{0,12}?(\d+)", 1), F.lit("")).cast("int")
    why = F.trim(F.regexp_extract(text, r"(?is)\b(?:match|candidate|index)\D{0,12}?\d+[\s.,:;-]*(.*)$", 1))
    return F.when(at.isNotNull(), F.struct(at.alias("at"), why.alias("why")))


def category(answer: Column) -> Column:
    """The class of a free category; "ufo" where it is none of those known."""
    low = F.trim(F.regexp_replace(F.lower(without_tags(answer)), r"[^a-z ]", " "))
    exact = F.element_at(F.create_map(*[F.lit(x) for kv in CATEGORIES.items() for x in kv]), low)
    named = sorted(CATEGORIES, key=len, reverse=True)
    found = F.nullif(F.regexp_extract(low, r"\b(" + "|".join(named) + r")\b", 1), F.lit(""))
    return F.coalesce(exact, F.element_at(F.create_map(*[F.lit(x) for kv in CATEGORIES.items() for x in kv]), found), F.lit("ufo"))
