"""Joins that link entities: by identifiers, by labels, by unambiguous keys, and repairs of references.

Any of several values may agree: values are exploded, brought to one form, joined by equality and made distinct, so no
plan has a nested loop over OR. Null keys match nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synoptic.operators.nearby import haversine_km, near_cells, own_cell, position, usable
from synoptic.operators.synsets import synsets
from synoptic.runtime import Scratch


#: Words for "no identifier", lower case.
NO_IDENTIFIER = ("n/a", "na", "n.a", "none", "null", "nil", "nan", "unknown", "undefined", "unspecified", "not available", "not applicable", "no identifier", "no id", "missing", "tbd", "void")


def _form(c: Column) -> Column:
    return F.lower(F.trim(c))


def exploded(rows: DataFrame, key: str, value: str, field: str) -> DataFrame:
    """(id, v, field) of a column of one or many values."""
    many = rows.schema[value].dataType.typeName() == "array"
    return rows.select(F.col(key).alias("id"), (F.explode(value) if many else F.col(value)).alias("v"), F.lit(field).alias("field")).where("v is not null")


def merge_on(left: DataFrame, left_key: str, left_attr: str, right: DataFrame, right_key: str, right_attr: str, linked: DataFrame | None = None) -> DataFrame:
    """(a, b): entities with a value in common, without case and surrounding blanks. `linked` (a, b): entities that are in
    it take no part."""
    one = exploded(left, left_key, left_attr, left_attr).select(F.col("id").alias("a"), _form(F.col("v")).alias("v"))
    two = exploded(right, right_key, right_attr, right_attr).select(F.col("id").alias("b"), _form(F.col("v")).alias("v"))
    if linked is not None:
        one, two = one.join(linked.select("a").distinct(), "a", "left_anti"), two.join(linked.select("b").distinct(), "b", "left_anti")
    return one.where("v <> ''").join(two, "v").select("a", "b").distinct()


def labels_of(rows: DataFrame, key: str, label: str = "label", alt: str = "alt_label") -> DataFrame:
    """(id, v, field) of all labels, lower case."""
    return exploded(rows, key, label, label).union(exploded(rows, key, alt, alt)).select("id", _form(F.col("v")).alias("v"), "field").distinct()


def matched_labels(left: DataFrame, left_key: str, least: int = 5) -> DataFrame:
    """(id, v, field): the labels of the left side that `label_matches` takes."""
    return labels_of(left, left_key).where(F.length("v") >= least)


def label_matches(left: DataFrame, left_key: str, right: DataFrame, right_key: str, least: int = 5) -> DataFrame:
    """(a, b, field_a, field_b): the same label or alternative label, the left one of `least` characters or more."""
    one = matched_labels(left, left_key, least).select(F.col("id").alias("a"), "v", F.col("field").alias("field_a"))
    two = labels_of(right, right_key).select(F.col("id").alias("b"), "v", F.col("field").alias("field_b"))
    return one.join(two, "v").groupBy("a", "b").agg(F.min("field_a").alias("field_a"), F.min("field_b").alias("field_b"))


def unambiguous_join(left: DataFrame, left_key: str, left_attr: str, right: DataFrame, right_key: str, right_attr: str, fallback: list[tuple[str, str]] | None = None) -> DataFrame:
    """(a, b): by keys that only one right entity has. Where a key is ambiguous, left entities with that key are joined by
    the (left, right) attributes of `fallback` instead, to the right entities that bear it."""
    two = exploded(right, right_key, right_attr, right_attr).select(F.col("id").alias("b"), _form(F.col("v")).alias("v")).where("v <> ''").distinct()
    one = exploded(left, left_key, left_attr, left_attr).select(F.col("id").alias("a"), _form(F.col("v")).alias("v")).distinct()
    bearers = two.groupBy("v").agg(F.min("b").alias("b"), F.max("b").alias("other"))
    found = one.join(bearers.where("b = other").select("v", "b"), "v").select("a", "b").distinct()
    if not fallback:
        return found
    unsure = bearers.where("b <> other").select("v")
    few_left = left.join(one.join(unsure, "v").select(F.col("a").alias(left_key)).distinct(), left_key, "left_semi")
    few_right = right.join(two.join(unsure, "v").select(F.col("b").alias(right_key)).distinct(), right_key, "left_semi")
    for mine, theirs in fallback:
        found = found.union(merge_on(few_left, left_key, mine, few_right, right_key, theirs))
    return found.distinct()


def not_equivalent(rows: DataFrame, key: str, linked: DataFrame, side: str) -> DataFrame:
    """Entities without a link."""
    return rows.join(linked.select(F.col(side).alias(key)).distinct(), key, "left_anti")


def reciprocal(edges: DataFrame, src: str, dst: str, known: DataFrame | None = None, name: str = "id") -> DataFrame:
    """(src, dst, relation): each part link from both sides, without loops on a node; with `known` only between known ids."""
    both = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"), F.lit("is_part_of").alias("relation"))
    both = both.union(both.select("dst", "src", F.lit("has_part"))).where("src is not null and dst is not null and src <> dst").distinct()
    if known is None:
        return both
    ids = known.select(F.col(name).alias("k")).distinct()
    return both.join(ids, F.col("src") == F.col("k"), "left_semi").join(ids, F.col("dst") == F.col("k"), "left_semi")


def placeholders(references: DataFrame, ref: str, known: DataFrame, name: str) -> DataFrame:
    """(uri, label, entity_type) for references that lead nowhere: label and class from the last two parts of the id."""
    missing = references.select(F.trim(F.col(ref)).alias("uri")).where("uri is not null and uri <> ''").distinct().join(known.select(F.col(name).alias("uri")), "uri", "left_anti")
    parts = F.split("uri", "[:/]")
    return missing.select("uri", F.replace(F.element_at(parts, -1), F.lit("-"), F.lit(" ")).alias("label"), F.when(F.size(parts) > 1, F.element_at(parts, F.when(F.size(parts) > 1, F.lit(-2)).otherwise(F.lit(-1)))).alias("entity_type"))


def rewritten(edges: DataFrame, merged: DataFrame) -> DataFrame:
    """Edges (src, dst) with merged ids (old, new) replaced, loops and repeats dropped."""
    one, two = merged.select(F.col("old").alias("src"), F.col("new").alias("s")), merged.select(F.col("old").alias("dst"), F.col("new").alias("d"))
    return edges.join(one, "src", "left").join(two, "dst", "left").select(F.coalesce("s", "src").alias("src"), F.coalesce("d", "dst").alias("dst")).where("src <> dst").distinct()


def restored(references: DataFrame, ref: str, names: DataFrame) -> DataFrame:
    """References with old codes (old, new) replaced by the new key, the others kept."""
    one = names.groupBy(F.col("old").alias(ref)).agg(F.min("new").alias("new"))
    return references.join(one, ref, "left").withColumn(ref, F.coalesce("new", ref)).drop("new")


def restored_links(references: DataFrame, key: str, ref: str, names: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """(src, dst, relation): part links by restored references, from both sides; links that lead to no known key are left
    out."""
    return reciprocal(restored(references, ref, names), key, ref, known, name)


def excluded(rows: DataFrame, key: str, exclusions: list[DataFrame]) -> DataFrame:
    """Rows whose key is in none of the exclusions (key)."""
    for e in exclusions:
        rows = rows.join(e.select(key).distinct(), key, "left_anti")
    return rows


def closed(edges: DataFrame, src: str, dst: str, name: str = "closure") -> DataFrame:
    """(src, dst): everything that is reached in one step or more. Paths double in each round."""
    scratch = Scratch(edges.sparkSession, name)
    paths = scratch.write(edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(src, dst).distinct())
    size = paths.count()
    while True:
        onward = paths.select(F.col(src).alias(dst), F.col(dst).alias("__far"))
        longer = scratch.write(paths.union(paths.join(onward, dst).select(src, F.col("__far").alias(dst))).distinct())
        scratch.drop(paths)
        paths, before, size = longer, size, longer.count()
        if size == before:
            return paths


def _key(*values: Column) -> Column:
    """Values as one short key (96 bits), null if one of them is."""
    stated = reduce(lambda x, y: x & y, (v.isNotNull() for v in values))
    return F.when(stated, F.struct(F.xxhash64(*values).alias("h"), F.hash(*values).alias("g")))


def star_links(rows: DataFrame, block: list[str]) -> DataFrame:
    """(a, b): links that join what all pairs of a block would join, of rows (id, guard, free, block columns): a pair is left
    out if both state a guard and differ in it, and at least one of the two must be free. As many links as rows at most,
    and one for each guard of a block."""
    first = lambda w: F.min(F.when(w, F.col("id")))
    null = F.col("guard").isNull()
    # A free row without a guard goes with all others. Else a free row joins those of its guard and all without one.
    blocks = rows.groupBy(*block).agg(first(null & F.col("free")).alias("center"), first(null).alias("open"), first(F.col("free")).alias("any"), F.min("id").alias("low"), F.max("id").alias("high")).where("low < high and any is not null").drop("low", "high")
    met = rows.select("id", "guard", "free", *block).join(blocks, block)
    apart = met.where("center is null")
    guards = apart.where("guard is not null").groupBy(*block, "guard").agg(first(F.col("free")).alias("own"), F.first("open").alias("open")).where("own is not null")
    links = met.where("center is not null").select(F.col("center").alias("a"), F.col("id").alias("b"))
    links = links.union(apart.where(null).select(F.col("any").alias("a"), F.col("id").alias("b")))
    links = links.union(apart.join(guards.drop("open"), [*block, "guard"]).select(F.col("own").alias("a"), F.col("id").alias("b")))
    links = links.union(guards.where("open is not null").select(F.col("own").alias("a"), F.col("open").alias("b")))
    return links.where("a <> b").distinct()


def self_merge(rows: DataFrame, km: float = 4.0, name: str = "self_merge") -> DataFrame:
    """(id, group): the records of groups of two or more that are the same, group being the least id. `rows` has id, kind,
    ids (identifiers, old and new), guard (the identifier that may not differ), number (of its name), labels, leaf (the
    last part of its address), latitude, longitude and start.

    Two records of one kind are the same if they share an identifier; or if they have the same number, the first word of a
    label in common and no different guard, and share the leaf, lie within `km` of one another (which decides if both
    have a place), start on the same day (if they do not), or share a label. Every way to agree is an equi-join and gives
    links to a representative, except places, which are paired in cells of a grid within a block. Texts are read once, to
    short keys."""
    scratch = Scratch(rows.sparkSession, name)
    stated = rows.where("id is not null").withColumn("kind", F.coalesce("kind", F.lit("")))
    low = lambda c: F.lower(F.replace(c, F.lit("-"), F.lit(" ")))
    first = F.array_distinct(F.filter(F.transform("labels", lambda v: F.split(v, r"[-. ]")[0]), lambda w: w != ""))
    placed = usable(F.col("latitude"), F.col("longitude"))
    words = stated.select("*", F.explode(first).alias("word"))
    block = lambda *v: _key(F.col("kind"), F.col("number"), F.col("word"), *v)
    ways = F.concat(
        F.array(F.struct(block(F.lit("leaf"), F.nullif("leaf", F.lit(""))).alias("k"), F.lit(True).alias("free")), F.struct(block(F.lit("start"), F.col("start").cast("string")).alias("k"), (~placed).alias("free"))),
        F.transform(F.array_distinct(F.transform("labels", low)), lambda v: F.struct(block(F.lit("label"), F.nullif(v, F.lit(""))).alias("k"), F.lit(True).alias("free"))),
    )
    facts = scratch.write(words.select("id", F.when(F.col("guard").isNotNull(), F.xxhash64("guard")).alias("guard"), block().alias("block"), ways.alias("ways"), F.when(placed, F.col("latitude")).alias("la"), F.when(placed, F.col("longitude")).alias("lo")))
    ways_of = facts.select("id", "guard", F.explode("ways").alias("w")).where("w.k is not null").select("id", "guard", "w.free", "w.k.h", "w.k.g")

    at = facts.where("la is not null").select("block", "guard", "id", "la", "lo")
    several = at.groupBy("block").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x < y").select("block")
    at = scratch.write(at.join(several, "block", "left_semi"))
    wide, edge = km * 1.01, km * 16
    here = at.select("block", F.col("guard").alias("guard2"), F.col("id").alias("b"), F.col("la").alias("la2"), F.col("lo").alias("lo2"), *position(F.col("la"), F.col("lo"))).withColumn("cell", own_cell(edge)).drop("x", "y", "z")
    there = near_cells(at.select("*", *position(F.col("la"), F.col("lo"))), wide, edge).drop("x", "y", "z")
    near = there.join(here, ["block", "cell"]).where((F.col("id") < F.col("b")) & F.coalesce(F.col("guard") == F.col("guard2"), F.lit(True)) & (haversine_km(F.col("la"), F.col("lo"), F.col("la2"), F.col("lo2")) < km))
    edges = reduce(DataFrame.union, [identifier_links(stated, "id", ["kind"], ["ids"]), star_links(ways_of, ["h", "g"]), near.select("id", "b")])
    edges = scratch.write(edges.toDF("src", "dst").distinct())
    return synsets(edges, name).select("id", F.col("synset_id").alias("group"))


def merge_within(rows: DataFrame, host: str, values: list[str], name: str = "merge_within") -> DataFrame:
    """(id, group): rows (id, host, values) of one host that share one of the values, of one or many each: instruments of a
    platform with a label or a file name in common."""
    stated = rows.where(F.col("id").isNotNull() & F.col(host).isNotNull())
    edges = []
    for c in values:
        one = exploded(stated.select(F.struct("id", host).alias("k"), c), "k", c, c).select(F.col("id.id").alias("id"), F.col(f"id.{host}").alias("h"), _form(F.col("v")).alias("v")).where("v <> ''").distinct()
        least = one.groupBy("h", "v").agg(F.min("id").alias("src"))
        edges.append(one.join(least, ["h", "v"]).select("src", F.col("id").alias("dst")))
    return synsets(reduce(DataFrame.union, edges).where("src <> dst").distinct(), name).select("id", F.col("synset_id").alias("group"))


def identifier_links(rows: DataFrame, key: str, block: list[str], ids: list[str]) -> DataFrame:
    """(a, b), a < b: rows of one block that share any identifier, whatever their names, as links from the least key of an
    identifier to each other one, so that an identifier of many rows gives as many links as it has rows."""
    stated = reduce(DataFrame.union, [rows.select(F.col(key).alias("b"), *block, F.explode(F.col(c) if rows.schema[c].dataType.typeName() == "array" else F.array(c)).alias("v")) for c in ids])
    stated = stated.withColumn("v", _form(F.col("v"))).where(F.col("b").isNotNull() & F.col("v").rlike("[a-z0-9]") & ~F.col("v").isin(*NO_IDENTIFIER))
    keyed = stated.select("b", _key(F.col("v"), *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in block]).alias("k")).select("b", "k.h", "k.g")
    least = keyed.groupBy("h", "g").agg(F.min("b").alias("a"), F.max("b").alias("last")).where("a < last").drop("last")
    return keyed.join(least, ["h", "g"]).where("a < b").select("a", "b").distinct()


def in_list(pairs: DataFrame, column: str, members: DataFrame, source: str) -> DataFrame:
    """`pairs` with the ids of a column replaced by the synonym (the least, of several) that belongs to a list; an id without
    one stays. `members` has id, synset_id and source."""
    own = members.where(F.col("source") == source).groupBy("synset_id").agg(F.min("id").alias("__own"))
    swap = members.select(F.col("id").alias(column), "synset_id").distinct().join(own, "synset_id").groupBy(column).agg(F.min("__own").alias("__own"))
    return pairs.join(swap, column, "left").withColumn(column, F.coalesce("__own", column)).drop("__own")


def related(pairs: DataFrame, src: str, dst: str, relation: str, inverse: str) -> DataFrame:
    """(src, dst, relation) with the inverse of each."""
    out = pairs.select(F.col(src).alias("src"), F.col(dst).alias("dst"), F.lit(relation).alias("relation"))
    return out.union(out.select("dst", "src", F.lit(inverse))).distinct()


def mapped_either_way(pairs: DataFrame, mappings: DataFrame, one: str, two: str, a: str = "a", b: str = "b") -> DataFrame:
    """`pairs` with `mapped`: whether a mapping (a, b) relates them, in either direction."""
    known = mappings.select(F.least(a, b).alias("__x"), F.greatest(a, b).alias("__y"), F.lit(True).alias("mapped")).distinct()
    found = pairs.withColumns({"__x": F.least(one, two), "__y": F.greatest(one, two)}).join(known, ["__x", "__y"], "left")
    return found.drop("__x", "__y").withColumn("mapped", F.coalesce("mapped", F.lit(False)))


def confusion(found: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """(tp, fp, fn, tn): pairs that are found held against annotated ones. `gold` has the keys and yes and no, the votes for
    and against; as many of both, or none, leaves a pair out. A found pair that nobody annotated counts as wrong."""
    judged = gold.groupBy(*keys).agg(F.sum("yes").alias("__y"), F.sum("no").alias("__n"))
    both = found.select(*keys).distinct().withColumn("__m", F.lit(True)).join(judged, keys, "full")
    hit, right, wrong = F.col("__m").isNotNull(), F.col("__y") > F.col("__n"), F.col("__n") > F.col("__y")
    unknown = F.col("__y").isNull()
    return both.agg(F.count(F.when(hit & right, 1)).alias("tp"), F.count(F.when(hit & (wrong | unknown), 1)).alias("fp"), F.count(F.when(~hit & right, 1)).alias("fn"), F.count(F.when(~hit & wrong, 1)).alias("tn"))
