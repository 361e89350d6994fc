"""Published views: label warnings, hierarchical listings, name lookup, rewrites and triples."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synoptic.model import class_of, closure
from synoptic.runtime import Scratch

#: Agencies whose names should not be part of a label.
AGENCIES = ["NASA", "ESA", "JAXA", "CNES", "ISRO", "ESO", "NOAA", "CNSA"]

#: Classes that need not be part of anything.
NO_BROADER = ("ground observatory", "investigation", "airborne", "spacecraft", "ground facility")


def lint(entities: DataFrame) -> DataFrame:
    """(uri, warning, label): labels that need a look, of entities (uri, label, entity_type, apertures, country, parent: the
    label of the entity that it is part of, parent_type).

    duplicate label; agency in it, unless the parent's label has it too; an acronym of two to five capitals; of telescopes,
    a size in another unit than metres ("aperture format"), else a label that does not begin with the size ("aperture
    missing"); of facilities on the ground, a country that the label does not end with ("country mismatch"), or none
    ("country missing"); a platform as parent that the label does not name after "at" or "on" ("broader missing"); no
    parent where the class should have one ("orphan")."""
    shared = entities.where("label is not null").groupBy(F.lower("label").alias("l")).agg(F.count("*").alias("n")).where("n > 1").select("l", F.lit(True).alias("dup"))
    rows = entities.join(shared, F.lower("label") == F.col("l"), "left")
    kind, above = class_of(F.col("entity_type")), closure()
    below = lambda c: [k for k in sorted(above) if c in above[k]]
    label, parent = F.col("label"), F.coalesce("parent", F.lit(""))
    words = lambda names: r"\b(" + "|".join(names) + r")\b"
    agency = F.filter(F.regexp_extract_all(label, F.lit(words(AGENCIES)), 1), lambda a: ~F.contains(parent, a))
    capitals = F.filter(F.regexp_extract_all(label, F.lit(r"(?<!\p{Lu})(\p{Lu}{2,5})(?!\p{Lu})"), 1), lambda a: ~a.isin(AGENCIES))
    # The country's name without what follows a comma ("Korea, Republic of").
    country = F.split("country", ",")[0]
    country = F.when(F.col("country").contains(",") & (country == "Korea"), "South Korea").otherwise(F.trim(country))
    unit = label.rlike(r"(?i)\d ?(cm|inches|inch|mm|km|foot|feet)")
    started = label.rlike(r"^\d+(\.\d+)?m ")
    platform = class_of(F.col("parent_type")).isin(below("platform")) & (class_of(F.col("parent_type")) != "investigation")
    named = F.contains(label, F.concat(F.lit(" at "), parent)) | F.contains(label, F.concat(F.lit(" on "), parent))
    checks: list[tuple[str, Column]] = [
        ("duplicate", F.col("dup").isNotNull()),
        ("agency", F.size(agency) > 0),
        ("acronym", F.size(capitals) > 0),
        ("aperture format", (kind == "telescope") & ~started & unit),
        ("aperture missing", (kind == "telescope") & ~started & ~unit),
        ("country mismatch", kind.isin(below("ground facility")) & ~F.endswith(label, F.concat(F.lit(", "), country))),
        ("country missing", kind.isin("ground observatory", "ground facility") & F.col("country").isNull()),
        ("broader missing", F.col("parent").isNotNull() & platform & ~named),
        ("orphan", F.col("parent").isNull() & ~F.coalesce(kind, F.lit("")).isin(*NO_BROADER)),
    ]
    flags = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks]), lambda x: x.isNotNull())
    return rows.where(label.isNotNull()).select("uri", F.explode(flags).alias("warning"), "label").distinct()


def levels(edges: DataFrame, nodes: DataFrame, most: int | None = None) -> DataFrame:
    """(id, label, level, path): nodes (id, label) below the roots by their first parent (src is part of dst). Nodes on loops,
    and below, are roots at the end: level 0 with their own path. With `most` nodes deeper than that are left out. One
    round a level; `hierarchy` takes few rounds for deep trees."""
    first = edges.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("up"))
    labelled = nodes.groupBy("id").agg(F.min("label").alias("label")).join(first, "id", "left")
    known = labelled.select(F.col("id").alias("k"))
    labelled = labelled.join(known, F.col("up") == F.col("k"), "left").withColumn("up", F.col("k")).drop("k")
    scratch = Scratch(edges.sparkSession, "levels")
    labelled = scratch.write(labelled)
    front = scratch.write(labelled.where("up is null").select("id", "label", F.lit(0).alias("level"), F.array("label").alias("names")))
    out = front
    for depth in count(1):
        above = front.select(F.col("id").alias("up"), F.col("names").alias("above"))
        front = scratch.write(labelled.join(above, "up").select("id", "label", F.lit(depth).alias("level"), F.concat("above", F.array("label")).alias("names")))
        if not front.limit(1).count():
            break
        out = out.union(front)
    rest = labelled.join(out.select("id"), "id", "left_anti").select("id", "label", F.lit(0).alias("level"), F.array("label").alias("names"))
    out = out.union(rest).select("id", "label", "level", F.array_join("names", " > ", "").alias("path"))
    return out if most is None else out.where(F.col("level") <= most)


def name_lookup(labels: DataFrame) -> DataFrame:
    """(term, names): from (term, label, preferred) the preferred label, then the others in order."""
    one = labels.where("term is not null and label is not null").groupBy("term", "label").agg(F.max("preferred").alias("preferred"))
    listed = F.array_sort(F.collect_list(F.struct((~F.col("preferred")).alias("after"), "label")))
    return one.groupBy("term").agg(F.transform(listed, lambda x: x["label"]).alias("names"))


def collapsed(labels: DataFrame, key: str, form: Column) -> DataFrame:
    """(old, new): ids with the same form of label, and the smallest of them."""
    formed = labels.select(F.col(key).alias("old"), form.alias("form")).where("form is not null and form <> ''").distinct()
    return formed.join(formed.groupBy("form").agg(F.min("old").alias("new")), "form").where("old <> new").groupBy("old").agg(F.min("new").alias("new"))


def in_namespace(column: str, old: str, new: str) -> Column:
    """An address moved from one prefix to another."""
    return F.when(F.col(column).startswith(old), F.concat(F.lit(new), F.substring(column, len(old) + 1, 1 << 30))).otherwise(F.col(column))


def entity_text(attributes: DataFrame, limit: int = 512, exclude: tuple[str, ...] = ()) -> DataFrame:
    """(uri, text): label, alternative labels, then the other attributes by name, each cut at `limit` characters (the
    stated length of a prompt's field)."""
    order = F.when(F.col("attr") == "label", 0).when(F.col("attr") == "alt_label", 1).otherwise(2)
    rows = attributes.where(F.col("value").isNotNull() & ~F.col("attr").isin(*exclude)).select("uri", order.alias("o"), "attr", "value").distinct()
    per = rows.groupBy("uri", "o", "attr").agg(F.substring(F.array_join(F.array_sort(F.collect_list("value")), ", "), 1, limit).alias("v"))
    return per.groupBy("uri").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "attr", "v"))), lambda x: F.concat(x["attr"], F.lit(": "), x["v"])), "; ").alias("text"))


def corpus(attributes: DataFrame, langs: tuple[str, ...] = ("en",)) -> DataFrame:
    """(uri, text): all values of a subject that are untagged or of the languages, in order."""
    kept = attributes.where(F.col("value").isNotNull() & (F.col("lang").isNull() | F.col("lang").isin(*langs)))
    return kept.groupBy("uri").agg(F.array_join(F.array_sort(F.collect_set("value")), " ").alias("text"))


def to_triples(attributes: DataFrame, base: str = "https://example.org/") -> DataFrame:
    """(subj, pred, obj, obj_kind, datatype, lang) from the long form."""
    number = F.col("attr").isin("latitude", "longitude", "altitude")
    date = F.col("attr").rlike("_date$|^modified$")
    link = F.col("attr").isin("type", "is_part_of", "has_part")
    kind = F.when(number, "float").when(date, "dateTime").when(~link & F.col("lang").isNull(), "string")
    return attributes.where("uri is not null and attr is not null and value is not null").select(F.concat(F.lit(base), F.col("uri")).alias("subj"), F.concat(F.lit(base + "attr#"), F.col("attr")).alias("pred"), F.when(link, F.concat(F.lit(base), F.col("value"))).otherwise(F.col("value")).alias("obj"), F.when(link, "uri").otherwise("literal").alias("obj_kind"), kind.alias("datatype"), F.when(~link, F.col("lang")).alias("lang")).distinct()


def n_triples(triples: DataFrame) -> Column:
    """A line of text for each triple."""
    escaped = F.regexp_replace(F.regexp_replace(F.regexp_replace("obj", r"\\", r"\\\\"), '"', r'\\"'), "\n", r"\\n")
    literal = F.concat(F.lit('"'), escaped, F.lit('"'), F.coalesce(F.concat(F.lit("@"), F.col("lang")), F.when(F.col("datatype").isNotNull() & (F.col("datatype") != "string"), F.concat(F.lit("^^<http://www.w3.org/2001/XMLSchema#"), F.col("datatype"), F.lit(">"))), F.lit("")))
    return F.concat(F.lit("<"), F.col("subj"), F.lit("> <"), F.col("pred"), F.lit("> "), F.when(F.col("obj_kind") == "uri", F.concat(F.lit("<"), F.col("obj"), F.lit(">"))).otherwise(literal), F.lit(" ."))


def instruments_apart(entities: DataFrame, types: str) -> tuple[DataFrame, DataFrame]:
    """(instruments only, the rest)."""
    only = F.coalesce((F.size(types) == 1) & (F.element_at(F.col(types), 1) == "instrument"), F.lit(False))
    return entities.where(only), entities.where(~only)


def ordered_rows(levelled: DataFrame) -> DataFrame:
    """Rows of the hierarchical listing in the order of their paths."""
    return levelled.orderBy("path", "id").select("id", "level", "label")


