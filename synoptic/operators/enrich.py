"""What is added to entities when they come in: forms of labels, classes, labels of references, recorded texts.

Null labels have no forms; null classes take the list's default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synoptic.functions.acronyms import acronyms_cut
from synoptic.functions.text import cut_location
from synoptic.model import class_of, closure

DELIMITERS = (" at ", ",")


def label_forms(rows: DataFrame, key: str, label: str) -> DataFrame:
    """(key, form, kind): the label, without its acronym, the acronym if it is certain, and the label without a place that
    follows one delimiter."""
    cut = rows.where(F.col(label).isNotNull()).select(F.col(key).alias("key"), F.col(label).alias("label"), acronyms_cut(label).alias("c"))
    forms = [F.struct(F.col("label").alias("form"), F.lit("label").alias("kind")), F.struct(F.col("c.name").alias("form"), F.lit("name").alias("kind")), F.struct(F.col("c.acronym").alias("form"), F.lit("acronym").alias("kind"))]
    forms += [F.struct(F.when(cut_location(F.col("c.name"), d)["location"] != "", cut_location(F.col("c.name"), d)["name"]).alias("form"), F.lit("short").alias("kind")) for d in DELIMITERS]
    out = cut.select("key", F.explode(F.array(*forms)).alias("f")).where("f.form is not null and f.form <> ''")
    return out.groupBy("key", F.col("f.form").alias("form")).agg(F.min(F.struct(F.when(F.col("f.kind") == "label", 0).when(F.col("f.kind") == "name", 1).when(F.col("f.kind") == "acronym", 2).otherwise(3).alias("o"), F.col("f.kind").alias("kind"))).alias("k")).select(F.col("key").alias(key), "form", "k.kind")


def united_types(rows: DataFrame, key: str, kind: str, default: str, ground: str = "ground observatory", space: tuple[str, ...] = ("spacecraft", "airborne", "investigation")) -> DataFrame:
    """(key, types): all classes of an entity's repeats; a ground class goes where there is one in space; the default where
    there is none."""
    united = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(kind)).alias("types"))
    in_space = F.arrays_overlap("types", F.array(*map(F.lit, space)))
    kept = F.when(in_space, F.array_remove("types", ground)).otherwise(F.col("types"))
    return united.select(key, F.when(F.size(kept) == 0, F.array(F.lit(default))).otherwise(kept).alias("types"))


def reference_labels(labels: DataFrame, key: str, label: str, lang: str) -> DataFrame:
    """(key, label): the English one, else the first of another language."""
    order = F.struct(F.when(F.col(lang) == "en", 0).otherwise(1).alias("o"), F.coalesce(F.col(lang), F.lit("")).alias("l"), F.col(label).alias("v"))
    return labels.where(F.col(label).isNotNull()).groupBy(key).agg(F.min(order).alias("m")).select(key, F.col("m.v").alias(label))


def with_recorded(rows: DataFrame, key: str, column: str, recorded: DataFrame) -> DataFrame:
    """`column` replaced by what was recorded for the key (key, text), if there is something."""
    texts = recorded.groupBy(key).agg(F.max("text").alias("__text"))
    return rows.join(texts, key, "left").withColumn(column, F.coalesce("__text", column)).drop("__text")


def with_source(values: Column, source: Column) -> Column:
    """Values stamped with the list that states them."""
    return F.transform(values, lambda v: F.struct(v.alias("value"), F.array(source).alias("prov")))


def as_json(attributes: DataFrame) -> DataFrame:
    """(uri, json): each attribute with all its values, tagged with their language, in order."""
    tagged = F.when(F.col("lang").isNull(), F.col("value")).otherwise(F.concat_ws("@", "value", "lang"))
    per = attributes.where("value is not null").groupBy("uri", "attr").agg(F.array_sort(F.collect_set(tagged)).alias("v"))
    return per.groupBy("uri").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("attr", "v"))))).alias("json"))


def unique_value(rows: DataFrame, key: str, value: str, synset: str) -> DataFrame:
    """(key, value): the smallest value of an entity and all its synonyms. One aggregate a synset, so that no pair of
    synonyms is made."""
    least = rows.where(F.col(value).isNotNull() & F.col(synset).isNotNull()).groupBy(synset).agg(F.min(value).alias(value))
    return rows.select(key, synset).distinct().join(least, synset).groupBy(key).agg(F.min(value).alias(value))


def entity_list(rows: DataFrame, kind: str, kinds: list[str], present: list[str], deprecated: str, lattice: bool = False, source: tuple[str, str] | None = None, limit: tuple[str, int] | None = None) -> DataFrame:
    """Entities of some classes (with `lattice` also of the classes below them) that have certain attributes and are not
    deprecated; of one list with `source` (column, name); with `limit` (column, n) the first n by a column."""
    if lattice:
        above = closure()
        kinds = sorted({k for k in above if above[k] & set(kinds)} | set(kinds))
    out = rows.where((class_of(F.col(kind)) if lattice else F.col(kind)).isin(kinds) & ~F.coalesce(F.col(deprecated), F.lit(False)))
    if source:
        out = out.where(F.col(source[0]) == source[1])
    for c in present:
        out = out.where(F.col(c).isNotNull())
    return out.orderBy(limit[0]).limit(limit[1]) if limit else out


def without_values(attributes: DataFrame, removed: DataFrame, by: tuple[str, ...] = ("uri", "attr", "value")) -> DataFrame:
    """Attributes (uri, attr, value, lang, source) less those removed, by any of these columns: without the value all values
    of an attribute go, with the language or the list those that are stated in it."""
    return attributes.join(removed.select(*by).distinct(), list(by), "left_anti")


def translated(column: Column, names: dict[str, str]) -> Column:
    """A code's name; the code where it has none."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), column), column)
