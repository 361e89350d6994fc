"""Reference data of the model: attributes, classes of facilities and their lattice, and lists with their defaults.

The long form of everything is `entity_attr` (source, uri, attr, value, lang, prov); wide views are made from it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITY_ATTR = T.StructType([T.StructField(n, T.StringType()) for n in ("source", "uri", "attr", "value", "lang")] + [T.StructField("prov", T.ArrayType(T.StringType()))])
TRIPLES = T.StructType([T.StructField(n, T.StringType()) for n in ("subj", "pred", "obj", "obj_kind", "datatype", "lang")])

#: Each class and the classes above it.
ABOVE = {
    "observation facility": ("ufo",), "ground facility": ("observation facility",), "space facility": ("observation facility",), "survey": ("observation facility",),
    "platform": ("ufo",), "instrument": ("ufo",),
    "ground observatory": ("ground facility", "platform"), "telescope": ("ground facility", "space facility", "instrument", "platform"),
    "spacecraft": ("space facility", "platform"), "airborne": ("space facility", "platform"), "investigation": ("spacecraft",),
}
#: Other names of classes in the lists.
CLASS_NAMES = {"space mission": "investigation", "observatory network": "ground observatory", "unknown": "ufo", "instrument_host": "spacecraft", "facility": "ground observatory"}

IDENTIFIERS = ("naif_id", "mcp_id", "cospar_id", "nssdca_id", "norad_id", "code")
REPRESENTATION = ("label", "alt_label", "definition", "description", "country", "continent")
LINKS = ("url", "uri", "ext_ref")
METADATA = ("modified", "deprecated", "type_confidence", "location_confidence")
DATES = ("launch_date", "start_date", "end_date")


@dataclass(frozen=True)
class Source:
    """What holds for a whole list: whether its classes are known, which there are, and the default."""

    name: str
    type_known: bool = False
    possible: tuple[str, ...] = tuple(ABOVE)
    default: str = "ufo"
    community: str | None = None
    authoritative: bool = False


#: The lists that the engine reads.
SOURCES = {
    s.name: s
    for s in (
        Source("aas", community="astronomy", authoritative=True), Source("iaumpc", True, ("ground observatory",), "ground observatory", "astronomy", True), Source("imcce", community="planetary"),
        Source("naif", True, ("spacecraft", "investigation"), "spacecraft", "heliophysics", True), Source("nssdc", True, ("spacecraft",), "spacecraft"), Source("pds", True, community="planetary", authoritative=True),
        Source("spase", True, community="heliophysics", authoritative=True), Source("wikidata"), Source("n2yo", True, ("spacecraft",), "spacecraft"),
    )
}


def closure(above: dict[str, tuple[str, ...]] | None = None) -> dict[str, set[str]]:
    """All classes above each class, and itself."""
    above = ABOVE if above is None else above
    names = set(above) | {s for ss in above.values() for s in ss}
    out: dict[str, set[str]] = {}

    def up(c: str) -> set[str]:
        if c not in out:
            out[c] = {c}.union(*(up(s) for s in above.get(c, ())))
        return out[c]

    for n in names:
        up(n)
    return out


def compatible_types(spark: SparkSession) -> DataFrame:
    """(a, b): classes of which one is the other or above it. At most as many rows as pairs of classes."""
    c = closure()
    return spark.createDataFrame(sorted((a, b) for a in c for b in c if b in c[a] or a in c[b]), "a string, b string")


def class_of(name: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in CLASS_NAMES.items() for x in kv])
    low = F.lower(F.trim(name))
    return F.coalesce(F.element_at(known, low), low)


def types_compatible(one: Column, two: Column) -> Column:
    """Whether some pair of two arrays of classes is compatible; true where an array is null or empty."""
    c = closure()
    family = F.create_map(*[x for a in sorted(c) for x in (F.lit(a), F.array(*[F.lit(b) for b in sorted(c) if b in c[a] or a in c[b]]))])
    met = F.exists(one, lambda a: F.arrays_overlap(F.coalesce(F.element_at(family, a), F.array(a)), two))
    return F.coalesce(F.size(one) < 1, F.lit(True)) | F.coalesce(F.size(two) < 1, F.lit(True)) | F.coalesce(met, F.lit(True))
