"""The mapping strategy: a small language of steps, and the executor that runs them as joins.

    file := { line } ; line := [ '#' comment ] | step [ '#' comment ]
    step := list ',' list [ '[' type { ',' type } ']' ] ':' tool { ',' tool }
    type := 'all' | [ '-' ] TYPE ; tool := 'all' | [ '-' ] NAME [ (>=|<=|==|<|>) NUMBER ]

Before the steps a plan of identifiers links entities that share one. A step blocks the pairs of its two lists, applies its
filters, takes exact label matches, scores what is left, and cuts and ranks the scores. What is left is assigned one to one
or, where answers to offers are recorded, offered in descending order and decided by them.

Later steps see the links of earlier ones: an entity that has a synonym in the other list of a step, directly or through
others, takes no part in it; pairs that were decided not to be the same are not offered again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synoptic.functions import acronyms, answers
from synoptic.functions import text as X
from synoptic.model import ABOVE, SOURCES, class_of
from synoptic.operators import compare, embed, joins, select, synsets
from synoptic.operators.alike import alike
from synoptic.operators.nearby import near_cells, own_cell, position, usable
from synoptic.runtime import Scratch

FILTERS = ("type", "date", "distance", "identifier", "number", "aperture", "same_broader")
MATCHERS = ("label_match",)
SCORERS = ("levenshtein_similarity", "acronym", "digit", "tfidf", "embedding")
TOOLS = (*FILTERS, *MATCHERS, *SCORERS)
#: Columns that entities may have, and what links entities.
OPTIONAL = {"continent": "string", "country": "string", "state": "string", "type_confidence": "double", "embedding": "array<double>"}
LINKS = ("exactMatch", "closeMatch")
#: Fixed value: the country whose states are told apart.
WITH_STATES = "united states"
#: How many nearest entities of the other list a step takes that scores without a limit.
RETRIEVED = 100
#: How far apart two usable positions may be for the distance filter.
NEAR_KM = 10.0
_TOOL = re.compile(r"(-?)([A-Za-z_]+)\s*(?:(>=|<=|==|<|>)\s*(-?\d+(?:\.\d+)?))?")


class StrategyError(ValueError):
    """What is wrong, and in which line."""


@dataclass(frozen=True)
class Step:
    list1: str
    list2: str
    types: frozenset[str]
    filters: tuple[str, ...] = ()
    matchers: tuple[str, ...] = ()
    scorers: tuple[str, ...] = ()
    limits: tuple[tuple[str, str, float], ...] = ()
    line: int = 0


def _choice(stated: list[tuple[bool, str]], every: list[str]) -> list[str]:
    """'all', names, and names taken out."""
    out: list[str] = []
    for minus, name in stated:
        if name == "all":
            out += every
        elif not minus:
            out.append(name)
    if out == [] and any(m for m, _ in stated):
        out = list(every)
    gone = {n for m, n in stated if m}
    return [n for n in dict.fromkeys(out) if n not in gone]


def parse(text: str, lists: dict = SOURCES, types: tuple[str, ...] = tuple(ABOVE)) -> list[Step]:
    """The steps of a strategy, lists of a step in the order of their names. A step without types left is skipped."""
    steps = []
    for number, raw in enumerate(text.splitlines(), 1):
        line = raw.split("#", 1)[0].strip()
        if not line:
            continue

        def bad(what: str, number: int = number) -> StrategyError:
            return StrategyError(f"line {number}: {what}")

        if line.count(":") != 1:
            raise bad("there must be exactly one ':'")
        head, tail = (x.strip() for x in line.split(":"))
        if not tail:
            raise bad("no tool")
        if head.count("[") != head.count("]") or head.count("[") > 1 or ("[" in head and not head.endswith("]")):
            raise bad("brackets do not match")
        names, _, inner = head.rstrip("]").partition("[")
        pair = [x.strip() for x in names.split(",") if x.strip()]
        if len(pair) != 2:
            raise bad("a step is between two lists")
        for x in pair:
            if x not in lists:
                raise bad(f"unknown list {x!r}")
        pair.sort()
        default = sorted(set(lists[pair[0]].possible) & set(lists[pair[1]].possible)) or list(types)
        stated = [(t.strip().startswith("-"), t.strip().lstrip("-").strip()) for t in inner.split(",") if t.strip()]
        for _, t in stated:
            if t != "all" and t not in types:
                raise bad(f"unknown type {t!r}")
        chosen = _choice(stated, list(types)) if stated else default
        tools, limits = [], []
        for part in (p.strip() for p in tail.split(",")):
            m = _TOOL.fullmatch(part)
            if not m or (m[2] != "all" and m[2] not in TOOLS):
                raise bad(f"unknown tool {part!r}")
            tools.append((bool(m[1]), m[2]))
            if m[3]:
                if m[2] not in SCORERS:
                    raise bad(f"{m[2]} has no score")
                limits.append((m[2], m[3], float(m[4])))
        if not chosen:
            continue
        use = _choice(tools, list(TOOLS))
        keep = lambda kind, use=use: tuple(n for n in use if n in kind)
        steps.append(Step(*pair, frozenset(chosen), keep(FILTERS), keep(MATCHERS), keep(SCORERS), tuple(limits), number))
    return steps


@dataclass
class Result:
    links: DataFrame
    scores: DataFrame | None = None
    done: list[Step] = field(default_factory=list)


def with_names(entities: DataFrame) -> DataFrame:
    """What names are compared by, once for each entity: `names` (label and alternative labels, and `code` where there is
    such a column), their sort keys, and the suffix numbers and all numbers of the labels."""
    kept = lambda *parts: F.array_distinct(F.filter(F.concat(*[F.coalesce(p, F.array().cast("array<string>")) for p in parts]), lambda n: F.trim(n) != ""))
    labels = [F.array("label"), F.col("alt_label")]
    rows = entities.withColumn("labels", kept(*labels)).withColumn("names", kept(*labels, *[F.col(c) for c in entities.columns if c == "code"]))
    return rows.withColumns({"keys": X.sort_keys("names"), "suffixes": X.all_suffix_numbers("labels"), "numbers": F.flatten(F.transform("labels", X.numbers_in))})


def keys_of(rows: DataFrame) -> DataFrame:
    """(id, k): the sort keys of an entity's names."""
    return rows.select(F.col("uri").alias("id"), F.explode("keys").alias("k"))


def retrieved(left: DataFrame, right: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """(a, b): of each entity the k nearest ones of the other side by the cosine of their vectors (uri, vector), found
    exactly, in blocks; and pairs of a short name and the initials or the capitals of a long one, which no vector shows."""
    one, two = vectors.join(left.select("uri"), "uri", "left_semi"), vectors.join(right.select("uri"), "uri", "left_semi")
    near = embed.cosine_top_k(one, two, "uri", "vector", k).select(F.col("query").alias("a"), F.col("uri").alias("b"))
    near = near.union(embed.cosine_top_k(two, one, "uri", "vector", k).select(F.col("uri").alias("a"), F.col("query").alias("b")))
    short = lambda rows: rows.select("uri", F.explode("names").alias("n")).where(r"n rlike '^\\w{2,12}$'").select("uri", F.lower("n").alias("s"))

    def letters(rows: DataFrame) -> DataFrame:
        words = F.filter(F.split("n", r"[^\p{L}\p{N}]+"), lambda w: (w != "") & ~F.lower(w).isin(*acronyms.STOP_WORDS))
        initials, capitals = F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), ""), F.regexp_replace("n", "[^A-Z]", "")
        return rows.select("uri", F.explode("names").alias("n")).where("n like '% %'").select("uri", F.explode(F.array(F.lower(initials), F.lower(capitals))).alias("s")).where("length(s) > 1")

    named = lambda x, y: x.withColumnRenamed("uri", "a").join(y.withColumnRenamed("uri", "b"), "s").select("a", "b")
    return near.union(named(short(left), letters(right))).union(named(letters(left), short(right))).distinct()


def blocked(left: DataFrame, right: DataFrame, step: Step, vectors: DataFrame | None = None, k: int = RETRIEVED) -> DataFrame:
    """(a, b): the pairs that a step can accept. Equal labels for its matchers; for its scorers what its limit of the label
    ratio leaves, found exactly. Under a distance filter two usable positions meet in cells of a grid instead. None of
    these is left out. A step that scores without such a limit takes the k nearest by `vectors` of both sides."""
    found = []
    if step.matchers:
        found.append(joins.label_matches(left, "uri", right, "uri").select("a", "b"))
    if step.scorers:
        least = max([v for s, op, v in step.limits if s == "levenshtein_similarity" and op in (">=", ">", "==")], default=0.0)
        todo = [(left, right)]
        if "distance" in step.filters:
            placed = usable(F.col("latitude"), F.col("longitude"))
            todo = [(left.where(~placed), right), (left.where(placed), right.where(~placed))]
            at = lambda rows: rows.where(placed).select("uri", *position(F.col("latitude"), F.col("longitude")))
            # The filter measures on a sphere, cells lie on the ellipsoid: distances differ by under 1 %.
            wide = NEAR_KM * 1.01
            found.append(near_cells(at(left), wide).select(F.col("uri").alias("a"), "cell").join(at(right).select(F.col("uri").alias("b"), own_cell(wide).alias("cell")), "cell").select("a", "b"))
        for one, two in todo:
            if least > 0:
                found.append(alike(keys_of(one), keys_of(two), least))
            else:
                found.append(retrieved(one, two, vectors, k))
    return reduce(DataFrame.union, found).distinct() if found else left.sparkSession.createDataFrame([], "a string, b string")


def with_cosine(pairs: DataFrame, weights: DataFrame) -> DataFrame:
    """`pairs` with s_tfidf: the cosine of both names' tf-idf vectors (uri, term, weight); null where one has no term."""
    one, two = weights.select(F.col("uri").alias("a"), "term", F.col("weight").alias("w1")), weights.select(F.col("uri").alias("b"), "term", F.col("weight").alias("w2"))
    dots = pairs.select("a", "b").join(one, "a").join(two, ["b", "term"]).groupBy("a", "b").agg(F.sum(F.col("w1") * F.col("w2")).alias("dot"))
    some = lambda side: weights.select(F.col("uri").alias(side), F.lit(True).alias("has_" + side)).distinct()
    rows = pairs.join(dots, ["a", "b"], "left").join(some("a"), "a", "left").join(some("b"), "b", "left")
    return rows.withColumn("s_tfidf", F.when(F.col("has_a") & F.col("has_b"), F.coalesce("dot", F.lit(0.0)))).drop("dot", "has_a", "has_b")


def run(steps: list[Step], entities: DataFrame, weights: dict[str, float] | None = None, z: float = 0.385, k: int = 10, name: str = "strategy", plan: tuple[tuple[str, str, str, str], ...] = (), recorded: DataFrame | None = None, most: int = 3, cap: int = 500, streak: int = 30, candidates: int = RETRIEVED) -> DataFrame:
    """(a, b, predicate, justification, score, scores): the mappings of all steps. `entities` has uri, source, label,
    alt_label, entity_type, latitude, longitude, years, ids, apertures, parents and may have code (an array, too) and the
    columns of OPTIONAL; what a list lacks is null.

    `plan` has (list, column, list, column) of identifiers that make two entities the same. `recorded` (a, b, answer) are
    answers to offers: then each entity is offered `most` times, at most `cap` pairs a step, until `streak` of them in a row
    are answered "distinct". Same makes a link, narrow and broad a relation, distinct a negative row; a pair whose answer
    is missing or can't be read stays open."""
    scratch = Scratch(entities.sparkSession, name)
    for c, kind in OPTIONAL.items():
        if c not in entities.columns:
            entities = entities.withColumn(c, F.lit(None).cast(kind))
    entities = scratch.write(with_names(entities))
    weights = weights or {}
    found: list[DataFrame] = []
    seen: set[str] = set()
    free = [s for s in steps if s.scorers and not any(n == "levenshtein_similarity" and op in (">=", ">", "==") and v > 0 for n, op, v in s.limits)]
    terms = vectors = None
    if free or any("tfidf" in step.scorers for step in steps):
        texts = entities.select("uri", X.fold_accents(F.array_join("labels", " ")).alias("text"))
        terms = scratch.write(embed.tfidf(texts, "uri", "text").select("uri", "term", "weight"))
    if free:
        vectors = scratch.write(embed.hashed(terms, "uri"))

    def open_ones(rows: DataFrame, list1: str, list2: str) -> tuple[DataFrame, DataFrame]:
        """Entities of both lists without a synonym in the other one."""
        taken = _taken(found, entities, list1, list2, seen, scratch)
        if taken is not None:
            rows = rows.join(taken, "uri", "left_anti")
        seen.update((list1, list2))
        return rows.where(F.col("source") == list1), rows.where(F.col("source") == list2)

    def add(rows: DataFrame) -> None:
        found.append(scratch.write(rows))

    for list1, column1, list2, column2 in plan:
        left, right = open_ones(entities, list1, list2)
        same = joins.merge_on(left, "uri", column1, right, "uri", column2)
        add(_mapped(select.one_to_one(same.withColumn("score", F.lit(1.0)), name), "exactMatch", "identifier"))
    for step in steps:
        wanted = entities.where(class_of(F.col("entity_type")).isin(list(step.types)) | F.col("entity_type").isNull())
        left, right = open_ones(wanted, step.list1, step.list2)
        direct = None
        if step.matchers and not step.filters and recorded is None:
            # Nothing tells pairs of equal labels apart, so they are assigned without being made. What is left has none.
            direct = scratch.write(select.one_to_one_by_value(joins.matched_labels(left, "uri"), joins.labels_of(right, "uri"), name))
            add(_mapped(direct, "exactMatch", "lexical"))
            step = replace(step, matchers=())
            if not step.scorers:
                continue
        pairs = blocked(left, right, step, vectors, candidates).join(_side(left, "a", "1"), "a").join(_side(right, "b", "2"), "b")
        for settled in found:
            gone = settled.where(~F.col("predicate").isin(*LINKS))
            pairs = pairs.join(gone.select("a", "b"), ["a", "b"], "left_anti").join(gone.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
        for f in step.filters:
            pairs = pairs.where(_filter(f))
        if direct is not None:
            pairs = pairs.join(direct.select("a"), "a", "left_anti").join(direct.select("b"), "b", "left_anti")
        pairs = rest = scratch.write(pairs)
        if step.matchers:
            exact = joins.label_matches(left, "uri", right, "uri").join(pairs.select("a", "b"), ["a", "b"])
            one = scratch.write(select.one_to_one(exact.select("a", "b", F.lit(1.0).alias("score")), name))
            add(_mapped(one, "exactMatch", "lexical"))
            rest = rest.join(one.select("a"), "a", "left_anti").join(one.select("b"), "b", "left_anti")
        if not step.scorers:
            continue
        # Written before anything is filtered by it, so that no score is computed twice.
        scored = scratch.write(rest.select("a", "b", *[_score(s).alias(f"s_{s}") for s in step.scorers if s != "tfidf"]))
        if "tfidf" in step.scorers:
            scored = scratch.write(with_cosine(scored, terms))
        total, scores = compare.hybrid_score({s: (F.col(f"s_{s}"), weights.get(s, 1.0)) for s in step.scorers})
        scored = scratch.write(scored.select("a", "b", total.alias("score"), scores.alias("scores")).where("score is not null"))
        for s, op, v in step.limits:
            scored = scored.where(compare.threshold(F.element_at("scores", s), op, v))
        cut = select.top_k(select.zscore_cut(scored, "score", z), ["a"], "score", ["b"], k).select("a", "b", "score", "scores")
        if recorded is None:
            chosen = scratch.write(select.one_to_one(cut.select("a", "b", "score"), name))
            add(chosen.join(scored.select("a", "b", "scores"), ["a", "b"]).select("a", "b", F.lit("closeMatch").alias("predicate"), F.lit("composite").alias("justification"), "score", "scores"))
        else:
            add(decided(cut, recorded, most, cap, streak, scratch, name))
    out = entities.sparkSession.createDataFrame([], "a string, b string, predicate string, justification string, score double, scores map<string,double>")
    for f in found:
        out = out.unionByName(f)
    return out


def decided(cut: DataFrame, recorded: DataFrame, most: int, cap: int, streak: int, scratch: Scratch, name: str) -> DataFrame:
    """The mappings that recorded answers make of scored pairs, offered in descending order of score until `streak` of them
    in a row are distinct."""
    read = recorded.groupBy("a", "b").agg(F.max("answer").alias("answer")).select("a", "b", answers.decision(F.col("answer")).alias("kind"))
    asked = scratch.write(cut.join(read, ["a", "b"], "left"))
    offers = scratch.write(select.attempts_within(asked.select("a", "b", "score", (F.col("kind") == "same").alias("same")), most, cap, name))
    # At most `cap` offers: one order of all is a small sort.
    turns = offers.join(asked.select("a", "b", "kind", "scores"), ["a", "b"]).where(F.col("kind").isNotNull()).select("*", F.struct((-F.col("score")).alias("s"), "a", "b").alias("turn"), (F.col("kind") != "distinct").alias("accepted"), F.lit(1).alias("session"))
    made = select.until_streak(turns, ["session"], "turn", F.floor(-F.col("score") * 100), "accepted", streak)
    return made.select("a", "b", answers.relation(F.col("kind")).alias("predicate"), F.lit("validated").alias("justification"), "score", "scores")


def _mapped(pairs: DataFrame, predicate: str, justification: str) -> DataFrame:
    return pairs.select("a", "b", F.lit(predicate).alias("predicate"), F.lit(justification).alias("justification"), "score", F.lit(None).cast("map<string,double>").alias("scores"))


def _taken(found: list[DataFrame], entities: DataFrame, list1: str, list2: str, seen: set[str], scratch: Scratch) -> DataFrame | None:
    """(uri) of the entities of two lists that have a synonym in the other one, through any links so far."""
    if not found:
        return None
    links = reduce(DataFrame.unionByName, [f.where(F.col("predicate").isin(*LINKS)).select("a", "b") for f in found])
    if seen <= {list1, list2}:
        return links.select(F.col("a").alias("uri")).union(links.select("b")).distinct()
    members = scratch.write(synsets.synsets(links.select(F.col("a").alias("src"), F.col("b").alias("dst")), "taken").join(entities.select(F.col("uri").alias("id"), "source"), "id"))
    of = lambda source: members.where(F.col("source") == source)
    taken = [of(x).join(of(y).select("synset_id").distinct(), "synset_id", "left_semi").select(F.col("id").alias("uri")) for x, y in ((list1, list2), (list2, list1))]
    return taken[0].union(taken[1]).distinct()


def _side(rows: DataFrame, key: str, mark: str) -> DataFrame:
    return rows.select(F.col("uri").alias(key), *[F.col(c).alias(c + mark) for c in rows.columns if c not in ("uri", "source", "label", "alt_label", "code", "labels")])


def _filter(name: str):  # noqa: ANN202
    c = F.col
    one = lambda m: F.array_compact(F.array(class_of(c("entity_type" + m))))
    sure = lambda m: F.coalesce(c("type_confidence" + m), F.lit(1.0))
    states = (F.when(F.lower(F.trim(c("country1"))) == WITH_STATES, c("state1")), c("state2"))
    places = [(c("continent1"), c("continent2")), (c("country1"), c("country2")), states]
    return {
        "type": lambda: compare.type_filter(one("1"), sure("1"), one("2"), sure("2")),
        "date": lambda: compare.overlap_filter(c("years1"), c("years2")),
        "distance": lambda: compare.distance_filter(c("latitude1"), c("longitude1"), c("latitude2"), c("longitude2"), places, NEAR_KM),
        "identifier": lambda: compare.overlap_filter(c("ids1"), c("ids2")),
        "number": lambda: compare.number_filter(c("suffixes1"), c("suffixes2")),
        "aperture": lambda: compare.aperture_filter(c("apertures1"), c("apertures2")),
        "same_broader": lambda: compare.broader_filter(c("parents1"), c("parents2")),
    }[name]()


def _score(name: str):  # noqa: ANN202
    """The highest over all pairs of names; of numbers, those of all labels; the cosine of stated embeddings."""
    if name == "embedding":
        return embed.cosine(F.col("embedding1"), F.col("embedding2"))
    how, value = {"levenshtein_similarity": (X.best_ratio, "keys"), "acronym": (acronyms.best_acronym_score, "names"), "digit": (X.digit_score, "numbers")}[name]
    return how(F.col(value + "1"), F.col(value + "2"))


def mapping_rows(mappings: DataFrame, set_id: str, creator: str) -> DataFrame:
    """Facts of a mapping table: one row a decision, scores that could not be computed left out."""
    measure = F.when(F.col("justification") == "lexical", "label").when(F.col("justification") == "identifier", "identifier").otherwise("hybrid")
    return mappings.select(F.concat_ws("|", F.lit(set_id), "a", "b").alias("mapping_id"), F.lit(set_id).alias("set_id"), F.col("a").alias("subject_id"), F.col("predicate").alias("predicate_id"), F.col("b").alias("object_id"), F.col("score").alias("similarity_score"), measure.alias("similarity_measure"), F.map_filter("scores", lambda _, v: v >= 0).alias("scores"), F.col("justification").alias("justification_type"), F.lit(creator).alias("creator"), F.lit(False).alias("deprecated"))
