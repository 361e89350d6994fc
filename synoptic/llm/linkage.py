"""Problem 3: matching entities across two sources without keys, by probabilistic record linkage.

Two blocking passes. By place: cells of a grid over the earth, of the stated position and of the ways in which positions
are mistyped (swapped, or with a wrong sign), whatever the kinds of facility. By name: all pairs of words of a name (the
word of a name that has one), words meeting also when mistyped, whatever the positions.

Entities whose names and kinds are read the same are one class, and the name pass pairs classes, not entities: a name that
a third of all entities bear is one class on each side. Pairs of entities are made for places alone, which are bounded by
distance. What the others add is counted: an entity of a class with k equally good partners in another shares its
confidence among them, so that over one half none of two or more can win, and only single partners are looked up. That is
why `least` must be one half or more, and nothing is lost by it.

Pairs are compared by levels of agreement in name, kind and place. Expectation-maximisation over the patterns of the place
pass finds how likely each level is among matches and among others, and the share of matches; that pairs of different kinds
are no matches is given. Pairs without a place weigh
by name and kind. Of pairs whose places are both stated but apart one match at most is expected that was never seen (the rule
of succession), and it is any of those that agree as much in name and kind. The odds of a pattern become each pair's confidence, scaled over the
candidates of an item, as an item is one thing at most: of two equally good sites neither is certain.

Patterns are at most 5 x 3 x 5, so their counts go to the driver; pairs stay distributed.

Nulls: a null id is left out. Missing, NaN or impossible coordinates and (0, 0) are no position; a null or empty name
agrees with none. Repeated rows of one id count once. Empty tables give empty results. Names of any length are paired by
all their words, in joins.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synoptic.llm import lexicon as L
from synoptic.operators import nearby as N
from synoptic.runtime import Scratch

KM, CLOSE_KM = 3.5, 1.0
#: Large steps run in passes over a part of their rows, so that the shuffle files of one part are there at a time: one for
#: each ROWS rows, at most PASSES.
ROWS, PASSES = 500_000, 8
#: Edge of the cells that near pairs are found in: a site goes into three of them, on average.
CELL_KM = 4 * KM
#: Levels of each comparison, from "differs" up. Name: one word, code, typed alike, the same. Kind: not stated, the same.
#: Place: apart, not stated, mistyped, within KM, within CLOSE_KM.
LEVELS = {"name": 5, "kind": 3, "place": 5}
NOT_STATED = {"kind": 1, "place": 1}
APART = DIFFERS = 0
KIND = 1
START, ROUNDS, SMOOTH = 8.0, 500, 0.01
#: A single word of so many letters is a name as well.
LONG_CODE = 6
PARTS = T.StructType([T.StructField("names", T.ArrayType(T.ArrayType(T.StringType()))), T.StructField("codes", T.ArrayType(T.StringType())), T.StructField("kind", T.StringType())])


def parts(names: Column, rules: L.Rules) -> Column:
    """Of all names of an entity: their words, its codes (with the initials of its names) and its kind."""

    @F.pandas_udf(PARTS)
    def read(names: pd.Series) -> pd.DataFrame:
        out = []
        for given in names:
            words, codes, kind = [], set(), None
            for name in given if given is not None else ():
                p = L.parse(name, rules)
                if p["code"]:
                    codes.add(p["code"])
                    if len(p["code"]) < LONG_CODE:
                        continue
                core = [w for w in p["core"] if w not in rules.place_words]
                if core:
                    words.append(core)
                kind = kind or p["kind"]
                if len(core) >= 2 and p["kind"]:
                    codes.add("".join(w[0] for w in [*core[:2], *p["kind"].split()]))
            out.append((sorted(words), sorted(codes), kind))
        return pd.DataFrame(out, columns=["names", "codes", "kind"])

    return read(names)


def _spellings(word: Column) -> Column:
    """A word of four letters or more, and what is left of it without one letter."""
    shorter = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return F.array_distinct(F.concat(F.array(word), shorter))


def _of_pass(c: Column, i: int, passes: int) -> Column:
    """Whether rows of this value belong to the i-th pass."""
    return F.pmod(F.xxhash64(c), F.lit(passes)) == i


@lru_cache(maxsize=100_000)
def _letters(word: str) -> int:
    """The letters of a word, a bit for each (some share one)."""
    out = 0
    for c in word:
        out |= 1 << (ord(c) & 63)
    return out


def _word(a: str, b: str) -> int:
    """2 the same, 1 typed alike, 0 different."""
    if a == b:
        return 2
    most = max(L.allowed(a), L.allowed(b)) if min(len(a), len(b)) > 3 else 0
    if not most or abs(len(a) - len(b)) > most:
        return 0
    # An error changes at most one letter of each word, so words with more letters of their own differ more.
    x, y = _letters(a), _letters(b)
    if (x & ~y).bit_count() > most or (y & ~x).bit_count() > most:
        return 0
    return 1 if L.distance(a, b, most) <= most else 0


def _initial(a: str, b: str) -> bool:
    return (len(a) == 1 or len(b) == 1) and a[0] == b[0]


def name_level(names1, names2, codes1, codes2) -> int:
    best = 0
    for one in names1:
        for two in names2:
            short, long = sorted((list(one), list(two)), key=len)
            if short == long or sorted(short) == sorted(long):
                return 4
            marks, left = [], list(long)
            for w in short:
                score, at = max(((_word(w, x) or (0.5 if _initial(w, x) else 0), x) for x in left), default=(0, None))
                marks.append(score)
                if score:
                    left.remove(at)
            met = [x for x in marks if x]
            if len(short) == 2 and marks == [2, 2]:
                return 4
            if (len(met) >= 2 or (len(met) == len(long) and len(long[0]) > 3)) and max(met) >= 1:
                best = max(best, 3)
            elif max(marks, default=0) >= 1:
                best = max(best, 1)
    # Of two names that are stated and differ in all words the initials agree by chance.
    open_ = best or not len(names1) or not len(names2)
    return max(best, 2) if best < 3 and open_ and set(codes1) & set(codes2) else best


@F.pandas_udf(T.IntegerType())
def name_levels(n1: pd.Series, n2: pd.Series, c1: pd.Series, c2: pd.Series) -> pd.Series:
    return pd.Series([name_level(*x) for x in zip(n1, n2, c1, c2, strict=True)], dtype="int32")


def _entities(rows: DataFrame, key: str, scratch: Scratch, rules: L.Rules) -> DataFrame:
    """(id, c, p, lat, lon): class (its least id), parts and position; lat and lon as stated, longitude within -180..180 where it can be."""
    names = F.concat(F.array("label"), F.coalesce("alt_label", F.array().cast("array<string>")))
    lon = F.when(F.col("longitude").between(-180, 360), F.pmod(F.col("longitude") + 180, F.lit(360.0)) - 180).otherwise(F.col("longitude"))
    one = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), names.alias("names"), F.col("latitude").alias("lat"), lon.alias("lon"))
    first = one.groupBy("id").agg(F.min(F.struct("names", "lat", "lon")).alias("r"))
    read = first.select("id", parts(F.col("r.names"), rules).alias("p"), "r.lat", "r.lon")
    read = scratch.write(read)
    least = read.groupBy("p").agg(F.min("id").alias("c")).withColumnRenamed("p", "q")
    # Kinds differ in null, which equality of structs does not forgive.
    same = (F.col("p.names") == F.col("q.names")) & (F.col("p.codes") == F.col("q.codes")) & F.col("p.kind").eqNullSafe(F.col("q.kind"))
    out = scratch.write(read.join(least, same).select("id", "c", "p", "lat", "lon"))
    scratch.drop(read)
    return out


def _classes(entities: DataFrame, mark: str) -> DataFrame:
    """Of each class its parts, how many entities it has with and without a place, and the least of each."""
    placed = N.usable(F.col("lat"), F.col("lon"))
    count = lambda w: F.count(F.when(w, 1))
    out = entities.groupBy("c").agg(F.first("p").alias("p"), count(placed).alias("placed"), count(~placed).alias("lost"), F.min(F.when(placed, F.col("id"))).alias("a_placed"), F.min(F.when(~placed, F.col("id"))).alias("a_lost"))
    return out.withColumnsRenamed({"c": "c" + mark, "p": "p" + mark})


def _placed(rows: DataFrame, lat: Column, lon: Column, mistyped: bool) -> DataFrame:
    return rows.where(N.usable(lat, lon)).select("id", "c", F.col("p.kind").alias("kind"), F.lit(mistyped).alias("mistyped"), *N.position(lat, lon))


def _kinds_agree(one: Column, two: Column) -> Column:
    """Whether they do not differ; a telescope of unknown kind may be any telescope."""
    loose = ((one == "telescope") & two.endswith("telescope")) | ((two == "telescope") & one.endswith("telescope"))
    return (one == two) | loose


def _kind_level(one: Column, two: Column) -> Column:
    return F.when(one.isNull() | two.isNull(), NOT_STATED["kind"]).when(_kinds_agree(one, two), 2).otherwise(DIFFERS)


def by_place(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, ca, b, cb, kind, place): entities within KM, also where an item's position is mistyped.

    A pair comes once: of the ways to read an item's position (as stated, with wrong signs, swapped) the first that is near
    counts, which each row tells by itself. A wrong sign mirrors y or z; the swapped position brings the stated one along."""
    lat, lon = F.col("lat"), F.col("lon")
    signs = [(lat, lon), (-lat, lon), (lat, -lon), (-lat, -lon)]
    none = [F.lit(None).cast("double").alias("s" + c) for c in "xyz"]
    way = lambda i, la, lo, s: right.where(N.usable(la, lo)).select(F.col("id").alias("b"), F.col("c").alias("cb"), F.col("p.kind").alias("k2"), F.lit(i).alias("way"), *N.position(la, lo), *s)
    stated = [F.when(N.usable(lat, lon), x).alias("s" + c) for x, c in zip(N.position(lat, lon), "xyz", strict=True)]
    ways = way(len(signs), lon, lat, stated)
    for i, (la, lo) in enumerate(signs):
        ways = ways.union(way(i, la, lo, none))
    reach = N.near_cells(_placed(left, lat, lon, False).select(F.col("id").alias("a"), F.col("c").alias("ca"), F.col("kind").alias("k1"), "x", "y", "z"), KM, CELL_KM).withColumnsRenamed({"x": "x1", "y": "y1", "z": "z1"})

    def far2(x: Column, y: Column, z: Column) -> Column:
        return sum(((c - F.col(n)) * (c - F.col(n)) for c, n in ((y, "y1"), (z, "z1"))), (x - F.col("x1")) * (x - F.col("x1")))

    x, y, z, nth = (F.col(c) for c in ("x", "y", "z", "way"))
    own = [F.when(nth == len(signs), F.col("s" + c)).otherwise(v) for c, v in (("x", x), ("y", F.when(nth.isin(2, 3), -y).otherwise(y)), ("z", F.when(nth.isin(1, 3), -z).otherwise(z)))]
    earlier = F.lit(False)
    for i, (b, c) in enumerate(((1, 1), (1, -1), (-1, 1), (-1, -1))):
        earlier = earlier | ((nth > i) & F.coalesce(far2(own[0], own[1] * b, own[2] * c) <= KM * KM, F.lit(False)))
    met = ways.withColumn("cell", N.own_cell(CELL_KM)).join(reach, "cell").where((far2(x, y, z) <= KM * KM) & ~F.when(nth == 0, False).otherwise(earlier))
    return met.select("a", "ca", "b", "cb", _kind_level(F.col("k1"), F.col("k2")).alias("kind"), F.when(nth > 0, 2).when(far2(x, y, z) <= CLOSE_KM * CLOSE_KM, 4).otherwise(3).alias("place"))


def by_name(left: DataFrame, right: DataFrame, scratch: Scratch) -> DataFrame:
    """(ca, cb): classes that have names with two words in common, or names of one word with that, words also mistyped.

    Words go by a number of 32 bits; two that share one make pairs that the comparison of names turns down. Spellings and
    pairs of words are met in passes over a part of them, as many as keep a pass in proportion to the names."""
    def words(classes: DataFrame, c: str, p: str) -> DataFrame:
        return classes.select(c, F.posexplode(p + ".names").alias("nth", "words")).select(c, "nth", F.posexplode("words").alias("at", "word"))

    one, two = scratch.write(words(left, "ca", "p1")), scratch.write(words(right, "cb", "p2"))
    number = lambda c: F.hash(c).alias("w")
    # Names of one letter's length differ are few; words that only one side has can be mistyped, all others may be, too.
    spelled = lambda rows, c, i, n: rows.select("word").distinct().where("length(word) > 3").select(number("word").alias(c), F.explode(_spellings(F.col("word"))).alias("s")).select(c, F.xxhash64("s").alias("s")).where(_of_pass(F.col("s"), i, n))
    passes = max(1, min(PASSES, (one.count() + two.count()) // ROWS))
    meant = scratch.write_in_passes(passes, lambda i: spelled(two, "typed", i, passes).join(spelled(one, "w", i, passes), "s").where("typed <> w").groupBy("typed").agg(F.collect_set("w").alias("ws")))

    # Of each name how many words it has, and the numbers that each may have.
    mine = scratch.write(one.select("ca", "nth", "at", number("word")).groupBy("ca", "nth").agg(F.count("*").alias("n"), F.collect_list(F.struct("w", "at")).alias("all")).drop("nth"))
    grouped = two.withColumn("typed", F.hash("word")).join(meant, "typed", "left").select("cb", "nth", "at", F.array_union(F.array("typed"), F.coalesce("ws", F.array().cast("array<int>"))).alias("ws"))
    # A word's meanings lie in one array, so that rows of words, not of meanings, are exchanged.
    each = lambda i: grouped.where(_of_pass(F.col("cb"), i, passes)).groupBy("cb", "nth").agg(F.collect_list(F.struct("ws", "at")).alias("each"))
    flat = F.flatten(F.transform("each", lambda e: F.transform(e["ws"], lambda w: F.struct(w.alias("w"), e["at"].alias("at")))))
    theirs = scratch.write_in_passes(passes, lambda i: each(i).select("cb", F.size(F.array_distinct(F.col("each.at"))).alias("n"), F.array_distinct(flat).alias("all")))
    scratch.drop(one, two, meant)
    # All pairs of a name's words, the lesser number first, and single words of names of one.
    total = theirs.agg(F.count("*").alias("names"), F.sum(F.size("all").cast("bigint") * F.size("all") / 2).alias("pairs")).first()
    parts = max(1, math.ceil((total["pairs"] or 0) / max(12 * total["names"], ROWS)))

    def keys(rows: DataFrame, c: str, i: int) -> DataFrame:
        first = rows.select(c, "n", "all", F.explode("all").alias("x")).where(_of_pass(F.col("x.w"), i, parts))
        later = F.filter("all", lambda y: (y["at"] != F.col("x.at")) & ((y["w"] > F.col("x.w")) | ((y["w"] == F.col("x.w")) & (y["at"] > F.col("x.at")))))
        both = F.transform(later, lambda y: F.xxhash64(F.col("x.w"), y["w"]))
        out = first.select(c, F.explode(F.when(F.col("n") == 1, F.array(F.xxhash64("x.w"))).otherwise(both)).alias("k"))
        # Rows go to the tasks that join them before repeated ones are dropped: one exchange does for both.
        return out.repartition("k").distinct()

    found = scratch.write_in_passes(parts, lambda i: keys(mine, "ca", i).join(keys(theirs, "cb", i), "k").select("ca", "cb").distinct())
    scratch.drop(mine, theirs)
    if parts == 1:
        return found
    named = scratch.write(found.distinct())
    scratch.drop(found)
    return named


def compared(pairs: DataFrame, one: DataFrame, two: DataFrame) -> DataFrame:
    """(ca, cb, name, kind): the levels of each pair of classes whose kinds do not differ."""
    met = pairs.join(one.select("ca", "p1"), "ca").join(two.select("cb", "p2"), "cb").withColumn("kind", _kind_level(F.col("p1.kind"), F.col("p2.kind")))
    return met.where(F.col("kind") != DIFFERS).select("ca", "cb", *[c for c in pairs.columns if c not in ("ca", "cb")], name_levels("p1.names", "p2.names", "p1.codes", "p2.codes").alias("name"), "kind")


def estimate(counts: dict[tuple[int, ...], int], apart: dict[tuple[int, ...], int] | None = None) -> dict[tuple[int, ...], float]:
    """Expectation-maximisation over the counts of patterns of pairs on the same ground: the odds of a match of each pattern
    there is. A field that is not stated tells nothing (weight 1). Matches start as tending to high levels, so that the two
    classes can't change places. Pairs of different kinds are known not to match (facilities of different kinds on the same
    ground are different): they tell how kinds and places fall among the others, which names and two fields leave open. How
    names fall they don't tell, as codes hold the kind's initials. `apart` counts pairs of (name, kind) whose places are apart."""
    sizes, missing = list(LEVELS.values()), [NOT_STATED.get(f) for f in LEVELS]
    whole = sum(counts.values())

    def likelihood(rates: list[list[float]], pattern: tuple[int, ...]) -> float:
        return math.prod(rates[i][v] for i, v in enumerate(pattern) if v != missing[i])

    def fitted(weights: dict[tuple[int, ...], float]) -> list[list[float]]:
        out = []
        for i, levels in enumerate(sizes):
            sums = [SMOOTH + sum(w for p, w in weights.items() if p[i] == v and v != missing[i]) for v in range(levels)]
            out.append([x / sum(sums) for x in sums])
        return out

    def others(hits: dict[tuple[int, ...], float]) -> list[list[float]]:
        name, _, place = fitted({p: n - hits[p] for p, n in counts.items() if p[KIND] != DIFFERS})
        _, kind, _ = fitted({p: n - hits[p] for p, n in counts.items()})
        return [name, kind, fixed or place]

    known = {p: n for p, n in counts.items() if p[KIND] == DIFFERS}
    fixed = fitted(known)[-1] if known else None
    m, u = ([[START ** (sign * v) for v in range(n)] for n in sizes] for sign in (1, -1))
    m, u = ([[x / sum(f) for x in f] for f in r] for r in (m, u))
    u[-1] = fixed or u[-1]
    share, before, found = 0.1, -math.inf, 0.0
    for _ in range(ROUNDS if whole else 0):
        both = {p: (share * likelihood(m, p), (1 - share) * likelihood(u, p)) for p in counts}
        now = sum(n * math.log(sum(both[p])) for p, n in counts.items())
        hits = {p: 0.0 if p[KIND] == DIFFERS else n * both[p][0] / sum(both[p]) for p, n in counts.items()}
        m, u = fitted(hits), others(hits)
        found = sum(hits.values())
        share = min(max(found / whole, 1e-9), 1 - 1e-9)
        if now - before < 1e-9 * whole:
            break
        before = now
    out = {}
    for p in product(*map(range, sizes)):
        if p[-1] == APART:
            unseen = found / (found + 2) * likelihood(m, (*p[:-1], NOT_STATED["place"]))
            out[p] = unseen / max((apart or {}).get(p[:-1], 0), 1)
        else:
            out[p] = share / (1 - share) * likelihood(m, p) / likelihood(u, p)
    return out


def link(left: DataFrame, left_key: str, right: DataFrame, right_key: str, name: str = "linkage", least: float = 0.5, rules: L.Rules = L.RULES) -> DataFrame:
    """(a, b, confidence): pairs of a left and a right entity (label, alt_label, latitude, longitude) of a confidence
    over `least`, which is one half or more."""
    if least < 0.5:
        raise ValueError("under one half an item could have several partners of a class")
    spark = left.sparkSession
    scratch = Scratch(spark, name)
    sites, items = _entities(left, left_key, scratch, rules), _entities(right, right_key, scratch, rules)
    one, two = scratch.write(_classes(sites, "a").withColumnRenamed("pa", "p1")), scratch.write(_classes(items, "b").withColumnRenamed("pb", "p2"))
    # From here names are read from the classes.
    narrow = lambda rows: scratch.write(rows.select("id", "c", F.struct("p.kind").alias("p"), "lat", "lon"))
    wide, (sites, items) = (sites, items), (narrow(sites), narrow(items))
    scratch.drop(*wide)
    named = by_name(one, two, scratch)
    # Of pairs of different kinds only the levels count.
    fields = list(LEVELS)
    kept = [F.when(F.col("kind") != DIFFERS, F.col(c)).alias(c) for c in ("a", "ca", "b", "cb")]
    ground = scratch.write(by_place(sites, items).select(*kept, "kind", "place"))
    same_kind, others = ground.where(F.col("kind") != DIFFERS).drop("kind"), ground.where(F.col("kind") == DIFFERS)
    passes = max(1, min(PASSES, (named.count() + ground.count()) // ROWS))
    part = lambda rows, c, i: rows.where(_of_pass(F.col(c), i, passes))
    # Each pair of classes once, and whether it was met by names.
    met = lambda i: part(same_kind, "ca", i).select("ca", "cb", F.lit(False).alias("named")).union(part(named, "ca", i).select("ca", "cb", F.lit(True))).groupBy("ca", "cb").agg(F.max("named").alias("named"))
    levels = scratch.write_in_passes(passes, lambda i: compared(met(i), part(one, "ca", i), two))
    scratch.drop(named)
    near = scratch.write_in_passes(passes, lambda i: part(same_kind, "ca", i).join(part(levels, "ca", i), ["ca", "cb"]))

    # Of pairs of different kinds, which are no matches, names are not compared: they count under level 0.
    patterns = near.select(*fields).union(others.select(F.lit(0), "kind", "place")).groupBy(*fields).count()
    counts = {tuple(r[f] for f in fields): r["count"] for r in patterns.collect()}  # at most 75 rows
    scratch.drop(ground)
    sizes = [df.select("c" + m, F.col("placed").alias("n" + m)) for df, m in ((one, "a"), (two, "b"))]
    matched = levels.where("named").drop("named")
    both = scratch.write_in_passes(passes, lambda i: part(matched, "ca", i).join(part(sizes[0], "ca", i), "ca").join(sizes[1], "cb").groupBy("name", "kind").agg(F.sum(F.col("na") * F.col("nb")).cast("bigint").alias("n")))
    close = near.where("named").groupBy("name", "kind").agg((-F.count("*")).alias("n"))
    apart = {(r["name"], r["kind"]): r["n"] for r in both.union(close).groupBy("name", "kind").agg(F.sum("n").alias("n")).collect()}  # at most 15 rows
    one, before = scratch.write(one.drop("p1")), one
    scratch.drop(before, two, both)
    odds = estimate(counts, apart)
    table = F.broadcast(spark.createDataFrame([(*p, o) for p, o in odds.items()], ", ".join(f"{f} int" for f in fields) + ", odds double"))

    weighed = near.join(table, fields).select("a", "ca", "b", "cb", "odds")
    # What an item meets by its name: of a class, k1 sites with which a place can't be compared and k0 that are apart.
    has = N.usable(F.col("lat"), F.col("lon"))
    kinds = F.array(F.struct(F.lit(NOT_STATED["place"]).alias("place"), F.col("k1").alias("k")), F.struct(F.lit(APART).alias("place"), F.col("k0").alias("k")))

    def by_names(i: int) -> DataFrame:
        met = part(items.select(F.col("id").alias("b"), F.col("c").alias("cb"), has.alias("has")), "cb", i).join(part(matched, "cb", i).join(one, "ca"), "cb")
        known = part(near, "cb", i).groupBy("b", "ca").agg(F.count("*").alias("known"))
        met = met.join(known, ["b", "ca"], "left").withColumn("known", F.coalesce("known", F.lit(0)))
        met = met.select("b", "ca", "name", "kind", "a_placed", "a_lost", "known", "has", F.when(F.col("has"), F.col("lost")).otherwise(F.col("lost") + F.col("placed")).alias("k1"), F.when(F.col("has"), F.col("placed") - F.col("known")).otherwise(0).alias("k0"))
        return met.select("*", F.explode(kinds).alias("e")).select("b", "ca", "name", "kind", "a_placed", "a_lost", "known", "has", "e.place", "e.k").where("k > 0").join(table, fields)

    met = scratch.write_in_passes(passes, by_names)
    scratch.drop(levels, one, items)
    total = weighed.select("b", "odds").union(met.select("b", (F.col("odds") * F.col("k")))).groupBy("b").agg(F.sum("odds").alias("total"))
    total = scratch.write(total)

    sure = lambda rows: rows.join(total, "b").withColumn("confidence", F.col("odds") / (1 + F.col("total"))).where(F.col("confidence") > least)
    single = scratch.write_in_passes(passes, lambda i: sure(part(met.where("k = 1"), "b", i)))
    scratch.drop(met)
    # The one site is the class's only one of that sort, unless others of the class are near: then it is the one left.
    only = single.where(f"place = {NOT_STATED['place']} or known = 0").select(F.when(F.col("place") == APART, F.col("a_placed")).otherwise(F.coalesce("a_lost", "a_placed")).alias("a"), "b", "confidence")
    rest = single.where(f"place = {APART} and known > 0").select("ca", "b", "confidence").join(sites.where(has).select(F.col("id").alias("a"), F.col("c").alias("ca")), "ca").join(near.select("a", "b"), ["a", "b"], "left_anti")
    return sure(weighed).select("a", "b", "confidence").union(only).union(rest.select("a", "b", "confidence"))
