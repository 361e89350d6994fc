"""Problem 7: variant spellings of names typed by people, linked to the entity that is meant.

Every listed name is rewritten by rules into all its forms, whatever the number n of its proper words: words in any order
("name"), two neighbours run together in either order and all run together (2n - 1 forms), all words but one as initials
(n forms), its nickname without filling words ("nick") and its short code ("code"); legal forms at the end go, and kinds
(their translations, abbreviations and absence), numbers and sizes are brought to one notation. Names as typed are
rewritten by the same rules, so that variants meet by equality of a form. Short forms of given names and typing errors
are rewritten by words: a word that no listed name has is spelled by all its deletions, which meet the deletions of listed
words by equality, and pairs within the allowed distance become rewritings.

A form is a number: the sum of its words' hashes, so that the order does not count, mixed with its rule and suffix. A name
with initials has one form for each whole word (with the initials of all others); it meets another name where all of them
do. That takes as many forms as there are words, and says the same as all choices of words to shorten.

A form that few entities bear tells more: the score of a meeting is log(entities / bearers of the form), less what its
rewritings cost. The best score wins; where two entities reach it, the name has none. A stated kind must be the entity's,
and the number or size must be the same or missing in both.

Work is done for each distinct name and distinct word, so a name typed in a third of all rows costs one. The list of
entities meets the names in joins; nothing is collected. Of a name that has over MOST combinations of rewritten words, only
those that reach a listed name are spelled out, at the least cost: it meets listed names by its rarest words, and a matching of
its places with the listed words finds the combination for each form. That gives what spelling out all of them would.

Nulls, empty and blank names have no entity. A second name of the same row is used as well; the better score counts, the
first name's where both are equal. Repeated rows of one key count once. Empty tables give empty results. A name with more
words than any listed one (and one more, as two may be run together) can only meet a name that is all its words run together;
with more words than half the letters of any such it meets nothing, so very long texts cost nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synoptic.llm import lexicon as L
from synoptic.runtime import Scratch

#: What a typing error and a short form of a given name cost; combinations that are spelled out; and the length from which
#: words are found by their parts rather than by their deletions.
COST, SHORT_FORM, MOST, LONG = 1.0, 0.25, 256, 24
PARSED = T.StructType([T.StructField("core", T.ArrayType(T.StringType())), T.StructField("kind", T.StringType()), T.StructField("suffix", T.StringType()), T.StructField("nick", T.ArrayType(T.StringType())), T.StructField("code", T.StringType())])
_hash = xxhash.xxh3_64_intdigest


def spellings(word: str, listed: bool) -> list[str]:
    """What two words within the allowed distance have in common: their deletions; of long words, one of five parts at its
    place, as two errors (swaps, even) touch at most four. The typed word is looked at as if it had each length that the
    listed one may have, and its parts each shift."""
    if len(word) <= LONG:
        return list(L.deletions(word, L.allowed(word)))
    out = []
    for size in (len(word),) if listed else range(len(word) - 2, len(word) + 3):
        cut = [size * i // 5 for i in range(6)]
        for i in range(5):
            for shift in (0,) if listed else range(-2, 3):
                at, end = cut[i] + shift, cut[i + 1] + shift
                if at >= 0 and end <= len(word):
                    out.append(f"{size} {i} {word[at:end]}")
    if len(word) <= LONG + 2:
        # The other word may be short enough to go by its deletions.
        out += list(L.deletions(word, 2))
    return list(dict.fromkeys(out))


def typing_errors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(word, meant, cost) for the pairs within what the shorter word may have."""
    for df in batches:
        most = [min(L.allowed(a), L.allowed(b)) for a, b in zip(df["word"], df["meant"], strict=True)]
        errors = [L.distance(a, b, m) for a, b, m in zip(df["word"], df["meant"], most, strict=True)]
        out = df.assign(cost=[e * COST for e in errors])
        yield out[[e <= m for e, m in zip(errors, most, strict=True)]]


def _number(rule: str, total: int, end: str) -> int:
    """A form as a signed number of 64 bits."""
    return _hash(f"{rule}:{total & 0xFFFFFFFFFFFFFFFF:x}|{end}") - (1 << 63)


def forms_of(core: list[str], suffix: str | None, nick: bool, code: str | None, listed: bool, shortened: bool = True) -> list[tuple[int, int]]:
    """(form, how many forms of this name must meet) for all rewritings of a name's parts. `shortened`: whether names of
    the other side may have initials where this one has words."""
    end = suffix or ""
    out = [(_number("code", _hash(code), ""), 1)] if code else []
    if not core:
        return out
    each = [_hash(w) for w in core]
    total, n = sum(each), len(core)
    if nick:
        return [*out, (_number("nick", total, end), 1)]
    whole = [i for i in range(n) if len(core[i]) > 1]
    if n > 1 or len(core[0]) > 3 or not code:
        out.append((_number("name", total, end), 1))
    if n == 1:
        return out
    for i in range(n - 1):
        a, b = core[i], core[i + 1]
        if len(a) > 1 and len(b) > 1:
            for joined in (a + b, b + a) if listed else (a + b,):
                out.append((_number("name", total - each[i] - each[i + 1] + _hash(joined), end), 1))
    if n > 2 and len(whole) == n:
        out.append((_number("name", _hash("".join(core)), end), 1))
    if len(whole) < n or listed or shortened:
        # "initial": the listed words are whole, some of the typed ones are not; "short": the other way round.
        first = [_hash("^" + w[0]) for w in core]
        initials = sum(first)
        rule = "initial" if listed == (len(whole) == n) else "short"
        forms = dict.fromkeys(_number(rule, initials - first[i] + each[i], end) for i in whole)
        out += [(f, 1 if len(whole) == n else len(forms)) for f in forms]
    return list(dict.fromkeys(out))


def listed_names(entities: DataFrame, key: str, label: str, aliases: str, rules: L.Rules) -> DataFrame:
    """(entity, nth, kind, core, suffix, nick, code): every listed name; an alias without a kind takes none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = []
            for entity, main, others in zip(df["k"], df["l"], df["o"], strict=True):
                for i, name in enumerate([main, *(others if others is not None else [])]):
                    p = L.parse(name, rules)
                    out.append((entity, i, p["kind"], p["core"], p["suffix"], bool(p["nick"]), p["code"]))
            yield pd.DataFrame(out, columns=["entity", "nth", "kind", "core", "suffix", "nick", "code"])

    kind = entities.schema[key].dataType.simpleString()
    rows = entities.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(label).alias("l"), F.col(aliases).alias("o"))
    return rows.mapInPandas(run, f"entity {kind}, nth int, kind string, core array<string>, suffix string, nick boolean, code string").where("size(core) > 0 or code is not null").distinct()


def listed_forms(names: DataFrame) -> DataFrame:
    """(form, need, entity, nth, kind): every form of every listed name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = []
            for entity, nth, kind, core, suffix, nick, code in df.itertuples(index=False, name=None):
                out += [(f, need, entity, nth, kind) for f, need in forms_of(list(core), suffix, nick, code, True)]
            yield pd.DataFrame(out, columns=["form", "need", "entity", "nth", "kind"])

    return names.mapInPandas(run, f"form bigint, need int, entity {names.schema['entity'].dataType.simpleString()}, nth int, kind string")


def listed_words(names: DataFrame) -> DataFrame:
    """(meant): every word of a listed name, and the words that neighbours make when they are run together."""
    joined = lambda a, b: F.transform(F.zip_with(F.slice("core", 1, F.size("core") - 1), F.slice("core", 2, F.size("core") - 1), lambda x, y: F.struct(x.alias("x"), y.alias("y"))), lambda p: F.concat(p[a], p[b]))
    pairs = F.when(F.size("core") > 1, F.concat(joined("x", "y"), joined("y", "x"))).otherwise(F.array().cast("array<string>"))
    return names.select(F.explode(F.concat("core", pairs)).alias("meant")).where("length(meant) > 3").distinct()


def typed_words(words: DataFrame, vocabulary: DataFrame, rules: L.Rules) -> DataFrame:
    """(word, meant, cost) for the typed words (word) that no listed name has: every listed word that may be meant; and for
    short forms of given names, their full forms."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def of_listed(w: pd.Series) -> pd.Series:
        return w.map(lambda x: spellings(x, True))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def of_typed(w: pd.Series) -> pd.Series:
        return w.map(lambda x: spellings(x, False))

    strange = words.where("length(word) > 3").join(vocabulary, F.col("word") == F.col("meant"), "left_anti")
    # A word is at most two letters longer than what is meant: longer ones than the other side's longest meet nothing.
    ends = lambda df, c: df.agg(F.coalesce(F.max(F.length(c)), F.lit(0)) + 2).first()[0]
    most_listed, most_typed = ends(vocabulary, "meant"), ends(strange, "word")
    left = strange.where(F.length("word") <= most_listed).select("word", F.explode(of_typed("word")).alias("spelling"))
    right = vocabulary.where(F.length("meant") <= most_typed).select("meant", F.explode(of_listed("meant")).alias("spelling"))
    errors = left.join(right, "spelling").select("word", "meant").distinct().mapInPandas(typing_errors, "word string, meant string, cost double")
    given = [(w, full) for w, names in rules.given.items() for full in names.split()]
    if not given:
        return errors
    short = words.sparkSession.createDataFrame(given, "word string, meant string").join(words, "word", "left_semi").join(vocabulary, "meant", "left_semi")
    return errors.unionByName(short.withColumn("cost", F.lit(SHORT_FORM)))


def typed_forms(names: DataFrame, meant: DataFrame, longest: int, letters: int, shortened: bool) -> tuple[DataFrame, DataFrame]:
    """((name, kind, pick, form, need, cost): the forms of each typed name over all that its words may mean; the names (name,
    p, options, far) of which there are too many, or that have more words (far) than listed names but for run-together ones)."""
    words = names.select("name", F.posexplode("p.core").alias("at", "word")).join(meant, "word")
    options = words.groupBy("name").agg(F.collect_list(F.struct("at", "meant", "cost")).alias("options"))
    far = F.size("p.core") > longest + 1
    # Words that are run together have two letters or more, so that names of more words meet nothing but by their code.
    rows = names.where(~far | (F.size("p.core") * 2 <= letters) | F.col("p.code").isNotNull()).join(options, "name", "left").select("name", "p", "options", far.alias("far"))
    counts = F.transform(F.sequence(F.lit(0), F.size("p.core") - 1), lambda i: 1 + F.size(F.filter("options", lambda o: o["at"] == i)))
    many = F.col("far") | (F.col("options").isNotNull() & (F.aggregate(counts, F.lit(1.0), lambda s, n: s * n) > MOST))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = []
            for name, p, options, far in zip(df["name"], df["p"], df["options"], df["far"], strict=True):
                choices = _choices(p["core"], options)
                if far or options is not None and math.prod(map(len, choices)) > MOST:
                    out += [(name, p["kind"], 0, form, need, 0.0) for form, need in forms_of([], None, False, p["code"], False)]
                    continue
                for i, pick in enumerate(product(*[c.items() for c in choices])):
                    cost = sum(c for _, c in pick)
                    out += [(name, p["kind"], i, form, need, cost) for form, need in forms_of([w for w, _ in pick], p["suffix"], len(p["nick"]) > 0, p["code"], False, shortened)]
            yield pd.DataFrame(out, columns=["name", "kind", "pick", "form", "need", "cost"])

    return rows.mapInPandas(run, "name string, kind string, pick bigint, form bigint, need int, cost double"), rows.where(many)


def _choices(core: list[str], options: list | None) -> list[dict[str, float]]:
    """What each word may mean, at the least cost."""
    out = [{w: 0.0} for w in core]
    for o in options if options is not None else ():
        own = out[o["at"]]
        own[o["meant"]] = min(o["cost"], own.get(o["meant"], o["cost"]))
    return out


def _assigned(table: list[list[tuple[float, tuple[str, ...]] | None]]) -> list[str] | None:
    """The words of the places (rows), each given another slot (column), at the least cost in all, by the Hungarian method;
    None where a place has no slot left."""
    n, never = len(table), 1e9
    cost = [[x[0] if x else never for x in row] for row in table]
    u, v, row_of, way = [0.0] * (n + 1), [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):
        row_of[0], j, least, seen = i, 0, [math.inf] * (n + 1), [False] * (n + 1)
        while row_of[j]:
            seen[j], delta, after = True, math.inf, 0
            for k in range(1, n + 1):
                if not seen[k]:
                    now = cost[row_of[j] - 1][k - 1] - u[row_of[j]] - v[k]
                    if now < least[k]:
                        least[k], way[k] = now, j
                    if least[k] < delta:
                        delta, after = least[k], k
            for k in range(n + 1):
                if seen[k]:
                    u[row_of[k]] += delta
                    v[k] -= delta
                else:
                    least[k] -= delta
            j = after
        while j:
            row_of[j], j = row_of[way[j]], way[j]
    chosen = [x for _, x in sorted((row_of[j], table[row_of[j] - 1][j - 1]) for j in range(1, n + 1))] if all(table[row_of[j] - 1][j - 1] for j in range(1, n + 1)) else None
    return [w for _, words in chosen for w in words] if chosen is not None else None


def bags_of(core: list[str], nick: bool, coded: bool) -> list[list[str]]:
    """The words of each "name" (or "nick") form of a listed name."""
    out = [core] if nick or len(core) > 1 or len(core[0]) > 3 or not coded else []
    if nick:
        return out
    for i in range(len(core) - 1):
        a, b = core[i], core[i + 1]
        if len(a) > 1 and len(b) > 1:
            out += [[*core[:i], joined, *core[i + 2 :]] for joined in (a + b, b + a)]
    if len(core) > 2 and all(len(w) > 1 for w in core):
        out.append(["".join(core)])
    return out


def best_picks(choices: list[dict[str, float]], nick: bool, coded: bool, core: list[str], listed_nick: bool, listed_coded: bool) -> Iterator[list[str]]:
    """For each form of a listed name (its words `core`) that some choice of the typed words has in common, such a choice of
    the least cost."""
    n = len(choices)
    if nick != listed_nick:
        return
    if n == 1 and coded and not nick:
        choices = [{w: c for w, c in choices[0].items() if len(w) > 3}]

    def one(i: int, word: str) -> tuple[float, tuple[str, ...]] | None:
        return (choices[i][word], (word,)) if word in choices[i] else None

    def two(i: int, word: str) -> tuple[float, tuple[str, ...]] | None:
        cuts = ((word[:k], word[k:]) for k in range(2, len(word) - 1))
        return min(((choices[i][a] + choices[i + 1][b], (a, b)) for a, b in cuts if a in choices[i] and b in choices[i + 1]), default=None)

    found = []
    for bag in bags_of(core, nick, listed_coded):
        if len(bag) == n:
            found.append(_assigned([[one(i, w) for w in bag] for i in range(n)]))
        elif nick:
            continue
        elif len(bag) == n - 1:
            found += [_assigned([[two(at, w) if i == at else one(i + (i > at), w) for w in bag] for i in range(n - 1)]) for at in range(n - 1)]
        if len(bag) == 1 and n > 2:
            ends: dict[int, tuple[float, list[str]]] = {0: (0.0, [])}
            for own in choices:
                after: dict[int, tuple[float, list[str]]] = {}
                for end, (cost, words) in ends.items():
                    for w, c in own.items():
                        if len(w) > 1 and bag[0].startswith(w, end) and cost + c < after.get(end + len(w), (math.inf,))[0]:
                            after[end + len(w)] = (cost + c, [*words, w])
                ends = after
            found.append(ends.get(len(bag[0]), (0.0, None))[1])
    if len(core) == n > 1 and not nick:
        whole, first = {w for w in core if len(w) > 1}, [w[0] for w in core]
        if all(len(w) > 1 for w in core):
            # Of the typed words some are initials, and all others are words of the listed name: for each of those the best.
            known = [{w: c for w, c in own.items() if len(w) == 1 or w in whole} for own in choices]
            least = lambda own, letter: min(((c, (w,)) for w, c in own.items() if w[0] == letter), default=None)
            for short in range(n):
                initials = {w: c for w, c in known[short].items() if len(w) == 1}
                for at in range(n) if initials else ():
                    for word in known[at] if at != short else ():
                        if len(word) > 1:
                            given = [initials if i == short else {word: known[at][word]} if i == at else known[i] for i in range(n)]
                            found.append(_assigned([[least(own, letter) for letter in first] for own in given]))
        elif whole:
            # All typed words are whole, and every whole word of the listed name is among them.
            full = [{w: c for w, c in own.items() if len(w) > 1} for own in choices]
            letters = list(first)
            for w in whole:
                letters.remove(w[0])
            least = lambda own, letter: min(((c, (w,)) for w, c in own.items() if w[0] == letter), default=None)
            found.append(_assigned([[*((own[w], (w,)) if w in own else None for w in sorted(whole)), *(least(own, x) for x in letters)] for own in full]))
    yield from (pick for pick in found if pick is not None)


def _anchors(places: list) -> tuple[list[int], list[int]]:
    """(places of which a listed name of as many words must have a word; places of which one stays if two neighbours are run
    together), those that meet fewest."""
    weight = {p["at"]: p["weight"] for p in places}
    must = [p["at"] for p in places if not p["open"]]
    apart = [(weight[a] + weight[b], [a, b]) for a in weight for b in weight if b - a > 1]
    return [min(must, key=lambda a: (weight[a], a))] if must else sorted(weight), min(apart)[1] if apart else []


def by_matching(many: DataFrame, listed: DataFrame, shortened: bool) -> DataFrame:
    """(name, kind, pick, form, need, cost) of names with many combinations: the forms of those that reach a listed name.

    Pairs to be matched come from equal keys: "=" a word of a form of so many words ("#" of a nickname), "<" the beginning of
    words that are run together, "~" the longest word of a listed name that has initials."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = []
            for core, suffix, nick, coded in df.itertuples(index=False, name=None):
                core = list(core)
                bags = bags_of(core, nick, coded)
                own = {("#" if nick else "=") + w + f"|{len(bag)}" for bag in bags for w in bag}
                own |= {"<" + bag[0][:k] for bag in bags if len(bag) == 1 and not nick for k in range(2, len(bag[0]))}
                if not nick and len(core) > 1:
                    # With initials on the typed side a name meets by its words as they are, as it does by its first form.
                    whole = [w for w in core if len(w) > 1]
                    if whole and len(whole) < len(core):
                        own.add("~" + max(whole, key=len) + f"|{len(core)}")
                out += [(key, core, suffix, nick, coded) for key in sorted(own)]
            yield pd.DataFrame(out, columns=["key", "core", "suffix", "listed_nick", "listed_coded"])

    @F.pandas_udf("core_at array<int>, joined_at array<int>")
    def anchors(places: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_anchors(list(p)) for p in places], columns=["core_at", "joined_at"])

    names = listed.where("size(core) > 0").select("core", F.coalesce("suffix", F.lit("")).alias("suffix"), "nick", F.col("code").isNotNull().alias("coded")).distinct()
    known = names.mapInPandas(keys, "key string, core array<string>, suffix string, listed_nick boolean, listed_coded boolean")
    own = F.concat(F.transform("p.core", lambda w, i: F.struct(i.alias("at"), w.alias("meant"), F.lit(0.0).alias("cost"))), F.coalesce("options", F.array().cast("array<struct<at int, meant string, cost double>>")))
    typed = many.select("name", F.coalesce("p.suffix", F.lit("")).alias("suffix"), F.size("p.core").alias("n"), (F.size("p.nick") > 0).alias("nick"), "far", F.explode(own).alias("o"))
    typed = typed.select("name", "suffix", "n", "nick", "far", "o.at", F.col("o.meant").alias("word")).distinct()
    borne = listed.select(F.explode("core").alias("word")).groupBy("word").agg(F.count("*").alias("weight"))
    places = typed.where("not far").join(borne, "word", "left").groupBy("name", "at").agg(F.sum(F.coalesce("weight", F.lit(0))).alias("weight"), F.max(F.length("word") == 1).alias("open"))
    chosen = places.groupBy("name").agg(F.collect_list(F.struct("at", "weight", "open")).alias("places")).select("name", anchors("places").alias("a"))
    long = F.length("word") > 1
    key = F.when(F.col("nick"), F.lit("#")).otherwise(F.lit("="))
    each = F.array(
        F.when(~F.col("far") & F.array_contains("a.core_at", F.col("at")), F.concat(key, "word", F.lit("|"), "n")),
        F.when(~F.col("far") & ~F.col("nick") & F.array_contains("a.joined_at", F.col("at")), F.concat(key, "word", F.lit("|"), F.col("n") - 1)),
        F.when(~F.col("nick") & (F.col("at") == 0) & (F.col("n") > 1) & long, F.concat(F.lit("<"), "word")),
        F.when(~F.col("far") & ~F.col("nick") & (F.col("n") > 1) & long & F.lit(shortened), F.concat(F.lit("~"), "word", F.lit("|"), "n")),
    )
    met = typed.join(chosen, "name", "left").select("name", "suffix", F.explode(each).alias("key")).where("key is not null").join(known, ["key", "suffix"]).select("name", "core", "listed_nick", "listed_coded").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = []
            for name, p, options, core, listed_nick, listed_coded in df.itertuples(index=False, name=None):
                choices, nick = _choices(p["core"], options), len(p["nick"]) > 0
                for pick in best_picks(choices, nick, p["code"] is not None, list(core), listed_nick, listed_coded):
                    cost = sum(own[w] for own, w in zip(choices, pick, strict=True))
                    number = _number("pick", 0, " ".join(pick))
                    out += [(name, p["kind"], number, form, need, cost) for form, need in forms_of(pick, p["suffix"], nick, p["code"], False, shortened)]
            yield pd.DataFrame(out, columns=["name", "kind", "pick", "form", "need", "cost"])

    pairs = met.join(many, "name").select("name", "p", "options", "core", "listed_nick", "listed_coded")
    return pairs.mapInPandas(run, "name string, kind string, pick bigint, form bigint, need int, cost double").distinct()


def meanings(names: DataFrame, entities: DataFrame, key: str, label: str, aliases: str, scratch: Scratch, rules: L.Rules = L.RULES) -> DataFrame:
    """(name, entity, score) of each distinct name (name) that has one best entity."""

    @F.pandas_udf(PARSED)
    def parsed(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([L.parse(n, rules) for n in texts], columns=["core", "kind", "suffix", "nick", "code"])

    listed = scratch.write(listed_names(entities, key, label, aliases, rules))
    forms = scratch.write(listed_forms(listed))
    # Scalars: how many words and letters the longest listed names have, how many entities there are, and whether any name has
    # initials.
    longest, letters, whole, shortened = listed.agg(F.coalesce(F.max(F.size("core")), F.lit(0)), F.coalesce(F.max(F.length(F.concat_ws("", "core"))), F.lit(0)), F.count_distinct("entity"), F.coalesce(F.max(F.exists("core", lambda w: F.length(w) == 1)), F.lit(False))).first()
    weights = forms.groupBy("form").agg(F.count_distinct("entity").alias("bearers"))
    rare = forms.join(weights, "form").select("form", F.col("need").alias("need2"), "entity", "nth", F.col("kind").alias("listed_kind"), F.log(F.lit(whole + 1.0) / F.col("bearers")).alias("rarity"))
    own = scratch.write(names.withColumn("p", parsed("name")))
    words = scratch.write(own.select(F.explode("p.core").alias("word")).distinct())
    vocabulary = scratch.write(listed_words(listed))
    meant = scratch.write(typed_words(words, vocabulary, rules))
    spelled, many = typed_forms(own, meant, longest, letters, shortened)
    many = scratch.write(many)
    if not many.isEmpty():
        spelled = spelled.unionByName(by_matching(many, listed, shortened))
    met = spelled.join(rare, "form")
    loose = F.col("kind").isNull() | F.col("listed_kind").isNull() | (F.col("kind") == F.col("listed_kind")) | ((F.col("kind") == "telescope") & F.col("listed_kind").endswith("telescope"))
    # Names that must meet by several forms at once are counted apart; all others need one meeting.
    need = F.greatest("need", "need2")
    lane = F.when(need > 1, F.struct("pick", "nth", "need", "need2"))
    hits = met.where(loose).groupBy("name", "entity", lane.alias("lane")).agg(F.count("*").alias("n"), F.max(need).alias("need"), F.max(F.col("rarity") - F.col("cost")).alias("score")).where("n >= need")
    scored = hits.groupBy("name", "entity").agg(F.round(F.max("score"), 9).alias("score"))
    ties = scored.groupBy("name", "score").agg(F.count("*").alias("n"), F.min("entity").alias("entity"))
    return ties.groupBy("name").agg(F.max_by(F.struct("n", "entity", "score"), "score").alias("b")).where("b.n = 1").select("name", "b.entity", "b.score")


def link(rows: DataFrame, key: str, names: list[str], entities: DataFrame, entity_key: str, label: str, aliases: str, name: str = "variants", rules: L.Rules = L.RULES) -> DataFrame:
    """(key, entity, score): each row's entity by the best of its names."""
    scratch = Scratch(rows.sparkSession, name)
    given = F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).alias("name")) for i, c in enumerate(names)])
    long = scratch.write(rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.explode(given).alias("g")).select("key", "g.at", "g.name").where("trim(name) <> ''").distinct())
    known = scratch.write(meanings(long.select("name").distinct(), entities, entity_key, label, aliases, scratch, rules))
    met = long.join(known, "name")
    return met.groupBy("key").agg(F.max_by(F.struct("entity", "score"), F.struct("score", -F.col("at"))).alias("b")).select("key", "b.entity", "b.score")
