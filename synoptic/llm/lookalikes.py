"""Problem 1: visually identical text with different characters.

A name is brought to one form in two steps.

1. Compatibility normalization of what does not show: invisible characters go, width forms and half-width kana become
   ordinary ones, ligatures, numerals and dots in one character become the characters that they show, every kind of blank
   becomes a space and blanks at the ends go, short hyphens become "-", and accents are composed. Characters whose
   compatibility form looks different (a superscript, a circled digit, a bold letter) stay.
2. Look-alike letters. Each token is a lattice: a letter stands for all letters of the same shape in Latin, Greek,
   Cyrillic, Armenian, Cherokee and Lisu. Viterbi finds the token's reading with the highest sum of character bigram scores of one script, plus a
   penalty for each change of script. The scores are counted over all tokens of the column that are of a single script.

A lattice depends only on shapes, so two names that look the same have the same lattice and the same reading, and a
reading always keeps the shapes, so names that look different stay different. Whole scripts are kept by the scores: a
Russian word typed with Latin letters comes out in Cyrillic.

Bigram counts and the readings of distinct tokens are made once for each distinct token, not for each row, so a name that
holds a third of all rows costs one reading. The counts go to the workers where there are at most MOST_BIGRAMS pairs of
characters; beyond that each token gets the counts of its own lattice by a join, with the same readings.

Nulls stay null; an empty text, or one of blanks and invisible characters only, is the empty form. Repeated rows of one
key count once; rows whose form is equal but whose characters are equal as well are no pair. Very long texts are handled
whole. Empty tables give empty results.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synoptic.runtime import Scratch

#: Letters of one shape, Latin, then Greek or Cyrillic. Accented letters follow from their base letter.
SHAPES = {
    "A": "ΑА", "B": "ΒВ", "C": "С", "E": "ΕЕ", "H": "ΗН", "I": "ΙІ", "J": "Ј", "K": "ΚК", "M": "ΜМ", "N": "Ν", "O": "ΟО", "P": "ΡР", "S": "Ѕ", "T": "ΤТ", "X": "ΧХ", "Y": "ΥҮ", "Z": "Ζ", "Q": "Ԛ", "W": "Ԝ",
    "a": "а", "c": "с", "d": "ԁ", "e": "е", "h": "һ", "i": "і", "j": "ј", "o": "οо", "p": "р", "q": "ԛ", "s": "ѕ", "v": "νѵ", "w": "ԝ", "x": "х", "y": "у",
    "Г": "Γ", "П": "Π", "Ф": "Φ",
}
#: Capitals of Cherokee and letters of Lisu and Armenian with the Latin letter of their shape.
MORE_SHAPES = {
    "A": "Ꭺꓮ", "B": "Ᏼꓐ", "C": "Ꮯꓚ", "D": "Ꭰꓓ", "E": "Ꭼꓰ", "F": "ꓝ", "G": "Ꮐꓖ", "H": "Ꮋꓧ", "I": "ӀꓲІ", "J": "Ꭻꓙ", "K": "Ꮶꓗ", "L": "Ꮮꓡ", "M": "Ꮇꓟ", "N": "ꓠ", "O": "Օꓳ", "P": "Ꮲꓑ", "R": "Ꭱꓣ", "S": "Ꮪꓢ", "T": "Ꭲꓔ",
    "U": "Սꓴ", "V": "Ꮩꓦ", "W": "Ꮃꓪ", "X": "ꓫ", "Y": "Ꭹꓬ", "Z": "Ꮓꓜ", "g": "ց", "h": "հ", "l": "ӏ", "n": "ո", "o": "օ", "q": "զ", "u": "ս",
}
LATTICE = {c: shape for k in SHAPES | MORE_SHAPES for shape in ["".join(dict.fromkeys(k + SHAPES.get(k, "") + MORE_SHAPES.get(k, "")))] for c in shape}
#: Hyphens of the same length as "-".
HYPHENS = "‐‑﹣－"
_INVISIBLE = regex.compile(r"[\p{Default_Ignorable_Code_Point}\p{Cf}]|(?![\t\n\v\f\r\x85])\p{Cc}")
_BLANK = regex.compile(r"[\s\p{Zs}\p{Zl}\p{Zp}]")
_SCRIPTS = {s: regex.compile(rf"\p{{Script={s}}}") for s in ("Latin", "Greek", "Cyrillic", "Armenian", "Cherokee", "Lisu")}
#: What a change of script costs, in bigrams never seen; and the largest table of counts that is sent to the workers.
CHANGE, MOST_BIGRAMS = 4.0, 200_000
COUNTS = "script string, pair string, n bigint"


def _widths() -> dict[int, str]:
    """Characters that have a compatibility form which looks the same: it differs in width, or in how many characters there
    are."""
    forms = {}
    for c in [*range(0xFF01, 0xFFF0), *range(0x3000, 0x3001)]:
        kind = unicodedata.decomposition(chr(c)).split(" ")
        if kind[0] in ("<wide>", "<narrow>"):
            forms[c] = unicodedata.normalize("NFKC", chr(c))
    # Latin and Armenian ligatures, roman numerals, and two or three dots in one character.
    for c in [*range(0xFB00, 0xFB18), *range(0x2160, 0x2180), 0x2024, 0x2025, 0x2026]:
        if unicodedata.decomposition(chr(c)).startswith("<compat>"):
            forms[c] = unicodedata.normalize("NFKC", chr(c))
    return forms | {ord(h): "-" for h in HYPHENS}


WIDTHS = _widths()


def tidy(text: str) -> str:
    """Step 1. Of invisible characters only those within Japanese marks could matter, and half-width voicing marks are
    joined to their kana by the composition."""
    text = _INVISIBLE.sub("", text).translate(WIDTHS)
    return unicodedata.normalize("NFC", _BLANK.sub(" ", text)).strip(" ")


@lru_cache(maxsize=100_000)
def script_of(c: str) -> str | None:
    return next((s for s, p in _SCRIPTS.items() if p.match(c)), None)


def _single_script(token: str) -> str | None:
    scripts = {script_of(c) for c in token} - {None}
    return scripts.pop() if len(scripts) == 1 else None


def read_token(token: str, score: dict[tuple[str, str], float], floor: float) -> str:
    """Step 2: the best reading of a token's lattice, in time that grows with its length. Of readings that tie, the one
    whose letters come first in SHAPES: an order that does not depend on the letters that were typed."""
    bare = unicodedata.normalize("NFD", token)
    if not any(c in LATTICE for c in bare):
        return token
    # A state is (last letter, script so far); each step keeps the best way into every state.
    best: dict[tuple[str, str | None], float] = {("^", None): 0.0}
    steps: list[dict[tuple[str, str | None], tuple[tuple[str, str | None], str]]] = []
    for c in bare:
        after: dict[tuple[str, str | None], float] = {}
        back: dict[tuple[str, str | None], tuple[tuple[str, str | None], str]] = {}
        for x in LATTICE.get(c, c):
            own = script_of(x)
            for state, total in best.items():
                last, script = state
                value = total + score.get((own, last + x), floor) if own else total
                if own and script and own != script:
                    value += CHANGE * floor
                key = (x, own) if own else ("^", script)
                if key not in after or value > after[key]:
                    after[key], back[key] = value, (state, x)
        best = after
        steps.append(back)
    state, out = max(best, key=best.__getitem__), []
    for back in reversed(steps):
        state, x = back[state]
        out.append(x)
    return unicodedata.normalize("NFC", "".join(reversed(out)))


@F.pandas_udf(T.StringType())
def tidy_column(texts: pd.Series) -> pd.Series:
    return texts.map(tidy, na_action="ignore")


def bigrams(tokens: DataFrame) -> DataFrame:
    """(script, pair, n) over all (token, n) of a single script; "^" is the start of a word."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out: dict[tuple[str, str], int] = {}
            for token, n in zip(df["token"], df["n"], strict=True):
                token = unicodedata.normalize("NFD", token)
                if script := _single_script(token):
                    last = "^"
                    for c in token:
                        if script_of(c):
                            key = (script, last + c)
                            out[key] = out.get(key, 0) + int(n)
                            last = c
                        else:
                            last = "^"
            yield pd.DataFrame([(s, p, n) for (s, p), n in out.items()], columns=["script", "pair", "n"])

    return tokens.mapInPandas(run, COUNTS).groupBy("script", "pair").agg(F.sum("n").alias("n"))


def scores(pairs: DataFrame) -> DataFrame:
    """(script, pair, score): the log-probability of a character after another within a script."""
    first = F.substring("pair", 1, 1).alias("last")
    totals = pairs.groupBy("script", first).agg(F.sum("n").alias("of"))
    return pairs.withColumn("last", first).join(totals, ["script", "last"]).select("script", "pair", F.log(F.col("n") / (F.col("of") + 1.0)).alias("score"))


def lattice_pairs(token: str) -> set[tuple[str, str]]:
    """All (script, pair) that a reading of the token can have."""
    out, before = set(), {"^"}
    for c in unicodedata.normalize("NFD", token):
        options = {x: script_of(x) for x in LATTICE.get(c, c)}
        out |= {(s, last + x) for x, s in options.items() if s for last in before}
        before = {x if s else "^" for x, s in options.items()}
    return out


def readings(tokens: DataFrame, score: DataFrame, floor: float) -> DataFrame:
    """(token, reading) of the tokens (token) whose reading has other characters."""
    if (size := score.count()) <= MOST_BIGRAMS:
        sent = tokens.sparkSession.sparkContext.broadcast({(r["script"], r["pair"]): r["score"] for r in score.limit(size).collect()})

        def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for df in batches:
                out = df.assign(reading=[read_token(t, sent.value, floor) for t in df["token"]])
                yield out[out["token"] != out["reading"]]

        return tokens.select("token").mapInPandas(read, "token string, reading string")

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            yield pd.DataFrame([(t, s, p) for t in df["token"] for s, p in lattice_pairs(t)], columns=["token", "script", "pair"])

    def read_own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = pd.DataFrame({"token": df["token"], "reading": [read_token(t, {(e["script"], e["pair"]): e["score"] for e in own}, floor) for t, own in zip(df["token"], df["own"], strict=True)]}, dtype=object)
            yield out[out["token"] != out["reading"]]

    wanted = tokens.select("token").mapInPandas(spread, "token string, script string, pair string")
    known = wanted.join(score, ["script", "pair"]).groupBy("token").agg(F.collect_list(F.struct("script", "pair", "score")).alias("own"))
    none = F.array().cast("array<struct<script:string,pair:string,score:double>>")
    return tokens.select("token").join(known, "token", "left").withColumn("own", F.coalesce("own", none)).mapInPandas(read_own, "token string, reading string")


def one_form(values: DataFrame, name: str = "forms") -> DataFrame:
    """(value, form) of every distinct value of `values` (value)."""
    spark = values.sparkSession
    scratch = Scratch(spark, name)
    tidied = scratch.write(values.where("value is not null").distinct().withColumn("tidy", tidy_column("value")))
    counted = scratch.write(tidied.groupBy("tidy").count().select("tidy", F.explode(F.split("tidy", " ")).alias("token"), "count").where("token <> ''").groupBy("token").agg(F.sum("count").alias("n")))
    pairs = scratch.write(bigrams(counted))
    whole = pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    changed_tokens = readings(counted, scratch.write(scores(pairs)), -math.log(whole + 1.0) - 1.0)
    positions = tidied.select("value", F.posexplode(F.split("tidy", " ")).alias("at", "token"))
    changed = positions.join(changed_tokens, "token")
    fixed = changed.groupBy("value").agg(F.map_from_entries(F.collect_list(F.struct("at", "reading"))).alias("new"))
    built = tidied.join(fixed, "value", "left")
    form = F.array_join(F.transform(F.split("tidy", " "), lambda t, i: F.coalesce(F.element_at("new", i), t)), " ")
    return built.select("value", F.when(F.col("new").isNull(), F.col("tidy")).otherwise(form).alias("form"))


def normalized(rows: DataFrame, key: str, fields: list[str], name: str = "forms") -> DataFrame:
    """(key, field, value, form) of every field of every row that is not null; repeated rows count once."""
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])
    scratch = Scratch(rows.sparkSession, name)
    long = scratch.write(rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.explode(entries).alias("e")).select("key", "e.field", "e.value").where("value is not null").distinct())
    # Written, as pairs read it several times.
    return scratch.write(long.join(one_form(long.select("value"), name), "value").select("key", "field", "value", "form"))


def look_alikes(forms: DataFrame) -> DataFrame:
    """(field, a, b), a < b: keys whose values in a field have one form but not the same characters. Empty forms show
    nothing and make no pair. Pairs are made between the different values of a form and then given to their keys, so
    copies of one value never meet one another."""
    shown = forms.where("form <> ''").select("field", "form", "value", "key").distinct()
    values = shown.select("field", "form", "value").distinct()
    many = values.join(values.groupBy("field", "form").agg(F.count("*").alias("n")).where("n > 1").drop("n"), ["field", "form"])
    pairs = many.join(many.withColumnRenamed("value", "value2"), ["field", "form"]).where("value < value2").drop("form")
    keys = shown.select("field", "value", "key")
    met = pairs.join(keys, ["field", "value"]).join(keys.select("field", F.col("value").alias("value2"), F.col("key").alias("key2")), ["field", "value2"])
    return met.where("key <> key2").select("field", F.least("key", "key2").alias("a"), F.greatest("key", "key2").alias("b")).distinct()


def members(forms: DataFrame) -> DataFrame:
    """(field, key, variant, class): rows whose values look the same have one class (their least key), those with the same
    characters one variant of it (the least key). One row for each value, however many look like it: two rows of one
    class and different variants are a pair of `look_alikes`."""
    shown = forms.where("form <> ''").select("field", "form", "value", "key").distinct()
    variants = shown.groupBy("field", "form", "value").agg(F.min("key").alias("variant"))
    classes = variants.groupBy("field", "form").agg(F.min("variant").alias("class"))
    return shown.join(variants, ["field", "form", "value"]).join(classes, ["field", "form"]).select("field", "key", "variant", "class")
