"""Scalar functions on names and texts. Plain rules are Column expressions; searches are Arrow functions.

All functions give null for null, and say so where an empty text has a result of its own.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Metres in a unit of length, as it is written in labels.
METRES = {"inch": 0.0254, "inches": 0.0254, "inche": 0.0254, "foot": 0.3048, "feet": 0.3048, "mm": 0.001, "millimeter": 0.001, "millimetre": 0.001, "cm": 0.01, "centimeter": 0.01, "centimetre": 0.01, "m": 1.0, "meter": 1.0, "metre": 1.0, "km": 1000.0, "kilometer": 1000.0, "kilometre": 1000.0}
#: Names of one series of spacecraft that stand for numbers.
NAMED_NUMBERS = {"rumba": 1, "salsa": 2, "samba": 3, "tango": 4}
AKA = ("also known as", "formerly the", "formerly", "a.k.a.", "aka")
_LENGTH = re.compile(r"(\d+(?:[.,]\d+)?)[ ]?-?(millimet(?:er|re)|centimet(?:er|re)|kilomet(?:er|re)|met(?:er|re)|inche?s?|foot|feet|cm|km|m)\b", re.IGNORECASE)
_LAUNCH = r"\b(\d{4}-\d{3}[A-Z])\b"


# Addresses -----------------------------------------------------------------------------------------------------------


def slug(label: Column) -> Column:
    """The label as the last part of an address: lower case, words of letters and digits joined by "-", no accents."""
    words = F.trim(F.regexp_replace(F.lower(label), r"[^\p{L}\p{N}_]+", " "))
    return F.replace(fold_accents(words), F.lit(" "), F.lit("-"))


def label_of_address(address: Column) -> Column:
    """What stands after "#", with spaces for hyphens."""
    return F.replace(F.substring_index(address, "#", -1), F.lit("-"), F.lit(" "))


def namespace(address: Column) -> Column:
    """The last part of an address before "#" (of /a/b#c: b); the whole where there is none."""
    return F.regexp_extract(address, r"([^/]*?)(?:#[^#]*)?$", 1)


@F.pandas_udf(T.StringType())
def fold_accents(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)), na_action="ignore")


# Languages, spacing --------------------------------------------------------------------------------------------------


def cut_language(value: Column) -> Column:
    """(text, lang) of a text with a suffix @lang; lang is null where there is none."""
    lang = F.regexp_extract(value, r"@([^ @]+)$", 1)
    return F.struct(F.when(lang == "", value).otherwise(F.regexp_replace(value, r"@[^ @]+$", "")).alias("text"), F.nullif(lang, F.lit("")).alias("lang"))


def clean(text: Column) -> Column:
    """One space for each run of blanks, no final dot, parentheses balanced: one that is not closed is closed at the end,
    the last of those too many is dropped."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"[\r\t]", " "), r"\n+", "\n"), r" +", " "))
    bare = F.regexp_replace(bare, r"\.$", "")
    excess = F.length(F.regexp_replace(bare, r"[^(]", "")) - F.length(F.regexp_replace(bare, r"[^)]", ""))
    return F.trim(F.when(excess > 0, F.concat(bare, F.lit(")"))).when(excess < 0, F.regexp_replace(bare, r"\)([^)]*)$", "$1")).otherwise(bare))


def without_parentheses(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"\([^()]*\)", " "), r" +", " "))


def without_punctuation(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\p{N}_\s]", " "), r"\s+", " "))


def without_tags(text: Column) -> Column:
    """Without <x>...</x> blocks."""
    return F.trim(F.regexp_replace(text, r"(?s)<(\w+)>.*?</\1>", ""))


def token_sort_key(text: Column) -> Column:
    """The words of a text in order of their characters, lower case."""
    return F.array_join(F.array_sort(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")), " ")


def without_words(text: Column, words: list[str]) -> Column:
    """Without stop words, which are given in lower case."""
    return F.array_join(F.filter(F.split(text, r"\s+"), lambda w: ~F.lower(w).isin(words)), " ")


# Parts of labels -----------------------------------------------------------------------------------------------------


def cut_location(label: Column, delimiter: str) -> Column:
    """(name, location): the two sides of a delimiter that occurs once; else the label and ""."""
    sides = F.split(label, re.escape(delimiter))
    once = F.size(sides) == 2
    return F.struct(F.when(once, F.trim(sides[0])).otherwise(label).alias("name"), F.when(once, F.trim(F.get(sides, F.lit(1)))).otherwise("").alias("location"))


def cut_part_of(label: Column) -> Column:
    """(name, part_of): what follows "part of (the)", up to the closing parenthesis if one was opened before it."""
    inside, after = r"(?i)^(.*?)\s*\(\s*part of(?: the)?\s+([^)]*)\)?(.*)$", r"(?i)^(.*?)\s*part of(?: the)?\s+(.*)$"
    opened, plain = label.rlike(inside), label.rlike(after)
    name = F.when(opened, F.concat(F.regexp_extract(label, inside, 1), F.lit(" "), F.regexp_extract(label, inside, 3))).when(plain, F.regexp_extract(label, after, 1)).otherwise(label)
    part = F.when(opened, F.regexp_extract(label, inside, 2)).when(plain, F.regexp_extract(label, after, 2)).otherwise("")
    return F.struct(clean(name).alias("name"), clean(part).alias("part_of"))


def cut_aka(label: Column) -> Column:
    """(name, aka): what follows "aka", "also known as" or "formerly (the)", up to a comma."""
    pattern = r"(?i)^(.*?)[\s(,]*\b(?:also known as|formerly(?: the)?|a\.k\.a\.|aka)\s+([^,)]+)\)?(.*)$"
    found = label.rlike(pattern)
    name = F.concat(F.regexp_extract(label, pattern, 1), F.regexp_extract(label, pattern, 3))
    return F.struct(clean(F.when(found, name).otherwise(label)).alias("name"), F.when(found, clean(F.regexp_extract(label, pattern, 2))).otherwise("").alias("aka"))


def launch_ids(text: Column) -> Column:
    """International launch designations such as 2007-004C."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(_LAUNCH), 1))


def launch_year(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, _LAUNCH.replace(r"(\d{4}-", r"(\d{4})(?:-").replace("[A-Z])", "[A-Z])"), 1), F.lit("")).cast("int")


def complete_date(text: Column) -> Column:
    """An ISO date and time from a partial one: no "+", month and day 00 become 01, missing parts are filled up."""
    bare = F.regexp_replace(text, r"^\+", "")
    bare = F.replace(F.replace(bare, F.lit("-00T"), F.lit("-01T")), F.lit("-00-"), F.lit("-01-"))
    return F.when(bare.rlike(r"^\d{4}$"), F.concat(bare, F.lit("-01-01T00:00:00"))).when(bare.rlike(r"^\d{4}-\d{2}$"), F.concat(bare, F.lit("-01T00:00:00"))).when(bare.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(bare, F.lit("T00:00:00"))).otherwise(bare)


def to_metres(text: Column) -> Column:
    """A number with a unit of length in metres; a number alone is taken as metres."""
    number = F.regexp_replace(F.regexp_extract(text, r"(\d+(?:[.,]\d+)?)", 1), ",", ".").try_cast("double")
    unit = F.lower(F.regexp_extract(text, r"\d\s*-?\s*([A-Za-z]+)", 1))
    factor = F.element_at(F.create_map(*[F.lit(x) for kv in METRES.items() for x in kv]), F.nullif(unit, F.lit("")))
    return number * F.coalesce(factor, F.lit(1.0))


def lengths_in(label: str) -> tuple[str, list[float]]:
    """The label without its sizes, and the sizes in metres to 2 decimals. A size in inches that only repeats one in
    metres, rounded or cut, is left out."""
    plain, inches = set(), {}
    for m in _LENGTH.finditer(label):
        unit, number = m[2].lower(), float(m[1].replace(",", "."))
        value = number * METRES[unit]
        if unit.startswith("inch"):
            inches[round(value, 2)] = {round(value, 1), float(round(value)), float(int(value))}
        else:
            plain.add(round(value, 2))
    kept = plain | {v for v, near in inches.items() if not near & plain}
    return _LENGTH.sub("", label).strip(), sorted(kept)


@F.pandas_udf(T.StructType([T.StructField("name", T.StringType()), T.StructField("metres", T.ArrayType(T.DoubleType()))]))
def apertures(labels: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([lengths_in(x) if isinstance(x, str) else (None, None) for x in labels], columns=["name", "metres"])


def roman(word: str) -> int | None:
    """The value of a roman numeral in its regular form."""
    marks = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}
    if not re.fullmatch(r"M{0,3}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})", word) or not word:
        return None
    values = [marks[c] for c in word]
    return sum(-v if v < w else v for v, w in zip(values, [*values[1:], 0], strict=True))


def suffix_number(label: str) -> int:
    """The last word that is a number: digits, one letter from A to L, a roman numeral up to 100 or a named number; 0 where
    there is none."""
    spaced = re.sub(r"(?<=[a-z])(?=[A-Z])|(?<=[A-Za-z])(?=\d)|[-/.]", " ", label)
    for word in reversed(spaced.split()):
        upper = word.upper()
        if re.fullmatch(r"[+-]?\d+", word):
            return int(word)
        if len(upper) == 1 and "A" <= upper <= "L":
            return ord(upper) - ord("A") + 1
        if (value := roman(upper)) is not None and value <= 100:
            return value
        if word.lower() in NAMED_NUMBERS:
            return NAMED_NUMBERS[word.lower()]
    return 0


@F.pandas_udf(T.LongType())
def suffix_numbers(labels: pd.Series) -> pd.Series:
    return labels.map(suffix_number, na_action="ignore").astype("Int64")


@F.pandas_udf(T.ArrayType(T.LongType()))
def all_suffix_numbers(names: pd.Series) -> pd.Series:
    """The different suffix numbers of several names."""
    return names.map(lambda ns: sorted({suffix_number(n) for n in ns}), na_action="ignore")


# Similarity of texts and numbers -------------------------------------------------------------------------------------


def indel_ratio(a: str, b: str) -> float:
    """1 - (insertions and deletions) / (length of both): twice the longest common subsequence, over both lengths. The
    subsequence is found with one big integer a letter of b, a bit for each letter of a."""
    if not a and not b:
        return 1.0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


def sorted_words(t: str) -> str:
    """The words of a text in order, without case and accents."""
    bare = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower()
    return " ".join(sorted(bare.split()))


@F.pandas_udf(T.ArrayType(T.StringType()))
def sort_keys(names: pd.Series) -> pd.Series:
    """The different keys of several names, without empty ones."""
    return names.map(lambda ns: sorted({sorted_words(n) for n in ns} - {""}), na_action="ignore")


@F.pandas_udf(T.DoubleType())
def best_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """The highest indel_ratio between the keys of both; null where one has none."""

    def best(one: list[str], two: list[str]) -> float | None:
        if not len(one) or not len(two):
            return None
        if set(one) & set(two):
            return 1.0
        top = 0.0
        for a in one:
            for b in two:
                if 2 * min(len(a), len(b)) > top * (len(a) + len(b)):
                    top = max(top, indel_ratio(a, b))
        return top

    return pd.Series([best(a, b) if a is not None and b is not None else None for a, b in zip(left, right, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def token_sort_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """indel_ratio of the sorted words of both, without case and accents."""
    return pd.Series([indel_ratio(sorted_words(a), sorted_words(b)) if isinstance(a, str) and isinstance(b, str) else None for a, b in zip(left, right, strict=True)], dtype="float64")


def digit_agreement(a: float, b: float) -> float:
    """How far two numbers agree, digit by digit from the left; 1 if they do to the precision of the shorter one, and 0
    where their whole parts differ even when rounded."""
    if a == b:
        return 1.0
    if int(a) != int(b) and round(a) != round(b):
        return 0.0
    short, long = sorted((str(a), str(b)), key=len)
    same = next((i for i, (x, y) in enumerate(zip(short, long, strict=False)) if x != y), len(short))
    if same == len(short):
        return 1.0
    dot = short.find(".")
    behind = same - dot if 0 <= dot < same else 0
    if same == len(short) - 1 and round(a, behind) == round(b, behind):
        return 1.0
    past = int(behind > 0)
    return (same - past) / (len(long) - past)


def number_inclusion(one: list[float], two: list[float]) -> float | None:
    """The share of the smaller set's numbers that the larger one holds; None where one is empty."""
    few, many = sorted((set(one), set(two)), key=len)
    return sum(any(digit_agreement(a, b) == 1 for b in many) for a in few) / len(few) if few else None


@F.pandas_udf(T.DoubleType())
def digit_score(one: pd.Series, two: pd.Series) -> pd.Series:
    return pd.Series([number_inclusion(a, b) if a is not None and b is not None else None for a, b in zip(one, two, strict=True)], dtype="float64")


def numbers_in(text: Column) -> Column:
    """All numbers of a text."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d+)?)"), 1), lambda x: x.cast("double"))
