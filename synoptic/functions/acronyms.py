"""How likely a short name is the acronym of a long one.

The acronym is placed letter by letter on the letters of the label, by dynamic programming over (letter, places taken):
a table of all sets of places that the letters so far can take, each with the least cost, is carried from letter to
letter. Sets are bits of one number, and what a letter can take is found by masks of the label made beforehand.

A letter takes the first letter of a word; at a cost of half of what leaving one out does while an earlier word is free.
Where no word is free, it takes the letter after the last one, if that is the second of its word, else a capital within a
word, else a stop word's letter from its start on. An x may be left out, or take a word with x as its second letter. The
score is the share of words that are taken, less the costs, to the power of 4.
"""

from __future__ import annotations

import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words that an acronym may pass over.
STOP_WORDS = frozenset("a an and at by for from in of on or the to with de des du en et l la le les un une sur d der die das und für".split())
_SUPERSCRIPTS = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹", "0123456789")


def _bits(mask: int) -> list[int]:
    """The single bits of a mask."""
    out = []
    while mask:
        out.append(mask & -mask)
        mask &= mask - 1
    return out


class Label:
    """Masks of a label's places: `words` holds the first letters of words (each digit of a number is one), the others what
    a letter may take by each rule."""

    def __init__(self, text: str):
        self.words = 0
        self.first, self.second, self.capital, self.stop, self.stop_start = (defaultdict(int) for _ in range(5))
        bit, behind = 1, False
        for word in re.findall(r"\w+", text):
            stop = word.lower() in STOP_WORDS
            for i, c in enumerate(word):
                low = c.lower()
                if word.isdigit() or (i == 0 and not stop):
                    self.words |= bit
                    self.first[low] |= bit
                elif i == 1 and not stop:
                    self.second[low] |= bit
                elif c.isupper():
                    self.capital[low] |= bit
                elif stop:
                    self.stop[low] |= bit
                    if not behind:
                        self.stop_start[low] |= bit
                behind = stop and not c.isupper()  # a stop word after another one starts nothing
                bit <<= 1
            bit <<= 1

    def places(self, letter: str, taken: int, last: int, price: float) -> list[tuple[int, int, float]]:
        """(places it takes, the last of them, cost) of each way to place a letter."""
        if letter == "x":
            # The word goes with it, if it is free.
            words = [b >> 1 for b in _bits(self.second["x"] & ~taken) if b >> 1 & self.words & ~taken]
            return [(0, last, 0.0)] + [(w | w << 1, w << 1, 0.0) for w in words]
        if free := self.first[letter] & ~taken:
            return [(w, w, price if self.words & ~taken & (w - 1) else 0.0) for w in _bits(free)]
        after = last << 1
        if after & self.second[letter] & ~taken:
            return [(after, after, 0.0)]
        open_ = self.capital[letter] & ~taken or (self.stop_start[letter] | (after & self.stop[letter])) & ~taken
        return [(c, c, 0.0) for c in _bits(open_)]

    def share(self, acronym: str) -> float:
        """The most that the acronym reaches; 0 where a letter finds no place."""
        if not self.words:
            return 0.0
        table = {(0, 0): 0.0}
        for k, letter in enumerate(acronym):
            price = 1 / (2 * (len(acronym) - k))
            after: dict[tuple[int, int], float] = {}
            for (taken, last), cost in table.items():
                for place, new_last, more in self.places(letter, taken, last, price):
                    state = (taken | place, new_last)
                    after[state] = min(after.get(state, 9.0), cost + more)
            table = after
        whole = self.words.bit_count()
        return max([0.0, *((taken & self.words).bit_count() / whole - cost for (taken, _), cost in table.items())])


def spelled_out(acronym: str) -> str:
    """Letters repeated as the digit before them says: DA2I is DAII."""
    return re.sub(r"(\d)([^\W\d_])", lambda m: m[2] * int(m[1]), acronym.translate(_SUPERSCRIPTS))


def acronym_probability(acronym: str, label: str) -> float:
    """From 0 to 1; -1 if the acronym is longer than a third of the label. 1 if it is the label's capitals."""
    short = re.sub(r"[\W_]", "", acronym)
    if not short or len(short) > len(label) / 3:
        return -1.0
    if short == "".join(c for c in label if "A" <= c <= "Z"):
        return 1.0
    read = Label(label)
    score = read.share(short.lower())
    if score == 0 and (longer := spelled_out(short)) != short:
        score = read.share(longer.lower())
    return score**4


@F.pandas_udf(T.DoubleType())
def acronym_score(left: pd.Series, right: pd.Series) -> pd.Series:
    """The probability that the shorter one is the acronym of the longer one; null below 0.5."""

    def one(a: object, b: object) -> float | None:
        if not isinstance(a, str) or not isinstance(b, str):
            return None
        p = acronym_probability(*sorted((a, b), key=len))
        return p if p >= 0.5 else None

    return pd.Series([one(a, b) for a, b in zip(left, right, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def best_acronym_score(left: pd.Series, right: pd.Series) -> pd.Series:
    """The highest acronym_probability between the names of both; null below 0.5."""

    def best(one: list[str], two: list[str]) -> float | None:
        top = max((acronym_probability(*sorted((a, b), key=len)) for a in one for b in two), default=-1.0)
        return top if top >= 0.5 else None

    return pd.Series([best(a, b) if a is not None and b is not None else None for a, b in zip(left, right, strict=True)], dtype="float64")


def cut_acronym(label: str) -> tuple[str, str]:
    """(name, acronym): without what is in parentheses; the acronym if it is the only one, at the end, and certain."""
    label = label.strip()
    found = re.findall(r"\(([^(]+?)\)", label)
    name = re.sub(r"\s+", " ", re.sub(r"\s*\([^(]+?\)", " ", label)).strip()
    sure = len(found) == 1 and label.endswith(")") and acronym_probability(found[0].strip(), name) == 1
    return (name, found[0].strip()) if sure else (name, "")


@F.pandas_udf(T.StructType([T.StructField("name", T.StringType()), T.StructField("acronym", T.StringType())]))
def acronyms_cut(labels: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([cut_acronym(x) if isinstance(x, str) else (None, None) for x in labels], columns=["name", "acronym"])
