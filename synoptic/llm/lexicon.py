"""Names as people write them: what is a kind of thing, a number, a size, a legal form, and what is left as the name.

`parse` takes a name apart by `Rules`: words for kinds in several languages with their usual abbreviations, connecting
words, filling words of nicknames, short forms of given names and legal forms. `RULES` holds the ones for facilities;
`rules_of` makes others from a table. Problems 3 and 7 share them.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

#: Words that name a kind of facility (a word of several kinds leaves the choice to the others).
KINDS = {
    "observatory": "observatory obs obsy observ observatoire observatorio sternwarte observatorium",
    "solar tower": "solar sol tower twr tour solaire torre sonnenturm",
    "magnetometer station": "magnetometer mag magn station stn sta magnetometrique estacion magnetometrica magnetometerstation",
    "meteor camera": "meteor met camera cam camara meteoros meteorique meteorkamera",
    "radio telescope": "radio rt telescope tel radiotelescope radiotelescopio radioteleskop telescopio",
    "interferometer array": "interferometer interf intf array arr reseau interferometrique red interferometrica interferometerfeld",
    "ionosonde": "ionosonde iono ionos ionosonda sonde ionospherique ionospharensonde",
    "survey telescope": "survey surv telescope tel telescopio releve rastreo durchmusterungsteleskop",
}
#: Words that connect others, that fill up nicknames, that end the names of companies, and kinds of places.
CONNECTING = "the of de du des la le el der die das and at"
FILLING = "old big ear eye lantern dish"
LEGAL = "inc incorporated corp corporation co company ltd limited llc llp plc gmbh ag kg sarl sas srl spa bv nv ab oy oyj aps asa pty kk"
PLACES = "ridge hill field site"
#: Short forms of given names.
GIVEN = {
    "al": "albert alan alfred", "alex": "alexander alexandra", "andy": "andrew", "ben": "benjamin", "bert": "albert robert", "beth": "elizabeth", "betty": "elizabeth", "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert",
    "charlie": "charles", "chris": "christopher christine", "chuck": "charles", "dan": "daniel", "dave": "david", "dick": "richard", "don": "donald", "ed": "edward edwin", "fred": "frederick alfred", "gene": "eugene", "greg": "gregory",
    "hank": "henry", "harry": "henry harold", "jack": "john", "jim": "james", "jimmy": "james", "joe": "joseph", "johnny": "john", "kate": "katherine", "kathy": "katherine", "ken": "kenneth", "larry": "lawrence", "liz": "elizabeth",
    "maggie": "margaret", "matt": "matthew", "meg": "margaret", "mike": "michael", "nick": "nicholas", "pat": "patrick patricia", "peggy": "margaret", "pete": "peter", "phil": "philip", "rick": "richard", "rob": "robert", "ron": "ronald",
    "sam": "samuel", "steve": "stephen steven", "sue": "susan", "ted": "theodore edward", "tim": "timothy", "tom": "thomas", "tony": "anthony", "vicky": "victoria", "will": "william",
}
#: Kind words that also stand in names of places: alone they tell nothing.
GENERIC = frozenset("station stn sta".split())
CENTIMETRES = {"m": 100.0, "meter": 100.0, "metre": 100.0, "meters": 100.0, "metres": 100.0, "cm": 1.0, "mm": 0.1, "km": 1e5, "in": 2.54, "inch": 2.54, "ft": 30.48}
ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10}

_SIZE = re.compile(r"(?<![\w.,])(\d+(?:[.,]\d+)?)\s*-?\s*(metres|meters|metre|meter|inch|cm|mm|km|in|ft|m)\b\.?")
_BARE_SIZE = re.compile(r"(?<![\w.,])(\d+[.,]\d+)(?![\w.,])")
_NUMBER = re.compile(r"(?:#|\b(?:no|nr|num|number|n°)\b\.?)?\s*(?<![\w.,])0*(\d{1,3})(?![\w.,]*\d)\b|\b(?:no|nr)\.?\s*0*(\d{1,3})\b|#\s*0*(\d{1,3})\b")
_CAMEL = re.compile(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ])")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?\.?|\d+")
_DOTTED = re.compile(r"\b(?:[^\W\d_]\.){2,}[^\W\d_]?")
_DIGIT = re.compile(r"\d")


def fold(text: str) -> str:
    """Without accents, lower case."""
    if text.isascii():
        return text.lower()
    bare = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", text))
    return "".join(c for c in bare if not unicodedata.combining(c)).lower().replace("ø", "o").replace("ł", "l").replace("ß", "ss")


def distance(a: str, b: str, most: int) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours; most + 1 where there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before2, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before2[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
    return row[-1]


def allowed(word: str) -> int:
    """Typing errors that a word of this length may have."""
    return 0 if len(word) < 4 else 1 if len(word) < 6 else 2


def deletions(word: str, most: int) -> set[str]:
    """The word without up to `most` of its letters."""
    out, edge = {word}, {word}
    for _ in range(most):
        edge = {w[:i] + w[i + 1 :] for w in edge for i in range(len(w))}
        out |= edge
    return out


@dataclass
class Rules:
    """Rules by which names are read. `kinds` gives the words of each kind, `given` the full forms of short given names."""

    kinds: dict[str, str] = field(default_factory=lambda: KINDS)
    connecting: str = CONNECTING
    filling: str = FILLING
    legal: str = LEGAL
    places: str = PLACES
    given: dict[str, str] = field(default_factory=lambda: GIVEN)

    def __post_init__(self) -> None:
        self.kind_of: dict[str, frozenset[str]] = {}
        for kind, words in self.kinds.items():
            for w in words.split():
                self.kind_of[w] = self.kind_of.get(w, frozenset()) | {kind}
        self.skipped = frozenset(self.connecting.split()) | {"no", "nr", "num", "number"}
        self.fillers, self.legal_forms, self.place_words = (frozenset(x.split()) for x in (self.filling, self.legal, self.places))
        self._near: dict[str, set[str]] = {}
        for w in self.kind_of:
            for d in deletions(w, 2 if len(w) >= 9 else 1) if len(w) >= 5 else ():
                self._near.setdefault(d, set()).add(w)
        self._longest = max(map(len, self.kind_of), default=0) + 2
        self._known: dict[str, str | None] = {}

    def kind_word(self, word: str) -> str | None:
        """The kind word that is meant, typed with few errors."""
        if word in self.kind_of:
            return word
        if not 4 <= len(word) <= self._longest:
            return None
        if word not in self._known:
            if len(self._known) > 200_000:
                self._known.clear()
            near = {k for d in deletions(word, 2 if len(word) >= 9 else 1) for k in self._near.get(d, ())}
            best = min(((distance(word, k, 2), k) for k in near), default=None)
            self._known[word] = best[1] if best and best[0] <= (2 if len(best[1]) >= 9 else 1) else None
        return self._known[word]

    def kind(self, words: list[str]) -> str | None:
        """The kind that all words can mean; "telescope" where it stays open which."""
        if not words or GENERIC.issuperset(words):
            return None
        shared = frozenset(self.kinds)
        for k in words:
            shared = shared & self.kind_of.get(k, frozenset()) or shared
        if len(shared) == 1:
            return next(iter(shared))
        return "telescope" if shared and all(k.endswith("telescope") for k in shared) else None


RULES = Rules()


def rules_of(table: DataFrame) -> Rules:
    """Rules from a table (rule, word, meaning): rule is kind (meaning: the kind), given (meaning: a full form),
    connecting, filling, legal or place. The table is a setting, read by the driver."""
    rows: Iterable = table.select("rule", "word", "meaning").distinct().collect()
    words: dict[str, list[str]] = {}
    pairs: dict[str, dict[str, list[str]]] = {"kind": {}, "given": {}}
    for r in rows:
        if r["rule"] == "kind":
            pairs["kind"].setdefault(r["meaning"], []).append(fold(r["word"]))
        elif r["rule"] == "given":
            pairs["given"].setdefault(fold(r["word"]), []).append(fold(r["meaning"]))
        else:
            words.setdefault(r["rule"], []).append(fold(r["word"]))
    joined = lambda d: {k: " ".join(sorted(v)) for k, v in d.items()}
    return Rules(joined(pairs["kind"]), *(" ".join(sorted(words.get(n, []))) for n in ("connecting", "filling", "legal", "place")), joined(pairs["given"]))


def parse(name: str | None, rules: Rules = RULES) -> dict:
    """{core: words of the proper name, kind, suffix ('n2' or 'c120' for 120 cm), nick: filling words, code}."""
    out: dict = {"core": [], "kind": None, "suffix": None, "nick": [], "code": None}
    if not name or not name.strip():
        return out
    text = (name if name.isascii() else unicodedata.normalize("NFKC", name)).strip()
    if 2 <= len(text) <= 7 and text.isalpha():
        out["code"] = fold(text)
    elif re.fullmatch(r"(?:[^\W\d_]\.\s?){2,7}", text + "." * (text[-1] != ".")):
        out["code"] = re.sub(r"[.\s]", "", fold(text))
        return out
    text = fold(_CAMEL.sub(" ", text) if not text.isupper() else text)
    if "." in text:
        text = _DOTTED.sub(lambda m: bare if (bare := m[0].replace(".", "")) in rules.legal_forms else m[0], text)
    if _DIGIT.search(text):
        if m := _SIZE.search(text):
            out["suffix"] = f"c{round(float(m[1].replace(',', '.')) * CENTIMETRES[m[2]])}"
        elif m := _BARE_SIZE.search(text):
            out["suffix"] = f"c{round(float(m[1].replace(',', '.')) * 100)}"
        elif m := _NUMBER.search(text):
            out["suffix"] = f"n{int(m[1] or m[2] or m[3])}"
        if m:
            text = text[: m.start()] + " " + text[m.end() :]
    words = [w for w in (x.rstrip(".") for x in _WORD.findall(text)) if w]
    kinds: list[str] = []
    core: list[str] = []
    for i, w in enumerate(words):
        if w in rules.skipped:
            continue
        if w in rules.fillers:
            out["nick"].append(w)
        elif (k := rules.kind_word(w)) is not None:
            kinds.append(k)
        elif w == "r" and i + 1 < len(words) and words[i + 1] in ("tel", "telescope") and "radio" in rules.kind_of:
            kinds.append("radio")
        elif not w.isdigit():
            core.append(w)
    while len(core) > 1 and core[-1] in rules.legal_forms:
        core.pop()
    if not out["suffix"] and len(core) > 1 and core[-1] in ROMAN and (len(core) > 2 or len(core[-1]) > 1):
        out["suffix"] = f"n{ROMAN[core.pop()]}"
    out["kind"], out["core"] = rules.kind(kinds), core
    return out


def same_kind(a: str | None, b: str | None) -> bool | None:
    """None where one is not stated."""
    if not a or not b:
        return None
    return a == b or ("telescope" in (a, b) and "telescope" in a and "telescope" in b)
