"""Problem 10: splitting oversized items at natural boundaries.

A text of more tokens than a profile's limit is cut into pieces of at most max_tokens. Its units are the stretches between
natural boundaries (ends of paragraphs, lines and sentences). For each boundary the term vectors of the units before and
after it are compared (cosine of two sliding blocks, over exact terms: words without the commonest ones, and pairs of
characters in scripts without blanks); the depth of the valley in that curve marks how strongly the topic
changes there. Within each size window (from half the limit to the limit) the deepest valley is cut, ties at the
stronger and then the later boundary. Where a window has no natural boundary, the last end of a clause, else of a word,
else of a character is taken. The next piece starts overlap_tokens before the cut, at the next start of a word (so that
the overlap is at most the stated one, and short of it by less than a word).

Tokens are counted by the public vocabulary's own words, so a piece's count is exact: a piece that starts and ends
between words has the sum of its words. Words too long for a piece (a run of signs, a text without any blank) are cut
between characters, and such pieces are counted anew and shortened while over the limit.

One pass, no shuffle; texts of any length are handled whole. Null and empty texts, and texts within the limit, give no
piece. A profile with a null or non-positive max_tokens gives none; a null overlap counts as 0, and an overlap of half the
limit or more is cut to half. Repeated rows give repeated pieces. Other columns are untouched.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from synoptic.llm.tokens import DEFAULT_VOCABULARY, Encoder, encoder, slices

#: Units on each side of a boundary, boundaries around a valley.
SIDE, AROUND = 3, 3
#: The commonest words of the languages, which tell nothing about a topic.
COMMON = frozenset(
    (
        "the and for are was were with that this from not but have has had its they which been their will would can all one into than then there these those also such "
        "les des une que qui pour dans est sont par sur pas plus avec aux ses son cette ces mais nous vous ont été "
        "der die das und den dem des ein eine einer von mit ist sind auf für nicht auch als sich bei aus nach wird werden oder durch zum zur "
        "los las del una por con para como más pero sus son fue entre sobre este esta "
        "что как это для его она они был была было были при или все уже так над под без"
    ).split()
)
#: Scripts that are written without blanks.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff]")
#: Strengths of boundaries.
WITHIN, WORD, CLAUSE, SENTENCE, LINE, PARAGRAPH = range(6)
ENDS, PAUSES, CLOSERS = tuple(".!?。！？…"), tuple(",;:、，；："), "\"'”’»)]}」』"


class Words:
    """What the splitter knows of each word of an encoder's memory, by the word's number."""

    def __init__(self, enc: Encoder):
        self.enc = enc
        self.clear()

    def clear(self) -> None:
        self.of = self.enc.index
        self.chars = np.zeros(0, np.int64)
        self.number: dict[str, int] = {}
        self.terms = np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ends = np.zeros(0, np.int8)
        self.breaks = np.zeros(0, np.int8)
        self.blank = np.zeros(0, bool)

    def extend(self) -> None:
        if self.of is not self.enc.index:
            self.clear()
        new = list(self.enc.index)[len(self.chars) :]
        bare = [w.strip() for w in new]
        self.chars = np.r_[self.chars, np.array([len(w) for w in new], np.int64)]
        found = [self.terms_of(b.lower()) if len(b) > 1 and b[0].isalpha() else () for b in bare]
        counts = np.array([len(f) for f in found], np.int64)
        self.first = np.r_[self.first, len(self.terms) + np.cumsum(counts) - counts]
        self.count = np.r_[self.count, counts]
        self.terms = np.r_[self.terms, np.fromiter((t for f in found for t in f), np.int64)]
        marks = [b.rstrip(CLOSERS) or b for b in bare]
        self.ends = np.r_[self.ends, np.array([(3 if m[-1] in "。！？" else 2) if m.endswith(ENDS) else 1 if m.endswith(PAUSES) else 0 for m in marks], np.int8)]
        self.breaks = np.r_[self.breaks, np.array([min(2, w.count("\n") or w.count("\r")) for w in new], np.int8)]
        self.blank = np.r_[self.blank, np.array([w[0].isspace() for w in new], bool)]


    def terms_of(self, word: str) -> list[int]:
        """The numbers of a word's terms: its own, or those of its pairs of characters."""
        number = self.number
        if _UNSPACED.search(word):
            return [number.setdefault(word[i : i + 2], len(number)) for i in range(len(word) - 1)]
        return [number.setdefault(word, len(number))] if len(word) > 2 and word not in COMMON else []

    def terms_in(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The terms of words one after another, and how many each has."""
        first, counts = self.first[numbers], self.count[numbers]
        return self.terms[np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())], counts


def boundary_strengths(ends: np.ndarray, breaks: np.ndarray, blank: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The strength of the boundary after each word of texts that follow one another; `last` marks each text's last word."""
    out = np.full(len(ends), WITHIN, np.int8)
    next_blank, next_break, prior_break = np.ones(len(ends), bool), np.zeros(len(ends), bool), np.zeros(len(ends), bool)
    broken = breaks > 0
    next_blank[:-1], next_break[:-1], prior_break[1:] = blank[1:], broken[1:], broken[:-1] & ~last[:-1]
    next_blank[last], next_break[last] = True, False
    out[next_blank] = WORD
    out[next_blank & (ends == 1)] = CLAUSE
    out[(next_blank & (ends == 2)) | (ends == 3)] = SENTENCE
    line = broken & ~next_break
    out[line] = LINE
    out[line & ((breaks > 1) | prior_break)] = PARAGRAPH
    # Between two breaks, or before one, is no good place: the place after them is.
    out[next_break] = WORD
    return out


def _from_zero(sizes: np.ndarray) -> np.ndarray:
    """Running sums from 0: one more than there are sizes."""
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def depths_of(words: Words, numbers: np.ndarray, strength: np.ndarray, begins: np.ndarray) -> list[np.ndarray]:
    """The depths at the natural boundaries of texts that follow one another and begin at the given words. Their units are
    numbered on, with a gap that no block spans."""
    strong = strength >= SENTENCE
    text = np.zeros(len(numbers), np.int64)
    text[begins[1:]] = 1
    unit = _from_zero(strong)[:-1] + np.cumsum(text) * 2 * SIDE
    terms, counts = words.terms_in(numbers)
    depth = valley_depths(np.repeat(unit, counts), terms, int(unit[-1]) + 1)
    ends = np.add.reduceat(strong.astype(np.int64), begins)
    return [depth[u : u + n] for u, n in zip(unit[begins].tolist(), ends.tolist(), strict=True)]


def valley_depths(unit_of: np.ndarray, term: np.ndarray, units: int) -> np.ndarray:
    """The depth of the similarity valley after each unit (the last one's is 0), from the unit and the term of each word.

    Vectors are sparse: words are sorted by (term, unit), where units that can meet in two neighbouring blocks stand at
    most 2 * SIDE - 1 places apart; their products are summed by the first unit and the distance. Cosines of blocks are
    sums of those."""
    if units < 2:
        return np.zeros(units)
    reach, wide = 2 * SIDE, units + 2 * SIDE
    keys = term * wide + unit_of
    keys.sort()
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[starts, len(keys)]).astype(np.float64)
    keys = keys[starts]
    unit = keys % wide + SIDE
    dot = np.bincount(unit, counts * counts, wide * reach)
    for j in range(1, reach):
        apart = keys[j:] - keys[:-j]
        hit = np.flatnonzero(apart < reach)
        dot += np.bincount(apart[hit] * wide + unit[hit], counts[hit] * counts[hit + j], wide * reach)
    dot = dot.reshape(reach, wide)  # dot[d][SIDE + u]: of the units u and u + d
    # The block before boundary i holds units i - SIDE to i - 1, of which those below 0 are empty.
    ends = np.arange(units + SIDE) + SIDE
    norm = sum(dot[0, ends - p] for p in range(1, SIDE + 1)) + 2 * sum(dot[p - q, ends - p] for p in range(2, SIDE + 1) for q in range(1, p))
    at = np.arange(1, units)
    met = sum(dot[p + q, at + SIDE - p] for p in range(1, SIDE + 1) for q in range(SIDE))
    sim = met / np.sqrt(np.maximum(norm[at] * norm[at + SIDE], 1e-12))
    before, after = sim.copy(), sim.copy()
    for k in range(1, AROUND + 1):
        before[k:] = np.maximum(before[k:], sim[:-k])
        after[:-k] = np.maximum(after[:-k], sim[k:])
    return np.append(before + after - 2 * sim, 0.0)


class Text:
    """One text as words: where each begins (chars, tokens) and how good a place to cut is after it.

    Places are looked up in plain lists: most texts have few words, and a window has few boundaries."""

    def __init__(self, text: str, enc: Encoder, chars: np.ndarray, tokens: np.ndarray, strength: np.ndarray, depth: np.ndarray, longest: int):
        self.text, self.enc = text, enc
        self.exact = not (tokens > longest).any()
        if not self.exact:
            chars, tokens, strength = self._cut_words(chars, tokens, strength, longest)
        self.at, self.tok = _from_zero(chars).tolist(), _from_zero(tokens).tolist()
        ends = np.flatnonzero(strength >= SENTENCE)
        self.natural = (ends + 1).tolist()
        self.strength: np.ndarray = strength
        self.weaker: tuple[list[int], ...] | None = None
        # Boundaries from the worst to the best: by depth, then strength, then place.
        order = np.lexsort((ends, strength[ends], np.round(depth, 6)))
        rank = np.empty(len(ends), np.int64)
        rank[order] = np.arange(len(ends))
        self.rank, self.order = rank.tolist(), order.tolist()

    def _cut_words(self, chars: np.ndarray, tokens: np.ndarray, strength: np.ndarray, longest: int) -> tuple[np.ndarray, ...]:
        """Words of more tokens than `longest` become runs of characters of at most so many bytes, and so tokens. A run
        within a word is no boundary, so the natural ones and their depths stay."""
        starts = _from_zero(chars)
        sizes, counts, powers = [], [], []
        for i in range(len(chars)):
            if tokens[i] <= longest:
                sizes.append(chars[i]), counts.append(tokens[i]), powers.append(strength[i])
                continue
            word = self.text[starts[i] : starts[i + 1]]
            step = max(1, longest // max(len(c.encode()) for c in set(word)))
            parts = [word[k : k + step] for k in range(0, len(word), step)]
            _, lengths = self.enc.encode_words(parts)
            sizes += [len(p) for p in parts]
            counts += lengths.tolist()
            powers += [WITHIN] * (len(parts) - 1) + [strength[i]]
        return np.array(sizes, np.int64), np.array(counts, np.int64), np.array(powers, np.int8)

    def _cut(self, low: int, end: int) -> int:
        """The place to cut between low (excluded) and end: the best natural boundary, else the last end of a clause, else
        of a word, else the end itself."""
        a, b = bisect_right(self.natural, low), bisect_right(self.natural, end)
        if a < b:
            return self.natural[self.order[max(self.rank[a:b])]]
        if self.weaker is None:
            self.weaker = tuple((np.flatnonzero(kept) + 1).tolist() for kept in (self.strength == CLAUSE, self.strength >= WORD))
        for places in self.weaker:
            k = bisect_right(places, end) - 1
            if k >= 0 and places[k] > low:
                return places[k]
        return end

    def count(self, start: int, end: int) -> int:
        if self.exact:
            return self.tok[end] - self.tok[start]
        return int(self.enc.counts([self.text[self.at[start] : self.at[end]]])[0])

    def pieces(self, most: int, overlap: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, end, tokens, tokens shared with the piece before), places as numbers of words."""
        tok, n = self.tok, len(self.tok) - 1
        least = max(overlap + 1, most // 2)
        start, prior = 0, 0
        while True:
            end = bisect_right(tok, tok[start] + most) - 1
            if end < n:
                end = self._cut(max(bisect_left(tok, tok[start] + least) - 1, prior, start), max(end, start + 1))
            tokens = self.count(start, end)
            while tokens > most and end > start + 1:
                end -= 1
                tokens = self.count(start, end)
            yield start, end, tokens, self.count(start, prior) if prior > start else 0
            if end >= n:
                return
            prior, start = end, max(start + 1, min(end, bisect_left(tok, tok[end] - overlap)))


def split(df: DataFrame, key: str, text: str, profiles: list[tuple[str, int, int]], vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(profile, key, piece_no, start_char, end_char, n_tokens, overlap_tokens, text), piece_no from 0.

    `profiles` are (profile, max_tokens, overlap_tokens). Pieces of a text cover all of it, in order."""
    wanted = [(p, int(m), min(int(o or 0), int(m) // 2)) for p, m, o in profiles if p is not None and m and m > 0]
    fields = [("profile", T.StringType()), (key, df.schema[key].dataType), ("piece_no", T.IntegerType()), ("start_char", T.IntegerType()), ("end_char", T.IntegerType()), ("n_tokens", T.IntegerType()), ("overlap_tokens", T.IntegerType()), ("text", T.StringType())]
    least = min((m for _, m, _ in wanted), default=0)
    longest = max(1, least // 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        words = Words(enc)
        for b in batches:
            texts, key_type = b.column(1).to_pylist(), b.column(0).type
            keys = b.column(0).to_pylist()
            for lo, hi in slices(texts):
                found = [enc.split(t) if t else [] for t in texts[lo:hi]]
                numbers = enc.learn(found)
                words.extend()
                bounds = np.cumsum([0, *(len(f) for f in found)], dtype=np.int64)
                last = np.zeros(len(numbers), bool)
                last[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = True
                chars, tokens = words.chars[numbers], enc.lengths[numbers]
                strength = boundary_strengths(words.ends[numbers], words.breaks[numbers], words.blank[numbers], last)
                totals = np.diff(_from_zero(tokens)[bounds]).tolist()
                todo = [i for i, total in enumerate(totals) if wanted and total > least]
                if not todo:
                    continue
                own_words = np.diff(bounds)
                kept = np.zeros(len(own_words), bool)
                kept[todo] = True
                mine = np.repeat(kept, own_words)
                depths = depths_of(words, numbers[mine], strength[mine], _from_zero(own_words[todo])[:-1])
                bounds = bounds.tolist()
                out: list[list] = [[] for _ in fields]
                for i, depth in zip(todo, depths, strict=True):
                    total = totals[i]
                    text, own = texts[lo + i], slice(bounds[i], bounds[i + 1])
                    t = Text(text, enc, chars[own], tokens[own], strength[own], depth, longest)
                    for profile, most, overlap in wanted:
                        if total > most:
                            rows = list(t.pieces(most, overlap))
                            begin, end = [t.at[r[0]] for r in rows], [t.at[r[1]] for r in rows]
                            for column, values in zip(out, ([profile] * len(rows), [keys[lo + i]] * len(rows), range(len(rows)), begin, end, [r[2] for r in rows], [r[3] for r in rows], [text[x:y] for x, y in zip(begin, end, strict=True)]), strict=True):
                                column.extend(values)
                if out[0]:
                    kinds = [pa.string(), key_type, *[pa.int32()] * 5, pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=[n for n, _ in fields])

    return df.select(key, text).mapInArrow(run, T.StructType([T.StructField(n, k) for n, k in fields]))
