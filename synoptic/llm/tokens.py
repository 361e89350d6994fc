"""Problem 8: token ids of a whole corpus by a public byte-level BPE vocabulary.

`Encoder` finds the ids by numpy merge rounds. The symbols of many words lie in one flat array; in every round the rank
of each adjacent pair is looked up by binary search over the sorted pair keys, each word's lowest rank is found with one
segmented minimum, and all places of that pair are merged. Words that repeat are encoded once (a bounded memory per
Python worker). `encode` and `count_tokens` are the operators: one pass over the rows, without a shuffle.

Null text and empty text: an empty list (count 0). Very long texts, texts without any blank, and bytes of any script are
encoded whole. Other columns are untouched; repeated rows are encoded as often as they occur.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_VOCABULARY = os.environ.get("SYNOPTIC_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"
#: The vocabulary's published rule for splitting a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that a Python worker remembers before it starts anew.
REMEMBERED = 400_000
_NONE = np.iinfo(np.int64).max


class Numbers(dict):
    """Numbers its keys as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Encoder:
    """Ids of words and texts. Words are numbered in `index` as they come; their ids lie one after another in `flat`."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        keys, ids = [], []
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if left is not None and right is not None and left < rank and right < rank:
                    keys.append((left << 32) | right)
                    ids.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
        self.keys, self.ids = np.array(keys, dtype=np.int64)[order], np.array(ids, dtype=np.int64)[order]
        self.split = regex.compile(PATTERN).findall
        self.forget()

    def forget(self) -> None:
        self.index = Numbers()
        self.lengths = np.zeros(0, dtype=np.int64)
        self.starts = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.int32)

    def _ranks(self, symbols: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The rank of the pair that begins at each symbol; _NONE where there is none or the word ends."""
        out = np.full(len(symbols), _NONE, dtype=np.int64)
        if len(symbols) > 1:
            keys = (symbols[:-1] << 32) | symbols[1:]
            at = np.searchsorted(self.keys, keys)
            at[at == len(self.keys)] = 0
            hit = (self.keys[at] == keys) & (word[:-1] == word[1:])
            out[:-1][hit] = self.ids[at[hit]]
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after another, and each word's number of ids."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(b) for b in raw], dtype=np.int64)
        symbols = self.byte_id[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_words = [], []
        rank = self._ranks(symbols, word)
        while len(symbols):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            spread = np.repeat(lowest, np.diff(np.r_[first, len(symbols)]))
            if (over := spread == _NONE).any():  # finished words leave the array
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                symbols, word, rank, spread = symbols[~over], word[~over], rank[~over], spread[~over]
                if not len(symbols):
                    break
            merge = rank == spread
            # Of overlapping places (a run of one symbol) every second merges, from the left.
            places = np.flatnonzero(merge)
            if len(places) > 1 and (np.diff(places) == 1).any():
                run = np.r_[0, np.cumsum(np.diff(places) != 1)]
                start = np.flatnonzero(np.r_[True, np.diff(run) != 0])
                places = places[(np.arange(len(places)) - start[run]) % 2 == 0]
            symbols[places] = spread[places]
            keep = np.ones(len(symbols), dtype=bool)
            keep[places + 1] = False
            symbols, word = symbols[keep], word[keep]
            rank = self._ranks(symbols, word)
        if not done_symbols:
            return np.zeros(0, dtype=np.int32), np.zeros(len(words), dtype=np.int64)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order].astype(np.int32), np.bincount(word, minlength=len(words))

    def learn(self, texts_words: list[list[str]]) -> np.ndarray:
        """The numbers of all words of all texts, one after another; new words are encoded together."""
        if len(self.index) > REMEMBERED:
            self.forget()
        index = self.index
        known = len(index)
        numbers = np.fromiter(map(index.__getitem__, chain.from_iterable(texts_words)), dtype=np.int64)
        if len(index) > known:
            new = list(index)[known:]
            ids, lengths = self.encode_words(new)
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, ids])
        return numbers

    def batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's ids begin (one more than there are texts)."""
        words = [self.split(t) if t else [] for t in texts]
        numbers = self.learn(words)
        bounds = np.cumsum([0, *(len(w) for w in words)], dtype=np.int64)
        lengths = self.lengths[numbers]
        ends = np.r_[0, np.cumsum(lengths)]
        ids = self.flat[np.repeat(self.starts[numbers] - ends[:-1], lengths) + np.arange(ends[-1])]
        return ids, ends[bounds]

    def counts(self, texts: list[str | None]) -> np.ndarray:
        words = [self.split(t) if t else [] for t in texts]
        numbers = self.learn(words)
        sums = np.r_[0, np.cumsum(self.lengths[numbers])]
        return np.diff(sums[np.cumsum([0, *(len(w) for w in words)], dtype=np.int64)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def slices(texts: list, most_chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Runs of texts of a bounded total length (a longer text is a run of its own)."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > most_chars:
            yield start, i
            start, size = i, 0
        size += n
    if len(texts) > start:
        yield start, len(texts)


def encode(df: DataFrame, key: str, text: str, vocabulary: str = DEFAULT_VOCABULARY, ids: str = "ids") -> DataFrame:
    """(key, ids): the token ids of every row's text, without special tokens; [] for an empty or a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in slices(texts):
                flat, offsets = enc.batch(texts[lo:hi])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), lists], names=[key, ids])

    kind = df.schema[key].dataType
    return df.select(key, text).mapInArrow(run, T.StructType([T.StructField(key, kind), T.StructField(ids, T.ArrayType(T.IntegerType(), False))]))


def count_tokens(text: Column, vocabulary: str = DEFAULT_VOCABULARY) -> Column:
    """The number of tokens of a text; 0 for an empty or a null text."""

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(vocabulary)
        for s in batches:
            texts = [t if isinstance(t, str) else None for t in s]
            yield pd.Series(np.concatenate([enc.counts(texts[lo:hi]) for lo, hi in slices(texts)] or [np.zeros(0, dtype=np.int64)]))

    return count(text)
