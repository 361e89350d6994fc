import base64
import os

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from synoptic.llm import tokens

VOCABULARY = tokens.DEFAULT_VOCABULARY
pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file")


@pytest.fixture(scope="module")
def known():
    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(texts):
    flat, at = tokens.encoder(VOCABULARY).batch(texts)
    return [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


def test_nulls_and_shapes(known):
    texts = [None, "", " ", "a" * 5000, "日本語" * 700, "\x00﻿‍", "it's <|endoftext|>\r\n\n  x", "== --- .... ~~~~~~~"]
    assert ids(texts) == [known.encode_ordinary(t) if t else [] for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_same_as_the_public_encoder(known, texts):
    assert ids(texts) == [known.encode_ordinary(t) for t in texts]
    assert tokens.encoder(VOCABULARY).counts(texts).tolist() == [len(known.encode_ordinary(t)) for t in texts]


def test_memory_is_bounded(known, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    e = tokens.Encoder(VOCABULARY)
    for t in ("one two three four", "five six", "one seven"):
        flat, _ = e.batch([t])
        assert flat.tolist() == known.encode_ordinary(t)
        assert len(e.index) <= 8


def test_operator(spark, known):
    rows = [(1, "The dome was moved.", "x"), (2, None, "y"), (3, "", "z"), (1, "The dome was moved.", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = sorted((r.doc_id, r.ids) for r in tokens.encode(df, "doc_id", "text").collect())
    want = known.encode_ordinary("The dome was moved.")
    assert got == [(1, want), (1, want), (2, []), (3, [])]
    assert sorted(r[0] for r in df.select(tokens.count_tokens(F.col("text"))).collect()) == sorted([len(want), len(want), 0, 0])
    assert tokens.encode(df.limit(0), "doc_id", "text").count() == 0
