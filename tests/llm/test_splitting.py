import os
from collections import defaultdict

import pytest

from synoptic.llm import splitting, tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.DEFAULT_VOCABULARY), reason="no vocabulary file")
SKY = "The telescope measured faint stars near the galaxy core. Its mirror gathers starlight from every galaxy. Stars in the galaxy were measured again by the telescope. "
SOIL = "Farmers plant wheat in wet soil. The soil feeds wheat and barley roots. Barley and wheat leave the soil dry after harvest. "
PROFILES = [("small", 40, 6), ("large", 120, 0), ("none", None, 3)]


def count(t):
    return int(tokens.encoder(tokens.DEFAULT_VOCABULARY).counts([t])[0])


def test_pieces(spark):
    texts = [SKY * 3, "x" * 3000, "日本語の文。" * 100, "=" * 5000 + " end", None, "", "short", "a\n\nb c.\r\n" * 80, "🙂" * 200, "0123456789abcdef" * 90, SKY * 3]
    rows = [(i, t, "p") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, profile string")
    by = defaultdict(list)
    for x in splitting.split(df, "doc_id", "text", PROFILES).collect():
        by[x.profile, x.doc_id].append(x)
    assert {k[0] for k in by} == {"small", "large"}
    for profile, most, overlap in PROFILES[:2]:
        for i, t in enumerate(texts):
            pieces = sorted(by.get((profile, i), []), key=lambda x: x.piece_no)
            if not t or count(t) <= most:
                assert not pieces
                continue
            assert [p.piece_no for p in pieces] == list(range(len(pieces))) and len(pieces) > 1
            assert pieces[0].start_char == 0 and pieces[-1].end_char == len(t)
            for p in pieces:
                assert p.text == t[p.start_char : p.end_char] and count(p.text) == p.n_tokens <= most
            for p, q in zip(pieces, pieces[1:], strict=False):
                assert p.start_char < q.start_char <= p.end_char < q.end_char
                assert count(t[q.start_char : p.end_char]) == q.overlap_tokens <= overlap
                if " " in t[:50] and overlap:
                    assert q.overlap_tokens >= overlap - 3


def test_cuts_where_the_topic_changes():
    enc = tokens.Encoder(tokens.DEFAULT_VOCABULARY)
    text = SKY * 2 + SOIL * 2
    words = splitting.Words(enc)
    numbers = enc.learn([enc.split(text)])
    words.extend()
    last = splitting.np.arange(len(numbers)) == len(numbers) - 1
    strength = splitting.boundary_strengths(words.ends[numbers], words.breaks[numbers], words.blank[numbers], last)
    t = splitting.Text(text, enc, words.chars[numbers], enc.lengths[numbers], strength, splitting.depths_of(words, numbers, strength, splitting.np.zeros(1, int))[0], 1000)
    cut = next(iter(t.pieces(count(SKY * 2) + count(SOIL), 0)))
    assert t.at[cut[1]] == len(SKY * 2) - 1


@pytest.mark.parametrize("seed", range(6))
def test_valleys_against_dense_vectors(seed):
    np, r = splitting.np, splitting.np.random.default_rng(seed)
    units, terms = int(r.integers(2, 30)), 40
    size = int(r.integers(0, 200))
    unit_of, term = np.sort(r.integers(0, units, size)), r.integers(0, terms, size)
    dense = np.zeros((units, terms))
    np.add.at(dense, (unit_of, term), 1)
    sim = []
    for i in range(1, units):
        a, b = dense[max(0, i - splitting.SIDE) : i].sum(0), dense[i : i + splitting.SIDE].sum(0)
        sim.append(a @ b / np.sqrt(max(a @ a * (b @ b), 1e-12)))
    want = [max(sim[max(0, i - splitting.AROUND) : i + 1]) + max(sim[i : i + splitting.AROUND + 1]) - 2 * sim[i] for i in range(units - 1)]
    assert np.allclose(splitting.valley_depths(unit_of, term, units), [*want, 0])


def test_depths_of_texts_together():
    enc = tokens.Encoder(tokens.DEFAULT_VOCABULARY)
    words, np = splitting.Words(enc), splitting.np
    texts = [enc.split(t) for t in (SKY * 2 + SOIL * 3, "One.", SOIL * 4 + "no end", SKY)]
    apart = []
    for own in texts:
        numbers = enc.learn([own])
        words.extend()
        last = np.arange(len(own)) == len(own) - 1
        strength = splitting.boundary_strengths(words.ends[numbers], words.breaks[numbers], words.blank[numbers], last)
        apart.append((numbers, strength, splitting.depths_of(words, numbers, strength, np.zeros(1, int))[0]))
    begins = np.cumsum([0, *(len(t) for t in texts)])[:-1]
    together = splitting.depths_of(words, np.concatenate([a[0] for a in apart]), np.concatenate([a[1] for a in apart]), begins)
    for (_, strength, alone), found in zip(apart, together, strict=True):
        inner = (strength >= splitting.SENTENCE)[:-1].sum()
        assert np.allclose(alone[:inner], found[:inner]) and len(alone) == len(found)


def test_terms():
    words = splitting.Words(tokens.Encoder(tokens.DEFAULT_VOCABULARY))
    assert not words.terms_of("the") and len(words.terms_of("日本語")) == 2 and words.terms_of("star") == words.terms_of("star") != words.terms_of("tree")
    assert len({t for i in range(3000) for t in words.terms_of(f"word{i}")}) == 3000


def test_cuts_at_natural_boundaries(spark):
    df = spark.createDataFrame([(1, SKY * 10)], "doc_id bigint, text string")
    pieces = splitting.split(df, "doc_id", "text", [("p", 60, 0)]).collect()
    assert all(p.text.rstrip().endswith(".") for p in pieces if p.text.strip())
    assert splitting.split(df.limit(0), "doc_id", "text", PROFILES).count() == 0
    assert splitting.split(df, "doc_id", "text", []).count() == 0
