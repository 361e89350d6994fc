import pytest

from synoptic.llm import lexicon as L
from synoptic.llm import variants as V

LISTED = [
    (1, "Tedupra Chetotri Survey Telescope 0.4m", ["TCST"]), (2, "Tedupra Chetotri Survey Telescope 1.2m", ["TECS", "The Gagatre Ear 1.2m"]), (3, "Vivifu Droklele Observatory 1", ["VDO"]),
    (4, "Vivifu Droklele Observatory 2", None), (5, "Choprova Kloshablo Solar Tower", ["CKST", "Big Verocha"]), (6, "Choprovi Kloshable Ionosonde", ["CKI"]),
]
TYPED = [
    ("Tedupra Chetotri Survey Telescope 40 cm", 1), ("CHETOTRI, TEDUPRA (SURV. TEL.) 1.20-m", 2), ("the gagatre ear 1.2 m", 2), ("Gagatr Ear 1.2m", 2), ("T. Chetotri Survey Tel. 0.4 metre", 1), ("tecs", 2), ("T.E.C.S.", 2),
    ("Tedupra Chetotri Survey Telescope", None), ("Tedupra Chetotri Survey Telescope 3.1m", None), ("Observatoire Vivifu Droklele II", 4), ("vivifu droklele obs. no. 01", 3), ("Vivifu Droklele Obsy #3", None),
    ("Tour solaire Chpprova Kolshablo", 5), ("ChoprovaKloshablo Solar Tower", 5), ("choprovakloshablo sol. twr", 5), ("Kloshablo Choprova", 5), ("Choprovi Kloshable Iono.", 6), ("Choprova Kloshablo Radio Telescope", None),
    ("Zubiru Nalipo Solar Tower", None), ("", None), (None, None), ("   ", None), ("word " * 5000, None), ("Çhoprova Kloshablo Şolar Tower", 5), ("big verocha", 5),
]


def test_link(spark):
    listed = spark.createDataFrame(LISTED, "fid bigint, label string, alt array<string>")
    rows = spark.createDataFrame([(i, t, None, "x") for i, (t, _) in enumerate(TYPED)] + [(0, TYPED[0][0], None, "x"), (500, "rubbish", "CKI", "x"), (None, "CKI", None, "x")], "mid bigint, label string, alt string, form string")
    got = {x.key: x.entity for x in V.link(rows, "mid", ["label", "alt"], listed, "fid", "label", "alt").collect()}
    assert {i: f for i, (_, f) in enumerate(TYPED) if f} | {500: 6} == got
    assert V.link(rows.limit(0), "mid", ["label"], listed, "fid", "label", "alt").count() == 0 == V.link(rows, "mid", ["label"], listed.limit(0), "fid", "label", "alt").count()


NAMES = [
    (1, "Mauna Kea North Observatory", None), (2, "James Clerk Maxwell Telescope", ["JCMT"]), (3, "International Business Machines Corp.", None), (4, "Hale Observatory", None), (5, "Alpha Bravo Charlie Deltas Echoes Foxtrot", None),
    (6, "J. Smithson Observatory", None), (7, "Robert Miller Array", None), (8, "Kea Kea Station", None), (9, "Observatory of Pneumonoultramicroscopicsilicovolcanoconiosis", None),
]
MANY_WORDS = [
    ("mauna kea north obs", 1), ("Maunakea North Observatory", 1), ("North Kea Mauna", 1), ("Mauna Kea Observatory", None), ("J. C. Maxwell Tel.", 2), ("Maxwell, James C.", 2), ("James Clark Maxwell", 2), ("J. Clerk Maxwel", 2),
    ("International Business Machines", 3), ("International Business Machines Ltd", 3), ("Internatonal Busines Machnes Co.", 3), ("Hale", 4), ("Hale Obs.", 4), ("Hael Observatory", 4), ("foxtrot echoes deltas charlie bravo alpha", 5),
    ("Alpa Bravoo Charly Deltas Echos Foxtrott", 5), ("AlphaBravo Charlie Deltas Echoes Foxtrot", 5), ("A B C D E Foxtrot", 5), ("A Bravo C Deltas E F", 5), ("A Bravo C Foxtrot E F", None), ("John Smithson Observatory", 6), ("J Smithson", 6),
    ("Bob Miller", 7), ("kea kea", 8), ("Pneumonoultramicroscopicsilicovlcanoconiosi", 9), ("x" * 100_000, None), (" ".join(f"w{i}" for i in range(3000)), None),
]


@pytest.mark.parametrize("most", [256, 0])
def test_names_of_any_number_of_words(spark, monkeypatch, most):
    """Also with every name compared word by word, which knows no initials and no words run together."""
    monkeypatch.setattr(V, "MOST", most)
    listed = spark.createDataFrame(NAMES, "fid int, label string, alt array<string>")
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(MANY_WORDS)], "mid int, label string")
    got = {x.key: x.entity for x in V.link(rows, "mid", ["label"], listed, "fid", "label", "alt").collect()}
    assert got == {i: f for i, (_, f) in enumerate(MANY_WORDS) if f and (most or "J. Clerk Maxwel" != MANY_WORDS[i][0])}


def test_rules_from_a_table(spark):
    rules = L.rules_of(spark.createDataFrame([("kind", "bank", "bank"), ("kind", "banque", "bank"), ("legal", "AG", None), ("connecting", "of", None), ("given", "Seppl", "Josef")], "rule string, word string, meaning string"))
    assert L.parse("Bank of Josef Huber AG", rules) == {"core": ["josef", "huber"], "kind": "bank", "suffix": None, "nick": [], "code": None}
    listed = spark.createDataFrame([(1, "Josef Huber Bank AG", None), (2, "Josef Huber Mill", None)], "fid int, label string, alt array<string>")
    rows = spark.createDataFrame([(1, "Banque Seppl Huber"), (2, "Huber Bankk"), (3, "Radio Josef Huber")], "mid int, label string")
    assert {(x.key, x.entity) for x in V.link(rows, "mid", ["label"], listed, "fid", "label", "alt", rules=rules).collect()} == {(1, 1)}


@pytest.mark.parametrize(("a", "b", "d"), [("abc", "abc", 0), ("abc", "acb", 1), ("abcd", "abd", 1), ("abcd", "xbcdy", 2), ("kitten", "sitting", 3)])
def test_distance(a, b, d):
    assert L.distance(a, b, 3) == d == L.distance(b, a, 3)


def test_deletions_meet_within_the_distance():
    assert L.deletions("abcd", 1) & L.deletions("abdc", 1) and len(L.deletions("abcdef", 2)) == 1 + 6 + 15


def test_no_pair_of_words_within_the_distance_is_missed():
    """Against all pairs, around the length from which words go by their parts."""
    import random

    r = random.Random(11)

    def typed(word):
        w = list(word)
        for _ in range(r.randint(0, 2)):
            i = r.randrange(len(w))
            kind = r.randrange(4)
            if kind == 0:
                w[i] = r.choice("abc")
            elif kind == 1:
                w.insert(i, r.choice("abc"))
            elif kind == 2 and len(w) > 4:
                del w[i]
            elif i + 1 < len(w):
                w[i], w[i + 1] = w[i + 1], w[i]
        return "".join(w)

    listed = ["".join(r.choice("abcdefgh") for _ in range(n)) for n in [4, 5, 6, 9, 22, 23, 24, 25, 26, 27, 28, 40, 90] for _ in range(6)]
    words = [typed(w) for w in listed for _ in range(6)]
    keys = {w: set(V.spellings(w, True)) for w in listed}
    for w in words:
        own = set(V.spellings(w, False))
        for x in listed:
            most = min(L.allowed(w), L.allowed(x))
            if w != x and L.distance(w, x, most) <= most:
                assert own & keys[x], (w, x)


def best(picks, suffix, nick, code, listed):
    """Of each form that picks (words, cost) have in common with a listed name, the least cost, where as many meet as must."""
    own, out = dict(V.forms_of(*listed, True)), {}
    for words, cost in picks:
        lanes = {}
        for form, need in V.forms_of(list(words), suffix, nick, code, False):
            if form in own:
                most = max(need, own[form])
                lanes.setdefault((need, own[form]) if most > 1 else None, [most]).append(form)
        for most, *forms in lanes.values():
            for form in forms if len(forms) >= most else ():
                out[form] = min(cost, out.get(form, cost))
    return out


def test_the_best_combinations_are_those_of_all():
    """Against all combinations: words run together, initials on either side, repeated words, nicknames, codes."""
    import random
    from itertools import product

    r, met = random.Random(5), 0
    words = ["ab", "ba", "abab", "baab", "abba", "a", "b", "aa", "babaab", "abcd", "acbd", "abcdabcd"]
    for _ in range(20_000):
        core = [r.choice(words) for _ in range(r.randint(1, 4))]
        nick = r.random() < 0.1
        choices = [{r.choice(words): 0.0} | {r.choice(words): r.choice((0.25, 1.0, 2.0)) for _ in range(r.randint(0, 3))} for _ in range(r.choice((len(core), len(core), len(core) + 1, r.randint(1, 4))))]
        code, listed_code = r.choice((None, "abcd")), r.choice((None, "xyz"))
        cost = lambda pick: sum(c[w] for c, w in zip(choices, pick, strict=True))  # noqa: E731, B023
        every = [(p, cost(p)) for p in product(*choices)]
        found = [(p, cost(p)) for p in V.best_picks(choices, nick, code is not None, core, nick, listed_code is not None)]
        listed = (core, None, nick, listed_code)
        assert (want := best(every, None, nick, code, listed)) == best(found, None, nick, code, listed), (core, choices)
        met += bool(want)
    assert met > 1500


@pytest.mark.parametrize("most", [256, 0])
def test_names_of_many_combinations_lose_nothing(spark, monkeypatch, most):
    """Initials, words run together, nicknames and codes of misspelled names, whatever number of combinations is spelled out."""
    monkeypatch.setattr(V, "MOST", most)
    listed = spark.createDataFrame([*NAMES, (10, "Kitt Peak North Camera", ["The Ringing Spider", "RNGSPD"]), (11, "R. Haleakala Skyfield Station", None)], "fid int, label string, alt array<string>")
    typed = [
        ("J. Clerk Maxwel", 2), ("Jmaes C. Maxwel", 2), ("JamesClrek Maxwell", 2), ("Maunkea North Obs", 1), ("the rinigng spidr", 10), ("Kittpaek Nroth Camera", 10), ("Richard Haleakla Skyfeild Stn", 11),
        ("R Haleakla Skyfeild", 11), ("KittPaekNorth", 10), ("Robrt M", 7), ("J C Maxwel", 2), ("James Clrek North", None), ("rngspd", 10),
    ]
    got = {x.key: x.entity for x in V.link(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(typed)], "mid int, label string"), "mid", ["label"], listed, "fid", "label", "alt").collect()}
    assert got == {i: f for i, (_, f) in enumerate(typed) if f}


def test_long_names_that_are_listed_run_together(spark):
    listed = spark.createDataFrame([(1, "Maunakeanorthern Observatory", None), (2, "Hale Observatory", None)], "fid int, label string, alt array<string>")
    rows = spark.createDataFrame([(1, "Mauna Kea Northern Observatory"), (2, "Mauna Kea Northern Hill"), (3, "Kea Mauna Northern")], "mid int, label string")
    assert {(x.key, x.entity) for x in V.link(rows, "mid", ["label"], listed, "fid", "label", "alt").collect()} == {(1, 1)}
