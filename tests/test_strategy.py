"""The strategy's pairs and scores against brute force."""

import random
from itertools import product

from synoptic.functions.text import indel_ratio
from synoptic.operators.alike import alike
from synoptic.plans import strategy

COLS = "uri string, source string, label string, alt_label array<string>, entity_type string, latitude double, longitude double, years array<int>, ids array<string>, apertures array<double>, parents array<string>"


def entity(uri, source, label, alt=None, at=(None, None)):
    return (uri, source, label, alt, None, *at, None, None, None, None)


def linked(spark, text, rows):
    """The links of a strategy, without the cut at the mean of the scores."""
    return {(x.a, x.b) for x in strategy.run(strategy.parse(text), spark.createDataFrame(rows, COLS), z=-9.0).collect()}


def test_alike_finds_all_pairs_over_the_limit(spark):
    r = random.Random(3)
    words = ["telescope", "solar tower", "array", "radio", "".join(r.choices("abcde", k=70))]
    keys = {" ".join(["".join(r.choices("abco", k=r.randrange(1, 9))), r.choice(words)]) for _ in range(150)} | {"x", "xy"}
    keys |= {k[:-2] + k[-1] for k in keys if len(k) > 2}
    rows = spark.createDataFrame([(k, k) for k in keys], "id string, k string")
    for least in (0.6, 0.85):
        got = {tuple(x) for x in alike(rows, rows, least).collect()}
        assert got == {(a, b) for a, b in product(keys, keys) if indel_ratio(a, b) >= least - 1e-9}


def test_mistyped_in_all_rare_words(spark):
    rows = [entity("a1", "aas", "Šurigla Prèlifu Solar Tower"), entity("w1", "wikidata", "Šurigla Prelifu Solar Töwer"), entity("a2", "aas", "Dibihâ Posagli Interferometer Array", at=(10.0, 20.0)), entity("w2", "wikidata", "Dibiha Pozagli Interferomeer Array", at=(10.01, 20.0))]
    rows += [entity(f"w{n}", "wikidata", f"{w} Solar Interferometer Tower Array", at=(50.0, float(n))) for n, w in enumerate(["Kolo", "Bari", "Metu"], 3)]
    assert linked(spark, "aas, wikidata: distance, levenshtein_similarity >= 0.85", rows) == {("a1", "w1"), ("a2", "w2")}


def test_best_of_all_names_and_suffix_numbers(spark):
    rows = [entity("a1", "aas", "Ñobeso Zahegle Observatory"), entity("w1", "wikidata", "ÑZO", ["Ñobeso Zahegle Observatori"])]
    rows += [entity("a2", "aas", "Kiruna Probe II"), entity("w2", "wikidata", "Kiruna Prube 2"), entity("a3", "aas", "Gosat Mission I"), entity("w3", "wikidata", "Gosat Misson II")]
    assert linked(spark, "aas, wikidata: number, levenshtein_similarity >= 0.8", rows) == {("a1", "w1"), ("a2", "w2")}
    assert linked(spark, "aas, wikidata: acronym >= 0.9", [entity("a1", "aas", "Kolo", ["ESO"]), entity("w1", "wikidata", "Metu", ["European Southern Observatory"])]) == {("a1", "w1")}


def test_tfidf_is_computed(spark):
    rows = [entity("a1", "aas", "Green Bank Telescope"), entity("w1", "wikidata", "Telescope of Green Bank"), entity("w2", "wikidata", "Kolo Array")]
    got = strategy.run(strategy.parse("aas, wikidata: tfidf >= 0.5"), spark.createDataFrame(rows, COLS), z=-9.0).collect()
    assert [(x.a, x.b) for x in got] == [("a1", "w1")] and 0.5 < got[0].scores["tfidf"] < 1


def test_three_lists_keep_the_links_of_each_pair(spark):
    """A link between two lists does not keep an entity from the third; one that follows from others is not made again."""
    rows = [entity(f"{m}{i}", source, f"{n} Observatory") for m, source in (("a", "aas"), ("p", "pds"), ("w", "wikidata")) for i, n in enumerate(("Kolomna", "Barinas"))]
    text = "aas, pds: label_match\naas, wikidata: label_match\npds, wikidata: label_match"
    got = linked(spark, text, rows)
    assert got == {("a0", "p0"), ("a1", "p1"), ("a0", "w0"), ("a1", "w1")}
    # All that is missing follows: p0 and w0 are synonyms through a0.


def test_identifiers_first(spark):
    rows = [(*entity("a1", "aas", "Kolo"), ["X 1"]), (*entity("w1", "wikidata", "Metu"), ["x 1"]), (*entity("a2", "aas", "Metu Tower"), None), (*entity("w2", "wikidata", "Metu Tower"), None)]
    df = spark.createDataFrame(rows, COLS + ", code array<string>")
    got = {(x.a, x.b, x.justification) for x in strategy.run(strategy.parse("aas, wikidata: label_match"), df, plan=(("aas", "code", "wikidata", "code"),)).collect()}
    assert got == {("a1", "w1", "identifier"), ("a2", "w2", "lexical")}


def test_recorded_answers_decide(spark):
    names = ["Alpha Prime", "Beta Prime", "Gamma Prime", "Delta Prime"]
    rows = [entity(f"a{i}", "aas", n) for i, n in enumerate(names)] + [entity(f"w{i}", "wikidata", n + "s") for i, n in enumerate(names)]
    answers = spark.createDataFrame([("a0", "w0", "Same."), ("a1", "w1", "<think>same</think> distinct"), ("a2", "w2", "narrow"), ("a0", "w1", "same")], "a string, b string, answer string")
    steps = "aas, wikidata: levenshtein_similarity >= 0.5\naas, wikidata: levenshtein_similarity >= 0.4"
    got = {(x.a, x.b): x.predicate for x in strategy.run(strategy.parse(steps), spark.createDataFrame(rows, COLS), z=-9.0, recorded=answers).collect()}
    assert got == {("a0", "w0"): "exactMatch", ("a1", "w1"): "differentFrom", ("a2", "w2"): "narrowMatch"}


def test_places_and_embeddings(spark):
    rows = [(*entity("a1", "aas", "North Site"), "United States", "Texas", [1.0, 0.0]), (*entity("w1", "wikidata", "North Sites"), "United States", "Ohio", [1.0, 0.0]), (*entity("w2", "wikidata", "North Sitez"), "United States", None, [0.0, 1.0])]
    df = spark.createDataFrame(rows, COLS + ", country string, state string, embedding array<double>")
    run = lambda text: {(x.a, x.b) for x in strategy.run(strategy.parse(text), df, z=-9.0).collect()}
    assert run("aas, wikidata: distance, levenshtein_similarity >= 0.8") == {("a1", "w2")}
    assert run("aas, wikidata: embedding >= 0.9") == {("a1", "w1")}


def test_a_label_that_many_bear_makes_no_pairs(spark, monkeypatch):
    """Labels are assigned without a pair of each two that share one; steps with filters still make them."""
    def pairs(*_):
        raise AssertionError("pairs were made")

    monkeypatch.setattr(strategy.joins, "label_matches", pairs)
    rows = [entity(f"{m}{i:03d}", source, "Unknown") for m, source in (("a", "aas"), ("p", "pds"), ("w", "wikidata")) for i in range(40 if m != "w" else 60)]
    text = "aas, pds: label_match\naas, wikidata: label_match\npds, wikidata: label_match"
    assert linked(spark, text, rows) == {(f"a{i:03d}", f"{m}{i:03d}") for m in "pw" for i in range(40)}


def test_assignment_by_values_is_that_of_all_pairs(spark, monkeypatch):
    """In rounds and in order: many of one value, entities with several values, values of one side only."""
    r = random.Random(5)
    for few in (200_000, 0):
        monkeypatch.setattr(strategy.select, "FEW", few)
        for crowd, more in ((60, 0), (25, 12)):
            one = [(f"a{i:03d}", "hot") for i in range(crowd)] + [(f"a{r.randrange(60):03d}", f"v{r.randrange(15)}") for _ in range(more)] + [("a900", "mine")]
            two = [(f"b{i:03d}", "hot") for i in range(crowd - 5)] + [(f"b{r.randrange(60):03d}", f"v{r.randrange(15)}") for _ in range(more)] + [("b900", "yours")]
            want, left, right = set(), set(), set()
            for a, b in sorted({(a, b) for a, v in one for b, w in two if v == w}):
                if a not in left and b not in right:
                    want.add((a, b))
                    left.add(a)
                    right.add(b)
            rows = [spark.createDataFrame(x, "id string, v string") for x in (one, two)]
            got = strategy.select.one_to_one_by_value(*rows).collect()
            assert {(x.a, x.b) for x in got} == want and len(got) == len(want)
