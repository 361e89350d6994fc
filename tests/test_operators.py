import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from synoptic import model
from synoptic.operators import changes, compare, embed, hierarchy, joins, nearby, publish, select, synsets, vote


def test_hierarchy_of_deep_wide_and_looped_trees(spark, monkeypatch):
    r = random.Random(1)
    up = {i: i - 1 for i in range(1, 400)} | {i: 200 if i % 3 else r.randrange(0, i) for i in range(400, 900)}
    up |= {2000: 2001, 2001: 2002, 2002: 2000, 2003: 2001, 2004: 2003}
    monkeypatch.setattr(hierarchy.paths, "__defaults__", (100,))
    monkeypatch.setattr(hierarchy.rank_lists, "__defaults__", (300,))
    got = {x.node_id: x for x in hierarchy.hierarchy(spark.createDataFrame(list(up.items()), "child bigint, parent bigint")).collect()}
    below = Counter()
    for n in up:
        path = [n]
        while path[-1] in up and path.count(path[-1]) == 1:
            path.append(up[path[-1]])
        if n >= 2000:
            assert (got[n].root_id, got[n].depth, got[n].path, got[n].n_descendants) == (-1, -1, "", None)
        else:
            assert (got[n].root_id, got[n].depth, got[n].path) == (path[-1], len(path) - 1, "/".join(map(str, path[::-1])))
            below.update(path[1:])
    assert len(got) == len(up) and all(got[n].n_descendants == below[n] for n in up if n < 2000)
    rows = hierarchy.descendants(spark.createDataFrame([got[n] for n in (1, 2, 3)]))
    assert {tuple(x) for x in rows.collect()} == {(0, 1, 1), (0, 2, 2), (1, 2, 1), (0, 3, 3), (1, 3, 2), (2, 3, 1)}


def test_loops(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1), (5, 6), (7, 8), (8, 7), (9, 9)], "child bigint, parent bigint").where("child <> parent")
    assert {tuple(x) for x in hierarchy.loops(df).collect()} == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7)}
    assert hierarchy.loops(df.limit(0)).count() == 0 == hierarchy.hierarchy(df.limit(0)).count()


def test_links_clean_references(spark):
    nodes = spark.createDataFrame([(1, "urn:a", None, ["URN:B::1.0 ", None, "urn:a"]), (2, "urn:b", " urn:zz", None), (3, "urn:c", "\nUrn:G::2.1", []), (3, "urn:c", "urn:g", []), (None, "urn:x", "urn:a", None)], "id bigint, lid string, up string, down array<string>")
    groups = spark.createDataFrame([(90, "urn:g")], "id bigint, lid string")
    assert {tuple(x) for x in hierarchy.links(nodes, groups, "id", "lid", "up", "down").collect()} == {(2, 1), (3, 90)}


def test_points_near_points(spark):
    r = random.Random(2)
    pts = [(i, r.gauss(10, 0.05), r.gauss(20, 0.05)) for i in range(120)] + [(200 + i, 89.95 + r.random() / 20, r.uniform(-180, 180)) for i in range(40)]
    pts += [(300 + i, r.gauss(0.05, 0.03), (180 + r.gauss(0, 0.05) + 180) % 360 - 180) for i in range(40)] + [(400, 10.0, 380.0 - 360 + 360), (401, None, 1.0), (402, math.nan, 1.0), (403, 0.0, 0.0), (404, 95.0, 0.0), (405, 12.0, 259.0), (406, 12.0, -101.0), (406, 12.0, -101.0)]
    df = spark.createDataFrame([(*p, "x") for p in pts], "id bigint, lat double, lon double, a string")
    ok = {p[0]: p for p in pts if p[1] is not None and not math.isnan(p[1]) and abs(p[1]) <= 90 and -180 <= p[2] <= 360 and (p[1], p[2]) != (0, 0)}

    def km(p, q):
        a, b, c, d = map(math.radians, (p[1], p[2], q[1], q[2]))
        return 2 * 6371.0088 * math.asin(min(1, math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2)))

    got = {tuple(x) for x in nearby.points_within(df, "id", "lat", "lon", 10.0).collect()}
    for a in ok:
        for b in ok:
            if a < b and abs(km(ok[a], ok[b]) - 10) > 0.1:
                assert ((a, b) in got) == (km(ok[a], ok[b]) < 10), (ok[a], ok[b])
    assert (405, 406) in got and all(a in ok and b in ok for a, b in got)


def ray_test(pts, x, y):
    odd = False
    for (xa, ya), (xb, yb) in zip(pts, pts[1:] + pts[:1], strict=True):
        if (ya > y) != (yb > y) and x < (xb - xa) * (y - ya) / (yb - ya) + xa:
            odd = not odd
    return odd


def test_points_in_regions(spark):
    r = random.Random(4)
    ring = [[0.0, 0.0], [10.0, 1.0], [12.0, 9.0], [5.0, 4.0], [1.0, 8.0]]
    pts = [(i, r.uniform(-2, 11), r.uniform(-2, 14)) for i in range(400)]
    regions = spark.createDataFrame([("r", ring), ("none", None)], "name string, ring array<array<double>>")
    got = {x.id for x in nearby.points_in_regions(spark.createDataFrame(pts, "id bigint, lat double, lon double"), "id", "lat", "lon", regions, "name", "ring", 8).collect()}
    assert got == {i for i, la, lo in pts if ray_test(ring, lo, la)} and 50 < len(got) < 350


def test_types(spark):
    c = model.closure()
    assert "ufo" in c["telescope"] and "platform" in c["investigation"]
    test = lambda a, b: spark.range(1).select(model.types_compatible(F.array(*map(F.lit, a)) if a else F.lit(None).cast("array<string>"), F.array(*map(F.lit, b)))).first()[0]
    assert test(["telescope"], ["instrument"]) and not test(["survey"], ["instrument"]) and test(None, ["survey"]) and test(["ufo"], ["spacecraft"])
    assert test(["investigation"], ["platform"]) and not test(["telescope"], ["spacecraft"])


def test_filters_pass_missing_data_and_are_symmetric(spark):
    rows = [([1999], [2000, 1999], 10.0, 20.0, 10.01, 20.0, "FR", "FR", [2.0], [2.01, 5.0], [0], [0]), ([], [5], None, 20.0, 10.0, 20.0, "FR", "DE", [], [1.0], [0, 10], [0]), ([1], [2], 10.0, 20.0, 12.0, 20.0, None, "DE", [2.0], [3.0], [2, 0], [2])]
    df = spark.createDataFrame(rows, "y1 array<int>, y2 array<int>, a1 double, o1 double, a2 double, o2 double, c1 string, c2 string, p1 array<double>, p2 array<double>, n1 array<bigint>, n2 array<bigint>")
    c = F.col
    for swap in (False, True):
        i, j = ("2", "1") if swap else ("1", "2")
        got = df.select(compare.overlap_filter(c("y" + i), c("y" + j)), compare.distance_filter(c("a" + i), c("o" + i), c("a" + j), c("o" + j), [(c("c" + i), c("c" + j))]), compare.aperture_filter(c("p" + i), c("p" + j)), compare.number_filter(c("n" + i), c("n" + j))).collect()
        assert [tuple(x) for x in got] == [(True, True, True, True), (True, False, True, False), (False, False, False, True)]


def test_one_to_one_is_the_sequential_scan(spark):
    r = random.Random(5)
    for size in (8, 40):
        pairs = {(r.randrange(size), r.randrange(size)): r.choice([0.1, 0.5, 0.5, 0.9]) for _ in range(size * 3)}
        used_a, used_b, want = set(), set(), set()
        for (a, b), s in sorted(pairs.items(), key=lambda x: (-x[1], x[0])):
            if a not in used_a and b not in used_b:
                want.add((a, b, s))
                used_a.add(a)
                used_b.add(b)
        got = select.one_to_one(spark.createDataFrame([(a, b, s) for (a, b), s in pairs.items()], "a bigint, b bigint, score double"))
        assert {tuple(x) for x in got.collect()} == want


def test_streaks(spark):
    seq = "aaraararrarrra"
    df = spark.createDataFrame([("g", i, x == "a") for i, x in enumerate(seq)] + [("h", 0, True)], "g string, i bigint, ok boolean")
    kept = select.until_streak(df, ["g"], "i", F.floor(F.col("i") / 3), "ok", 2).groupBy("g").count().collect()
    assert {x.g: x["count"] for x in kept} == {"g": seq.index("rr") + 2, "h": 1}


def test_votes(spark):
    rows = [("g", "aa", "fr"), ("g", "aa", "fr"), ("g", "b", "en"), ("h", None, None), ("i", "x", None), ("i", "yy", None), ("i", "zz", None)]
    df = spark.createDataFrame(rows, "g string, v string, lang string")
    assert {x.g: x.value for x in vote.majority(df, ["g"], "v").collect()} == {"g": "aa", "i": "zz"}
    assert {x.g: x.value for x in vote.majority(df, ["g"], "v", "lang").collect()} == {"g": "b", "i": "zz"}
    ones = lambda *vs: [(v, 1) for v in vs]
    assert vote.rounded_majority(ones(0.5, 0.51, 0.512, 3.0)) == 0.512 and vote.rounded_majority([]) is None and vote.rounded_majority(ones(2.0)) == 2.0
    assert vote.rounded_majority([(1.25, 1), (7.0, 3), (1.3, 1)]) == 7.0
    nums = spark.createDataFrame([("g", v, i) for i, v in enumerate([1.0, 0.51, 0.51, 0.5, None])], "g string, v double, o int")
    assert vote.majority_numbers(nums, ["g"], "v", "o").first().value == 0.51
    days = spark.createDataFrame([("g", "2014-09-25"), ("g", "2014-01-01"), ("g", "2013-03-04"), ("h", "2000-01-01")], "g string, d string").select("g", F.to_date("d").alias("d"))
    assert {x.g: [str(v) for v in x.dates] for x in vote.majority_dates(days, ["g"], "d").collect()} == {"g": ["2014-09-25"], "h": ["2000-01-01"]}
    prov = vote.values_with_sources(spark.createDataFrame([("e", "a", "1"), ("e", "a", "2")], "e string, v string, s string"), ["e"], "v", "s").first()
    assert prov.prov == ["1", "2"] and prov.mentions == 2


def test_changes(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, None, 1)], "k int, v string, t int")
    new = spark.createDataFrame([(2, "x", 2), (3, None, 2), (4, "d", 2), (4, "e", 3)], "k int, v string, t int")
    assert {x.k: x.change for x in changes.diff(old, changes.latest(new, ["k"], ["t"]), "k", ["v"]).collect()} == {1: "deleted", 2: "updated", 3: "unchanged", 4: "added"}
    assert {(x.k, x.v) for x in changes.upsert(old, new, ["k"], ["t"]).collect()} == {(1, "a"), (2, "x"), (3, None), (4, "e")}
    assert {x.k for x in changes.newer_keys(old, new, "k", "t").collect()} == {2, 3, 4}
    fixes = spark.createDataFrame([("add", 9, None, "n"), ("rename", 1, 2, None), ("rename", 3, 30, None), ("update", 30, None, "u"), ("delete", 9, None, None)], "action string, k int, new_key int, v string")
    assert {(x.k, x.v) for x in changes.patched(old.select("k", "v"), "k", fixes, ["v"]).collect()} == {(2, "b"), (30, "u")}


def test_synsets(spark):
    edges = [(1, 2), (2, 3), (5, 4), (7, 7), (None, 1)] + [(100, 101 + i) for i in range(50)] + [(200 + i, 201 + i) for i in range(60)]
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    got = defaultdict(set)
    for x in synsets.synsets(df).collect():
        got[x.synset_id].add(x.id)
    assert dict(got) == {1: {1, 2, 3}, 4: {4, 5}, 100: set(range(100, 151)), 200: set(range(200, 261))}
    cut = synsets.synsets(synsets.without(df, spark.createDataFrame([(3, 2)], "src bigint, dst bigint"))).collect()
    assert {x.id for x in cut if x.synset_id == 1} == {1, 2}
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "id bigint, synset_id bigint")
    assert synsets.closure_pairs(members).count() == 4


def test_joins(spark):
    left = spark.createDataFrame([(1, [" A1 ", None]), (2, ["b2"]), (3, None)], "id int, ids array<string>")
    right = spark.createDataFrame([(10, "a1"), (11, "B2"), (12, "b2"), (13, None), (14, "")], "id int, code string")
    assert {tuple(x) for x in joins.merge_on(left, "id", "ids", right, "id", "code").collect()} == {(1, 10), (2, 11), (2, 12)}
    assert {tuple(x) for x in joins.unambiguous_join(left, "id", "ids", right, "id", "code").collect()} == {(1, 10)}
    named_left = spark.createDataFrame([(1, "k", "Alpha", ["Al"]), (2, "k", "Beta", None), (3, "u", "x", None)], "id int, code string, label string, alt array<string>")
    named_right = spark.createDataFrame([(10, "K", "alpha"), (11, "k", "al"), (12, "u", "zzz")], "id int, code string, label string")
    both = joins.unambiguous_join(named_left, "id", "code", named_right, "id", "code", [("label", "label"), ("alt", "label")])
    assert {tuple(x) for x in both.collect()} == {(3, 12), (1, 10), (1, 11)}
    linked = spark.createDataFrame([(1, 10)], "a int, b int")
    assert {tuple(x) for x in joins.merge_on(left, "id", "ids", right, "id", "code", linked).collect()} == {(2, 11), (2, 12)}
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 2)], "s int, d int")
    assert joins.closed(e, "s", "d").count() == 3 + 9


def test_tfidf_and_cosine(spark):
    docs = spark.createDataFrame([(1, "red telescope 12"), (2, "Red dome"), (3, None), (4, "")], "id int, t string")
    w = {(x.id, x.term): x.weight for x in embed.tfidf(docs, "id", "t").collect()}
    assert set(w) == {(1, "red"), (1, "teles"), (1, "12"), (2, "red"), (2, "dome")} and sum(v * v for (i, _), v in w.items() if i == 1) == pytest.approx(1)
    vecs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0])], "id int, v array<double>")
    top = embed.cosine_top_k(vecs.where("id = 1"), vecs, "id", "v", 2).collect()
    assert [(x.id, x["rank"]) for x in sorted(top, key=lambda x: x["rank"])] == [(2, 1), (3, 2)]
    assert vecs.where("id=1").select(embed.cosine(F.col("v"), F.array(F.lit(1.0), F.lit(1.0)))).first()[0] == pytest.approx(math.sqrt(0.5))


def test_hybrid_embedding(spark):
    from pyspark.ml.linalg import Vectors

    r = random.Random(1)
    df = spark.createDataFrame([(i, Vectors.dense([r.random() for _ in range(4)]), Vectors.dense([r.random() for _ in range(3)])) for i in range(20)], ["id", "x", "y"])
    out = embed.hybrid(df, {"x": 0.5, "y": 0.25}, "h", width=4).collect()
    assert all(len(x.h) == 3 and x.h.norm(2) == pytest.approx(1) for x in out)


def test_views(spark):
    nodes = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (8, "x"), (9, "y")], "id int, label string")
    edges = spark.createDataFrame([(2, 1), (3, 2), (8, 9), (9, 8)], "src int, dst int")
    got = {x.id: (x.level, x.path) for x in publish.levels(edges, nodes).collect()}
    assert got == {1: (0, "a"), 2: (1, "a > b"), 3: (2, "a > b > c"), 8: (0, "x"), 9: (0, "y")}
    t = publish.to_triples(spark.createDataFrame([("s", "u#1", "label", 'a "q"', "en"), ("s", "u#1", "is_part_of", "u#2", None), ("s", "u#1", "latitude", "1.5", None)], "source string, uri string, attr string, value string, lang string"))
    lines = {x[0] for x in t.select(publish.n_triples(t)).collect()}
    assert '<https://example.org/u#1> <https://example.org/attr#label> "a \\"q\\""@en .' in lines and any(x.endswith("<https://example.org/u#2> .") for x in lines)


def test_enrichment(spark):
    from synoptic.functions import answers
    from synoptic.operators import enrich

    df = spark.createDataFrame([(1, "European Southern Observatory (ESO)"), (2, "Dome at Hill"), (3, None), (2, "Dome at Hill")], "id int, label string")
    got = {(x.id, x.form, x.kind) for x in enrich.label_forms(df, "id", "label").collect()}
    assert got == {(1, "European Southern Observatory (ESO)", "label"), (1, "European Southern Observatory", "name"), (1, "ESO", "acronym"), (2, "Dome at Hill", "label"), (2, "Dome", "short")}
    kinds = spark.createDataFrame([(1, "ground observatory"), (1, "spacecraft"), (2, None)], "id int, kind string")
    assert {x.id: x.types for x in enrich.united_types(kinds, "id", "kind", "ufo").collect()} == {1: ["spacecraft"], 2: ["ufo"]}
    r = spark.range(1).select(answers.best_candidate(F.lit("<x>1</x>Best match: 3. It has the same code")).alias("b"), answers.best_candidate(F.lit("none fits")).alias("n"), answers.category(F.lit("It is a Radio Telescope.")).alias("c"), answers.category(F.lit("?")).alias("u"), answers.decision(F.lit("no idea")).alias("d"), enrich.with_source(F.array(F.lit("a")), F.lit("s")).alias("w")).first()
    assert tuple(r.b) == (3, "It has the same code") and r.n is None and (r.c, r.u, r.d) == ("telescope", "ufo", None) and tuple(r.w[0]) == ("a", ["s"])
    older, newer = ({"label": F.lit(a), "alt_label": F.array(*map(F.lit, b))} for a, b in (("A", ["x"]), ("B", ["B", "y"])))
    m = vote.merged_entity(older, newer)
    assert tuple(spark.range(1).select(m["label"], m["alt_label"]).first()) == ("B", ["A", "x", "y"])


def test_superseded(spark):
    df = spark.createDataFrame([("k", 3, 30), ("k", 1, 10), ("k", 2, 20), ("k", 4, 30), ("l", 9, 5)], "key string, id int, day int")
    got = {x.id: (x.replaces, x.replaced_by, x.deprecated) for x in changes.superseded(df, ["key"], "id", "day", F.floor(F.col("day") / 20)).collect()}
    assert got == {1: (None, 2, True), 2: (1, 3, True), 3: (2, 4, True), 4: (3, None, False), 9: (None, None, False)}


def test_running_total(spark):
    from synoptic.runtime import running_total

    df = spark.createDataFrame([("g", i, i % 3) for i in range(50)] + [("h", 1, 7)], "g string, i int, n int")
    got = {(x.g, x.i): x.t for x in running_total(df, ["g"], [F.col("i")], F.floor(F.col("i") / 7), F.col("n"), "t").collect()}
    assert got == {("h", 1): 0} | {("g", i): sum(k % 3 for k in range(i)) for i in range(50)}


def test_identifier_links(spark):
    rows = spark.createDataFrame([(1, "x", "c1", "N1", None), (2, "x", "c2", " n1", None), (3, "x", "c3", "n/a", ["C2"]), (4, "y", "c4", "N1", ["N/A"]), (5, "x", "c5", "N/A", []), (6, None, "c6", "N9", None), (7, None, "c7", "N9", None)], "id int, kind string, code string, nssdca_id string, prior_id array<string>")
    got = {tuple(x) for x in joins.identifier_links(rows, "id", ["kind"], ["code", "nssdca_id", "prior_id"]).collect()}
    assert got == {(1, 2), (2, 3), (6, 7)}


def slow_rounded_majority(values):
    """One value after another against all values of all clusters."""
    places = lambda v: len(repr(v).split(".")[-1])
    clusters = []
    for v in values:
        home = next((c for c in clusters if any(round(v, p) == round(w, p) for w in c for p in [min(places(v), places(w))])), None)
        clusters.append([v]) if home is None else home.append(v)
    return max(max(clusters, key=len), key=lambda v: (len(repr(v)), v)) if clusters else None


def test_rounded_votes_against_brute_force():
    r = random.Random(3)
    for _ in range(400):
        values = [round(r.choice([1.2, 1.25, 3.0]) + r.uniform(-0.1, 0.1), r.randint(0, 3)) for _ in range(r.randint(1, 12))]
        firsts = list(dict.fromkeys(values))
        assert vote.rounded_majority([(v, values.count(v)) for v in firsts]) == slow_rounded_majority([v for f in firsts for v in [f] * values.count(f)])


@pytest.fixture(params=[True, False], ids=["few", "many"])
def few(request, monkeypatch):
    """Both ways: what is left at once in one task, and in rounds to the end."""
    if not request.param:
        monkeypatch.setattr(select, "FEW", 0)
        monkeypatch.setattr(synsets, "FEW", 0)


def slow_attempts(pairs, most, cap, same=frozenset()):
    """The pairs in order, one at a time."""
    tries, out = {}, []
    for s, a, b in sorted(pairs, key=lambda p: (-p[0], p[1], p[2])):
        if tries.get(("a", a), 0) < most and tries.get(("b", b), 0) < most and (cap is None or len(out) < cap):
            more = most if (a, b) in same else 1
            tries["a", a], tries["b", b] = tries.get(("a", a), 0) + more, tries.get(("b", b), 0) + more
            out.append((a, b, s))
    return out


def test_attempts(spark, few):
    made = lambda pairs: spark.createDataFrame([(float(s), a, b) for s, a, b in pairs], "score double, a int, b int")
    passed_over = [(9, 1, 1), (8, 1, 2), (7, 1, 3), (6, 1, 9), (5, 2, 9), (4, 3, 9), (3, 4, 9)]
    assert (4, 9, 3.0) in {tuple(x) for x in select.attempts_within(made(passed_over)).collect()}
    r = random.Random(2)
    for most, cap in ((1, None), (3, 20), (2, 500)):
        pairs = list({(a, b): (r.randint(1, 30), a, b) for a, b in ((r.randint(1, 12), r.randint(1, 15)) for _ in range(100))}.values())
        assert {tuple(x) for x in select.attempts_within(made(pairs), most, cap).collect()} == set(slow_attempts(pairs, most, cap))
        same = {(a, b) for _, a, b in r.sample(pairs, 25)}
        marked = made(pairs).withColumn("same", F.struct("a", "b").isin([F.struct(F.lit(a), F.lit(b)) for a, b in same]))
        assert {tuple(x) for x in select.attempts_within(marked, most, cap).collect()} == set(slow_attempts(pairs, most, cap, same))
    assert select.attempts_within(made(passed_over).limit(0)).count() == 0


def test_levels_deeper_than_ten(spark):
    nodes = spark.createDataFrame([(i, f"n{i}") for i in range(15)], "id int, label string")
    edges = spark.createDataFrame([(i, i - 1) for i in range(1, 15)], "src int, dst int")
    assert {x.id: x.level for x in publish.levels(edges, nodes).collect()} == {i: i for i in range(15)}
    assert {x.id for x in publish.levels(edges, nodes, 10).collect()} == set(range(11))


def test_cosine_ties_go_by_id(spark):
    vecs = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(60, 0, -1)], "id int, v array<double>")
    assert sorted(x.id for x in embed.cosine_top_k(vecs.where("id = 60"), vecs, "id", "v", 5).collect()) == [1, 2, 3, 4, 5]


def components(pairs):
    """Groups of linked ids, by the least."""
    low = {x: x for p in pairs for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def test_star_links_join_what_all_pairs_join(spark):
    r = random.Random(8)
    for _ in range(6):
        rows = [(i, r.choice([None, None, "x", "y", "z"]) if r.random() < 0.8 else "w", r.random() < 0.5, r.choice("AB"), r.choice("pq")) for i in range(24)]
        pairs = [(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[3:] == b[3:] and (a[1] is None or b[1] is None or a[1] == b[1]) and (a[2] or b[2])]
        links = [tuple(x) for x in joins.star_links(spark.createDataFrame(rows, "id int, guard string, free boolean, k string, v string"), ["k", "v"]).collect()]
        assert components(links) == components(pairs) and len(links) <= 2 * len(rows)


def test_merged_records(spark):
    same = dict(kind="t", number=0, leaf=None, lat=None, lon=None, start=None)
    given = [
        (1, ["A"], None, ["Kolo Dome"]), (2, ["a"], None, ["Other"]), (3, None, "n1", ["Kolo Site"]), (4, None, "n2", ["Kolo Site"]), (5, None, None, ["Metu-Dome"]), (6, None, None, ["metu dome"]), (7, None, None, ["Metu dome"]), (8, None, None, [])
    ]
    rows = [(i, same["kind"], ids, guard, same["number"], labels, None, None, None, None) for i, ids, guard, labels in given]
    rows += [(20, "t", None, None, 0, ["Near One"], None, 10.0, 20.0, "d"), (21, "t", None, None, 0, ["Near Two"], None, 10.01, 20.0, "e"), (22, "t", None, None, 0, ["Near Three"], None, 50.0, 20.0, "d"), (23, "t", None, None, 0, ["Near Four"], None, None, None, "e"), (24, "t", None, None, 1, ["Near Four"], "leaf", None, None, "e")]
    df = spark.createDataFrame(rows, "id int, kind string, ids array<string>, guard string, number int, labels array<string>, leaf string, latitude double, longitude double, start string")
    # 5 and 7 share a first word and a label; 6 has another first word. 22 starts as 20 does, but both have a place.
    assert {x.id: x.group for x in joins.self_merge(df).collect()} == {1: 1, 2: 1, 5: 5, 7: 5, 20: 20, 21: 20, 23: 20}
    parts = spark.createDataFrame([(1, "h", "Cam", "x.xml"), (2, "h", "cam", None), (3, "h", "Spec", "x.xml"), (4, "g", "Cam", None), (5, None, "Cam", None)], "id int, host string, label string, file string")
    assert {x.id: x.group for x in joins.merge_within(parts, "host", ["label", "file"]).collect()} == {1: 1, 2: 1, 3: 1}


def test_lint(spark):
    rows = [
        ("u1", "Big Dome, Chile", "ground observatory", "Chile", None, None), ("u2", "Big Dome", "ground observatory", "Korea, Republic of", None, None), ("u3", "2.5m Dish at Hill", "telescope", None, "Hill", "ground observatory"),
        ("u4", "90cm Dish", "telescope", None, "Hill", "ground observatory"), ("u5", "Dish NASA KLM", "telescope", None, None, None), ("u6", "big dome", "instrument", None, "ESO", "investigation"), ("u7", "Big Place, South Korea", "observatory network", "Korea, Republic of", None, None), ("u8", None, None, None, None, None),
    ]
    got = {(x.uri, x.warning) for x in publish.lint(spark.createDataFrame(rows, "uri string, label string, entity_type string, country string, parent string, parent_type string")).collect()}
    assert got == {
        ("u2", "duplicate"), ("u6", "duplicate"), ("u2", "country mismatch"), ("u4", "aperture format"), ("u4", "broader missing"), ("u5", "agency"), ("u5", "acronym"), ("u5", "aperture missing"), ("u5", "orphan"),
    }


def test_golden_record(spark):
    rows = [(1, "aas", "ABC-1", 10.0, 20.0, 0.5, "ABC-1"), (1, "pds", "ABC-1", 11.0, 21.0, 1.0, None), (1, "naif", "Dome", 11.04, 21.0, 1.0, None), (2, "wikidata", "Own", None, None, 1.0, None), (2, "pds", "Voted", 1.0, 2.0, 0.2, None), (2, "aas", "Voted", 1.0, None, 0.9, None), (3, "pds", "X1", None, None, None, "X1")]
    df = spark.createDataFrame(rows, "g int, source string, label string, lat double, lon double, sure double, code string")
    got = {x.g: x for x in vote.golden(df, "g", "source", "label", {}, [], [], "source", ("lat", "lon", "sure"), "wikidata", ["code"]).collect()}
    assert (got[1].label, got[1].lat, got[1].lon, got[1].code, got[1].labels) == ("Dome", 11.04, 21.0, ["ABC-1"], ["ABC-1", "Dome"])
    assert (got[2].label, got[2].lat, got[2].lon) == ("Own", 1.0, 2.0) and got[3].label == "X1" and got[3].lat is None


def test_confusion(spark):
    found = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4)], "a int, b int")
    gold = spark.createDataFrame([(1, 1, 2, 0), (2, 2, 0, 1), (3, 3, 1, 1), (5, 5, 1, 0), (6, 6, 0, 3)], "a int, b int, yes int, no int")
    assert joins.confusion(found, gold, ["a", "b"]).first().asDict() == {"tp": 1, "fp": 2, "fn": 1, "tn": 1}


def test_points_in_regions_of_many_corners(spark):
    r = random.Random(12)
    ring = [[30 + (8 + 4 * math.sin(9 * t) + r.uniform(0, 0.3)) * math.cos(t), 10 + (8 + 4 * math.sin(9 * t)) * math.sin(t)] for t in (2 * math.pi * i / 2500 for i in range(2500))]
    square = [[-5.0, -5.0], [5.0, -5.0], [5.0, 5.0], [-5.0, 5.0]]
    points = [(i, r.uniform(-8, 24), r.uniform(-8, 44)) for i in range(1500)] + [(9000, None, 1.0), (9001, 0.0, 0.0), (9002, 2.0, 361.0)]

    want = {(i, n) for i, la, lo in points[:1500] for n, pts in (("star", ring), ("square", square)) if ray_test(pts, lo, la)}
    regions = spark.createDataFrame([("star", ring), ("square", square), ("none", None), ("line", ring[:2])], "name string, ring array<array<double>>")
    df = spark.createDataFrame(points, "id int, la double, lo double")
    for level in (3, 12):
        assert {tuple(x) for x in nearby.points_in_regions(df, "id", "la", "lo", regions, "name", "ring", level).collect()} == want
    assert nearby.points_in_regions(df, "id", "la", "lo", regions.limit(0), "name", "ring").count() == 0
    with pytest.raises(ValueError):
        nearby.points_within(df, "id", "la", "lo", 0.001)


def test_paths_deeper_than_those_kept(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "SHALLOW", 5)
    monkeypatch.setattr(hierarchy, "PART_CHARS", 200)
    up = {i: i - 1 for i in range(1, 60)} | {i: i - 40 for i in range(60, 90)}
    pairs = spark.createDataFrame(list(up.items()), "child bigint, parent bigint")
    got = {x.node_id: x.path for x in hierarchy.hierarchy(pairs).collect()}

    def path(i):
        return f"{path(up[i])}/{i}" if i in up else str(i)

    assert got == {i: path(i) for i in up}


def test_one_to_one_against_a_scan(spark, few):
    r = random.Random(6)
    pairs = list({(a, b): (float(r.randint(1, 20)), a, b) for a, b in ((r.randint(1, 30), f"b{r.randint(1, 30)}") for _ in range(250))}.values())
    got = {tuple(x) for x in select.one_to_one(spark.createDataFrame(pairs, "score double, a int, b string")).collect()}
    used, want = set(), set()
    for s, a, b in sorted(pairs, key=lambda p: (-p[0], p[1], p[2])):
        if a not in used and b not in used:
            used |= {a, b}
            want.add((a, b, s))
    assert got == want and select.one_to_one(spark.createDataFrame([], "score double, a int, b string")).count() == 0


def test_synsets_both_ways(spark, few):
    r = random.Random(7)
    edges = [(r.randint(1, 80), r.randint(1, 80)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(30)] + [(5, 5), (None, 3)]
    want = components([(a, b) for a, b in edges if a is not None and a != b])
    assert {x.id: x.synset_id for x in synsets.synsets(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()} == want
    named = synsets.synsets(spark.createDataFrame([("b", "a"), ("c", "b")], "src string, dst string"))
    assert {x.id: x.synset_id for x in named.collect()} == {"a": "a", "b": "a", "c": "a"}


def test_lists_and_removals_by_any_column(spark):
    from synoptic.operators import enrich

    rows = spark.createDataFrame([(1, "telescope", "aas", "x", False), (2, "spacecraft", "aas", "y", None), (3, "spacecraft", "pds", None, False), (4, "investigation", "aas", "z", True), (5, "space mission", "aas", "w", False)], "id int, kind string, src string, label string, gone boolean")
    got = enrich.entity_list(rows, "kind", ["spacecraft"], ["label"], "gone", lattice=True, source=("src", "aas"))
    assert {x.id for x in got.collect()} == {2, 5} and [x.id for x in enrich.entity_list(rows, "kind", ["telescope", "spacecraft"], [], "gone", limit=("id", 2)).collect()] == [1, 2]
    attributes = spark.createDataFrame([("u", "label", "a", "en", "aas"), ("u", "label", "b", "fr", "pds"), ("v", "label", "a", "en", "aas")], "uri string, attr string, value string, lang string, source string")
    assert {(x.uri, x.value) for x in enrich.without_values(attributes, spark.createDataFrame([("u", "fr")], "uri string, lang string"), ("uri", "lang")).collect()} == {("u", "a"), ("v", "a")}


def test_refreshed_list(spark):
    old = spark.createDataFrame([(1, "a", "2020", False), (2, "b", "2020", False), (3, "c", "2020", False), (4, "d", "2019", True), (5, "e", "2019", True)], "k int, v string, modified string, deprecated boolean")
    new = spark.createDataFrame([(1, "a"), (2, "x"), (5, "e"), (6, "f")], "k int, v string")
    got = {x.k: (x.v, x.modified, x.deprecated) for x in changes.refreshed(old, new, "k", ["v"], F.lit("now")).collect()}
    assert got == {1: ("a", "2020", False), 2: ("x", "now", False), 3: ("c", "now", True), 4: ("d", "2019", True), 5: ("e", "now", False), 6: ("f", "now", False)}


def test_relations_by_the_synonym_of_a_list(spark):
    members = spark.createDataFrame([(1, 1, "aas"), (2, 1, "pds"), (3, 1, "pds"), (4, 4, "aas")], "id int, synset_id int, source string")
    pairs = spark.createDataFrame([(1, 9), (4, 9), (7, 9)], "src int, dst int")
    assert {(x.src, x.dst) for x in joins.in_list(pairs, "src", members, "pds").collect()} == {(2, 9), (4, 9), (7, 9)}


@pytest.mark.parametrize(("given", "clean"), [("urn:A:b::1.0", "urn:a:b"), (" \t Urn:a::12 \n", "urn:a"), ("a ::1.2.3", "a"), ("a::1::2", "a::1"), ("a::x", "a::x"), ("::1.0", ""), ("", ""), ("a b", "a b"), (None, None)])
def test_references(spark, given, clean):
    assert spark.range(1).select(hierarchy.clean_reference(F.lit(given).cast("string"))).first()[0] == clean


def test_ways_are_those_of_the_tours(spark, monkeypatch):
    """Deep, wide and looped trees, an id of -1, and as few tables as the halvings of the depth."""
    r = random.Random(1)
    up = {i: i - 1 for i in range(1, 300)} | {i: 200 if i % 3 else r.randrange(0, i) for i in range(300, 700)}
    up |= {2000: 2001, 2001: 2002, 2002: 2000, 2003: 2001, 2004: 2003, 3000: -1, 3001: 3000, 4000: 4001}
    pairs = spark.createDataFrame(list(up.items()), "child bigint, parent bigint")
    written = []
    write = hierarchy.Scratch.write
    monkeypatch.setattr(hierarchy.Scratch, "write", lambda self, df: written.append(1) or write(self, df))
    got = {x.node_id: (x.root_id, x.depth, x.path) for x in hierarchy.ways(pairs).collect()}
    assert len(got) == len(up) and len(written) <= 30
    for n in up:
        path = [n]
        while path[-1] in up and path.count(path[-1]) == 1:
            path.append(up[path[-1]])
        assert got[n] == ((-1, -1, "") if 2000 <= n < 2005 else (path[-1], len(path) - 1, "/".join(map(str, path[::-1]))))
    assert hierarchy.ways(pairs.limit(0)).count() == 0
