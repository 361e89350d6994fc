import math

import pytest
from pyspark.sql import functions as F

from synoptic.functions import geo
from synoptic.functions import text as X
from synoptic.functions.acronyms import acronym_probability, cut_acronym

ACRONYMS = [
    ("COVID-19 Vaccines Global Access", "COVAX", None), ("National Aeronautics and Space Administration", "NASA", 1), ("National Aeronautics of Space Administration", "SAONAE", None),
    ("Taxe sur la Valeur Ajoutée", "TVA", 1), ("United Nations Educational, Scientific and Cultural Organization", "UNESCO", 1), ("Société Nationale des Chemins de fer Français ", "SNCF", 1),
    ("Société Nationale des Chemins de fer Français ", "SNCFF", 1), ("System for Audio-Visual Event Modeling", "SAVEM", 1), ("System for Audio-Visual Event Modeling", "SyfAuViEvMo", 1),
    ("SUMmarization in Open Context", "SUMINO", None), ("Développement et Administration Internet et Intranet", "DA2I", 1), ("extensible Markup Language", "XML", 1),
    ("Southern Photometric Local Universe Survey", "S-PLUS", 1), ("Deep Space Station 43", "DSS-43", 1), ("Deep Space Station 43", "DSS-42", 0), ("Venus Express", "VEX", 1),
    ("1.3m Balloon Observations Of Millimetric Extragalactic Radiation ANd Geophysics", "BOOMERANG", 1), ("Balloon Observations Of Millimetric Extragalactic Radiation ANd Geophysics", "BOOMERANGE", 1),
]


@pytest.mark.parametrize(("label", "acronym", "expected"), ACRONYMS)
def test_acronyms(label, acronym, expected):
    p = acronym_probability(acronym, label)
    assert 0 < p < 1 if expected is None else p == expected


def test_acronym_edges():
    assert acronym_probability("", "x") == -1 == acronym_probability("abcdef", "abc")
    assert cut_acronym("European Southern Observatory (ESO)") == ("European Southern Observatory", "ESO")
    assert cut_acronym("A (b) tower (c)") == ("A tower", "")


@pytest.mark.parametrize(("a", "b", "expected"), [(1.10, 1.099, 1), (0.3, 0.375, 1), (4, 40, 0), (3, 3.3, 1), (3.3, 3.4, 0.5), (3.9, 3.104, 0.25), (0.4, 0.04, 1 / 3), (38, 37.9999, 1)])
def test_digits(a, b, expected):
    assert X.digit_agreement(a, b) == pytest.approx(expected)


def test_number_inclusion():
    assert X.number_inclusion([0.0, 0.5], [0.0, 0]) == 1
    assert X.number_inclusion([], [1.0]) is None


def test_lengths():
    assert X.lengths_in("0.4 inches, 5.0m")[1] == [0.01, 5.0]
    assert X.lengths_in("65cm")[1] == [0.65]
    assert X.lengths_in("40 inch (1.02 m)")[1] == [1.02] or X.lengths_in("40 inch (1 m)")[1] == [1.0]


@pytest.mark.parametrize(("label", "n"), [("Voyager2", 2), ("Pioneer-10", 10), ("ThemisD", 4), ("Explorer II", 2), ("Cluster Samba", 3), ("Venus", 0), ("", 0), ("Apollo XIV", 14)])
def test_suffix_number(label, n):
    assert X.suffix_number(label) == n


def test_indel_ratio():
    def slow(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return 2 * t[-1][-1] / (len(a) + len(b))

    for a, b in [("kitten", "sitting"), ("", "abc"), ("abcabc" * 20, "bca" * 37), ("same", "same"), ("é", "e")]:
        assert X.indel_ratio(a, b) == pytest.approx(slow(a, b))


def row(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_columns(spark):
    lit = F.lit
    r = row(
        spark,
        slug=X.slug(lit("  Ça va, Observatoire (n° 2) ")), clean=X.clean(lit(" a \t b  (c.")), clean2=X.clean(lit("a b) c).")), lang=X.cut_language(lit("Tour@fr")), nolang=X.cut_language(lit("a@b c")),
        ids=X.launch_ids(lit("2007-004C, 2007-004C-12C x")), year=X.launch_year(lit("x 2007-004C")), d1=X.complete_date(lit("2014")), d2=X.complete_date(lit("2014-05-00")), d3=X.complete_date(lit("+2014-05-06")), d4=X.complete_date(lit("-0300-01-01")),
        loc=X.cut_location(lit("Dome at Hill"), " at "), loc2=X.cut_location(lit("a, b, c"), ","), part=X.cut_part_of(lit("Dish (part of the Big Array), Hill")), aka=X.cut_aka(lit("Old Dome, formerly the New Dome")),
        tags=X.without_tags(lit("<think>x\ny</think> same")), paren=X.without_parentheses(lit("a (b) c")), punct=X.without_punctuation(lit("a,b. c")), m=X.to_metres(lit("40 inches")), m2=X.to_metres(lit("1,5 km")), null=X.slug(lit(None).cast("string")),
    )
    assert r.slug == "ca-va-observatoire-n-2" and r.clean == "a b (c)" and r.clean2 == "a b) c"
    assert tuple(r.lang) == ("Tour", "fr") and tuple(r.nolang) == ("a@b c", None)
    assert r.ids == ["2007-004C"] and r.year == 2007
    assert (r.d1, r.d2, r.d3, r.d4) == ("2014-01-01T00:00:00", "2014-05-00T00:00:00", "2014-05-06T00:00:00", "-0300-01-01")
    assert tuple(r.loc) == ("Dome", "Hill") and tuple(r.loc2) == ("a, b, c", "")
    assert tuple(r.part) == ("Dish , Hill", "Big Array") and tuple(r.aka) == ("Old Dome", "New Dome")
    assert (r.tags, r.paren, r.punct) == ("same", "a c", "a b c")
    assert r.m == pytest.approx(1.016) and r.m2 == 1500 and r.null is None


def test_geo(spark):
    assert geo.geodesic(48.8566, 2.3522, 51.5074, -0.1278) == pytest.approx(343.923, abs=0.01)
    assert geo.geodesic(10, 20, 10, 20) == 0 and geo.geodesic(0, 0, 0.1, 179.9) > 19900
    r = row(spark, a=geo.wrapped_longitude(F.lit(265.5)), b=geo.wrapped_longitude(F.lit(-10.0)), c=geo.geodetic_latitude(F.lit(0.62411), F.lit(0.77873)), s=geo.state_of(F.lit("Green Bank, West Virginia, USA")), none=geo.state_of(F.lit("Texas"), F.lit("Ohio")), sp=geo.in_space(F.lit(" Earth.Moon ")))
    assert r.a == pytest.approx(-94.5) and r.b == -10 and r.c == pytest.approx(51.4774, abs=0.01) and r.s == "West Virginia" and r.none is None and r.sp
    countries = spark.createDataFrame([("RU", "Russia", "EU"), ("US", "United States", "NA"), ("AQ", "Antarctica", "AQ")], "code string, name string, continent string")
    places = spark.createDataFrame([(1, "russia", None, 60.0), (2, None, "ru", 50.0), (3, "USA", "us", 0.0), (4, "Nowhere", None, 0.0), (5, None, None, 0.0), (6, "Antarctica", None, 1.0)], "id int, country string, cc string, lon double")
    got = {x.id: (x.country, x.continent) for x in geo.with_continent(places, countries, "country", "cc", "lon").collect()}
    assert got == {1: ("Russia", "Asia"), 2: ("Russia", "Europe"), 3: ("United States", "North America"), 4: (None, "Antarctica"), 5: (None, None), 6: ("Antarctica", "Antarctica")}
    assert math.isclose(geo.geodesic(0, 0, 0, 1), 111.319, abs_tol=0.01)
