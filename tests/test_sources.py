import json

import pytest
from pyspark.sql import functions as F

from synoptic.plans import strategy
from synoptic.sources import readers, writers
from synoptic.streaming import refresh

TTL = '''@prefix s: <http://x.org/s#> . @prefix skos: <http://www.w3.org/2004/02/skos/core#> .
# a comment
s:a a s:Craft ; skos:prefLabel "Alpha \\"one\\""@en , "Alfa"@fr ;
  s:when "2001-01-01"^^<http://www.w3.org/2001/XMLSchema#date> ; s:mass 3.5 ; s:part [ s:n 1 ; s:m "x" ] .
<http://x.org/b> skos:altLabel """two
lines""" .
'''
HTML = "<html><p> </p><p>Intro <b>text</b></p><table><tr><th>Name<th>Band</tr><tr><td>A &amp; B</td><td><a href='d/1.html'>x</a></td></tr><tr><td>C</td></table><pre>-12 'VOYAGER'  31 'X Y'</pre>"


def test_turtle(spark, tmp_path):
    (tmp_path / "a.ttl").write_text(TTL)
    (tmp_path / "b.ttl").write_text(TTL)
    got = {tuple(x) for x in readers.turtle(spark, [str(tmp_path)]).collect()}
    s = "http://x.org/s#"
    assert (s + "a", "http://www.w3.org/2004/02/skos/core#prefLabel", 'Alpha "one"', "literal", None, "en") in got
    assert (s + "a", s + "when", "2001-01-01", "literal", "http://www.w3.org/2001/XMLSchema#date", None) in got
    assert ("http://x.org/b", "http://www.w3.org/2004/02/skos/core#altLabel", "two\nlines", "literal", None, None) in got
    # The blank node of each file is one of its own; all else is the same triple.
    blanks = {t[2] for t in got if t[3] == "blank"}
    assert len(blanks) == 2 and all((b, s + "n", "1", "literal", "integer", None) in got for b in blanks) and len(got) == 12
    listed = readers.parse_turtle("@prefix s: <http://x.org/s#> . s:a s:has (s:b 2) . _:n s:of s:a .", "f")
    first, rest = "http://www.w3.org/1999/02/22-rdf-syntax-ns#first", "http://www.w3.org/1999/02/22-rdf-syntax-ns#rest"
    assert ("_:fb1", first, s + "b", "uri", None, None) in listed and ("_:fb1", rest, "_:fb2", "blank", None, None) in listed and ("_:fb2", first, "2", "literal", "integer", None) in listed
    assert (s + "a", s + "has", "_:fb1", "blank", None, None) in listed and ("_:fn", s + "of", s + "a", "uri", None, None) in listed


def test_html(spark):
    df = spark.createDataFrame([("p", HTML), ("q", None)], "id string, html string")
    assert {tuple(x) for x in readers.html_table(df, "html").collect()} == {("A & B", "name", "A & B"), ("A & B", "band", "x"), ("C", "name", "C")}
    r = df.where("id = 'p'").select(readers.html_links("html").alias("l"), readers.first_paragraph("html").alias("p"), readers.quoted_codes(F.get(readers.html_preformatted("html"), F.lit(0))).alias("c")).first()
    assert r.l == ["d/1.html"] and r.p == "Intro text" and [tuple(x) for x in r.c] == [(-12, "VOYAGER"), (31, "X Y")]
    page = spark.createDataFrame([("u", "<table><tr><td>Mass:</td><td>5</td></tr><tr><td>only</td></tr></table>")], "id string, html string")
    assert [tuple(x) for x in readers.two_column_page(page, "id", "html").collect()] == [("u", "mass", "5")]


def test_text_formats(spark):
    lines = spark.createDataFrame([("Code  Long.   cos      sin    Name",), ("000   0.0000 0.62411 +0.77873 Greenwich",), ("248 ", ), (None,)], "value string")
    got = readers.observatory_codes(lines).collect()
    assert [(x.code, x.label, x.longitude) for x in got] == [("000", "Greenwich", 0.0)] and got[0].latitude == pytest.approx(51.48, abs=0.05)
    blocks = spark.createDataFrame([("observatory = kpno\n name = \"Kitt\"\n\nobservatory = lick\nx=1",)], "t string")
    assert {tuple(x) for x in readers.key_value_blocks(blocks, "t").collect()} == {("kpno", "observatory", "kpno"), ("kpno", "name", '"Kitt"'), ("lick", "observatory", "lick"), ("lick", "x", "1")}
    d = spark.range(1).select(readers.degrees(F.lit("12 30 00 S")), readers.degrees(F.lit("-5 15")), readers.cache_name(F.lit("https://A.b/c?d=1"))).first()
    assert tuple(d) == (-12.5, -5.25, "https_a_b_c_d_1")


def test_json_and_xml(spark, tmp_path):
    (tmp_path / "x" / "Observatory").mkdir(parents=True)
    (tmp_path / "x" / "Other").mkdir()
    (tmp_path / "x" / "Observatory" / "a.json").write_text(json.dumps({"Spase": {"ResourceID": "i", "Names": [{"ResourceName": "n"}], "InformationURL": {"URL": "u", "Description": "no"}, "Longitude": "12E"}}))
    (tmp_path / "x" / "Other" / "b.json").write_text("{}")
    long = readers.json_tree(spark, str(tmp_path))
    assert {(x.attr, x.value) for x in long.collect()} == {("ResourceID", "i"), ("ResourceName", "n"), ("URL", "u"), ("Longitude", "12E")}
    clean = readers.cleaned_attributes(long, {"ResourceName": "label", "Longitude": "longitude"})
    w = readers.wide(clean, ["label", "longitude"], ["URL"]).first()
    assert (w.label, w.longitude, w.URL) == ("n", "12", ["u"])
    (tmp_path / "p1.json").write_text(json.dumps({"data": [{"id": 1, "name": "a"}]}))
    assert [tuple(x) for x in readers.paged_json(spark, str(tmp_path / "p1.json")).collect()] == [(1, "a")]
    (tmp_path / "c.xml").write_text("<all><rec><title>t</title><ref>r1</ref><ref>r2</ref></rec></all>")
    assert readers.xml_records(spark, str(tmp_path / "c.xml"), "rec").first().ref == ["r1", "r2"]
    item = json.dumps({"entities": {"Q1": {"labels": {"en": {"value": "L"}}, "aliases": {"fr": [{"value": "A"}]}, "claims": {"P625": [{"mainsnak": {"datavalue": {"value": {"latitude": 1.5, "longitude": 2}}}}], "P31": [{"mainsnak": {"datavalue": {"value": {"id": "Q9"}}}}], "P1": [{}]}}}})
    got = spark.createDataFrame([(item,), ("{bad",)], "j string").select(F.explode(readers.item_attributes("j")).alias("x")).select("x.*").collect()
    assert {tuple(x) for x in got} == {("label", "L", "en"), ("alt_label", "A", "fr"), ("latitude", "1.5", None), ("longitude", "2", None), ("type", "Q9", None)}
    (tmp_path / "v.tsv").write_text("A\tB\tComments\tEntity1\tEntity2\nx\to\t\te1\te2\n")
    v = readers.votes(spark, str(tmp_path / "v.tsv")).first()
    assert (v.yes, v.no, v.Entity1) == (1, 1, "e1")


def test_writers(spark, tmp_path):
    writers.listing(spark.createDataFrame([(1, 0, "a", "a"), (2, 1, "b", "a > b")], "id int, level int, label string, path string"), str(tmp_path / "l"))
    assert [x.value for x in spark.read.text(str(tmp_path / "l")).collect()] == ['"1";"0";"a"', '"2";"1";"b"']
    writers.lookup(spark.createDataFrame([("t", ["a", "b"])], "term string, names array<string>"), str(tmp_path / "n"))
    assert spark.read.json(str(tmp_path / "n")).first().names == ["a", "b"]
    writers.mappings(spark.createDataFrame([("a", "b", "x", "y")], "subject_id string, object_id string, subject_source string, object_source string"), str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 1


def test_strategy_language():
    steps = strategy.parse("# head\naas, iaumpc [telescope, ground observatory]: type, label_match, acronym >= 0.5 # x\n\nspase, pds: all, -tfidf, -date\nnaif,nssdc [all, -survey]: digit")
    assert [(s.list1, s.list2) for s in steps] == [("aas", "iaumpc"), ("pds", "spase"), ("naif", "nssdc")]
    assert steps[0].types == {"telescope", "ground observatory"} and steps[0].limits == (("acronym", ">=", 0.5),) and steps[0].matchers == ("label_match",)
    assert "tfidf" not in steps[1].scorers and "date" not in steps[1].filters and "survey" not in steps[2].types


@pytest.mark.parametrize("text", ["aas iaumpc type", "aas, iaumpc:", "aas, iaumpc [x: type", "aas, iaumpc [rocket]: type", "aas: type", "aas, nowhere: type", "aas, pds: magic", "aas, pds: type >= 3"])
def test_strategy_errors(text):
    with pytest.raises(strategy.StrategyError, match="line 2"):
        strategy.parse("\n" + text)


def test_strategy_run(spark):
    cols = "uri string, source string, label string, alt_label array<string>, entity_type string, latitude double, longitude double, years array<int>, ids array<string>, apertures array<double>, parents array<string>"
    rows = [("a1", "aas", "Hale Telescope", None, "telescope", 33.3, -116.8, None, None, None, None), ("a2", "aas", "Green Bank Dish", None, "telescope", None, None, None, None, None, None), ("w1", "wikidata", "hale telescope", None, None, 33.3, -116.8, None, None, None, None), ("w2", "wikidata", "Green Banc Dish", None, None, None, None, None, None, None, None), ("w3", "wikidata", "Hale Telescope", None, None, -30.0, 10.0, None, None, None, None)]
    got = strategy.run(strategy.parse("aas, wikidata: distance, label_match\naas, wikidata: levenshtein_similarity >= 0.8"), spark.createDataFrame(rows, cols))
    assert {(x.a, x.b, x.predicate) for x in got.collect()} == {("a1", "w1", "exactMatch"), ("a2", "w2", "closeMatch")}


def test_streams(spark, tmp_path):
    one, two = str(tmp_path / "in"), str(tmp_path / "ck")
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, t int").coalesce(1).write.parquet(one)
    schema = spark.read.parquet(one).schema
    refresh.keep_latest(refresh.event_stream(spark, one, schema), str(tmp_path / "out"), ["k"], ["t"], two).awaitTermination()
    spark.createDataFrame([(2, "c", 2), (3, "d", 2)], "k int, v string, t int").coalesce(1).write.mode("append").parquet(one)
    refresh.keep_latest(refresh.event_stream(spark, one, schema), str(tmp_path / "out"), ["k"], ["t"], two).awaitTermination()
    assert {(x.k, x.v) for x in refresh.latest_rows(spark, str(tmp_path / "out"), schema, 1).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    with pytest.raises(FileNotFoundError):
        refresh.latest_rows(spark, str(tmp_path / "out"), schema, 2)
