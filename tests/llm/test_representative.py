import pytest
from pyspark.sql import functions as F

from synoptic.llm import representative as R


def test_best_of_the_most_trusted(spark):
    rows = [
        (1, 10, "good", "Dome A", "1", "2"), (1, 11, "poor", "Dome B", "3", "9"), (1, 12, "poor", "Dome B", "3", "8"), (1, 11, "poor", "Dome B", "3", "9"),
        (2, 20, "good", "unknown", None, "1"), (2, 21, None, "Dish", None, "5"), (2, 22, "none", "Disc", None, "7"),
        (3, 30, "good", "alone", "1", "1"), (None, 40, "good", "x", "1", "1"), (4, None, "good", "x", "1", "1"), (5, 50, "poor", "--", None, "1"), (5, 51, "poor", " ", None, "2"),
    ]
    df = spark.createDataFrame(rows, "g int, id int, src string, label string, v string, t string").withColumn("at", F.to_timestamp(F.concat(F.lit("2020-01-0"), "t"))).withColumn("value", F.lit("clash"))
    trust = spark.createDataFrame([("good", 1), ("poor", 2), ("poor", 3)], "source string, rank int")
    fields = {"label": (F.col("label"), R.usable_text(F.col("label"))), "v": (F.col("v"), F.col("v").isNotNull())}
    got = {x.g: (x.label_id, x.v_id) for x in R.representatives(df, "g", "id", "src", "at", fields, trust).collect()}
    assert got[1] == (10, 10) and got[5] == (None, None) and set(got) == {1, 2, 5} and got[2][0] in (21, 22) and got[2][1] is None
    assert R.representatives(df.limit(0), "g", "id", "src", "at", fields, trust).count() == 0


def test_votes_find_the_reliable_source(spark):
    rows = []
    for g in range(40):
        rows += [(g, "f", "true", g * 10 + i, s, None, None) for i, s in enumerate(("a", "b"))] + [(g, "f", f"wrong{g}", g * 10 + 2, "c", None, None)]
    rows += [(99, "f", "true", 991, "a", None, None), (99, "f", "wrong", 990, "c", None, None)]
    stated = spark.createDataFrame(rows, "g int, field string, value string, id int, source string, changed timestamp, rank int")
    truth, reliability = R.discover(stated)
    assert {x.value for x in truth.collect()} == {"true"}
    # Without rounds to learn from, the two claims of the last group tie, and the later record wins.
    assert {x.value for x in R.discover(stated, rounds=1)[0].where("g = 99").collect()} == {"wrong"}
    r = {x.source: x.reliability for x in reliability.collect()}
    assert r["a"] > 0.9 and r["c"] < 0.1


def test_trust_outweighs_any_number_and_the_latest_its_earlier_claims(spark):
    rows = [(1, "f", "best", 1, "top", "2020-01-01", 1)] + [(1, "f", "other", 10 + i, f"s{i}", "2021-01-01", 2 + i % 8) for i in range(40)]
    rows += [(2, "f", "early", 100 + i, "top", f"2020-01-{i + 1:02d}", 1) for i in range(20)] + [(2, "f", "late", 150, "top", "2020-02-01", 1)] + [(2, "f", "early", 160 + i, f"s{i}", "2021-01-01", 2) for i in range(8)]
    rows += [(3, "f", "x", 200, "s1", "2020-01-01", 500), (3, "f", "y", 201, "s2", "2020-01-02", 900), (3, "f", "y", 202, "nobody", "2020-01-02", None)]
    stated = spark.createDataFrame(rows, "g int, field string, value string, id int, source string, changed string, rank int").withColumn("changed", F.to_timestamp("changed"))
    assert {x.g: (x.value, x.id) for x in R.discover(stated)[0].collect()} == {1: ("best", 1), 2: ("late", 150), 3: ("x", 200)}


def test_reliability_decides_within_a_rank(spark):
    """Two sources of one rank: the one that agrees with others elsewhere is believed where they stand alone."""
    rows = []
    for g in range(30):
        rows += [(g, "f", "true", g * 10, "good", None, 3), (g, "f", "true", g * 10 + 1, "other", None, 3), (g, "f", f"w{g}", g * 10 + 2, "bad", None, 3)]
    rows += [(50, "f", "true", 501, "good", None, 3), (50, "f", "wrong", 500, "bad", None, 3)]
    stated = spark.createDataFrame(rows, "g int, field string, value string, id int, source string, changed timestamp, rank int")
    last = lambda n: R.discover(stated, rounds=n)[0].where("g = 50").first()["value"]
    assert last(1) == "wrong" and last(10) == "true"


@pytest.mark.parametrize(("text", "ok"), [("1999", True), ("+1999-05-00", True), ("1999-02-30", False), ("1999-13-01", False), ("0000-00-00", False), ("9999-12-31", False), ("2000-01-01T00:00:00Z", False), ("2000-01-02", True), ("", False), (None, False), ("N/A", False), ("1905-06-13T06:30:00.000Z", True)])
def test_dates(spark, text, ok):
    assert spark.range(1).select(R.usable_date(F.lit(text).cast("string"))).first()[0] is ok


def test_positions_and_texts(spark):
    p = lambda a, b: spark.range(1).select(R.usable_position(F.lit(a).cast("double"), F.lit(b).cast("double"))).first()[0]
    assert p(1, 2) and p(0, 2) and not p(0, 0) and not p(None, 2) and not p(float("nan"), 2) and not p(91, 2) and not p(-9999, -9999)
    t = lambda x: spark.range(1).select(R.usable_text(F.lit(x).cast("string"))).first()[0]
    assert t("x") and not t(" TBD ") and not t("??") and not t(None) and not t("")
