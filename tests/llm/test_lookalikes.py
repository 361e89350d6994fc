import math
import unicodedata

from synoptic.llm import lookalikes as A

NAMES = ["Solar Tower", "Sоlаr Тower", "Ｓｏｌａｒ　Ｔｏｗｅｒ", "Solar Tower ", "So‍lar To͏wer", "Solar Tower²", "solar tower", "S0lar Tower", "Solar-Tower", "Solar‐Tower", "SolarTower", "Обсерватория", "Oбcepвaтopия", "Télescope", "Télescope", "Tеlescope", "Τηλεσκόπιο", "Tηλεσκόπιo", "ガガ", "ｶﾞｶﾞ", "", " ​", None]


def test_forms(spark):
    df = spark.createDataFrame([(i, n, n[::-1] if n else None, "x") for i, n in enumerate(NAMES)] + [(0, NAMES[0], NAMES[0][::-1], "y")], "id bigint, label string, alt string, value string")
    forms = A.normalized(df, "id", ["label", "alt"])
    by = {x.key: x.form for x in forms.where("field = 'label'").collect()}
    assert len({by[i] for i in range(5)}) == 1 and by[0] == "Solar Tower"
    assert len({by[i] for i in (0, 5, 6, 7, 8, 10)}) == 6 and by[8] == by[9]
    assert by[11] == by[12] == "Обсерватория" and by[13] == by[14] and by[15] != by[13] and by[15] == "Telescope"
    assert by[16] == by[17] == unicodedata.normalize("NFC", "Τηλεσκόπιο") and by[18] == by[19] and by[20] == by[21] == "" and 22 not in by
    pairs = {(x.a, x.b) for x in A.look_alikes(forms.where("field = 'label'")).collect()}
    assert {(0, 1), (0, 4), (8, 9), (11, 12), (13, 14), (16, 17), (18, 19)} <= pairs and (20, 21) not in pairs and (0, 5) not in pairs
    assert A.normalized(df.limit(0), "id", ["label"]).count() == 0


def test_equal_shapes_have_equal_readings():
    score, floor = {("Latin", "^c"): -0.1, ("Cyrillic", "^с"): -0.1, ("Latin", "co"): -0.2}, -9.0
    words = ["coco", "сосо", "cосo", "cοco"]
    assert len({A.read_token(w, score, floor) for w in words}) == 1
    assert A.read_token("x" * 30000, score, floor) == A.read_token("х" * 30000, score, floor)
    assert A.read_token("пoлe", {("Cyrillic", p): -0.1 for p in ("^п", "по", "ол", "ле")}, floor) == "поле"


def test_scores(spark):
    pairs = spark.createDataFrame([("Latin", "ab", 3), ("Latin", "ac", 1), ("Latin", "ba", 4)], A.COUNTS)
    got = {r["pair"]: r["score"] for r in A.scores(pairs).collect()}
    assert got == {"ab": math.log(3 / 5), "ac": math.log(1 / 5), "ba": math.log(4 / 5)}


def test_readings_beyond_the_bound_are_the_same(spark, monkeypatch):
    df = spark.createDataFrame([(n,) for n in [*NAMES, "Mоunt", "mοunt", "Ηill", "Нill", "Ӏnn", "Inn"]], "value string")
    want = sorted(map(tuple, A.one_form(df).collect()))
    monkeypatch.setattr(A, "MOST_BIGRAMS", 0)
    assert sorted(map(tuple, A.one_form(df).collect())) == want and len(want) == len({n for n in NAMES if n is not None}) + 6


def test_compatibility_forms():
    assert A.tidy("ﬁne Ⅳ … Ⅻ") == "fine IV ... XII" and A.tidy("x² ①") == "x² ①"


def test_members_say_the_same_as_pairs(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([*NAMES, *NAMES[:3]])], "id bigint, label string")
    forms = A.normalized(df, "id", ["label"])
    rows = A.members(forms).collect()
    pairs = {(x.key, y.key) for x in rows for y in rows if x.key < y.key and x["class"] == y["class"] and x.variant != y.variant}
    assert pairs == {(x.a, x.b) for x in A.look_alikes(forms).collect()} and len(rows) == sum(bool(n and n.strip(" \u200b")) for n in [*NAMES, *NAMES[:3]])


def test_shapes_are_no_ambiguous_classes():
    letters = [c for c in {shape for shape in A.LATTICE.values()} for c in c]
    assert len(letters) == len(set(letters)) < 250
