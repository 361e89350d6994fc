import random
from collections import defaultdict

from pyspark.sql import functions as F

from synoptic.llm import groups


def brute(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def test_components_of_chains_stars_and_noise(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 400)] + [(1000, 1001 + i) for i in range(300)] + [(2000 + r.randrange(400), 2000 + r.randrange(400)) for _ in range(250)]
    edges += [(5, 5), (100, 101), (101, 100)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    want = brute([e for e in edges if e[0] != e[1]])
    for rounds in (1, 3):
        assert {x.id: x.group_id for x in groups.components(df, rounds=rounds).collect()} == want


def test_empty(spark):
    assert groups.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_identifiers(spark):
    rows = [" X.1. ", "x.1", "N/A", "none", "--", "", None, "\tUnknown. ", "1998-741B ", "a  b"]
    df = spark.createDataFrame([(x,) for x in rows], "i string").select(groups.clean_identifier(F.col("i")).alias("i"))
    assert [x.i for x in df.collect()] == ["x.1", "x.1", None, None, None, None, None, None, "1998-741b", "a  b"]


def test_records_share_identifiers(spark):
    rows = [(1, "a"), (2, "a"), (2, "b"), (3, "b"), (3, "b"), (4, "c"), (5, None), (None, "a"), (6, "d"), (7, "d")]
    got = groups.groups(spark.createDataFrame(rows, "id bigint, ident string")).collect()
    by = defaultdict(set)
    for x in got:
        by[x.group_id].add(x.id)
    assert dict(by) == {1: {1, 2, 3}, 6: {6, 7}}
