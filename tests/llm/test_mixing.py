import random
from collections import Counter, defaultdict

import pytest

from synoptic.llm import mixing

SHAPE = "doc_id bigint, source string, n_tokens bigint, list_name string"


def test_shares_and_repeats(spark):
    r = random.Random(5)
    docs = [(i, "big" if i % 3 else "hot" if i % 2 else "small", r.choice([1, 5, 40, 300, 9000]), "clash") for i in range(6000)]
    docs += [(9001, "nobody", 50, None), (9002, None, 50, None), (9003, "big", 0, None), (1, "big", docs[1][2], "clash")]
    targets = spark.createDataFrame([("big", 0.5, 1), ("hot", 0.2, 2), ("small", 0.2, 3), ("absent", 0.1, 4), ("null", None, 1)], "list_name string, weight double, max_repeat int")
    mixed = mixing.mix(spark.createDataFrame(docs, SHAPE), "doc_id", "source", "n_tokens", targets)
    rows = mixed.collect()
    used = Counter(x.doc_id for x in rows)
    most = {"big": 1, "hot": 2, "small": 3}
    source = {d[0]: d[1] for d in docs}
    assert all(n <= most[source[d]] for d, n in used.items())
    assert len({(x.doc_id, x.repeat) for x in rows}) == len(rows) == len({x.position for x in rows})
    sums = defaultdict(int)
    for x in rows:
        sums[x.list_name] += x.n_tokens
    whole = sum(sums.values())
    for name, w in (("big", 0.5), ("hot", 0.2), ("small", 0.2)):
        assert sums[name] / whole == pytest.approx(w / 0.9, abs=0.02)
    # As much as the scarcest source allows.
    have = defaultdict(int)
    for d in {d[0]: d for d in docs}.values():
        have[d[1]] += d[2]
    assert whole == pytest.approx(min(m * have[s] / (w / 0.9) for (s, m), w in zip(most.items(), (0.5, 0.2, 0.2), strict=True)), rel=0.03)
    report = {x.list_name: x for x in mixing.shares(mixed, targets).collect()}
    assert report["absent"].actual_share == 0 and report["big"].n_tokens == sums["big"]
    # Any part of the schedule has nearly the shares.
    early = [x for x in rows if x.position < whole / 2]
    assert sum(x.n_tokens for x in early if x.list_name == "big") / sum(x.n_tokens for x in early) == pytest.approx(0.5 / 0.9, abs=0.04)


def test_empty(spark):
    targets = spark.createDataFrame([("a", 1.0, 1)], "list_name string, weight double, max_repeat int")
    assert mixing.mix(spark.createDataFrame([], SHAPE), "doc_id", "source", "n_tokens", targets).count() == 0
    docs = spark.createDataFrame([(1, "a", 7, None)], SHAPE)
    assert [(x.doc_id, x.repeat) for x in mixing.mix(docs, "doc_id", "source", "n_tokens", targets).collect()] == [(1, 1)]
    assert mixing.mix(docs, "doc_id", "source", "n_tokens", targets.limit(0)).count() == 0


def test_a_stated_size(spark):
    docs = spark.createDataFrame([(i, "a" if i % 2 else "b", 100, None) for i in range(4000)], SHAPE)
    targets = spark.createDataFrame([("a", 0.75, 1), ("b", 0.25, 1)], "list_name string, weight double, max_repeat int")
    mixed = mixing.mix(docs, "doc_id", "source", "n_tokens", targets, size=100_000)
    sums = {r["list_name"]: r["n"] for r in mixed.groupBy("list_name").agg({"n_tokens": "sum"}).toDF("list_name", "n").collect()}
    assert sum(sums.values()) == pytest.approx(100_000, rel=0.02) and sums["a"] / sum(sums.values()) == pytest.approx(0.75, abs=0.02)
