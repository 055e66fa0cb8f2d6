"""Names inside texts against a search for each name, with few and with many names, and plans without a shuffle of texts."""

import random

import pytest
from pyspark.sql import functions as F

from attestor.operators import gazetteer, names


@pytest.mark.parametrize("held", [10**6, 3], ids=["automaton", "join"])
@pytest.mark.parametrize("least", [1, 2])
def test_equal_to_a_search_for_each(spark, monkeypatch, held, least):
    monkeypatch.setattr(names, "HELD", held)
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("甲乙丙a\U00020000") for _ in range(n))
    texts = [(rng.randrange(3), word(rng.randrange(12))) for _ in range(120)] + [(None, "甲乙"), (1, None), (1, ""), (2, "甲" * 3000)]
    known = [(rng.randrange(3), word(rng.randrange(5))) for _ in range(40)] + [(None, "甲"), (0, None), (0, ""), (2, "甲甲")]
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "i int, s int, t string")
    keys = spark.createDataFrame(known, "s int, k string")
    found = df.select("i", "s", F.explode(names.names_in(df, "t", keys, "k", ("s",), least)).alias("k"))
    got = sorted(map(tuple, found.join(keys.distinct(), ["s", "k"]).select("i", "k").collect()))
    assert got == sorted((i, k) for i, (s, t) in enumerate(texts) for k in {k for x, k in known if x == s and x is not None} if t and k and len(k) >= least and k in t)


@pytest.mark.parametrize("held", [10**6, 0], ids=["automaton", "join"])
def test_longest_contained(spark, monkeypatch, held):
    monkeypatch.setattr(names, "HELD", held)
    queries = spark.createDataFrame([(1, "a long text"), (2, "long"), (3, ""), (4, None), (2, "long"), (5, "xyz")], "i int, t string")
    keys = spark.createDataFrame([("long", 3), ("text", 1), ("long text", 7), ("", 0), ("ong", 2)], "k string, o int")
    got = sorted((r["i"], r["k"]) for r in gazetteer.longest_contained(queries, keys, "t", "k", "o").collect())
    assert got == [(1, "long text"), (2, "long")]


def test_one_map_pass(spark):
    df = spark.createDataFrame([("s", "text")], "s string, t string")
    out = df.withColumn("n", names.names_in(df, "t", spark.createDataFrame([("s", "ex")], "s string, k string"), "k", ("s",)))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.first()["n"] == ["ex"]
