"""The similarity index against all pairs, its best keys against one pass, and the growth of what it compares."""

import difflib
import os
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from attestor.operators import similarity


def ratio(query, key):
    return difflib.SequenceMatcher(None, key, query).ratio()


def words(rng, letters, low, high, n):
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(low, high))) for _ in range(n)]


CJK = "新星華國際人力資源仲介有限公司股份顧問甲乙丙丁戊己庚辛\U00020000"


@pytest.mark.parametrize(
    ("least", "letters", "low", "high"),
    [(0.78, CJK, 0, 14), (0.5, "abcde", 0, 6), (0.6, CJK, 1, 5), (0.9, "abc", 0, 30), (0.72, "ab", 30, 140), (0.4, CJK, 0, 8), (1.0, "ab", 0, 6), (0.05, "abc", 0, 5)],
)
def test_equal_to_all_pairs(spark, least, letters, low, high):
    rng = random.Random(f"{least}{letters}")
    asked = words(rng, letters, low, high, 70)
    known = words(rng, letters, low, high, 70) + [x[: len(x) // 2] + rng.choice(letters) + x[len(x) // 2 + 1 :] for x in asked[:30]]
    want = {(a, b): r for a in set(asked) for b in set(known) if a and b and (r := ratio(a, b)) >= least - 1e-15}
    note = Observation()
    pairs = similarity.similar_pairs(spark.createDataFrame([(x,) for x in asked] + [(None,)], "query string"), spark.createDataFrame([(x,) for x in known] + [(None,)], "key string"), least, observe=note)
    assert {(r["query"], r["key"]): r["ratio"] for r in pairs.collect()} == want
    assert len(want) <= note.get["compared"] <= note.get["candidates"] <= len(set(asked)) * len(set(known))


def test_scopes_and_order(spark):
    asked = spark.createDataFrame([(1, "abcde"), (2, "abcde"), (None, "abcde"), (1, "vwxyz")], "s int, query string")
    known = spark.createDataFrame([(1, "abcdx", 5), (1, "xbcde", 3), (1, "xbcde", 9), (2, "zzzzz", 1), (None, "abcde", 1)], "s int, key string, pos int")
    got = similarity.similar_pairs(asked, known, 0.7, ("s",)).collect()
    assert sorted((r["s"], r["query"], r["key"]) for r in got) == [(1, "abcde", "abcdx"), (1, "abcde", "xbcde")]
    best = similarity.most_similar(asked, known, "pos", 0.7, ("s",)).collect()
    assert [(r["s"], r["query"], r["pos"], r["ratio"]) for r in best] == [(1, "abcde", 3, 0.8)]
    lopsided = lambda q, k: 2 * len(set(q) & set(k)) / (len(q) + len(k)) if q[0] == "a" else 0.0
    assert similarity.similar_pairs(asked, known, 0.7, ("s",), lopsided).count() == 2


def registry_of(rng, n):
    places = "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉戌亥乾坤離仁義禮智信忠孝和平東南西北中山水火土金木花草春夏秋冬"
    return ["".join(rng.choice(places) for _ in range(rng.randrange(3, 6))) + rng.choice(["人力資源有限公司", "人力仲介有限公司", "國際人力資源管理顧問有限公司"]) for _ in range(n)]


def test_best_keys_and_growth(spark):
    """Names that share most of their letters: the best keys are exact, and comparisons stay far below all pairs."""
    rng = random.Random(2)
    compared = {}
    for n in (300, 3000):
        known = registry_of(rng, n)
        asked = [x[1:] if rng.random() < 0.3 else x[:1] + rng.choice("甲東木") + x[2:] for x in rng.sample(known, n // 3)]
        notes = []
        best = similarity.most_similar(spark.createDataFrame([(x,) for x in asked], "query string"), spark.createDataFrame(list(zip(known, range(n), strict=True)), "key string, pos long"), "pos", 0.78, observed=notes).collect()
        compared[n] = sum(o.get["compared"] for o in notes)
        if n == 300:
            want = {x: max(((r, -i) for i, y in enumerate(known) if (r := ratio(x, y)) >= 0.78), default=None) for x in asked}
            assert {r["query"]: (r["ratio"], -r["pos"]) for r in best} == {x: w for x, w in want.items() if w}
        else:
            assert len(best) == len(set(asked))
    assert compared[3000] < 3000 * 1000 / 50
    assert compared[3000] < 30 * compared[300]


def test_empty_sides(spark):
    some, none = spark.createDataFrame([("abcd",)], "query string"), spark.createDataFrame([], "key string, pos long")
    assert similarity.most_similar(some, none, "pos", 0.8).collect() == []
    assert similarity.most_similar(some.limit(0), spark.createDataFrame([("abcd", 1)], "key string, pos long"), "pos", 0.8).collect() == []
    with pytest.raises(ValueError, match="above 0"):
        similarity.similar_pairs(some, none, 0.0)
    assert similarity.most_similar(some.select(F.upper("query").alias("query")), spark.createDataFrame([("ABCD", 1)], "key string, pos long"), "pos", 0.8).first()["ratio"] == 1.0


def test_registered_query(spark):
    """The query's rows by comparing every name with every agency."""
    from attestor.operators.registry import NAME_MIN
    from attestor.plans import catalogue

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no driver tables")
    got = {(r["query"], r["pos"], r["ratio"]) for r in catalogue.queries()["similar_agencies"](spark, sf).collect()}
    known = [(r["s_suppkey"], r["n"]) for r in spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", catalogue._agency_name(F.col("s_suppkey")).alias("n")).collect()]
    names = {r["c_custkey"]: r["n"] for r in spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", catalogue._agency_name(F.col("c_custkey")).alias("n")).collect()}
    asked = {n[1:] if k % 3 == 0 else n[:2] + "大" + n[3:] if k % 3 == 1 else n for k, n in names.items()}
    want = set()
    for q in asked:
        best = max((ratio(q, n), -pos) for pos, n in known)
        if best[0] >= NAME_MIN:
            want.add((q, -best[1], round(best[0], 3)))
    assert got == want
    assert len(want) > 5


def test_equal_texts_meet_in_a_join(spark):
    """Queries that are keys themselves never reach the index, where alike numbers would all be candidates."""
    names = [f"SUPPLIER{i:09d}" for i in range(2000)]
    asked = spark.createDataFrame([(x,) for x in names] + [(None,)], "query string")
    known = spark.createDataFrame([(x, i) for i, x in enumerate(names)] + [(x, i + 5000) for i, x in enumerate(names)] + [(None, 9)], "key string, pos int")
    observed = []
    best = similarity.most_similar(asked, known, "pos", 0.78, observed=observed).collect()
    assert sorted((r["query"], r["pos"], r["ratio"]) for r in best) == [(x, i, 1.0) for i, x in enumerate(names)]
    assert observed == []


def test_texts_of_scopes_without_keys_get_no_entries(spark, monkeypatch):
    """A scope without keys costs nothing, and entries are handed on in pieces."""
    monkeypatch.setattr(similarity, "PIECE", 3)
    asked = spark.createDataFrame([(i % 2, f"abcde{i}") for i in range(40)], "s int, query string")
    known = spark.createDataFrame([(1, "abcde1", 1)], "s int, key string, pos int")
    original = similarity.keys
    counter = spark.sparkContext.accumulator(0)

    def counted(text, counts, least):
        counter.add(1)
        return original(text, counts, least)

    monkeypatch.setattr(similarity, "keys", counted)
    made = similarity.similar_pairs(asked, known, 0.8, ("s",)).collect()
    assert counter.value == 20 + 1
    assert {r["s"] for r in made} == {1} and ("abcde1", "abcde1", 1.0) in {(r["query"], r["key"], r["ratio"]) for r in made}
    assert len(made) == len({r["query"] for r in made}) == sum(ratio(f"abcde{i}", "abcde1") >= 0.8 for i in range(1, 40, 2))
