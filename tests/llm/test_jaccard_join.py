"""The join against a brute-force version, with limits so low that every path is taken."""

import random
import re

import pytest

from attestor.llm import jaccard_join as J

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    """{doc_id: (size, component)} by comparing all pairs."""
    sets = {d: shingle_set(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {d: (len(sets[d]), root(d)) for d in ids}


def corpus(seed, n=90):
    """Families of near copies, exact copies, a shared passage, short and blank texts."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(30)]
    docs = []
    for _ in range(n):
        kind = r.random()
        if docs and kind < 0.55:
            w = r.choice(docs[-12:])[1].split() or ["a"]
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = r.choice(words)
            docs.append((len(docs), " ".join(w)))
        elif kind < 0.6:
            docs.append((len(docs), r.choice(["", " \n", "one two", "One  two", "a b c d e", "a b c d e f"])))
        else:
            w = [r.choice(words) for _ in range(r.randint(3, 60))]
            if r.random() < 0.5:
                w += passage
            docs.append((len(docs), " ".join(w)))
    return docs


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("SMALL_RUN", 3), ("SMALL_ROUND", 300), ("SMALL_PRODUCT", 1), ("BUCKET", 500), ("COMMON", 20)):
            monkeypatch.setattr(J, name, value)
    docs = corpus(5 + small)
    df = spark.createDataFrame([(d, t, "x", 1, b"y") for d, t in docs], "doc_id long, text string, n string, h int, node binary").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.join(df).collect()}
    assert got == brute(docs)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, "a b c d e f g h"), (7, "a b c d e f g h"), (7, "A b c d e f g h"), (9, "a b c d e f g h"), (3, None), (4, ""), (None, None), (None, "q r s t u"), (5, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.join(df).collect()), key=str)
    assert got == sorted([(None, 4, 7), (7, 4, 7), (7, 4, 7), (9, 4, 7), (3, 0, 3), (4, 0, 4), (None, 0, None), (None, 1, None), (5, 1, 5)], key=str)
    kept = sorted(((r["doc_id"], r["text"]) for r in J.representatives(df).collect()), key=str)
    assert [k for k in kept if k[0] == 7] in ([(7, "a b c d e f g h")], [(7, "A b c d e f g h")])
    assert len(kept) == 6
    twice = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e")], "doc_id long, text string")
    assert [tuple(r) for r in J.representatives(twice).collect()] == [(1, "a b c d e")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert J.join(df).collect() == []
    assert J.representatives(df).collect() == []
