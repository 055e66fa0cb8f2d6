"""Exact similarity join on the ratio of matching blocks (2 * matched / (|a| + |b|)), without comparing all pairs.

A ratio of t needs a(t) = ceil(t * (|a| + |b|) / 2) characters that both texts have, counted with
repeats.  Each text becomes a set of tokens (character, which occurrence of it), in one order for all texts, rare
characters first.  Two texts that share a tokens share one of their first |x| - a + 1, and two of
their first |x| - a + 2.

1. Index: every text gives pairs of its first tokens as keys; single tokens only where a partner may need
   one common character alone, or more than ``PAIRED`` (texts so long that pairs would be many).
2. Candidates meet on a key if their lengths allow the ratio and enough tokens follow the common ones.
3. Of the distinct candidates those that share fewer than a tokens are dropped.
4. What is left is compared in full.

Every pair that reaches t passes 2 and 3, so the result equals that of comparing all pairs.  The order only
decides the work: counts of up to ``KNOWN`` characters go to the workers, others count as rare.
"""

from __future__ import annotations

import difflib
import math
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from attestor.session import cut

#: Common characters up to which pairs of tokens are keys; characters whose counts every worker knows.
PAIRED, KNOWN = 48, 1 << 16
#: Below this ratio nearly all pairs are candidates, and an index only adds to their work.
WORTH_INDEXING = 0.4
_EPSILON = 1e-9
#: Texts whose index entries a worker holds at a time; a text may have thousands.
PIECE = 200

# Kinds of keys: the common characters that a pair of texts needs are one, 2 to PAIRED, or more.
_ONE, _PAIR, _MANY = "1", "2", "m"


def needed(total: int, least: float) -> int:
    """Characters that two texts of this total length must share for the ratio, one at least."""
    return max(1, math.ceil(least * total / 2 - _EPSILON))


def tokens(text: str, counts: dict[str, int]) -> list[str]:
    """The text's characters, each with the number of its occurrence, rare ones first."""
    seen: Counter[str] = Counter()
    out = []
    for c in text:
        seen[c] += 1
        out.append((counts.get(c, 0) / seen[c], c, seen[c]))
    return [f"{c}{k}" for _, c, k in sorted(out)]


def keys(text: str, counts: dict[str, int], least: float) -> Iterator[tuple[str, int]]:
    """(key, position of its last token) of a text's index entries."""
    t, n = tokens(text, counts), len(text)
    shortest = max(1, math.ceil(n * least / (2 - least) - _EPSILON))
    longest = math.floor(n * (2 - least) / least + _EPSILON)
    low, high = needed(n + shortest, least), needed(n + longest, least)
    if low == 1:
        yield from ((_ONE + x, i) for i, x in enumerate(t))
    if low <= PAIRED and high >= 2:
        prefix = t[: n - max(low, 2) + 2]
        yield from ((_PAIR + a + b, j) for j, b in enumerate(prefix) for a in prefix[:j])
    if high > PAIRED:
        yield from ((_MANY + x, i) for i, x in enumerate(t[: n - max(low, PAIRED + 1) + 1]))


def shared(a: str, b: str) -> int:
    """Characters that both texts have, with repeats."""
    return (Counter(a) & Counter(b)).total()


def character_counts(texts: DataFrame) -> dict[str, int]:
    """Of a column ``text``: how often the most frequent characters occur, ``KNOWN`` of them at most."""
    n = texts.select(F.explode(F.split("text", "")).alias("c")).where("c <> ''").groupBy("c").count()
    return {r["c"]: r["count"] for r in n.orderBy(F.desc("count"), "c").limit(KNOWN).collect()}


def similar_pairs(
    queries: DataFrame, known: DataFrame, least: float, scope: tuple[str, ...] = (),
    ratio: Callable[[str, str], float] | None = None, observe: Observation | None = None, counts: dict[str, int] | None = None,
) -> DataFrame:
    """(scope, query, key, ratio) of all pairs of distinct texts that reach the ratio.

    ``queries`` is (scope, query) and ``known`` (scope, key); texts of different scopes, null scopes and empty texts never
    meet.  ``ratio`` compares a query with a key (by default the gestalt ratio, the key first), at most at
    twice their common characters by their length.  ``observe`` gets the numbers of candidates and of full comparisons;
    ``counts`` of characters are those of both sides unless given.
    """
    if not 0 < least <= 1:
        raise ValueError("the ratio must be above 0 and at most 1")
    compare = ratio or (lambda query, key: difflib.SequenceMatcher(None, key, query).ratio())
    asked = queries.select(*scope, F.col("query").alias("text")).where("text <> ''").distinct()
    held = known.select(*scope, F.col("key").alias("text")).where("text <> ''").distinct()
    counts = counts if counts is not None else character_counts(asked.select("text").unionByName(held.select("text")))

    if scope:  # texts whose scope has no keys need no entries
        asked = asked.join(held.select(*scope).distinct(), list(scope), "left_semi")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                piece = pa.Table.from_batches([batch.slice(at, PIECE)])
                found = [list(keys(t, counts, least)) for t in piece.column("text").to_pylist()]
                out = piece.take(pa.array([i for i, e in enumerate(found) for _ in e], pa.int64()))
                out = out.append_column("e_key", pa.array([k for e in found for k, _ in e], pa.string())).append_column("e_at", pa.array([i for e in found for _, i in e], pa.int32()))
                yield from out.combine_chunks().to_batches()

    def side(texts: DataFrame, name: str) -> DataFrame:
        texts = texts.select(*scope, "text")
        rows = texts.mapInArrow(entries, StructType([*texts.schema.fields, StructField("e_key", StringType()), StructField("e_at", IntegerType())]))
        return rows.select(*scope, F.col("text").alias(name), F.length("text").alias(f"n_{name}"), F.substr("e_key", F.lit(1), F.lit(1)).alias("kind"), F.xxhash64("e_key").alias("hash"), F.col("e_at").alias(f"at_{name}"))

    n, m = F.col("n_query"), F.col("n_key")
    need = F.greatest(F.lit(1), F.ceil(F.lit(least) * (n + m) / 2 - _EPSILON))
    kind = F.when(need == 1, _ONE).when(need <= PAIRED, _PAIR).otherwise(_MANY)
    of_key = F.when(F.col("kind") == _PAIR, 2).otherwise(1)
    room = F.least(n - F.col("at_query"), m - F.col("at_key")) - 1
    fits = (need <= F.least(n, m)) & (F.col("kind") == kind) & (of_key + room >= need)
    pairs = side(asked, "query").join(side(held, "key"), [*scope, "kind", "hash"]).where(fits).select(*scope, "query", "key").distinct()

    def compared(query: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series([compare(q, k) if shared(q, k) >= needed(len(q) + len(k), least) else None for q, k in zip(query, key, strict=True)], dtype="float64")

    rated = pairs.withColumn("ratio", F.pandas_udf(compared, "double")("query", "key"))
    if observe is not None:
        rated = rated.observe(observe, F.count("*").alias("candidates"), F.count("ratio").alias("compared"))
    return rated.where(F.col("ratio") >= F.lit(math.nextafter(least, 0.0)))


#: Ratios at which the best key is looked for, one after the other, down to the one asked for.
LADDER = (0.96, 0.92, 0.88, 0.84, 0.8, 0.7, 0.6, 0.5)


def most_similar(
    queries: DataFrame, known: DataFrame, order: str, least: float, scope: tuple[str, ...] = (),
    ratio: Callable[[str, str], float] | None = None, observed: list[Observation] | None = None,
) -> DataFrame:
    """(scope, query, ratio, the other columns of ``known``): the best key of every query, the first in order of equals.

    Queries that are keys themselves take those by an equi-join, as only equal texts have the gestalt ratio 1.  Then come
    steps of falling ratios: a query with a key at or above a step has its best key among the pairs that reach it, and
    leaves.  So a query whose best key is close never meets the many that are only just similar enough.
    """
    asked = queries.select(*scope, "query").where("query <> ''").distinct()
    rest = [c for c in known.columns if c not in (*scope, "key")]
    first = known.where("key <> ''").groupBy(*scope, "key").agg(F.min_by(F.struct(*rest), order).alias("first"))
    steps = [x for x in LADDER if x > least + 0.02] + [least]
    found, keyed = None, [*scope, "query"]
    if ratio is None:
        found = cut(asked.join(first.withColumnRenamed("key", "query"), keyed).select(*keyed, F.struct(F.lit(1.0).alias("ratio"), "first").alias("b")))
        asked = cut(asked.join(found.select(*keyed), keyed, "left_anti"))
        if asked.isEmpty():
            steps = []
    counts = character_counts(first.select(F.col("key").alias("text"))) if steps else {}
    for step in steps:
        note = Observation() if observed is not None else None
        pairs = similar_pairs(asked, first, step, scope, ratio, note, counts).join(first, [*scope, "key"])
        best = F.max_by(F.struct("ratio", "first"), F.struct("ratio", (-F.col(f"first.{order}")).alias("o"))).alias("b")
        now = cut(pairs.groupBy(*scope, "query").agg(best))
        if note is not None:
            observed.append(note)
        found = now if found is None else found.unionByName(now)
        if step != least:
            asked = cut(asked.join(now.select(*keyed), keyed, "left_anti"))
            if asked.isEmpty():
                break
    return found.select(*scope, "query", "b.ratio", "b.first.*")
