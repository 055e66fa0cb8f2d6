"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are hashed character n-grams (3 to 5 code points, letters folded to lower case, white space
as a blank, row ends as blanks), each counted once a document.  A ratio r = log of its smoothed share
among toxic over clean documents scales each feature; a logistic regression is then fitted to the
scaled features that depend on the label.  Scoring adds the weights of the features that occur anywhere
in the whole text, however long it is.

Nulls and empty texts have no feature and score as the intercept does.  Without labelled rows of
both classes (an empty table, say) the score is 0 everywhere.  Repeated rows score alike; of rows with
one id one is learned, and an id with both labels counts as toxic.  A kept column named ``score`` gives
way to the result's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.llm.common import Scratch, by_bytes, map_arrow, mix64, text_bytes, with_text

#: Bound of the training sample: documents of each class.
SAMPLE = 1024
ORDERS, BITS = (3, 4, 5), 18
#: Least chi-square of a feature with the label (a chance of about one in a thousand), and the fewest documents it is in.
LEAST_CHI, LEAST = 10.8, 4

_FOLD = np.array([ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(map(chr, range(1 << 16)))], np.uint32)
_FOLD[[9, 10, 11, 12, 13]] = 0x20


def grams(raw: np.ndarray, bounds: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature number of the n-gram at each place, and the places' bounds by row.

    The code points are expected folded, each row between two blanks.
    """
    m = max(len(raw) - order + 1, 0)
    h = np.full(m, order, np.uint64)
    raw = raw.astype(np.uint64)
    for j in range(order):
        h *= np.uint64(0x100000001B3)
        h ^= raw[j : j + m]
    return (mix64(h) >> np.uint64(64 - BITS)).astype(np.uint32), np.minimum(np.maximum(bounds, 0), m)


def padded(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points with a blank before and after each row, and the rows' bounds in them."""
    n = len(bounds) - 1
    codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le", "surrogatepass"), "<u4")
    bounds = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[bounds]
    out = np.full(len(codes) + 2 * n, 0x20, np.uint32)
    where = np.arange(len(codes)) + np.repeat(2 * np.arange(n) + 1, np.diff(bounds))
    out[where] = np.where(codes < len(_FOLD), _FOLD[np.minimum(codes, len(_FOLD) - 1)], codes)
    return out, bounds + 2 * np.arange(n + 1)


def present(raw: np.ndarray, bounds: np.ndarray, useful: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs, each once; only ``useful`` features if a mask is given."""
    keys = []
    rows = np.arange(len(bounds) - 1)
    data, at = padded(raw, bounds)
    for order in ORDERS:
        f, _ = grams(data, at, order)
        place = np.flatnonzero(useful[f]) if useful is not None else np.arange(len(f))
        row = np.searchsorted(at, place, "right") - 1
        inside = place + order <= at[row + 1]
        keys.append((row[inside].astype(np.int64) << BITS) | f[place[inside]])
    key = np.unique(np.concatenate(keys)) if len(rows) else np.zeros(0, np.int64)
    return key >> BITS, (key & ((1 << BITS) - 1)).astype(np.int64)


@dataclass
class Model:
    """Weights by feature number, and the intercept; ``weights`` is None where nothing was learned."""

    weights: np.ndarray | None
    intercept: float

    def score(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n = len(bounds) - 1
        if self.weights is None:
            return np.zeros(n)
        row, feature = present(raw, bounds, self.weights != 0)
        return 1 / (1 + np.exp(-np.clip(self.intercept + np.bincount(row, self.weights[feature], n), -30, 30)))


def fit(rows: list[tuple[np.ndarray, int]], ratio: np.ndarray, rounds: int = 300, l2: float = 2e-3) -> Model:
    """Logistic regression from (feature numbers, label) pairs on features scaled by their ratios (0: unused)."""
    y = np.array([label for _, label in rows], float)
    if not len(y) or y.min() == y.max():
        return Model(None, 0.0)
    best = np.flatnonzero(ratio)
    place = np.full(len(ratio), -1)
    place[best] = np.arange(len(best))
    kept = [p[p >= 0] for p in (place[f] for f, _ in rows)]
    docs, cols = np.repeat(np.arange(len(rows)), [len(k) for k in kept]), np.concatenate(kept)
    x = ratio[best][cols]
    w, b = np.zeros(len(best)), 0.0
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.bincount(docs, x * w[cols], len(y)) + b
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        gw, gb = np.bincount(cols, x * g[docs], len(best)) + l2 * w, g.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw**2, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        c, d = 1 - 0.9**t, 1 - 0.999**t
        w -= 0.02 * (m / c) / (np.sqrt(v / d) + 1e-8)
        b -= 0.02 * (mb / c) / (np.sqrt(vb / d) + 1e-8)
    weights = np.zeros(len(ratio))
    weights[best] = np.where(np.abs(w * ratio[best]) > 1e-3, w * ratio[best], 0)
    return Model(weights, b)


def learn(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE, alpha: float = 1.0) -> Model:
    """Fit on at most ``sample`` labelled documents of each class.

    Labelled ids are dealt to ``sample`` buckets by hash and the smallest hash of each bucket and
    class is taken, so that the sample depends on ids alone.  Features are counted in Spark; only the
    numbers of those that depend on the label, document by document, and no text, reach the driver.
    """
    h = F.xxhash64(F.col(doc_id))
    picked = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1))
    if allowed is not None:
        picked = picked.where(allowed)
    chosen = picked.groupBy(F.col(label).cast("int").alias("y"), F.pmod(h, F.lit(sample)).alias("bucket")).agg(F.min_by(doc_id, h).alias("id")).collect()
    of = {}
    for r in chosen:
        of[r["id"]] = max(r["y"], of.get(r["id"], 0))
    if not of:
        return Model(None, 0.0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = text_bytes(batch.column(1))
            for i in range(batch.num_rows):
                part = raw[bounds[i] : bounds[i + 1]]
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([one.column(0), pa.array([of[one.column(0)[0].as_py()]], pa.int32()), pa.array([present(part, np.array([0, len(part)]))[1]], pa.list_(pa.int64()))], ["id", "y", "features"])

    kind = docs.schema[doc_id].dataType.simpleString()
    scratch = Scratch(docs.sparkSession)
    rows = map_arrow(docs.where(F.col(doc_id).isin(list(of))).select(F.col(doc_id).alias("id"), F.col(text).alias("text")), work, f"id {kind}, y int, features array<bigint>")
    rows = scratch.save(rows.groupBy("id").agg(F.first("y").alias("y"), F.min("features").alias("features")), "features")
    n1, n = (int(x or 0) for x in rows.agg(F.sum("y"), F.count("*")).first())
    n0 = n - n1
    ratio = np.zeros(1 << BITS)
    if n0 and n1:
        held = rows.select("y", F.explode("features").alias("f")).groupBy("f").agg(F.sum("y").alias("toxic"), F.count("*").alias("c")).where(F.col("c") >= LEAST)
        share, apart = F.col("c") / n, F.col("toxic") / n1 - (F.col("c") - F.col("toxic")) / n0
        chi = apart * apart / F.greatest(share * (1 - share), F.lit(1e-9)) * (n1 * n0 / n)
        for r in held.where(chi >= LEAST_CHI).collect():
            ratio[r["f"]] = np.log((r["toxic"] + alpha) / (n1 + 2 * alpha)) - np.log((r["c"] - r["toxic"] + alpha) / (n0 + 2 * alpha))
    useful = F.broadcast(docs.sparkSession.createDataFrame([(int(f),) for f in np.flatnonzero(ratio)], "f bigint"))
    seen = rows.select("id", F.explode("features").alias("f")).join(useful, "f").groupBy("id").agg(F.array_sort(F.collect_list("f")).alias("f"))
    used = rows.select("id", "y").join(seen, "id", "left").select("id", "y", "f").collect()
    scratch.drop("features")
    return fit([(np.array(r["f"] or [], np.int64), r["y"]) for r in sorted(used, key=lambda r: r["id"])], ratio)


def score(df: DataFrame, model: Model, keep: tuple[str | Column, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns with ``score`` (0 to 1, higher for toxic)."""
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.intercept))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch in batches:
            raw, bounds = text_bytes(batch.column(0))
            parts = [m.score(raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]) for a, b in by_bytes(bounds, 1 << 20)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(np.concatenate([np.zeros(0), *parts]))], [*names, "score"])

    inner = with_text(df, text, keep, "score")
    names = inner.columns[1:]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields[1:])
    return map_arrow(inner, work, f"{schema}, score double")
