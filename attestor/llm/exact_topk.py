"""Exact top-k inner-product search by pivot-table elimination.

Every vector is stored with its distances to ``PIVOTS`` pivots.  For a query, the largest difference
of pivot distances is a lower bound of its distance to a candidate, and so bounds the inner product
from above: (|q|^2 + |x|^2 - bound^2) / 2.  Candidates are evaluated in the order of that bound until
it falls below the k-th score found, which is exact; ties go to the smaller id, so equality goes on.

Vectors are cut to integers floor(scale * x).  Null vectors and those with a null or non-finite
component take no part; only vectors of equal length are compared.  Every row is its own: rows with
the same id are all queries and candidates, only a query's own row is left out, and a row without an
id is a candidate whose id counts as the largest.  Long vectors are taken whole; an empty table
gives no rows; other columns play no part.  Pivots come from a bounded sample; all rows are indexed.
Queries meet all rows in blocks: each block of candidates with each block of queries.  Queries are copied to
a bounded number of groups of candidates and meet them in a sort-merge join, never in a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestor.llm.common import Scratch, map_arrow

#: Pivots, rows of the sample that they and the first thresholds are taken from, rows of a block.
PIVOTS, SAMPLE, BLOCK, QUERY_BLOCK = 32, 2048, 2048, 512
#: Pivots that all pairs are held against; the others only see what these leave.
FIRST = 8
#: Groups of candidates that every query goes to, at most.
GROUPS = 256
#: Stands for a null id.
NO_ID = (1 << 63) - 1


def integers(df: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(row, id, v, d): whole-number vectors that take part, with a number for each row."""
    x = F.col(embedding)
    ok = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")))
    return df.where(ok).select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(vec_id).cast("long"), F.lit(NO_ID)).alias("id"), v.alias("v"), F.size(x).alias("d"))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first traversal from the sample's first row."""
    picked = [0]
    far = np.linalg.norm(sample - sample[0], axis=1)
    while len(picked) < min(n, len(sample)):
        picked.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(sample - sample[picked[-1]], axis=1))
    return sample[picked]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.linalg.norm(x - p, axis=1) for p in pivots], 1)


def scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of x with q."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(len(q), 1)
    if most < 2**53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return x.astype(np.int64) @ q.astype(np.int64)


def search_block(q: np.ndarray, q_rows: np.ndarray, q_dist: np.ndarray, floor: np.ndarray, x: np.ndarray, x_rows: np.ndarray, x_ids: np.ndarray, x_dist: np.ndarray, k: int) -> tuple[list[tuple[int, int, int]], int]:
    """The up to k best (place of the query, id, score) of a block for each query, and how many were evaluated.

    ``floor`` is a score that k other rows are known to reach (or -inf).
    """
    out: list[tuple[int, int, int]] = []
    evaluated = 0
    xf, qf = x.astype(np.float64), q.astype(np.float64)
    x2 = (xf * xf).sum(1)
    for a in range(0, len(q), 64):
        part = qf[a : a + 64]
        bound = np.zeros((len(part), len(x)))
        for p in range(min(FIRST, x_dist.shape[1])):
            np.maximum(bound, np.abs(q_dist[a : a + 64, p, None] - x_dist[None, :, p]), out=bound)
        q2 = (part * part).sum(1)
        total = q2[:, None] + x2[None, :]
        total += 1e-9 * total + 1e-6
        first = (total - bound * bound) / 2
        for i in range(len(part)):
            alive = np.flatnonzero((first[i] >= floor[a + i]) & (x_rows != q_rows[a + i]))
            if x_dist.shape[1] > FIRST and len(alive):
                rest = np.abs(x_dist[alive, FIRST:] - q_dist[a + i, FIRST:]).max(1)
                u = np.minimum(first[i, alive], (total[i, alive] - rest * rest) / 2)
                alive, u = alive[u >= floor[a + i]], u[u >= floor[a + i]]
            else:
                u = first[i, alive]
            order = np.argsort(-u, kind="stable")
            alive, u = alive[order], u[order]
            best_s, best_i = np.zeros(0, np.int64), np.zeros(0, np.int64)
            at, step = 0, 64
            while at < len(alive):
                limit = max(floor[a + i], best_s[k - 1] if len(best_s) >= k else -np.inf)
                if u[at] < limit:
                    break
                now = alive[at : at + step]
                s = np.concatenate([best_s, scores(x[now], q[a + i])])
                n = np.concatenate([best_i, x_ids[now]])
                order = np.lexsort((n, -s))[:k]
                best_s, best_i = s[order], n[order]
                at, step = at + step, min(step * 2, 4096)
            evaluated += min(at, len(alive))
            out += zip([a + i] * len(best_s), best_i.tolist(), best_s.tolist(), strict=True)
    return out, evaluated


def _pack(df: DataFrame, rows: int, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Blocks of vectors with their pivot distances: d, block, rows, ids, vectors (int64), distances (float64)."""
    shared = df.sparkSession.sparkContext.broadcast(pivots)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base, made = (context.partitionId() if context else 0) << 32, 0
        held: dict[int, list[tuple[np.ndarray, ...]]] = {}

        def flush(d: int) -> pa.RecordBatch:
            nonlocal made
            numbers, ids, v = (np.concatenate(x) for x in zip(*held.pop(d), strict=True))
            dist = _distances(v.astype(np.float64), shared.value[d]) if d in shared.value else np.zeros((len(v), 0))
            made += 1
            return pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([base + made], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in (numbers, ids, v, dist))], ["d", "block", "rows", "ids", "vectors", "distances"])

        for batch in batches:
            numbers, ids, sizes = (batch.column(i).to_numpy() for i in (0, 1, 3))
            for d in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == d)
                v = batch.column(2).take(pa.array(own)).flatten().to_numpy().reshape(len(own), d)
                held.setdefault(d, []).append((numbers[own], ids[own], v))
                if sum(len(x[0]) for x in held[d]) >= rows:
                    yield flush(d)
        for d in list(held):
            yield flush(d)

    return map_arrow(df.select("row", "id", "v", "d"), work, "d int, block bigint, rows binary, ids binary, vectors binary, distances binary")


def search(df: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256, pivots: int = PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest inner products of every query row; ``is_query`` is on column ``id``."""
    spark = df.sparkSession
    scratch = Scratch(spark)
    vectors = scratch.save(integers(df, vec_id, embedding, scale), "vectors")
    h = F.xxhash64("row", "id")
    drawn: dict[int, list[tuple[int, list[int]]]] = {}
    for r in vectors.groupBy("d", F.pmod(h, F.lit(sample)).alias("b")).agg(F.min_by(F.struct("row", "v"), h).alias("x")).select("d", "x").collect():
        drawn.setdefault(r["d"], []).append((r["x"]["row"], r["x"]["v"]))
    known = {d: (np.array([i for i, _ in sorted(x)], np.int64), np.array([v for _, v in sorted(x)], np.int64)) for d, x in drawn.items() if d}
    points = {d: choose_pivots(v.astype(np.float64), pivots) for d, (_, v) in known.items()}

    blocks = scratch.save(_pack(vectors, BLOCK, points), "blocks")
    queries = scratch.save(_pack(vectors.where(is_query & (F.col("id") != NO_ID)), QUERY_BLOCK, points), "queries")
    groups = max(1, min(GROUPS, blocks.count()))
    # Every block of queries goes to every group of blocks.  Spark knows the size of the queries' files alone, not that of
    # their copies, and would send those through the driver.
    left = queries.select("d", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.col("rows").alias("qr"), F.col("ids").alias("qi"), F.col("vectors").alias("qv"), F.col("distances").alias("qd"))
    right = blocks.select("d", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("g"), "rows", "ids", "vectors", "distances")
    shared = spark.sparkContext.broadcast(known)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                d = r["d"]
                x_rows, x_ids, q_rows, q_ids = (np.frombuffer(r[c], np.int64) for c in ("rows", "ids", "qr", "qi"))
                x, q = (np.frombuffer(r[c], np.int64).reshape(len(i), d) for c, i in (("vectors", x_rows), ("qv", q_rows)))
                xd, qd = (np.frombuffer(r[c], np.float64).reshape(len(i), -1) for c, i in (("distances", x_rows), ("qd", q_rows)))
                found, _ = search_block(q, q_rows, qd, _floors(q, q_rows, shared.value.get(d), k), x, x_rows, x_ids, xd, k)
                place, ids, score = (np.array(c, np.int64) for c in (zip(*found, strict=True) if found else ((), (), ())))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (q_rows[place], q_ids[place], ids, score)], ["query_row", "query_id", "vec_id", "score"])

    # Tasks by number: pairs of blocks are few bytes but long work, so they must not be put together by size.
    left, right = (x.repartition(groups, "d", "g") for x in (left, right))
    found = map_arrow(left.join(right.hint("merge"), ["d", "g"]).select("d", "qr", "qi", "qv", "qd", "rows", "ids", "vectors", "distances"), work, "query_row bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    out = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score")
    return scratch.keep_for(out, "queries", "blocks")


def _floors(q: np.ndarray, q_rows: np.ndarray, known: tuple[np.ndarray, np.ndarray] | None, k: int) -> np.ndarray:
    """For each query the k-th score within the sample: the final k-th can't be lower."""
    if known is None:
        return np.full(len(q), -np.inf)
    rows, v = known
    out = np.full(len(q), -np.inf)
    for i in range(len(q)):
        s = scores(v, q[i])[rows != q_rows[i]]
        if len(s) >= k:
            out[i] = np.partition(s, len(s) - k)[len(s) - k]
    return out
