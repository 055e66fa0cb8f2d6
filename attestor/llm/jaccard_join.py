"""Exact Jaccard self-join on five-word shingles by a grouped prefix join, and its components.

1. Documents with the same shingle set become one node (copies are never paired).
2. Shingles are ordered by frequency, the frequent last, ties by hash.  Frequencies are counted over
   all sets; up to ``COMMON`` of the most frequent are known to every worker, the rest count as rare.
   The order never changes the result, only the work.
3. Nodes with the same prefix and size form one group.  Two groups are paired where they share a prefix
   shingle and where what follows it in either can still hold the overlap that a link needs (a bound on
   the other's size).  A group whose shingle stands late can only meet one whose shingle stands early.
4. Pairs are expanded to members.  Those whose parity sketches (1024 bits, of longer sets also two to
   four bits a shingle) differ in more places than two linked sets can are left out: every differing
   place is a shingle that only one set has.
5. What is left is verified on whole sets of 64-bit shingles, in few rounds: first every node with the
   partner that has the most partners, then the pairs whose nodes are in different components still.
6. A shingle (or group) with more than ``SMALL_RUN`` holders isn't expanded at first.  Its holders are
   compared with leaders, the key's and those with an equal MinHash value, a leader being the holder with
   the most common shingles; after components are formed, holders that are still apart are paired, those
   whose shingle stands early with all of compatible size.  No link between components is lost,
   whatever the sizes.

Words are maximal runs other than white space, A-Z folded.  A text of fewer than five words has one
shingle; one without words (null, empty, blank) has none and links with nothing.  Rows with equal
sets link.  A null id never becomes a component's id unless no other is in it.  Texts of any length
are taken whole, an empty table gives an empty result, rows that occur twice are two rows, and other
columns of the input, whatever their names, play no part.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.llm.common import Scratch, by_bytes, fresh, map_arrow, mix64, shingles, text_bytes, word_hashes

#: Similarity as a fraction; holders of a shingle that are paired with each other directly.
NUMERATOR, DENOMINATOR, SMALL_RUN = 3, 4, 64
#: Prefix shingles in a shuffled bucket; common shingles known to every worker (8 bytes each).
BUCKET, COMMON = 1_500_000, 1 << 18
#: Shingles that one round of comparisons may move, beside half of all.
SMALL_ROUND = 10_000_000
#: Members of two groups that are paired directly.
SMALL_PRODUCT = 256
#: Keys that a worker remembers to leave copies out early; bounds its memory, not the result.
REMEMBERED = 200_000


def sets(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """(row, sorted distinct shingles, node key) of every row with words."""
    raw, bounds = text_bytes(batch.column(column))
    for a, b in by_bytes(bounds, 1 << 20):
        h, rows = shingles(word_hashes(raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]))
        for i in np.flatnonzero(np.diff(rows)).tolist():
            s = np.unique(h[rows[i] : rows[i + 1]])
            yield a + i, s, hashlib.blake2b(s, digest_size=16).digest()


def new_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[np.ndarray, bytes]]]:
    """(shingles, node key) of each batch's nodes, without most of those that came before."""
    seen: set[bytes] = set()
    for batch in batches:
        found = []
        for _, s, key in sets(batch, 0):
            if key not in seen:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(key)
                found.append((s, key))
        yield found


def prefix_length(n: int) -> int:
    return n - (NUMERATOR * n + DENOMINATOR - 1) // DENOMINATOR + 1


#: Sizes are shuffled as one byte, in steps of 6 %; comparisons of classes only err on the safe side.
_STEPS = np.unique(np.ceil(1.06 ** np.arange(1, 300)).astype(np.int64))[:255]


def size_class(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(_STEPS, n, "right").astype(np.uint8)


def largest_partner(n: int, position: np.ndarray) -> np.ndarray:
    """The size that a set may have to link with one of size n, if their first shared shingle is at the position.

    The overlap is at most n - position, and a link needs (n + m) * t / (1 + t).
    """
    return (DENOMINATOR + NUMERATOR) * (n - position) // NUMERATOR - n


SKETCH, MINIMA = 16, 4  # 64-bit words of parities; MinHash values


def wide_words(n: int) -> int:
    """Words of the wide sketch of a set of size n: two to four bits a shingle; none where the narrow one does as well."""
    return 0 if n <= 32 * SKETCH else 1 << min(14, (2 * n - 1).bit_length() - 6)


def _parities(s: np.ndarray, words: int) -> np.ndarray:
    flags = (np.bincount((s & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(flags).view(np.int64)


def sketch(s: np.ndarray, common: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of 1024 hash values the parity of the number of shingles that have it, MinHash values, and minus
    the share of common shingles per mille; the wide sketch, the same for more hash values."""
    low = s & np.uint64(0xFFFFFFFF)
    minima = np.array([s[0], s[-1], low.min(), low.max()], np.uint64).view(np.int64)
    words = wide_words(len(s))
    return np.concatenate([_parities(s, SKETCH), minima, np.array([-(1000 * common // len(s))])]), _parities(s, words) if words else np.zeros(0, np.int64)


def _wide_differ(x: str, y: str) -> Column:
    """Places in which two wide sketches differ; the longer one is folded, as a parity of twice the hash values holds one of half as many."""
    words = F.least(F.size(x), F.size(y))

    def folded(c: str) -> Column:
        halves = F.zip_with(F.slice(c, F.lit(1), words), F.slice(c, words + 1, words), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(c) > words, halves).otherwise(F.col(c))

    apart = F.zip_with(folded(x), folded(y), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.when((words > 0) & (F.greatest(F.size(x), F.size(y)) <= 2 * words), F.aggregate(apart, F.lit(0), lambda t, c: t + c)).otherwise(0)


def _alike(a: str, b: str) -> Column:
    """Sizes and sketches (columns n, sketch and wide with the suffixes) that linked sets can have.

    Linked sets differ in at most (|x| + |y|) * (1 - t) / (1 + t) shingles.
    """
    most = (F.col(f"n{a}") + F.col(f"n{b}")) * (DENOMINATOR - NUMERATOR)
    fits = DENOMINATOR * F.least(f"n{a}", f"n{b}") >= NUMERATOR * F.greatest(f"n{a}", f"n{b}")
    narrow = sum((F.bit_count(F.get(f"sketch{a}", F.lit(i)).bitwiseXOR(F.get(f"sketch{b}", F.lit(i)))) for i in range(SKETCH)), F.lit(0))
    return fits & (narrow * (DENOMINATOR + NUMERATOR) <= most) & (_wide_differ(f"wide{a}", f"wide{b}") * (DENOMINATOR + NUMERATOR) <= most)


def _pair() -> list[Column]:
    """a < b and the sum of their sizes, of columns with suffixes x and y."""
    return [F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), (F.col("nx") + F.col("ny")).alias("size")]


_NODE = ("node", "n", "sketch", "wide")


def _side(nodes: DataFrame, suffix: str, *keys: str | Column) -> DataFrame:
    return nodes.select(*keys, F.col("node").alias(suffix), *(F.col(c).alias(f"{c}{suffix}") for c in _NODE[1:]))


def _nodes(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    kind = docs.schema[id_column].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, node = [0] * batch.num_rows, [None] * batch.num_rows
            for i, s, key in sets(batch, 1):
                n[i], node[i] = len(s), key
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(node, pa.binary())], ["id", "h", "n", "node"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    return map_arrow(rows, work, f"id {kind}, h bigint, n bigint, node binary")


def _deal(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(bucket)], strict=False):
        yield int(bucket[a]), [c[order[a:b]] for c in columns]


def _bucket(token: np.ndarray, buckets: int) -> np.ndarray:
    return ((token.astype(np.uint64) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _common(docs: DataFrame, text: str, buckets: int, own: Scratch) -> np.ndarray:
    """32-bit shingles of more than ``SMALL_RUN`` sets, ``COMMON`` at most, in the order of their frequency.

    Sorted 32-bit shingles are packed as differences, in some 2 bytes each.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            tokens = np.sort(np.concatenate([np.zeros(0, np.uint32), *held]))
            held.clear()
            ends = np.searchsorted(_bucket(tokens, buckets), np.arange(buckets + 1))
            at = np.flatnonzero(np.diff(ends))
            packed = [pa.compress(np.diff(tokens[ends[k] : ends[k + 1]], prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True) for k in at]
            sizes = np.diff(ends)[at]
            return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())], ["bucket", "size", "payload"])

        for found in new_sets(batches):
            for s, _ in found:
                held.append((s >> np.uint64(32)).astype(np.uint32))
                size += len(s)
            if size > 4_000_000:
                yield flush()
                size = 0
        yield flush()

    def often(frame: pd.DataFrame) -> pd.DataFrame:
        planes = (np.frombuffer(pa.decompress(x, 4 * int(n), "zstd"), np.uint8).reshape(4, -1) for n, x in zip(frame["size"], frame["payload"], strict=True))
        tokens = np.sort(np.concatenate([np.cumsum(np.ascontiguousarray(x.T).view(np.uint32).ravel(), dtype=np.uint32) for x in planes]))
        edge = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        n = np.diff(np.concatenate([edge, [len(tokens)]]))
        return pd.DataFrame({"token": tokens[edge[n > SMALL_RUN]].astype(np.int64), "n": n[n > SMALL_RUN].astype(np.int64)})

    packed = map_arrow(docs.select(F.col(text).alias("text")), count, "bucket int, size int, payload binary")
    counts = own.save(packed.groupBy("bucket").applyInPandas(often, "token bigint, n bigint").withColumn("class", F.floor(8 * F.log2("n"))), "common")
    least, room = None, COMMON
    for r in sorted(counts.groupBy("class").count().collect(), reverse=True):
        room -= r["count"]
        if room < 0:
            break
        least = r["class"]
    if least is None:
        return np.zeros(0, np.uint32)
    rows = sorted((r["n"], r["token"]) for r in counts.where(F.col("class") >= least).select("n", "token").collect())
    return np.array([t for _, t in rows], np.uint32)


_INDEX = "kind int, a bigint, b bigint, n int, u int, node binary, sketch array<bigint>, wide array<bigint>"


def _index(docs: DataFrame, text: str, buckets: int, common: np.ndarray) -> DataFrame:
    """Rows of kind 0: a pair of groups (a, b); 1: group a holds shingle b, with its size class n and
    that of its largest partner u; 2: node with its sketch is in group a of size n."""
    shared = docs.sparkSession.sparkContext.broadcast(common)
    width = SKETCH + MINIMA + 1

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.argsort(shared.value, kind="stable")
        common = shared.value[rank]
        out: list[list] = []  # of each node: group, size, node, (shingles, bounds) of the rare and of the common, sketches
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal out
            kinds, at, sizes, payloads = [], [], [], []
            groups = np.array([x[0] for x in out], np.uint64)
            for kind, place in ((0, 3), (1, 4)):
                tokens = np.concatenate([np.zeros(0, np.uint32), *(x[place][0] for x in out)])
                most = np.concatenate([np.zeros(0, np.uint8), *(x[place][1] for x in out)])
                counts = [len(x[place][0]) for x in out]
                g = np.repeat(groups, counts)
                n = np.repeat(size_class(np.array([x[1] for x in out], np.int64)), counts)
                # Holders of a common shingle are spread by group, as they are passed on row by row.
                for k, c in _deal(_bucket(tokens, buckets) if kind == 0 else (mix64(g + tokens) % np.uint64(buckets)).astype(np.int64), tokens, g, n, most):
                    kinds.append(kind), at.append(k), sizes.append(len(c[0])), payloads.append(b"".join(x.tobytes() for x in c))
            nodes = np.array([np.frombuffer(x[2], np.uint8) for x in out], np.uint8).reshape(-1, 16)
            sketches = np.array([x[5][0] for x in out], np.int64).reshape(-1, width)
            for k, (g, n, o) in _deal((groups % np.uint64(buckets)).astype(np.int64), groups, np.array([x[1] for x in out], np.uint32), np.arange(len(out))):
                kinds.append(2), at.append(k), sizes.append(len(o)), payloads.append(b"".join([g.tobytes(), n.tobytes(), nodes[o].tobytes(), sketches[o].tobytes(), *(out[i][5][1].tobytes() for i in o.tolist())]))
            out = []
            return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(kinds, pa.int32()), pa.array(sizes, pa.int32()), pa.array(payloads, pa.binary())], ["bucket", "kind", "size", "payload"])

        for found in new_sets(batches):
            for s, key in found:
                n = len(s)
                p = prefix_length(n)
                token = (s >> np.uint64(32)).astype(np.uint32)
                if len(common):
                    where = np.searchsorted(common, token)
                    where[where == len(common)] = 0
                    last = common[where] == token
                    rare = np.flatnonzero(~last)[:p]
                    rest = np.flatnonzero(last)
                    shared_by_many = len(rest)
                    rest = rest[np.argsort(rank[where[rest]], kind="stable")][: p - len(rare)]
                else:
                    rare, rest, shared_by_many = np.arange(p), np.zeros(0, np.int64), 0
                most = size_class(largest_partner(n, np.arange(p)))
                group = hashlib.blake2b(s[rare].tobytes() + b"|" + s[rest].tobytes() + n.to_bytes(8, "little"), digest_size=8).digest()
                entries = []
                for chosen, bound in ((rare, most[: len(rare)]), (rest, most[len(rare) :])):
                    t, first = np.unique(token[chosen], return_index=True)
                    entries.append((t, bound[first]))
                out.append([int.from_bytes(group, "little"), n, key, *entries, sketch(s, shared_by_many)])
                size += p
            if size > 1_000_000:
                yield flush()
                size = 0
        yield flush()

    def pair(frame: pd.DataFrame) -> pd.DataFrame:
        made: list[pd.DataFrame] = []

        def add(kind: int, a: np.ndarray, b: np.ndarray | int = 0, n: np.ndarray | int = 0, u: np.ndarray | int = 0, node: list | None = None, bits: list | None = None, wide: list | None = None) -> None:
            objects = (pd.Series(x if x is not None else [None] * len(a), range(len(a)), dtype=object) for x in (node, bits, wide))
            made.append(pd.DataFrame({"kind": kind, "a": a.view(np.int64), "b": b, "n": n, "u": u} | dict(zip(("node", "sketch", "wide"), objects, strict=True)), index=range(len(a))))

        parts: dict[int, list[list[np.ndarray]]] = {0: [], 1: []}
        for kind, m, payload in zip(frame["kind"], frame["size"], frame["payload"], strict=True):
            if kind == 2:
                nodes = [payload[12 * m + 16 * i : 12 * m + 16 * i + 16] for i in range(m)]
                bits = list(np.frombuffer(payload, np.int64, width * m, 28 * m).reshape(m, width))
                n = np.frombuffer(payload, np.uint32, m, 8 * m).astype(np.int64)
                ends = np.cumsum([wide_words(x) for x in n.tolist()])
                wide = np.split(np.frombuffer(payload, np.int64, int(ends[-1]), (28 + 8 * width) * m), ends[:-1])
                add(2, np.frombuffer(payload, np.uint64, m).copy(), 0, n, 0, nodes, bits, wide)
            else:
                parts[kind].append([np.frombuffer(payload, np.uint32, m), np.frombuffer(payload, np.uint64, m, 4 * m), np.frombuffer(payload, np.uint8, m, 12 * m), np.frombuffer(payload, np.uint8, m, 13 * m)])
        if parts[1]:
            t, g, n, u = (np.concatenate(c) for c in zip(*parts[1], strict=True))
            add(1, g, t.astype(np.int64), n, u)
        if parts[0]:
            t, g, n, u = (np.concatenate(c) for c in zip(*parts[0], strict=True))
            order = np.argsort(t, kind="stable")
            t = t[order]
            twice = np.zeros(len(t), bool)
            twice[1:] = t[1:] == t[:-1]
            twice[:-1] |= twice[1:].copy()
            order, t = order[twice], t[twice]
            g = g[order]
            o = np.lexsort((g, t))
            t, g, order = t[o], g[o], order[o]
            once = np.ones(len(t), bool)
            once[1:] = (t[1:] != t[:-1]) | (g[1:] != g[:-1])
            t, g, order = t[once], g[once], order[once]
            n, u = n[order], u[order]
            edge = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.int64)
            run = np.diff(np.concatenate([edge, [len(t)]])) if len(t) else np.zeros(0, np.int64)
            large = np.repeat(run > SMALL_RUN, run)
            if large.any():
                add(1, g[large], t[large].astype(np.int64), n[large], u[large])
            t, g, n, u = t[~large], g[~large], n[~large], u[~large]
            found = []
            for d in range(1, SMALL_RUN):
                same = np.flatnonzero(t[d:] == t[:-d])
                if not len(same):
                    break
                same = same[(n[same] <= u[same + d]) & (n[same + d] <= u[same])]
                found.append(np.stack([g[same], g[same + d]], 1))
            if found:
                pairs = np.concatenate(found)
                pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
                pairs = pairs[np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)])] if len(pairs) else pairs
                add(0, pairs[:, 0].copy(), pairs[:, 1].copy().view(np.int64))
        return pd.concat(made) if made else pd.DataFrame({c: pd.Series([], dtype=object) for c in ("kind", "a", "b", "n", "u", "node", "sketch", "wide")})

    packed = map_arrow(docs.select(F.col(text).alias("text")), emit, "bucket int, kind int, size int, payload binary")
    return packed.groupBy("bucket").applyInPandas(pair, _INDEX)


#: Bits of the filter in one row, and in all at most (32 MB).
_PIECE, _FILTER = 19, 28


def _filter_bits(nodes: DataFrame, n: int) -> np.ndarray:
    """A one-hash Bloom filter of node keys, of at most 32 MB however many they are."""
    bits = min(max(_PIECE, int(n * 12).bit_length()), _FILTER)
    key = F.conv(F.substring(F.hex("node"), 1, 12), 16, 10).cast("bigint")
    places = nodes.select(F.pmod(key, F.lit(1 << bits)).alias("p")).distinct().select(F.shiftright("p", _PIECE).alias("piece"), "p")

    def piece(frame: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(1 << _PIECE, np.uint8)
        flags[frame["p"].to_numpy() & ((1 << _PIECE) - 1)] = 1
        return pd.DataFrame({"piece": frame["piece"].iloc[:1], "bits": [np.packbits(flags, bitorder="little").tobytes()]})

    out = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (_PIECE - 3)
    for r in places.groupBy("piece").applyInPandas(piece, "piece bigint, bits binary").collect():
        out[r["piece"] * size : (r["piece"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def _sets(docs: DataFrame, text: str, bloom: np.ndarray) -> DataFrame:
    """Shingles of the nodes that the filter holds, each node once."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = shared.value
        mask = 8 * len(flags) - 1
        for found in new_sets(batches):
            places = [int.from_bytes(key[:6], "big") & mask for _, key in found]
            chosen = [x for x, p in zip(found, places, strict=True) if flags[p >> 3] >> (p & 7) & 1]
            for at in range(0, len(chosen), 64):
                part = chosen[at : at + 64]
                yield pa.RecordBatch.from_arrays([pa.array([k for _, k in part], pa.binary()), pa.array([s.tobytes() for s, _ in part], pa.binary())], ["node", "set"])

    return map_arrow(docs.select(F.col(text).alias("text")), work, "node binary, set binary").dropDuplicates(["node"])


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Elements that two sorted arrays without repeats share."""
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _compare(pairs: DataFrame, n: int, docs: DataFrame, text: str) -> DataFrame:
    """The pairs (a, b) that link, of n pairs."""
    found = _sets(docs, text, _filter_bits(pairs.select(F.explode(F.array("a", "b")).alias("node")), 2 * n))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                o = overlap(x, y)
                linked.append(DENOMINATOR * o >= NUMERATOR * (len(x) + len(y) - o))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    one, two = (found.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab")
    joined = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b")
    return map_arrow(joined, work, "a binary, b binary")


def _release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of what is over: it does so once nothing refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _leaders(holders: DataFrame) -> DataFrame:
    """Pairs of holders of keys k with leaders, which have the most common shingles, ties to the smaller node.

    Leaders are the key's, and for each MinHash value that of all holders which have it.
    """

    def led(rows: DataFrame, *keys: str) -> DataFrame:
        order = F.struct(F.get("sketch", F.lit(SKETCH + MINIMA)).alias("rank"), *_NODE)
        first = rows.groupBy(*keys).agg(F.min(order).alias("s"), F.count("*").alias("c")).where("c > 1").select(*keys, "s.*")
        return _side(rows, "x", *keys).join(_side(first, "y", *keys), list(keys)).where((F.col("x") != F.col("y")) & _alike("x", "y")).select(*_pair())

    values = F.array(*(F.xxhash64(F.lit(i), F.get("sketch", F.lit(SKETCH + i))) for i in range(MINIMA)))
    alone = holders.select(*_NODE).dropDuplicates(["node"])
    return led(holders, "k").unionByName(led(alone.withColumn("value", F.explode(values)), "value"))


def _to_hubs(pairs: DataFrame) -> DataFrame:
    """For every node its pair with the partner that has the most partners, if they are more than its own (ties to the smaller node)."""
    degree = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("c"))
    for c in "ab":
        pairs = pairs.join(degree.select(F.col("node").alias(c), F.struct((-F.col("c")).alias("c"), F.col("node").alias("node")).alias(f"r{c}")), c)
    low, high = F.greatest("ra", "rb"), F.least("ra", "rb")
    first = pairs.groupBy(low.alias("low")).agg(F.min(F.struct(high.alias("high"), "a", "b", "size")).alias("s"))
    return first.select("s.a", "s.b", "s.size")


def components(edges: DataFrame, own: Scratch, name: str) -> DataFrame:
    """(node, root) of every node in an edge (a, b), the root being the component's smallest node.

    Every node points to its smallest neighbour if that is smaller; pointers are followed for four
    steps, edges are moved along them, and so on until no edge is left.
    """
    ends = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    first = ends = own.save(ends, f"{name}-0")
    moves: list[DataFrame] = []
    while not ends.isEmpty():
        step = ends.groupBy("u").agg(F.min("v").alias("v"))
        for i in range(2):
            step = own.save(step, f"{name}-{len(moves)}-{i}")
            step = step.join(step.select(F.col("u").alias("v"), F.col("v").alias("w")), "v", "left").select("u", F.coalesce("w", "v").alias("v"))
        step = own.save(step, f"{name}-{len(moves)}-2")
        moves.append(step)
        one, two = (step.select(F.col("u").alias(c), F.col("v").alias(f"{c}{c}")) for c in "uv")
        moved = ends.join(one, "u").join(two, "v", "left").select(F.col("uu").alias("a"), F.coalesce("vv", "v").alias("b")).where("a <> b")
        ends = own.save(moved.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-{len(moves)}")
    at = first.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("root", F.col("node"))
    for step in moves:
        at = at.join(step.select(F.col("u").alias("root"), F.col("v").alias("next")), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return own.save(at, f"{name}-roots")


class _Components:
    """Verified links and the components that they form, grown round by round; pairs inside one component are never compared."""

    def __init__(self, docs: DataFrame, text: str, own: Scratch, most: int):
        self.docs, self.text, self.own, self.most, self.step = docs, text, own, most, 0
        self.roots: DataFrame | None = None

    def rooted(self, nodes: DataFrame, column: str, root: str) -> DataFrame:
        if self.roots is None:
            return nodes.withColumn(root, F.col(column))
        return nodes.join(self.roots.select(F.col("node").alias(column), F.col("root").alias(f"_{root}")), column, "left").withColumn(root, F.coalesce(f"_{root}", column)).drop(f"_{root}")

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose nodes are in different components so far."""
        return self.rooted(self.rooted(pairs, "a", "ra"), "b", "rb").where("ra <> rb").select(*pairs.columns)

    def compare(self, pairs: DataFrame, n: int) -> None:
        """Verify n pairs and join the components of those that link."""
        self.step += 1
        links = self.own.save(_compare(pairs, n, self.docs, self.text), f"links-{self.step}")
        known = links if self.roots is None else links.unionByName(self.roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        self.roots = components(known, self.own, f"components-{self.step}")
        _release(self.docs.sparkSession)

    def grow(self, pairs: DataFrame) -> None:
        """Compare pairs until none is left whose nodes are apart, each round moving ``most`` shingles or so."""
        while True:
            pairs = self.own.save(self.apart(pairs), f"open-{self.step}")
            n, size = pairs.agg(F.count("*"), F.sum("size")).first()
            if not n:
                return
            parts = -(-size // self.most)
            part = F.pmod(F.xxhash64("a", "b", F.lit(self.step)), F.lit(parts))
            self.compare(pairs.where(part == 0) if parts > 1 else pairs, -(-n // parts))
            if parts == 1:
                return
            pairs = pairs.where(part > 0)


def join(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for every row."""
    own = Scratch(docs.sparkSession)
    rows = own.save(label(docs, id_column, text, own), "labelled")
    return own.keep_for(rows.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id"), "labelled")


def representatives(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id (nulls last).

    Rows without words all stay; of rows with equal id and text in one component one stays.
    """
    own = Scratch(docs.sparkSession)
    rows = own.save(label(docs, id_column, text, own), "labelled").where("n > 0")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "h")).alias("s"), F.count("*").alias("c"))
    first = first.where("c > 1").select("root", F.col("s.id").alias("first_id"), F.col("s.h").alias("first_h"))
    member = rows.join(first, "root").withColumn("stays", F.col("id").eqNullSafe(F.col("first_id")) & (F.col("h") == F.col("first_h")))
    member = own.save(member.groupBy("id", "h").agg(F.max("stays").alias("stays"), F.count("*").alias("c")).where("not stays or c > 1"), "of-many")
    hashed = fresh(docs, "hash")

    def among(base: DataFrame, few: DataFrame, how: str) -> DataFrame:
        return base.join(few, base[id_column].eqNullSafe(few["id"]) & (base[hashed] == few["h"]), how)

    gone, twice = (member.where(x).select("id", "h") for x in ("not stays", "stays"))
    kept = among(docs.withColumn(hashed, F.xxhash64(text)), gone, "left_anti")
    if not twice.isEmpty():
        kept = among(kept, twice, "left_anti").unionByName(among(kept, twice, "left_semi").dropDuplicates([id_column, text]))
    return own.keep_for(kept.drop(hashed), "of-many")


def label(docs: DataFrame, id_column: str, text: str, own: Scratch) -> DataFrame:
    """(id, h, n, root, component_id) for every row; rows of one root are connected by links.

    The verified links connect exactly the documents that the full set of links connects.
    """
    nodes = own.save(_nodes(docs, id_column, text), "documents")
    total, prefixes = nodes.where("n > 0").agg(F.sum("n"), F.sum(F.col("n") - F.ceil(F.col("n") * NUMERATOR / DENOMINATOR) + 1)).first()
    buckets = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(prefixes or 0) // BUCKET))
    common = _common(docs, text, buckets, own)
    _release(docs.sparkSession)
    index = own.save(_index(docs, text, buckets, common), "index")
    _release(docs.sparkSession)

    member = index.where("kind = 2").groupBy(F.col("a").alias("g"), "node", "n").agg(F.first("sketch").alias("sketch"), F.first("wide").alias("wide"))
    member = own.save(member, "member")
    many = own.save(member.groupBy("g").agg(F.count("*").alias("c")).where("c > 1"), "many")
    sized = index.where("kind = 0").select("a", "b").distinct()
    for c in "ab":
        sized = sized.join(many.select(F.col("g").alias(c), F.col("c").alias(f"c{c}")), c, "left")
    sized = own.save(sized.select("a", "b", (F.coalesce("ca", F.lit(1)) * F.coalesce("cb", F.lit(1)) <= SMALL_PRODUCT).alias("small")), "group-pairs")
    direct = sized.where("small").join(_side(member, "x", F.col("g").alias("a")), "a").join(_side(member, "y", F.col("g").alias("b")), "b").where(_alike("x", "y")).select(*_pair())

    # Keys whose holders are not paired yet: common shingles, groups of several members, large pairs of groups.
    keys = index.where("kind = 1").select(F.col("b").alias("k"), F.col("a").alias("g"), F.col("n").alias("class"), "u")
    for more in (sized.where("not small").select(F.xxhash64("a", "b").alias("k"), F.explode(F.array("a", "b")).alias("g")), many.select(F.col("g").alias("k"), "g")):
        keys = keys.unionByName(more.withColumns({"class": F.lit(0), "u": F.lit(255)}))
    holders = own.save(keys.distinct().join(member, "g").select("k", *_NODE, "class", "u"), "holders")
    counts = own.save(holders.groupBy("k").agg(F.count("*").alias("c")).where("c > 1"), "keys")
    few, large = (own.save(holders.join(counts.where(x).select("k"), "k"), name) for x, name in ((F.col("c") <= SMALL_RUN, "few"), (F.col("c") > SMALL_RUN, "large")))
    pairs = direct.unionByName(_meet(few).select(*_pair())).unionByName(_leaders(large.where("u >= class")))
    pairs = own.save(pairs.distinct(), "pairs")
    _release(docs.sparkSession)

    grown = _Components(docs, text, own, max(SMALL_ROUND, int(total or 0) // 2))
    nearest = own.save(_to_hubs(pairs), "nearest")
    if n := nearest.count():
        grown.compare(nearest, n)
    rest = pairs.join(nearest, ["a", "b"], "left_anti")
    if not large.isEmpty():
        placed = own.save(grown.rooted(large, "node", "root"), "placed")
        open_keys = placed.groupBy("k").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("k")
        cross = _meet(own.save(placed.join(open_keys, "k", "left_semi"), "open-holders"), apart=True).select(*_pair())
        rest = rest.unionByName(cross.distinct().join(nearest, ["a", "b"], "left_anti")).distinct()
    grown.grow(rest)

    filled = nodes.where("n > 0")
    known = own.save(grown.rooted(filled.groupBy("node").agg(F.min("id").alias("rep")), "node", "root"), "reps")
    least = known.groupBy("root").agg(F.min("rep").alias("component_id"))
    places = own.save(known.join(least, "root").select("node", "root", "component_id"), "places")
    blank = nodes.where("n = 0").select("id", "h", "n", F.col("node").alias("root"), F.col("id").alias("component_id"))
    return filled.join(places, "node").select("id", "h", "n", "root", "component_id").unionByName(blank)


def _meet(holders: DataFrame, apart: bool = False) -> DataFrame:
    """Pairs of holders of one key that may link, or with ``apart`` those of them in different components.

    Of two that may link one at least can have a partner of its own size (u >= class); these are
    dealt to the sizes of their partners, so late holders never meet each other.
    """
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(DENOMINATOR / NUMERATOR)) + 1e-9).cast("int")
    more = ["root"] if apart else []
    early = holders.where("u >= class").withColumn("size", F.explode(F.array(step - 1, step, step + 1)))
    one = _side(early, "x", "k", "size", F.col("class").alias("class_x"), F.col("u").alias("u_x"), *(F.col(c).alias("rx") for c in more))
    two = _side(holders.withColumn("size", step), "y", "k", "size", F.col("class").alias("class_y"), F.col("u").alias("u_y"), *(F.col(c).alias("ry") for c in more))
    once = (F.col("x") != F.col("y")) & ((F.col("u_y") < F.col("class_y")) | (F.col("x") < F.col("y")))
    if apart:
        once = once & (F.col("rx") != F.col("ry"))
    fits = (F.col("class_x") <= F.col("u_y")) & (F.col("class_y") <= F.col("u_x"))
    return one.join(two, ["k", "size"]).where(once & fits & _alike("x", "y"))
