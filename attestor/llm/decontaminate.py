"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by their number of shingles into classes of bound U = 8, 16, 32, ...  The
documents' shingles are cut into blocks of U; a window is two neighbouring blocks, so that the
passage of an item lies in one window whole and the two sets stay of like size however long the
document is.  Window and item are compared slot by slot (``SLOTS`` MinHash functions); one equal
slot makes the window's documents candidates.  Items of one or two shingles, too small beside the
smallest window, are looked up exactly.  If slots were independent, a passage that holds 3/4 of a
larger item's shingles would be missed with a chance below 1e-5.  Every candidate is then verified exactly: the share of the
item's distinct shingles that occur in the whole document.

Shingles are of five words (A-Z folded, split at white space); a shorter text is one shingle,
so an item of one to four words is found only in a document of just these words.
Nulls and texts without words, on either side, match nothing.  Repeated rows each get their result;
several items with the same text are all reported.  Texts of any length are taken whole; empty tables
match nothing.  A kept column named ``leaks`` gives way to the result's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.llm.common import by_bytes, map_arrow, mix64, shingles, text_bytes, with_text, word_hashes

SLOTS, THRESHOLD, SMALLEST = 64, 0.75, 8
#: Items of at most so many shingles are looked up exactly.
EXACT = 2
#: Bytes of item text that are sent to the workers at once; more items take further rounds.
ROUND_BYTES = 8 << 20

_FACTORS = (mix64(np.arange(1, SLOTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _slot(x: np.ndarray, k: int) -> np.ndarray:
    """A bijection of 32 bits for each slot."""
    return x * _FACTORS[k]


@dataclass
class Items:
    """Signatures and shingles of some items, ready for probing."""

    sizes: np.ndarray  # distinct shingles of each item
    shingle: np.ndarray  # all distinct shingles, sorted
    owner_at: np.ndarray  # bounds of the owners of each shingle
    owner: np.ndarray
    classes: list[tuple[int, list[np.ndarray], np.ndarray]]  # U, values by slot, filter by slot
    short: np.ndarray  # shingles of the items that are looked up exactly, sorted


def prepare(texts: list[str | None]) -> Items:
    raw, bounds = text_bytes(pa.array(texts, pa.string()))
    h, rows = shingles(word_hashes(raw, bounds))
    sets = [np.unique(h[a:b]) for a, b in zip(rows[:-1], rows[1:], strict=True)]
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate([np.zeros(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    shingle, first = np.unique(flat[order], return_index=True)
    classes: list[tuple[int, list[np.ndarray], np.ndarray]] = []
    level = np.maximum(np.ceil(np.log2(np.maximum(sizes, 1) / SMALLEST)), 0).astype(int)
    for c in sorted({int(x) for x, n in zip(level, sizes, strict=True) if n}):
        inside = [(s >> np.uint64(32)).astype(np.uint32) for s, x in zip(sets, level, strict=True) if x == c and len(s)]
        values = [np.unique(np.array([_slot(s, k).min() for s in inside], np.uint32)) for k in range(SLOTS)]
        quick = np.zeros((SLOTS, 1 << 16), bool)
        for k, v in enumerate(values):
            quick[k, (v * np.uint32(0x9E3779B1)) >> np.uint32(16)] = True
        classes.append((SMALLEST << c, values, quick))
    return Items(sizes, shingle, np.concatenate([first, [len(flat)]]), owner[order], classes, np.unique(flat[np.repeat(sizes <= EXACT, sizes)]))


def _fold_min(v: np.ndarray) -> np.ndarray:
    """Minima of neighbouring pairs."""
    if len(v) % 2:
        v = np.append(v, np.uint32(0xFFFFFFFF))
    return np.minimum(v[0::2], v[1::2])


def candidate_rows(h: np.ndarray, rows: np.ndarray, items: Items) -> np.ndarray:
    """Rows that share a window with an equal slot, or hold a shingle of a short item."""
    if not len(h) or not items.classes:
        return np.zeros(0, np.int64)
    marked = np.zeros(len(rows), np.int64)  # +1 where a run of candidate rows begins, -1 after it
    if len(items.short):
        at = np.searchsorted(items.short, h)
        at[at == len(items.short)] = 0
        held = np.searchsorted(rows, np.flatnonzero(items.short[at] == h), "right") - 1
        np.add.at(marked, held, 1)
        np.add.at(marked, held + 1, -1)
    x = (h >> np.uint64(32)).astype(np.uint32)
    for k in range(SLOTS):
        v, width = _slot(x, k), 1
        for bound, values, quick in items.classes:
            while width < bound:
                v = _fold_min(v)
                width *= 2
            window = np.minimum(v[:-1], v[1:]) if len(v) > 1 else v
            maybe = np.flatnonzero(quick[k][(window * np.uint32(0x9E3779B1)) >> np.uint32(16)])
            if not len(maybe):
                continue
            found = values[k]
            at = np.searchsorted(found, window[maybe])
            at[at == len(found)] = 0
            maybe = maybe[found[at] == window[maybe]]
            lo, hi = maybe * bound, np.minimum((maybe + 2) * bound, len(h))
            np.add.at(marked, np.searchsorted(rows, lo, "right") - 1, 1)
            np.add.at(marked, np.searchsorted(rows, hi, "left"), -1)
    return np.flatnonzero(np.cumsum(marked)[:-1] > 0)


def verify(h: np.ndarray, items: Items, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """(item, shared shingles) of the items that a document's shingles hold to the threshold."""
    at = np.searchsorted(items.shingle, h)
    at[at == len(items.shingle)] = 0
    met = np.unique(at[items.shingle[at] == h])
    if not len(met):
        return []
    parts = [items.owner[items.owner_at[m] : items.owner_at[m + 1]] for m in met.tolist()]
    shared = np.bincount(np.concatenate(parts), minlength=len(items.sizes))
    good = np.flatnonzero((shared > 0) & (shared >= threshold * items.sizes))
    return list(zip(good.tolist(), shared[good].tolist(), strict=True))


def flag(docs: DataFrame, benchmark: DataFrame, keep: tuple[str | Column, ...] = ("doc_id",), text: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns and ``leaks``: an array of (item_id, n_shared, n_item) for each document."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(item_text)), F.lit(0)).alias("n")).first()["n"]
    rounds = int(size // ROUND_BYTES) + 1
    inner = with_text(docs, text, keep, "leaks")
    names = inner.columns[1:]
    kind = benchmark.schema[item_id].dataType
    out = inner.withColumn("leaks", F.array().cast(f"array<struct<item_id:{kind.simpleString()},n_shared:bigint,n_item:bigint>>"))
    for r in range(rounds):
        part = benchmark.select(item_id, item_text).where(F.pmod(F.xxhash64(item_text), F.lit(rounds)) == r)
        rows = sorted((tuple(x) for x in part.collect()), key=lambda x: (x[0] is None, x[0]))
        out = _round(out, names, [x[0] for x in rows], prepare([x[1] for x in rows]), threshold)
    return out.select(*names, "leaks")


def _round(df: DataFrame, names: list[str], ids: list, items: Items, threshold: float) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast((ids, items))
    fields = df.schema.fields

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, items = shared.value
        for batch in batches:
            raw, bounds = text_bytes(batch.column(0))
            leaks = batch.column(len(names) + 1).to_pylist()
            for a, b in by_bytes(bounds, 1 << 20):
                h, rows = shingles(word_hashes(raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]))
                for i in candidate_rows(h, rows, items).tolist():
                    leaks[a + i] = leaks[a + i] + [{"item_id": ids[j], "n_shared": n, "n_item": int(items.sizes[j])} for j, n in verify(h[rows[i] : rows[i + 1]], items, threshold)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(leaks, batch.schema.field("leaks").type)], batch.schema.names)

    return map_arrow(df, work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields))
