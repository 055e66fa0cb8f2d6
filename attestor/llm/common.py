"""Shared pieces: Arrow maps with bounded batches, shared scratch tables, and a word-hash kernel.

The kernel turns UTF-8 text into one 64-bit hash per word with a handful of passes over the
bytes, so that no Python object is made per word.  Two different words share a hash with
probability near 2**-64, which the operators built on it take as identity.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass covers; bounds a worker's memory.
CHUNK_BYTES = 1 << 20
#: Rows in an Arrow batch; with texts of some KB a batch then stays at a few MB.
BATCH_ROWS = 500


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches small enough for long texts."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return df.mapInArrow(fn, schema)


class Scratch:
    """Written tables in the shared checkpoint folder; what a result reads stays until the session's JVM ends.

    The folder is the session's ``spark.checkpoint.dir``.  Only in local mode (one machine, as in
    tests) may it be unset; then one is made in the local temporary folder.
    """

    def __init__(self, spark: SparkSession):
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = f"file://{tempfile.gettempdir()}/attestor-checkpoints"
            spark.sparkContext.setCheckpointDir(base)
        self.spark, self.root, self.names = spark, f"{base.rstrip('/')}/scratch-{uuid.uuid4().hex}", set()
        jvm = spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.root)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it back: cuts lineage and survives the loss of executors."""
        path = f"{self.root}/{name}"
        self.names.add(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self.names.discard(name)
            _remove(self.spark, f"{self.root}/{name}")

    def keep_for(self, result: DataFrame, *names: str) -> DataFrame:
        """Remove all tables but the named ones, which ``result`` and what is derived from it read."""
        self.drop(*(self.names - set(names)))
        return result


def fresh(df: DataFrame, *names: str) -> str:
    """A column name made of the given ones that ``df`` doesn't have, whatever the case of letters."""
    taken, name = {c.lower() for c in df.columns}, "__" + "_".join(names)
    while name.lower() in taken:
        name += "_"
    return name


def with_text(df: DataFrame, text: str, keep: Iterable[str | Column], *made: str) -> DataFrame:
    """The text, then the kept columns; kept ones named as one that the operator makes are left out."""
    own = {c.lower() for c in made}
    inner = df.select(F.col(text).alias(fresh(df, "text")), *keep)
    return inner.drop(*(c for c in inner.columns[1:] if c.lower() in own))


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows end to end and the row bounds (n + 1); null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    bounds = np.frombuffer(off, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, in place where possible."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers() -> tuple[np.ndarray, np.ndarray]:
    p = 0x9E3779B97F4A7C15 | 1
    inv = pow(p, -1, 1 << 64)
    n = 2 * CHUNK_BYTES + 64
    up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
    for out, base in ((up, p), (down, inv)):
        out[0], size = 1, 1
        while size < n:
            step = min(size, n - size)
            out[size : size + step] = out[:step] * np.uint64(pow(base, size, 1 << 64))
            size += step
    return up, down


_POW: tuple[np.ndarray, np.ndarray] | None = None

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """Words of some rows: hashes, byte bounds in the rows' joined bytes, and each row's share."""

    __slots__ = ("ends", "hashes", "rows", "starts")

    def __init__(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray):
        self.hashes, self.starts, self.ends, self.rows = hashes, starts, ends, rows


def word_hashes(raw: np.ndarray, bounds: np.ndarray, space: np.ndarray = _SPACE, fold: np.ndarray = _LOWER, part: tuple[np.ndarray, np.ndarray] | None = None) -> Words:
    """Hash every word of every row.

    ``space`` flags the byte values that separate words, ``fold`` maps a byte to the one hashed
    (by default A-Z to a-z).  ``rows[i]:rows[i + 1]`` are the words of row i.  ``part`` gives two
    sets of byte values; a word also ends where one of the second follows one of the first.
    """
    global _POW
    if _POW is None:
        _POW = _powers()
    up, down = _POW
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    at, n = 0, len(raw)
    # Cuts fall on separators, or else on row bounds, so no word is split.
    while at < n:
        end = min(n, at + CHUNK_BYTES)
        if end < n:
            row_end = bounds[np.searchsorted(bounds, end, "right") - 1]
            if row_end > at:
                end = int(row_end)
            else:
                back = np.flatnonzero(space[raw[at:end]])
                if len(back):
                    end = at + int(back[-1]) + 1
                else:  # one word longer than a chunk
                    ahead = np.flatnonzero(space[raw[end : bounds[np.searchsorted(bounds, end, "left")]]])
                    end = end + int(ahead[0]) if len(ahead) else int(bounds[np.searchsorted(bounds, end, "left")])
        piece = raw[at:end]
        solid = ~space[piece]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        if part is not None:
            split = part[0][piece[:-1]] & part[1][piece[1:]]
            first[1:] |= split
            last[:-1] |= split
        lo, hi = np.searchsorted(bounds, at, "left"), np.searchsorted(bounds, end, "left")
        inner = bounds[lo:hi] - at
        inner = inner[(inner >= 0) & (inner < len(piece))]
        first[inner] = solid[inner]
        before = inner[inner > 0] - 1
        last[before] = solid[before]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        if len(s):
            if len(piece) + 1 > len(up):
                hashes = _long_words(fold[piece], s, e)
            else:
                total = np.empty(len(piece) + 1, np.uint64)
                total[0] = 0
                np.cumsum((fold[piece].astype(np.uint64) + np.uint64(1)) * up[: len(piece)], out=total[1:])
                hashes = mix64((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
            parts.append((hashes, s + at, e + at))
        at = end
    if parts:
        hashes, starts, ends = (np.concatenate(x) for x in zip(*parts, strict=True))
    else:
        hashes, starts, ends = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return Words(hashes, starts, ends, np.searchsorted(starts, bounds, "left"))


def _long_words(piece: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """The same hashes for pieces longer than the power table, word by word in blocks."""
    up, _ = _POW
    out = np.zeros(len(s), np.uint64)
    for i, (a, b) in enumerate(zip(s.tolist(), e.tolist(), strict=True)):
        total, scale = np.uint64(0), 1
        for k in range(a, b, CHUNK_BYTES):
            block = piece[k : min(b, k + CHUNK_BYTES)].astype(np.uint64) + np.uint64(1)
            part = int((block * up[: len(block)]).sum(dtype=np.uint64)) * scale
            total = np.uint64((int(total) + part) % (1 << 64))
            scale = scale * int(up[len(block)]) % (1 << 64)
        out[i] = np.uint64((int(total) + (b - a)) % (1 << 64))
    return mix64(out)


#: Multipliers of the words in a shingle; fixed odd 64-bit values.
_SHINGLE = [np.uint64(x | 1) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)]


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each row and the rows' bounds in them.

    A row with fewer words gives its whole sequence as one; a row without words gives none.
    """
    w, rows = words.hashes, words.rows
    n_words = np.diff(rows)
    count = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    out_rows = np.concatenate([[0], np.cumsum(count)])
    if len(w) == 0:
        return np.zeros(0, np.uint64), out_rows
    m = max(len(w) - size + 1, 0)
    full = np.zeros(m, np.uint64)
    for j in range(size):
        full += w[j : j + m] * (_SHINGLE[j % 5] + np.uint64(2 * (j // 5)))
    full = mix64(full)
    first = np.repeat(rows[:-1] - out_rows[:-1], count) + np.arange(out_rows[-1])
    short = (n_words > 0) & (n_words < size)
    if not short.any():
        return full[first], out_rows
    if m == 0:
        full = np.zeros(1, np.uint64)
    out = full[np.minimum(first, len(full) - 1)]
    for i in np.flatnonzero(short):
        h = int(n_words[i]) * 0x9E3779B97F4A7C15
        for j, x in enumerate(w[rows[i] : rows[i + 1]].tolist()):
            h += x * int(_SHINGLE[j % 5])
        out[out_rows[i]] = mix64(np.array([h % (1 << 64)], np.uint64))[0]
    return out, out_rows


def by_bytes(bounds: np.ndarray, most: int = 4 * CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each, one row at least."""
    at, n = 0, len(bounds) - 1
    while at < n:
        end = int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end
        at = end


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every run, end to end."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    skip = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    return skip + np.arange(total)


def binary(rows: Iterable[bytes | None]) -> pa.Array:
    return pa.array(list(rows), pa.binary())
