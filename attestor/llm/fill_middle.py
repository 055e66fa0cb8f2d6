"""Fill-in-middle samples: a text is cut at two line ends and its middle moved to the end.

Line ends are bits over the bytes of many texts at once, packed into 64-bit words under a directory of
popcounts by block of 512 bits.  The popcount of a text's span is its number n of lines; two ranks
0..n come from a hash of the id, and ``select`` turns them into byte cuts, so no list of lines is made.
A second vector, of the bytes that begin a code point, gives lengths in code points by ``rank``.

Text, n and id decide the result alone, so rows that occur twice give equal results.  A null text counts
as empty; a null id hashes as an empty one.  Texts of any length are taken whole (a batch holds some MB or
one text), an empty table gives an empty result.  Kept columns named as one that is made here are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.llm.common import by_bytes, fresh, map_arrow, text_bytes, with_text

#: Marks before prefix, suffix and middle.  A text that holds one stays as it is.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MADE = ("n", "form", "prefix_chars", "middle_chars", "output")

_WORDS = 8  # 64-bit words in a block
_BLOCK = 64 * _WORDS


class BitVector:
    """A packed bit vector with rank and select, both over whole arrays of arguments."""

    def __init__(self, flags: np.ndarray):
        blocks = len(flags) // _BLOCK + 1
        packed = np.zeros(blocks * _BLOCK // 8, np.uint8)
        bits = np.packbits(flags, bitorder="little")
        packed[: len(bits)] = bits
        self.words = packed.view("<u8").reshape(blocks, _WORDS)
        ends = np.cumsum(np.bitwise_count(self.words), axis=1, dtype=np.int64)
        self.within = ends - np.bitwise_count(self.words)
        self.before = np.concatenate([[0], np.cumsum(ends[:, -1])])

    def __len__(self) -> int:
        """Number of ones."""
        return int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block, word, bit = at // _BLOCK, at // 64 % _WORDS, (at % 64).astype(np.uint64)
        below = self.words[block, word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[block] + self.within[block, word] + np.bitwise_count(below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Position of each k-th one, counted from 0."""
        block = np.searchsorted(self.before, k, "right") - 1
        left = k - self.before[block]
        word = (self.within[block] <= left[:, None]).sum(axis=1) - 1
        left = left - self.within[block, word]
        bits = np.unpackbits(self.words[block, word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        inside = (np.cumsum(bits, axis=1, dtype=np.int64) > left[:, None]).argmax(axis=1)
        return block * _BLOCK + word * 64 + inside


def line_ends(raw: np.ndarray, bounds: np.ndarray) -> BitVector:
    """Ones at line feeds and at the last byte of every text."""
    flags = raw == 0x0A
    flags[bounds[1:][np.diff(bounds) > 0] - 1] = True
    return BitVector(flags)


def cuts(ends: BitVector, bounds: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of every text and the bytes after which its prefix and its middle end."""
    base = ends.rank(bounds)
    n = np.diff(base)
    one, two = h1 % (n + 1), h2 % (n + 1)

    def cut(units: np.ndarray) -> np.ndarray:
        out = bounds[:-1].copy()
        some = units > 0
        out[some] = ends.select(base[:-1][some] + units[some] - 1) + 1
        return out

    return n, cut(np.minimum(one, two)), cut(np.maximum(one, two))


def transform(
    docs: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50,
    id_column: str = "doc_id", text: str = "text", keep: Iterable[str | Column] = ("doc_id",),
) -> DataFrame:
    """The kept columns, n, form (plain, psm or spm), prefix_chars, middle_chars and output.

    ``percent`` of the texts are rearranged, ``spm_percent`` of these with the suffix first.  The draws are
    the first four 32-bit groups of the SHA-256 of ``seed:id``.
    """
    draws = fresh(docs, "draws")
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(docs[id_column].cast("string"), F.lit(""))).cast("binary"), 256)
    parts = F.array(*(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)))
    rows = with_text(docs.withColumn(draws, parts), text, [*keep, F.col(draws)], *MADE)
    kept = rows.schema.fields[1:-1]
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, s, m = marks
        for batch in batches:
            raw, bounds = text_bytes(batch.column(0))
            h = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
            for a, b in by_bytes(bounds):
                piece, at, own = raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], h[a:b]
                ends, heads = line_ends(piece, at), BitVector((piece & 0xC0) != 0x80)
                n, first, second = cuts(ends, at, own[:, 0], own[:, 1])
                chars = [(heads.rank(y) - heads.rank(x)).tolist() for x, y in ((at[:-1], first), (first, second))]
                forms, out = [], []
                data = piece.tobytes()
                for i, (start, c1, c2, end) in enumerate(zip(at[:-1].tolist(), first.tolist(), second.tolist(), at[1:].tolist(), strict=True)):
                    whole = data[start:end]
                    if not whole or own[i, 2] % 100 >= percent or any(x in whole for x in marks):
                        forms.append("plain"), out.append(whole)
                    elif own[i, 3] % 100 < spm_percent:
                        forms.append("spm"), out.append(b"".join((s, data[c2:end], p, data[start:c1], m, data[c1:c2])))
                    else:
                        forms.append("psm"), out.append(b"".join((p, data[start:c1], s, data[c2:end], m, data[c1:c2])))
                moved = [f != "plain" for f in forms]
                lengths = [pa.array([x if y else None for x, y in zip(c, moved, strict=True)], pa.int64()) for c in chars]
                rest = [batch.column(1 + j).slice(a, b - a) for j in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(n, pa.int64()), pa.array(forms, pa.string()), *lengths, pa.array(out, pa.binary()).cast(pa.string())], [*(f"c{j}" for j in range(len(kept))), *MADE])

    plain = rows.toDF("text", *(f"c{j}" for j in range(len(kept))), "draws")
    schema = ", ".join([*(f"c{j} {f.dataType.simpleString()}" for j, f in enumerate(kept)), "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"])
    return map_arrow(plain, work, schema).toDF(*(f.name for f in kept), *MADE)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The original text, of an output and its form.

    The marks are not in the text, and none can arise where a part meets one, so the first of each is the one that was set.
    """
    out, kind = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    between = F.when(kind == "psm", F.instr(out, SUFFIX)).otherwise(F.instr(out, PREFIX))
    last = F.instr(out, MIDDLE)
    head = F.substr(out, F.lit(len(PREFIX) + 1), between - len(PREFIX) - 1)
    tail = F.substr(out, between + len(SUFFIX), last - between - len(SUFFIX))
    middle = F.substr(out, last + len(MIDDLE))
    return F.when(kind == "psm", F.concat(head, middle, tail)).when(kind == "spm", F.concat(tail, middle, head)).otherwise(out)
