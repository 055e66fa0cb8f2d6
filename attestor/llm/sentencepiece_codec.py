"""SentencePiece encoding that keeps offsets, and decoding.

The model's compiled character map (a double-array trie and its replacement texts) is applied by
longest prefix, as the library does, and records from which source bytes every normalised byte
comes.  The library turns the text into ids; the ids' piece lengths tile the normalised text, and
the recorded alignment projects each piece to the span of original bytes it stands for.  If a
tiling does not cover the normalised text exactly, the row's spans are null: spans are never guessed,
and no row ends a job.

Nulls count as empty text; an empty text gives only the begin and end ids.  Texts of any length are
taken whole, repeated rows are encoded alike, and an empty table gives no rows.  Of the input's columns
only the id is returned.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestor.llm.common import map_arrow, text_bytes

_META = b"\xe2\x96\x81"  # the visible stand-in for a space


class CharMap:
    """A compiled character map: uint32 length of the trie, the trie's units, then the texts."""

    def __init__(self, blob: bytes):
        self.units: list[int] = []
        self.texts = b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = list(struct.unpack_from(f"<{size // 4}I", blob, 4))
            self.texts = blob[4 + size :]
        self.heads = self._heads()

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _heads(self) -> np.ndarray:
        """Byte values that some key begins with."""
        out = np.zeros(256, bool)
        if self.units:
            root = self._offset(self.units[0])
            for b in range(1, 256):
                i = root ^ b
                out[b] = i < len(self.units) and (self.units[i] & 0x800000FF) == b
        return out

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """The longest key at a position: bytes it takes and their replacement."""
        units, found = self.units, None
        if not units:
            return None
        node = self._offset(units[0])
        for k in range(at, len(data)):
            node ^= data[k]
            unit = units[node] if node < len(units) else 0
            if not data[k] or (unit & 0x800000FF) != data[k]:
                break
            node ^= self._offset(unit)
            if unit & 0x100:
                value = units[node] & 0x7FFFFFFF
                found = (k + 1 - at, value)
        if found is None:
            return None
        return found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])]


class Normalizer:
    """The library's normalisation with a source position for every byte made."""

    def __init__(self, charmap: bytes, dummy_prefix: bool, squeeze: bool, escape: bool, suffix: bool = False, symbols: tuple[bytes, ...] = ()):
        self.map = CharMap(charmap)
        self.dummy, self.squeeze, self.escape, self.suffix = dummy_prefix, squeeze, escape, suffix
        self.symbols = sorted(symbols, key=len, reverse=True)

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them and the end the source position (n + 1)."""
        if not data:
            return b"", np.zeros(1, np.int64)
        if not self.map.units and not self.squeeze and not self.symbols:
            return self._plain(data)
        return self._mapped(data)

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """No map, no squeezing: only the prefix and the stand-in for spaces."""
        mark = _META if self.escape else b" "
        raw = np.frombuffer(data, np.uint8)
        width = np.where(raw == 0x20, len(mark), 1)
        source = np.repeat(np.arange(len(raw)), width)
        out = data.replace(b" ", mark)
        if self.dummy and not self.suffix:
            out, source = mark + out, np.concatenate([np.zeros(len(mark), np.int64), source])
        elif self.dummy:
            out, source = out + mark, np.concatenate([source, np.full(len(mark), len(raw))])
        return out, np.concatenate([source, [len(raw)]])

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        mark = _META if self.escape else b" "
        out, source = bytearray(), []
        heads, n = self.map.heads, len(data)

        def prefix(at: int) -> tuple[int, bytes]:
            for s in self.symbols:
                if data.startswith(s, at):
                    return len(s), s
            if heads[data[at]] and (hit := self.map.longest(data, at)):
                return hit
            b = data[at]
            size = 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            return size, data[at : at + size]

        at = 0
        if self.squeeze:
            while at < n:
                size, made = prefix(at)
                if made != b" ":
                    break
                at += size
            if at == n:
                return b"", np.full(1, n)
        if self.dummy and not self.suffix:
            out += mark
            source += [at] * len(mark)
        previous = self.squeeze
        while at < n:
            size, made = prefix(at)
            if previous:
                made = made.lstrip(b" ")
            if made:
                shown = made.replace(b" ", mark)
                out += shown
                source += [at] * len(shown)
                previous = self.squeeze and made.endswith(b" ")
            at += size
        end = n
        if self.squeeze:
            while out.endswith(mark):
                end = source[len(out) - len(mark)]
                del out[-len(mark) :]
                del source[len(out) :]
        if self.dummy and self.suffix:
            out += mark
            source += [end] * len(mark)
        return bytes(out), np.array([*source, end], np.int64)


class Codec:
    """A model with its normaliser and the lengths of its pieces."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        spec = proto.ModelProto()
        spec.ParseFromString(model)
        kinds = proto.ModelProto.SentencePiece
        own = tuple(p.piece.encode() for p in spec.pieces if p.type == kinds.USER_DEFINED)
        n = spec.normalizer_spec
        self.normalize = Normalizer(n.precompiled_charsmap, n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces, spec.trainer_spec.treat_whitespace_as_suffix, own)
        self.lengths = np.array([1 if p.type == kinds.BYTE else 0 if p.type == kinds.CONTROL else len(p.piece.encode()) for p in spec.pieces], np.int64)
        self.unknown = self.lib.unk_id()

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode(text), "<u4")

    def spans(self, text: str, ids: np.ndarray) -> np.ndarray | None:
        """For each piece the original bytes [begin, end) it stands for, as an (n, 2) array; None if the pieces don't fit."""
        normal, source = self.normalize(text.encode())
        sizes = self.lengths[ids]
        if (ids == self.unknown).any():
            sizes = np.array([len(p.encode()) for p in self.lib.encode(text, out_type=str)], np.int64)
        ends = np.cumsum(sizes)
        if (int(ends[-1]) if len(ends) else 0) != len(normal):
            return None
        return np.stack([source[ends - sizes], source[ends]], 1).astype("<u4")


_CODECS: dict[bytes, Codec] = {}


def codec(model: bytes) -> Codec:
    """One codec per worker and model."""
    key = hashlib.blake2b(model).digest()
    if key not in _CODECS:
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def encode_decode(df: DataFrame, model: bytes, id_column: str = "doc_id", text_column: str = "text", with_spans: bool = True) -> DataFrame:
    """Encode every text with begin and end ids, project its pieces, and decode it again.

    Returns ``id_column``, ``ids`` (binary: little-endian uint32 ids), ``spans`` (binary: begin and
    end byte of each id in the original UTF-8 text, uint32 each; begin and end ids get empty
    spans) and ``decoded`` (what the library decodes from the ids).
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        first, last = np.array([c.lib.bos_id()], "<u4"), np.array([c.lib.eos_id()], "<u4")
        for batch in batches:
            ids, spans, decoded = [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                body = c.encode(text)
                if with_spans:
                    inner = c.spans(text, body)
                    close = np.array([[inner[-1, 1] if inner is not None and len(inner) else 0] * 2], "<u4")
                    spans.append(None if inner is None else np.concatenate([np.zeros((1, 2), "<u4"), inner, close]).tobytes())
                whole = np.concatenate([first, body, last])
                ids.append(whole.tobytes())
                decoded.append(c.lib.decode(whole.tolist()))
            columns = [batch.column(0), pa.array(ids, pa.binary())]
            columns += [pa.array(spans, pa.binary())] * with_spans + [pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "ids", *["spans"] * with_spans, "decoded"])

    kind = df.schema[id_column].dataType.simpleString()
    out = map_arrow(df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")), work, f"id {kind}, ids binary, {'spans binary, ' * with_spans}decoded string")
    return out.withColumnRenamed("id", id_column)


def unpack(data: bytes) -> np.ndarray:
    """Ids of a packed column."""
    return np.frombuffer(data, "<u4")
