"""Token-id output compressed by Re-Pair grammars, with random access.

Texts are sorted by id over the whole table and encoded; each shard (a range of ids) is written as
blocks of about ``BLOCK_TOKENS`` ids.  A block repeatedly replaces its frequent adjacent pairs by
nonterminals and stores the rules, every nonterminal's expansion length and the running number of
ids at every ``STEP``-th symbol, so that any range of ids is decoded without the rest.

File format: a Parquet table (shard, block, doc_ids, doc_tokens, payload); the payload is
little-endian: magic ``RPR1``, uint32 width of a symbol, alphabet size, rules, symbols, steps, then
uint32 pairs of the rules, uint32 expansion lengths, uint64 ids before each step, and the symbols.

Nulls count as empty text (the end id alone); null ids sort first; rows with equal ids are put in
order of their text's hash.  A document is never split; an empty table gives an empty file.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestor.llm.common import _LOWER, map_arrow, ragged, text_bytes, word_hashes

#: Ids in a block; symbols between two stored positions.
BLOCK_TOKENS, STEP = 1 << 20, 1024
#: Rounds of replacement, pairs replaced in a round, and the fewest times such a pair occurs.
ROUNDS, PAIRS, LEAST = 8, 4096, 6
#: Words whose ids a worker remembers.
REMEMBERED = 500_000


# --- grammar ---------------------------------------------------------------------------------


def compress(ids: np.ndarray, alphabet: int, rounds: int = ROUNDS, pairs: int = PAIRS, least: int = LEAST) -> bytes:
    """Re-Pair: in every round the most frequent adjacent pairs each become a nonterminal."""
    seq = ids.astype(np.uint32)
    width = 2 if alphabet <= 1 << 15 or alphabet + 1024 <= 1 << 16 else 4
    room = (1 << 16) - alphabet if width == 2 else 1 << 20
    pairs = min(pairs, 1 << 24)
    left, right = np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    lengths = np.ones(alphabet, np.uint32)
    for _ in range(rounds):
        if len(seq) < 2 or room <= len(left):
            break
        # Sorting (pair, place) brings the places of each pair together.
        if width == 2:
            packed = (((seq[:-1].astype(np.uint64) << np.uint64(16)) | seq[1:]) << np.uint64(32)) | np.arange(len(seq) - 1, dtype=np.uint64)
            packed.sort()
            key, where = (packed >> np.uint64(32)).astype(np.uint32), packed.astype(np.uint32)
            half, low = np.uint32(16), np.uint32(0xFFFF)
        else:
            key = (seq[:-1].astype(np.uint64) << np.uint64(32)) | seq[1:]
            where = np.argsort(key, kind="stable")
            key = key[where]
            half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.concatenate([edge, [len(key)]]))
        often = np.flatnonzero(count >= least)
        if not len(often):
            break
        take = min(pairs, room - len(left))
        if len(often) > take:
            often = often[np.argsort(-count[often], kind="stable")[:take]]
        count, edge = count[often], edge[often]
        pair = key[edge]
        # Where places overlap, every second one of the run is replaced.
        chosen = (where[ragged(edge, count)].astype(np.uint64) << np.uint64(24)) | np.repeat(np.arange(len(often), dtype=np.uint64), count)
        chosen.sort()
        place = (chosen >> np.uint64(24)).astype(np.int64)
        run = np.flatnonzero(np.concatenate([[True], np.diff(place) != 1]))
        parity = (np.arange(len(place)) - np.repeat(run, np.diff(np.concatenate([run, [len(place)]])))) & 1
        place, at = place[parity == 0], (chosen[parity == 0] & np.uint64(0xFFFFFF)).astype(np.int64)
        used = np.bincount(at, minlength=len(often)) > 0
        number, pair = (np.cumsum(used) - 1)[at], pair[used]
        a, b = (pair >> half).astype(np.uint32), (pair & low).astype(np.uint32)
        before = len(seq)
        seq[place] = (alphabet + len(left) + number).astype(np.uint32)
        stay = np.ones(len(seq), bool)
        stay[place + 1] = False
        seq = seq[stay]
        lengths = np.concatenate([lengths, lengths[a] + lengths[b]])
        left, right = np.concatenate([left, a]), np.concatenate([right, b])
        if before - len(seq) < before // 200:
            break
    ends = np.cumsum(lengths[seq], dtype=np.uint64)
    steps = np.concatenate([np.zeros(1, np.uint64), ends])[::STEP] if len(seq) else np.zeros(1, np.uint64)
    head = struct.pack("<4s5I", b"RPR1", width, alphabet, len(left), len(seq), len(steps))
    return b"".join([head, np.stack([left, right], 1).astype("<u4").tobytes(), lengths[alphabet:].astype("<u4").tobytes(), steps.astype("<u8").tobytes(), seq.astype(f"<u{width}").tobytes()])


class Block:
    """A payload opened for random access."""

    def __init__(self, payload: bytes):
        magic, width, self.alphabet, rules, symbols, steps = struct.unpack_from("<4s5I", payload)
        if magic != b"RPR1":
            raise ValueError("not a grammar block")
        at = struct.calcsize("<4s5I")
        self.rules = np.frombuffer(payload, "<u4", 2 * rules, at).reshape(-1, 2).astype(np.int64)
        at += 8 * rules
        self.lengths = np.concatenate([np.ones(self.alphabet, np.int64), np.frombuffer(payload, "<u4", rules, at).astype(np.int64)])
        at += 4 * rules
        self.steps = np.frombuffer(payload, "<u8", steps, at).astype(np.int64)
        at += 8 * steps
        self.symbols = np.frombuffer(payload, f"<u{width}", symbols, at).astype(np.int64)
        self.offsets, self.flat = self._expansions()

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each symbol's ids lie in one flat array; rules are filled in by their depth."""
        n = self.alphabet
        offsets = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        flat = np.empty(int(self.lengths.sum()), np.uint32)
        flat[:n] = np.arange(n)
        done = 0
        while done < len(self.rules):  # rules refer to earlier ones only
            ahead = self.rules[done:].max(1) >= n + done
            end = done + (int(np.argmax(ahead)) if ahead.any() else len(ahead))
            parts = self.rules[done:end].ravel()
            to = offsets[n + done]
            made = flat[ragged(offsets[parts], self.lengths[parts])]
            flat[to : to + len(made)] = made
            done = end
        return offsets, flat

    def __len__(self) -> int:
        return int(self.lengths[self.symbols].sum())

    def all(self) -> np.ndarray:
        return self.flat[ragged(self.offsets[self.symbols], self.lengths[self.symbols])]

    def range(self, begin: int, end: int) -> np.ndarray:
        """Ids begin..end, decoding only the symbols that cover them."""
        if end <= begin:
            return np.zeros(0, np.uint32)
        first = (int(np.searchsorted(self.steps, begin, "right")) - 1) * STEP
        base, parts = int(self.steps[first // STEP]), []
        at, have = first, base
        while have < end and at < len(self.symbols):
            part = self.symbols[at : at + STEP]
            parts.append(self.flat[ragged(self.offsets[part], self.lengths[part])])
            have += len(parts[-1])
            at += STEP
        return np.concatenate(parts)[begin - base : end - base]


# --- encoding --------------------------------------------------------------------------------

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in '!"#$%&()*+,-./:;=?@[]^_{|}~']] = True
_AS_IS = np.arange(256, dtype=np.uint8)


class WordEncoder:
    """Encodes texts word by word, remembering the ids of words met before.

    Exact where the tokenizer's normaliser and pre-tokenizer never look across white space, or
    across a letter followed by a mark; ``independent`` checks that the tokenizer is of that kind
    and otherwise every text is encoded in one piece.
    """

    def __init__(self, path: str, json_text: str | None = None):
        import json

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        text = json_text if json_text is not None else open(path, encoding="utf-8").read()
        self.tok = Tokenizer.from_str(text)
        self.model = self.tok.model
        spec = json.loads(text)
        self.independent = self._independent(spec)
        self.marks = _MARK.copy()  # but for what special tokens are made of
        for t in spec.get("added_tokens", []):
            self.marks[np.frombuffer(t["content"].encode(), np.uint8)] = False
        self.size = self.tok.get_vocab_size()
        self._forget()

    @staticmethod
    def _independent(spec: dict) -> bool:
        kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        words = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed value: the pattern known to be safe
        return kinds == ["NFC", "Replace", "Lowercase"] and bool(pre) and pre[0].get("pattern", {}).get("Regex") == words and all(not (t["lstrip"] or t["rstrip"]) for t in spec.get("added_tokens", []))

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.store: list[np.ndarray] = []
        self.flat, self.starts, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, words: list[str], keys: list[int]) -> None:
        """Ids of new words: plain lower-case letters go to the model alone, the rest through all steps."""
        tokenize = self.model.tokenize
        plain = [w.isascii() and w.isalpha() for w in words]
        ids = [[t.id for t in tokenize(w.lower())] if p else [] for w, p in zip(words, plain, strict=True)]
        rest = [i for i, p in enumerate(plain) if not p]
        for i, e in zip(rest, self.tok.encode_batch([words[i] for i in rest], add_special_tokens=False), strict=True):
            ids[i] = e.ids
        for k in keys:
            self.known[k] = len(self.known)
        counts = np.array([len(x) for x in ids], np.int64)
        flat = np.array([t for x in ids for t in x], np.uint32)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
        self.counts, self.flat = np.concatenate([self.counts, counts]), np.concatenate([self.flat, flat])

    def encode(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, and the rows' bounds in them."""
        if not self.independent:
            ids = [np.array(self.tok.encode(raw[a:b].tobytes().decode(), add_special_tokens=False).ids, np.uint32) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            return np.concatenate([np.zeros(0, np.uint32), *ids]), np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        # A combining mark can make upper and lower case differ; such texts are hashed as they are.
        marks = bool(((raw == 0xCC) | (raw == 0xCD)).any())
        words = word_hashes(raw, bounds, fold=_AS_IS if marks else _LOWER, part=(_LETTER, self.marks))
        codes, unique = pd.factorize(words.hashes)
        if len(self.known) > REMEMBERED:
            self._forget()
        first = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1)) if len(codes) else np.zeros(0, np.int64)
        keys = unique.tolist()
        get = self.known.get
        slots = [get(k, -1) for k in keys]
        new = [i for i, s in enumerate(slots) if s < 0]
        if new:
            starts, ends = words.starts[first[new]].tolist(), words.ends[first[new]].tolist()
            data = raw.tobytes()
            self._learn([data[a:b].decode() for a, b in zip(starts, ends, strict=True)], [keys[i] for i in new])
            for i in new:
                slots[i] = self.known[keys[i]]
        slot = np.array(slots, np.int64)[codes] if len(codes) else np.zeros(0, np.int64)
        counts = self.counts[slot]
        ids = self.flat[ragged(self.starts[slot], counts)]
        return ids, np.concatenate([[0], np.cumsum(counts)])[words.rows]


_ENCODERS: dict[int, WordEncoder] = {}


def encoder(json_text: str) -> WordEncoder:
    key = hash(json_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder("", json_text)
    return _ENCODERS[key]


# --- files -----------------------------------------------------------------------------------


def write(df: DataFrame, path: str, tokenizer_json: str, end_id: int, id_column: str = "doc_id", text_column: str = "text", block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode, sort by id and write the blocks; ``end_id`` follows every document."""
    shared = df.sparkSession.sparkContext.broadcast(tokenizer_json)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        context = TaskContext.get()
        shard = context.partitionId() if context else 0
        alphabet = max(enc.size, end_id + 1)
        ids: list = []
        counts: list[np.ndarray] = []
        tokens: list[np.ndarray] = []
        held, block = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, block
            sizes = np.concatenate(counts)
            out = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([ids], pa.list_(id_type)), pa.array([sizes.tolist()], pa.list_(pa.int64())), pa.array([compress(np.concatenate(tokens), alphabet)], pa.binary())],
                ["shard", "block", "doc_ids", "doc_tokens", "payload"],
            )
            ids.clear(), counts.clear(), tokens.clear()
            held, block = 0, block + 1
            return out

        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            raw, bounds = text_bytes(batch.column(1))
            body, at = enc.encode(raw, bounds)
            size = np.diff(at) + 1
            whole = np.full(int(size.sum()), end_id, np.uint32)
            whole[np.arange(len(body)) + np.repeat(np.arange(len(size)), np.diff(at))] = body
            ids += batch.column(0).to_pylist()
            counts.append(size)
            tokens.append(whole)
            held += len(whole)
            if held >= block_tokens:
                yield flush()
        if ids:
            yield flush()

    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"))
    map_arrow(ordered, work, f"shard int, block int, doc_ids array<{kind}>, doc_tokens array<bigint>, payload binary").write.mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """Every document of the files: id, start, n_tokens and ids (binary, little-endian uint32)."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    sizes = files.select("shard", "block", F.aggregate("doc_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"))
    # Running sums over blocks of a shard, then over shards: one row for each shard meets in one task.
    inner = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    within = sizes.withColumn("in_shard", F.coalesce(F.sum("n").over(inner), F.lit(0)))
    outer = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.groupBy("shard").agg(F.sum("n").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(outer), F.lit(0))).drop("n")
    starts = within.join(before, "shard").select("shard", "block", (F.col("in_shard") + F.col("before")).alias("begin"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins = batch.column(3).to_pylist()
            for i in range(batch.num_rows):
                ids = batch.column(0)[i].values
                sizes = np.asarray(batch.column(1)[i].values, np.int64)
                tokens = Block(batch.column(2)[i].as_buffer()).all().astype("<u4", copy=False)
                at = np.concatenate([[0], np.cumsum(sizes)])
                data, lo = tokens.tobytes(), 0
                while lo < len(sizes):  # batches of some MB
                    hi = max(lo + 1, int(np.searchsorted(at, at[lo] + (1 << 20), "right")) - 1)
                    packed = [data[4 * a : 4 * b] for a, b in zip(at[lo:hi].tolist(), at[lo + 1 : hi + 1].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([ids[lo:hi], pa.array(begins[i] + at[lo:hi]), pa.array(sizes[lo:hi]), pa.array(packed, pa.binary())], ["id", "start", "n_tokens", "ids"])
                    lo = hi

    joined = files.join(F.broadcast(starts) if files.rdd.getNumPartitions() < 10_000 else starts, ["shard", "block"]).select("doc_ids", "doc_tokens", "payload", "begin")
    return map_arrow(joined, work, f"id {kind}, start bigint, n_tokens bigint, ids binary").withColumnRenamed("id", id_column)
