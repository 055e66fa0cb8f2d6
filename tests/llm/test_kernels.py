"""Word hashes, grammar compression, offsets: exact against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from attestor.llm import common, repair_output, sentencepiece_codec

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.mark.parametrize("chunk", [16, 64, 1 << 20])
def test_word_hashes(monkeypatch, chunk):
    monkeypatch.setattr(common, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(common, "_POW", None)
    r = random.Random(3)
    docs = ["".join(r.choice(["a", "B", "é", " ", "\n", "c" * 30, "\x0b", "日"]) for _ in range(r.randint(0, 40))) for _ in range(200)] + [None, ""]
    raw, bounds = common.text_bytes(pa.array(docs))
    words, known = common.word_hashes(raw, bounds), {}
    for i, d in enumerate(docs):
        want = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in d or ""))
        got = words.hashes[words.rows[i] : words.rows[i + 1]].tolist()
        assert len(want) == len(got)
        assert all(known.setdefault(w, h) == h for w, h in zip(want, got, strict=True))
    assert len(set(known.values())) == len(known)
    h, rows = common.shingles(words)
    assert [min(n, 1) if n < 5 else n - 4 for n in np.diff(words.rows).tolist()] == np.diff(rows).tolist()
    assert len(h) == rows[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=300), st.integers(2, 4), st.sampled_from([6, 70_000]))
def test_grammar_round_trip(ids, least, alphabet):
    block = repair_output.Block(repair_output.compress(np.array(ids, np.uint32), alphabet, least=least))
    assert block.all().tolist() == ids
    assert len(block) == len(ids)
    for a in range(0, len(ids), 37):
        assert block.range(a, a + 50).tolist() == ids[a : a + 50]


def test_grammar_shrinks_and_reads_at_random():
    r = np.random.default_rng(1)
    phrases = [r.integers(0, 1000, 7) for _ in range(20)]
    ids = np.concatenate([phrases[i] for i in r.integers(0, 20, 3000)]).astype(np.uint32)
    payload = repair_output.compress(ids, 1000)
    assert len(payload) < len(ids)
    block = repair_output.Block(payload)
    for a in r.integers(0, len(ids) - 100, 50).tolist():
        assert (block.range(a, a + 100) == ids[a : a + 100]).all()


def test_words_encode_as_whole_texts_do():
    enc = repair_output.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    assert enc.independent
    r = random.Random(2)
    parts = ["a", "B", "Th", "the", "é", "J̌", " ", "\n", ".", ",", "'s", "'", "日", "١", "5", "<|startoftext|>", "#", " ", "​", "İ", "ß", "K", "\x85", "\x0b", "-", "S'", "|"]
    for _ in range(30):
        docs = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(40)] + ["", None]
        raw, bounds = common.text_bytes(pa.array(docs))
        ids, at = enc.encode(raw, bounds)
        for i, d in enumerate(docs):
            assert ids[at[i] : at[i + 1]].tolist() == enc.tok.encode(d or "", add_special_tokens=False).ids


def test_other_tokenizers_encode_in_one_piece():
    enc = repair_output.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not enc.independent
    raw, bounds = common.text_bytes(pa.array(["Hello  world", "", "x"]))
    ids, at = enc.encode(raw, bounds)
    assert ids[at[0] : at[1]].tolist() == enc.tok.encode("Hello  world", add_special_tokens=False).ids


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nmt_nfkc_cf", "nfkc_cf", "identity"])
def test_normaliser_follows_the_library(rule):
    import sentencepiece as spm
    from sentencepiece import sentencepiece_model_pb2 as proto

    r = random.Random(1)
    parts = ["a", "B", "  ", " ", "ﬁ", "①", "ｶﾞ", "が", "é", "é", "\t", "\n", "　", "한", "㍿", "​", "Å", "日", "­", "ß"]
    for escape, dummy, squeeze in ((True, True, True), (True, True, False), (False, False, True), (True, False, True)):
        lib = spm.SentencePieceNormalizer(rule_name=rule, escape_whitespaces=escape, add_dummy_prefix=dummy, remove_extra_whitespaces=squeeze)
        spec = proto.ModelProto()
        spec.ParseFromString(lib.serialized_model_proto())
        own = sentencepiece_codec.Normalizer(spec.normalizer_spec.precompiled_charsmap, dummy, squeeze, escape)
        for _ in range(120):
            text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
            out, source = own(text.encode())
            assert out.decode() == lib.normalize(text)
            assert len(source) == len(out) + 1
            assert (np.diff(source) >= 0).all()


def test_pieces_lie_on_their_bytes():
    codec = sentencepiece_codec.Codec(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    for text in ["", "  hello  world ", "日本語 テスト\n\n", "🙂 é", "\x00a\x00 ", "▁x ▁", "a\tb"]:
        data, ids = text.encode(), codec.encode(text)
        spans = codec.spans(text, ids)
        assert b"".join(data[a:b] for a, b in spans) == data
        for i, (a, b) in zip(ids.tolist(), spans.tolist(), strict=True):
            piece = codec.lib.id_to_piece(i)
            if not codec.lib.is_byte(i):
                assert data[a:b].decode().replace(" ", "▁") in (piece, piece[1:])


def test_codec_table(spark):
    model = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
    texts = ["Hello world", None, "", "a" * 5000, "日 " * 300]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    codec = sentencepiece_codec.Codec(model)
    for r in sentencepiece_codec.encode_decode(df, model).collect():
        want = [1, *codec.lib.encode(texts[r["doc_id"]] or ""), 2]
        assert sentencepiece_codec.unpack(r["ids"]).tolist() == want
        assert r["decoded"] == codec.lib.decode(want)
        assert len(r["spans"]) == 2 * len(r["ids"])


def test_files_round_trip(spark, tmp_path):
    texts = {3: "Hello, world. Hello, world.", 1: None, 2: "", 9: "x " * 4000, 5: "İstanbul’s K"}
    df = spark.createDataFrame([(k, v, "e") for k, v in texts.items()], "doc_id long, text string, id string").repartition(3)
    json_text = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    repair_output.write(df, f"file://{tmp_path}/f", json_text, 2, block_tokens=64)
    tok = repair_output.WordEncoder("", json_text).tok
    at = 0
    rows = repair_output.read(spark, f"file://{tmp_path}/f").orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == sorted(texts)
    for r in rows:
        want = [*tok.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 2]
        assert np.frombuffer(r["ids"], "<u4").tolist() == want
        assert (r["start"], r["n_tokens"]) == (at, len(want))
        at += len(want)
    repair_output.write(df.where("false"), f"file://{tmp_path}/empty", json_text, 2)
    assert repair_output.read(spark, f"file://{tmp_path}/empty").collect() == []


def test_copies_of_queries_are_never_broadcast(spark, monkeypatch):
    """Queries go to a bounded number of groups, several blocks in each, and not through the driver."""
    from attestor.llm import exact_topk

    rng = np.random.default_rng(4)
    vectors = rng.integers(-9, 9, (60, 3)).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(exact_topk, "BLOCK", 4)
    monkeypatch.setattr(exact_topk, "GROUPS", 3)
    out = exact_topk.search(df, is_query=F.col("id") % 5 == 0, k=2, scale=1)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    product = (vectors @ vectors.T).astype(int)
    want = [(q, rank + 1, i, int(product[q, i])) for q in range(0, 60, 5) for rank, i in enumerate(sorted((i for i in range(60) if i != q), key=lambda i: (-product[q, i], i))[:2])]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect()) == want
