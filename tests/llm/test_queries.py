"""Every registered query on whole small tables: contracts by brute force, awkward rows, empty tables."""

import hashlib
import math
import os
import struct
import zlib

import pytest

from attestor.llm import queries
from test_conversation_repair import ROLES, damaged
from test_conversation_repair import plain as plain_repair
from test_fill_middle import plain
from test_html_extraction import CASES
from test_jaccard_join import brute
from test_text_operators import plain_base

SF = "/root/testdata/sf0.001"
TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "embeddings": "vec_id long, embedding array<float>",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn long, role string, text string",
}
#: Columns of other people's tables that are named like the operators' own.
CLASHING = ("license", "licenses", "dice", "findings", "masked", "leaks", "score", "margin", "rejected", "lang_pred", "ids", "n_tokens", "start", "decoded", "spans", "n_entities", "n_shingles", "component_id", "held_out", "__text", "__h", "__m", "id", "r")
NAMES = [n for n in queries.queries() if n != "pipeline"]
needs_tokenizers = pytest.mark.skipif(not os.path.isdir("/opt/tokenizers"), reason="no tokenizer files")


def digest(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def tables(spark, folder, rows):
    for name, schema in TABLES.items():
        df = spark.createDataFrame(rows.get(name, []), schema)
        for c in CLASHING if name == "documents" else ():
            df = df.selectExpr("*", f"'x' AS `{c}`")
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


PROSE = "The quick brown fox jumps over the lazy dog while a second fox looks on and waits for its turn"
TEXTS = [
    (1, None), (2, ""), (3, PROSE), (3, PROSE), (4, PROSE), (5, PROSE + " today"), (6, " \t\r\n "), (7, "one two"), (8, "ONE  two"),
    (9, "password: hunter2hunter2 and AKIA" + "B7" * 10 + " then " + "0f" * 20), (10, "写真 ✓ é́ \U0001f600 ﬁ " * 30), (11, "w " * 60_000 + "secret=abcdefgh12345"),
    (12, "Licensed under the MIT License."), (13, "Write to Ms. Anna Berg at anna.berg@example.com or +49 171 2345678."), (14, "x" * 200_000), (None, "no id here but words enough to count"), (-5, "a negative id comes before the others"),
]
TURNS = [(i // 4 if i % 57 else None, (i % 4, None, i % 3)[i % 7 % 3], ROLES[i % 11 % 7], ("Yes.", "No? ", "cut", "", None, "é!\n", "Yes.")[i % 13 % 7]) for i in range(400)]


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    docs = [(d, t, ("en", "de", None)[i % 3], "s", None if t is None else len(t)) for i, (d, t) in enumerate(TEXTS)]
    vectors = [(50, [0.5, 0.25]), (50, [0.5, 0.25]), (7, [0.125, -1.0]), (8, None), (100, [math.nan, 1.0]), (None, [2.0, 2.0]), (9, [0.5, 0.25]), (10, [None, 1.0])]
    return tables(spark, tmp_path_factory.mktemp("awkward") / "t", {
        "pages": [(i or None, f"u{i}", page) for i, (page, _) in enumerate(CASES.values())], "conversations": TURNS, "documents": docs, "benchmark": [(1, PROSE), (2, None), (3, ""), (4, "one two")],
        "labels": [(3, 1, 0), (4, 1, 1), (4, 1, 0), (None, 1, 1), (9, None, None)], "embeddings": vectors,
    })


@pytest.fixture(scope="module")
def results(spark, awkward):
    """Rows of a query on the awkward tables, each query run once."""
    seen = {}

    def of(name):
        if name not in seen:
            seen[name] = [r.asDict() for r in queries.queries()[name](spark, awkward).collect()]
        return seen[name]

    return of


def key(x):
    return (x is not None, x or 0)


@needs_tokenizers
def test_token_files(results):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(queries._tokenizer("word_bpe_49k.json")))
    want, start = [], 0
    for d, t in sorted(TEXTS, key=lambda x: key(x[0])):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((d, start, len(ids), zlib.crc32(digest(ids))))
        start += len(ids)
    got = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in results("op2_repair_output")]
    assert sorted(got, key=lambda r: r[1]) == want


@needs_tokenizers
def test_pieces(results):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=str(queries._tokenizer("piece_bpe_32k.model")))
    want = []
    for d, t in TEXTS:
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        want.append((d, len(ids), hashlib.sha256(digest(ids)).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in results("op7_sentencepiece")]
    assert sorted(got, key=lambda r: (key(r[0]), r)) == sorted(want, key=lambda r: (key(r[0]), r))


def test_base_secrets(results):
    kinds, want = ("assign", "access", "hex"), {}
    for d, t in TEXTS:
        own = plain_base(t or "")
        want[d] = (*(sum(k == i for _, k, _ in own) for i in range(3)), hashlib.sha256(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in own).encode()).hexdigest())
    rows = results("op3_secret_scan")
    assert len(rows) == len(TEXTS)
    assert all((r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == want[r["doc_id"]] for r in rows)
    assert want[9][:3] == (1, 1, 1)
    assert want[11][0] == 1


def test_folds_and_scores(results):
    for name, folds, held in (("op6_language_id", 4, 2), ("op9_toxicity", 5, 0)):
        rows = results(name)
        assert sorted((r["doc_id"] for r in rows), key=key) == sorted((d for d, _ in TEXTS), key=key)
        assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % folds == held) for r in rows)
        assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in results("op9_toxicity"))
    assert {r["doc_id"]: r["lang_pred"] for r in results("op6_language_id") if r["doc_id"] in (1, 2, 6)} == dict.fromkeys((1, 2, 6), "und")


def test_components(results):
    once = {d: t for d, t in TEXTS if d is not None}
    want = brute(sorted(once.items()))
    assert all((r["n_shingles"], r["component_id"]) == want[r["doc_id"]] for r in results("op10_jaccard_join") if r["doc_id"] is not None)
    assert len(results("op10_jaccard_join")) == len(TEXTS)
    assert want[5][1] == 3
    assert want[8][1] == 7


def test_leaks(results):
    got = sorted((r["doc_id"], r["item_id"], r["n_shared"], r["n_item"]) for r in results("op4_decontaminate"))
    n = len(PROSE.split()) - 4
    assert got == [*((d, 1, n, n) for d in (3, 3, 4, 5)), (7, 4, 1, 1), (8, 4, 1, 1)]


def test_licences_and_surrogates(results):
    rows = results("op1_license_scan")
    assert len(rows) == len(TEXTS)
    assert {r["doc_id"]: r["license"] for r in rows if r["license"]} == {12: "MIT"}
    rows = results("op8_pii_surrogates")
    assert len(rows) == len(TEXTS)
    of, texts = {r["doc_id"]: r for r in rows}, dict(TEXTS)
    assert of[13]["n_entities"] == 3
    assert "anna.berg@example.com" not in of[13]["text"]
    assert all(r["text"] == texts[d] for d, r in of.items() if not r["n_entities"])


def test_pages(results):
    want = {(i or None, f"u{i}", text, len(text)) for i, (_, text) in enumerate(CASES.values())}
    assert {tuple(r.values()) for r in results("op11_html_extraction")} == want
    assert len(results("op11_html_extraction")) == len(CASES)


def test_conversations(results):
    want = {c: plain_repair(c, rows)[0] for c, rows in damaged(TURNS).items() if len(rows) <= 6}
    got = {r["conv_id"]: tuple(r.values()) for r in results("op12_conversation_repair")}
    assert set(got) == {r[0] for r in TURNS}
    assert len(want) > 90
    assert all(got[c] == row for c, row in want.items())


def test_fill_middle(results):
    want = []
    for d, t in TEXTS:
        n, form, p, m, out = plain(d, t)
        want.append((d, n, form, p, m, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = [tuple(r[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")) for r in results("op13_fill_middle")]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_vectors(results):
    """Rows of equal ids are rows of their own; null ids are candidates, never queries."""
    whole = [(50, (128, 64)), (50, (128, 64)), (7, (32, -256)), (None, (512, 512)), (9, (128, 64))]
    for i in (0, 1):
        scores = sorted((sum(a * b for a, b in zip(whole[i][1], v, strict=True)) for j, (_, v) in enumerate(whole) if j != i), reverse=True)
        assert sorted((r["score"] for r in results("op5_exact_topk")), reverse=True) == sorted(scores * 2, reverse=True)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, tmp_path, name):
    assert queries.queries()[name](spark, tables(spark, tmp_path / "t", {})).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for f in os.listdir(SF):
        db.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    own = queries.queries()[name](spark, SF)
    columns = ", ".join(own.columns)
    assert sorted(map(tuple, own.collect())) == sorted(db.execute(f"SELECT {columns} FROM ({queries.oracle_sql()[name]})").fetchall())
