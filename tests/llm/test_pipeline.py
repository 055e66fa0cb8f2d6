"""The pipeline's stages on the smallest driver tables, each against its own rule."""

import os

import pytest

from test_jaccard_join import brute, shingle_set

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        steps[name] = docs.collect()
        if name != "sentencepiece":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = spark.createDataFrame(steps[name], docs.schema)
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    kept = {r["doc_id"]: r["text"] for r in steps["toxicity"]}
    assert len(toxic & set(kept)) <= 0.4 * len(toxic)
    assert len(kept) >= len(rows) - 2 * len(toxic)
    groups = brute(list(kept.items()))
    assert sorted(r["doc_id"] for r in steps["near_duplicates"]) == sorted({c for _, c in groups.values()})
    items = [shingle_set(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in steps["near_duplicates"] if not any(i and len(i & shingle_set(r["text"])) >= 0.75 * len(i) for i in items)}
    assert {r["doc_id"] for r in steps["decontamination"]} == clean
    assert {r["doc_id"] for r in steps["secrets"]} == clean
    assert all(r["n_chars"] == len(r["text"]) for r in steps["secrets"])
    assert not any("token = " in r["text"] for r in steps["secrets"])
    assert {r["doc_id"] for r in steps["sentencepiece"]} == clean


def test_awkward_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (None, "a b c d e f", "en", "s", 11), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "x " * 40_000, "en", "s", 80_000), (4, "token = \"" + "a1" * 20 + "\"", "en", "s", 50)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "2", "2", "3", "4", "None"]
