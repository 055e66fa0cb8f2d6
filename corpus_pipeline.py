"""A pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Every stage works on all rows that its predecessor kept and, but for the last, returns the columns
of ``documents``.  Rows with null or empty texts pass every filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.llm import decontaminate, jaccard_join, queries, secret_scan, sentencepiece_codec, toxicity
from attestor.llm.common import Scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; labels are learned as the registered query does."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(docs, labels, allowed=queries._fold("doc_id", 5) != 0)
    return toxicity.score(docs, model, keep=COLUMNS).where("score < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays, that with the smallest id."""
    return jaccard_join.representatives(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 3/4 or more of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.flag(docs, benchmark, keep=COLUMNS).where(F.size("leaks") == 0).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text, and its length set anew; every document stays."""
    out = secret_scan.scan(docs, keep=("doc_id", "lang", "source", "n_chars"), mask="<secret>")
    n_chars = F.when(F.size("findings") > 0, F.length("masked").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.select("doc_id", F.col("masked").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and spans (packed as the operator says) of every document."""
    out = sentencepiece_codec.encode_decode(docs, queries._tokenizer("piece_bpe_32k.model").read_bytes())
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", "spans")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("sentencepiece", encode),
]

#: Trained models and tokenizers are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{i}-{name}")
        if i:
            scratch.drop(f"{i - 1}-{STAGES[i - 1][0]}")
    return scratch.keep_for(docs, f"{len(STAGES) - 1}-{STAGES[-1][0]}")
