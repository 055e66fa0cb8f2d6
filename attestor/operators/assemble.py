"""Rows of the sheet from queue items, agencies and employers, and the run's counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestor.operators import registry as R
from attestor.schema import EMPLOYER, KEYED_IN, MANUAL_REVIEW, SHEET_COLUMNS, conform

_FROM_EMPLOYER = {"employer_cn": "name_cn", "employer_en": "name_en", "addr_std": "addr_std", "addr_ocr": "addr_cn", "doubt": "doubt", "addr_en": "addr_en", "zip": "zip", "employer_phone": "phone"}


def with_employer(rows: DataFrame, employers: DataFrame) -> DataFrame:
    """Employer columns by document; a value that the row has itself wins."""
    own = [c for c in _FROM_EMPLOYER if c in rows.columns]
    known = conform(employers, EMPLOYER).select(F.col("source_docx"), *(F.col(e).alias(f"__{c}") for c, e in _FROM_EMPLOYER.items()))
    out = rows.join(known, "source_docx", "left")
    values = {c: F.coalesce(F.nullif(F.col(c), F.lit("")) if c in own else F.lit(None).cast("string"), F.col(f"__{c}"), F.lit("")) for c in _FROM_EMPLOYER}
    return out.withColumns(values).drop(*(f"__{c}" for c in _FROM_EMPLOYER))


def sheet_rows(keyed: DataFrame, manual: DataFrame, registry: DataFrame, employers: DataFrame) -> DataFrame:
    """The 15 columns of keyed-in and manual rows (source_docx, permit, reason)."""
    rows = keyed.select("source_docx", "permit", F.lit(KEYED_IN).alias("status"), "reason").unionByName(manual.select("source_docx", "permit", F.lit(MANUAL_REVIEW).alias("status"), "reason"))
    full = with_employer(R.lookup(rows, registry, "permit"), employers)
    return full.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in SHEET_COLUMNS))


def doubt_report(employers: DataFrame) -> DataFrame:
    """Documents with a doubt, by name."""
    return employers.where("doubt <> ''").select("source_docx", "doubt", "name_cn", "name_en", "addr_cn", "addr_std", "zip").orderBy("source_docx")


def scan_counters(results: DataFrame) -> DataFrame:
    """Images, hits by region, documents by tier."""
    per_doc = results.groupBy("source_docx").agg(F.max("scan_tier").alias("t"), F.count("*").alias("n"), F.count_if((F.col("mol") != "") | (F.col("id") != "")).alias("hits"), F.count_if(F.col("hit_roi") == "permit_upper").alias("upper"), F.count_if(F.col("hit_roi") == "permit_lower").alias("lower"))
    return per_doc.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "hits", "upper", "lower")), F.count_if(F.col("t") == 1).alias("tier1_docs"), F.count_if(F.col("t") == 2).alias("expanded_docs"))


def summary(queue: DataFrame) -> DataFrame:
    """Items by route."""
    return queue.groupBy("route").agg(F.count("*").alias("n"), F.count_distinct("source_docx").alias("n_docs"))


def not_yet_written(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Rows whose document and status the log doesn't have; its older word for keyed-in counts as such."""
    done = log.select("source_docx", F.when(F.col("status") == "vision", KEYED_IN).otherwise(F.col("status")).alias("status")).distinct()
    return rows.join(done, ["source_docx", "status"], "left_anti")


def empty_employers(documents: DataFrame, note: str) -> DataFrame:
    """Blank employer rows with a note."""
    return conform(documents.select("source_docx", F.lit(note).alias("note")), EMPLOYER)
