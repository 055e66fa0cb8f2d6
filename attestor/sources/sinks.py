"""Outputs: scan results, review pages, page texts, reports, the sheet, the log and the registry's export."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.functions import scalars as S
from attestor.operators.assemble import doubt_report, not_yet_written
from attestor.schema import SHEET_COLUMNS
from attestor.sources import images
from attestor.sources.documents import REGIONS, few_rows
from attestor.sources.ledger import Ledger
from attestor.sources.tables import CSV, encoded_results


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files that spreadsheets read: a byte-order mark and a header in each, and quotes doubled.

    The mark is part of the first name as it is written.  Values keep their line breaks and outer spaces.
    """
    marked = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    marked.write.mode("overwrite").options(**CSV, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_results(results: DataFrame, path: str) -> None:
    """Scan results as CSV, replacing what is there."""
    write_csv(encoded_results(results), path)


def review_pages(pages: DataFrame, content: DataFrame) -> DataFrame:
    """Originals for review: images 2, 5 and 6 of large documents, 2 and 3 of small ones."""
    wanted = F.when(F.col("docx_class") == "large", F.col("image_index").isin(2, 5, 6)).otherwise(F.col("image_index").isin(2, 3))
    return pages.where(wanted).select("source_docx", "image_name").join(content, ["source_docx", "image_name"])


def crops(results: DataFrame, content: DataFrame, decode: Callable[[bytes], np.ndarray]) -> DataFrame:
    """(source_docx, image_name, crop, content, error): the regions that results name, upright, as PNG.

    ``decode`` turns an image file into an array; its errors become values.
    """
    named = F.array(
        F.struct(F.col("mol_crop").alias("crop"), F.lit("mol").alias("region")),
        F.struct(F.col("permit_crop").alias("crop"), F.when(F.col("hit_roi").isin(*REGIONS), F.col("hit_roi")).otherwise("permit_upper").alias("region")),
    )
    wanted = results.select("source_docx", "image_name", F.explode(named).alias("c")).select("source_docx", "image_name", "c.*").where("crop <> ''")
    wanted = wanted.groupBy("source_docx", "image_name").agg(F.collect_set(F.struct("crop", "region")).alias("asked"))  # two names a page
    columns = ["source_docx", "image_name", "crop", "content", "error"]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                try:
                    page, error = images.upright(decode(bytes(r.content)), images.orientation(bytes(r.content))), ""
                except Exception as e:  # a decoder may raise anything
                    page, error = None, f"{type(e).__name__}: {e}"
                rows = [(r.source_docx, r.image_name, a["crop"], None if page is None else images.png(images.crop(page, REGIONS[a["region"]])), error) for a in r.asked]
                yield pd.DataFrame(rows, columns=columns)

    few_rows(results.sparkSession)
    joined = wanted.join(content.select("source_docx", "image_name", "content"), ["source_docx", "image_name"])
    return joined.mapInPandas(work, "source_docx string, image_name string, crop string, content binary, error string")


def texts(spark: SparkSession, path: str) -> Ledger:
    """The second reader's full texts at a path, for replay without new calls."""
    return Ledger(spark, path, "source_docx string, image_name string, text string")


def write_texts(rows: DataFrame, path: str, run_id: str) -> int:
    """Append the texts of pages that the store doesn't have; a retry adds nothing."""
    page = ["source_docx", "image_name"]
    return texts(rows.sparkSession, path).append(rows, run_id, lambda new, known: new.dropDuplicates(page).join(known.select(*page), page, "left_anti"))


def write_doubts(employers: DataFrame, path: str) -> None:
    """Documents with doubts; a handful of rows, in one file in order."""
    write_csv(doubt_report(employers).coalesce(1), path)


# Names of the remote errors that may pass.
_PASSING = ("ServiceUnavailable", "DeadlineExceeded", "InternalServerError", "TooManyRequests")


def may_pass(error: Exception) -> bool:
    """Connection errors, timeouts, HTTP 429 and 5xx, and the remote classes that stand for them."""
    status = getattr(getattr(error, "resp", error), "status", None) or getattr(error, "code", None)
    busy = isinstance(status, int) and (status == 429 or 500 <= status < 600)
    return isinstance(error, (ConnectionError, TimeoutError)) or busy or type(error).__name__ in _PASSING


def retrying(action: Callable[[], object], tries: int = 5, start: float = 2.0, most: float = 30.0, should_retry: Callable[[Exception], bool] = may_pass, sleep: Callable[[float], None] = time.sleep) -> object:
    """Run an action, waiting longer after each failure that is worth a retry."""
    wait = start
    for attempt in range(1, tries + 1):
        try:
            return action()
        except Exception as e:
            if attempt == tries or not should_retry(e):
                raise
            sleep(wait)
            wait = min(wait * 2, most)
    return None


def sheet(spark: SparkSession, path: str) -> Ledger:
    """The sheet at a path: 15 text columns, appended to in transactions."""
    return Ledger(spark, path, ", ".join(f"{c} string" for c in SHEET_COLUMNS))


def append_sheet(rows: DataFrame, path: str, run_id: str, log: DataFrame | None = None) -> int:
    """Append all rows that neither the sheet nor an older ``log`` has, in one transaction; return how many.

    The sheet's log is a view of its rows (``sheet_log``), so both are published by the same step: whatever
    step a run is killed at, the next one writes exactly what is missing.
    """

    def new(rows: DataFrame, committed: DataFrame) -> DataFrame:
        left = not_yet_written(rows, committed)
        return left if log is None else not_yet_written(left, log)

    ledger = sheet(rows.sparkSession, path)
    return retrying(lambda: ledger.append(rows, run_id, new))


def sheet_log(spark: SparkSession, path: str) -> DataFrame:
    """timestamp, source_docx, final_value, status and reason of every row of the sheet."""
    rows = sheet(spark, path).rows()
    return rows.select(F.col("committed_at").alias("timestamp"), "source_docx", F.col("permit").alias("final_value"), "status", "reason")


def export_log(log: DataFrame, path: str) -> None:
    """The log as CSV for people and spreadsheets."""
    write_csv(log, path)


def roster_export(roster: DataFrame) -> DataFrame:
    """The registry with its derived columns: ISO dates, normalised numbers and the telephone note, all as text."""

    def text(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(""))

    derived = {"phones": F.array_join(S.split_phone_field(F.col("phone")), " / "), "phone_note": S.phone_note(F.col("phone")), "state": F.when(F.col("active"), "active").otherwise("inactive"), "revoked_on": S.iso_date(F.col("revoked_on")), "closed_on": S.iso_date(F.col("closed_on"))}
    out = roster.withColumns(derived)
    return out.select(*(text(F.col(c)).alias(c) for c in out.columns if c not in ("base", "active", "pos")))
