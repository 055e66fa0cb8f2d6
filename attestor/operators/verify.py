"""Cross-check of the second reader's value against the first's, and the list of known permits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.functions import scalars as S
from attestor.schema import CONFIRMED, DISAGREEMENT, FORMAT_INVALID, OCR_CONFUSION, VISION_ONLY


def levels(value: Column, candidate: Column, valid: Column) -> Column:
    """The first level that applies: format, second reader alone, equal, one edit apart, else."""
    return F.when(~valid, FORMAT_INVALID).when(candidate == "", VISION_ONLY).when(value == candidate, CONFIRMED).when(F.levenshtein(value, candidate) == 1, OCR_CONFUSION).otherwise(DISAGREEMENT)


def verify(items: DataFrame, known: DataFrame | None = None, value: str = "second_value", candidate: str = "candidate_value", valid: Column | None = None) -> DataFrame:
    """Items with level, final_value, should_keyin, rationale and in_known_list.

    Only equal values are keyed in; values one edit apart are left blank.  ``known`` (column
    ``permit``, distinct) changes the wording alone.  Nulls count as ''.
    """
    v, c = F.coalesce(F.col(value), F.lit("")), F.coalesce(F.col(candidate), F.lit(""))
    good = S.valid_permit(v) if valid is None else valid
    level = levels(v, c, good)
    out = items.withColumn("level", level)
    if known is None:
        out = out.withColumn("listed", F.lit(False))
    else:
        out = out.join(known.select(F.col("permit").alias("__permit"), F.lit(True).alias("listed")).distinct(), v == F.col("__permit"), "left").drop("__permit")
    listed = F.coalesce("listed", F.lit(False)) & (F.col("level") != FORMAT_INVALID)
    final = F.when(F.col("level") == FORMAT_INVALID, S.first_of(v, c)).when(F.col("level") == OCR_CONFUSION, "").otherwise(v)
    why = F.when(F.col("level") == FORMAT_INVALID, F.when(v == "", "second reader found nothing").otherwise(F.concat(F.lit("not a permit: "), v)))
    why = why.when(F.col("level") == VISION_ONLY, F.concat(F.lit("second reader alone: "), v)).when(F.col("level") == CONFIRMED, F.concat(F.lit("both readers: "), v))
    why = why.otherwise(F.concat(F.lit("first="), c, F.lit(", second="), v, F.lit(", edits="), F.levenshtein(v, c).cast("string")))
    why = F.when(listed, F.concat(why, F.lit("; known before"))).otherwise(why)
    return out.withColumns({"final_value": final, "should_keyin": F.col("level") == CONFIRMED, "rationale": why, "in_known_list": listed}).drop("listed")


def known_permits(log: DataFrame) -> DataFrame:
    """Distinct trimmed non-empty final values of an upload log."""
    return log.select(F.trim(F.col("final_value")).alias("permit")).where("permit <> ''").distinct()
