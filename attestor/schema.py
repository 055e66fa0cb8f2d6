"""Fixed schemas of the engine's tables; a missing value is '' / 0 / false, never null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

PAGE = "source_docx string, image_name string, image_index int, has_number boolean, ord int, n_images int, docx_class string, tier int"
OCR_READ = "source_docx string, image_name string, roi string, phase string, config_ord int, config string, engine string, text string, conf double"
SCAN_RESULT = (
    "source_docx string, image_name string, docx_class string, scan_tier int, mol string, mol_layer int, mol_conf double, mol_from_vote boolean, "
    "id string, id_layer int, id_conf double, id_from_vote boolean, cross_match boolean, final_value string, final_conf double, vision_review boolean, "
    "note string, manual_review string, low_conf string, hit_config string, hit_roi string, mol_crop string, permit_crop string, status string"
)
QUEUE = "source_docx string, image_name string, img_path string, candidate_value string, candidate_conf double, reason string, direct_keyin boolean, no_vote_rescue boolean, route string"
ROSTER = "pos bigint, permit string, base int, suffix string, name string, address string, phone string, revoked_on string, closed_on string, active boolean"
EMPLOYER = "source_docx string, name_cn string, name_en string, addr_cn string, addr_en string, phone string, addr_std string, zip string, addr_matched boolean, doubt_name string, doubt_addr string, doubt_house string, doubt string, image string, note string"
SHEET_COLUMNS = ("source_docx", "permit", "status", "reason", "agency_name", "agency_address", "agency_phone", "employer_cn", "employer_en", "addr_std", "addr_ocr", "doubt", "addr_en", "zip", "employer_phone")

# Statuses of scans and of sheet rows, levels of verification.
OK, LARGE_NO_HIT, SMALL_NO_HIT, PERMIT_PARTIAL = "ok", "large_no_hit", "small_no_hit", "permit_partial"
KEYED_IN, MANUAL_REVIEW = "keyed-in", "manual_review"
CONFIRMED, OCR_CONFUSION, VISION_ONLY, DISAGREEMENT, FORMAT_INVALID = "confirmed", "likely_ocr_confusion", "vision_only", "disagreement", "format_invalid"


def blank(kind: DataType) -> Column:
    """The value that stands for missing in a column of this type."""
    name = kind.simpleString()
    return F.lit({"string": "", "boolean": False}.get(name, 0)).cast(kind)


def conform(df: DataFrame, schema: str | StructType) -> DataFrame:
    """Columns of the schema in its order and types; absent or null ones get their blank."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    have = set(df.columns)
    return df.select(*(F.coalesce(F.col(f.name).cast(f.dataType), blank(f.dataType)).alias(f.name) if f.name in have else blank(f.dataType).alias(f.name) for f in fields))
