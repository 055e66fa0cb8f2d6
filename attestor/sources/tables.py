"""Tables from files: scan results and logs as CSV, the registry and the gazetteer as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from attestor.operators import gazetteer, registry
from attestor.schema import LARGE_NO_HIT, OK, PERMIT_PARTIAL, SCAN_RESULT, SMALL_NO_HIT

# Registry fields by our names.
REGISTRY_FIELDS = {"permit": "許可證", "name": "機構名稱", "address": "機構地址", "phone": "電話", "revoked_on": "廢止許可日期", "closed_on": "終止營業日期"}
#: Options of CSV that holds any text: line breaks inside quotes, quotes doubled, blank rather than null.
CSV = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"', "emptyValue": "", "lineSep": "\n"}
CITY_SCHEMA = "CityName string, CityEngName string, AreaList array<struct<AreaName:string,AreaEngName:string,ZipCode:string,RoadList:array<struct<RoadName:string,RoadEngName:string>>>>"
ROAD_SCHEMA = "CityName string, AreaName string, RoadName string, RoadEngName string, _note string"


def scan_results(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan results: Y or a check mark is true, blank or unreadable numbers 0, unknown states ok, a missing tier 1."""
    return typed_results(read_csv(spark, path))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Text columns of CSV with a header; values may hold line breaks, and none is null."""
    return spark.read.options(**CSV, multiLine=True).csv(path).fillna("")


def typed_results(raw: DataFrame) -> DataFrame:
    columns = []
    for f in StructType.fromDDL(SCAN_RESULT):
        text = F.coalesce(F.col(f.name), F.lit("")) if f.name in raw.columns else F.lit("")
        kind = f.dataType.simpleString()
        if kind == "boolean":
            value = F.trim(text).isin("Y", "✓")
        elif kind in ("int", "double"):
            value = F.coalesce(F.trim(text).try_cast(kind), F.lit(1 if f.name == "scan_tier" else 0).cast(kind))
        elif f.name == "status":
            value = F.when(text.isin(OK, LARGE_NO_HIT, SMALL_NO_HIT, PERMIT_PARTIAL), text).otherwise(OK)
        else:
            value = text
        columns.append(value.alias(f.name))
    return raw.select(*columns)


def encoded_results(results: DataFrame) -> DataFrame:
    """Text columns for a CSV: true as Y, false and 0 as blank, confidences with one decimal."""
    columns = []
    for f in StructType.fromDDL(SCAN_RESULT):
        c, kind = F.col(f.name), f.dataType.simpleString()
        if kind == "boolean":
            c = F.when(c, "Y").otherwise("")
        elif kind == "int":
            c = F.when(c == 0, "").otherwise(c.cast("string"))
        elif kind == "double":
            c = F.when(c == 0, "").otherwise(F.format_string("%.1f", c))
        columns.append(c.alias(f.name))
    return results.select(*columns)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def upload_log(spark: SparkSession, path: str) -> DataFrame:
    """timestamp, source_docx, final_value, status, reason as text; a log that isn't there is empty."""
    schema = "timestamp string, source_docx string, final_value string, status string, reason string"
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    names = [f.name for f in StructType.fromDDL(schema)]
    raw = read_csv(spark, path)
    return raw.select(*(F.col(n) if n in raw.columns else F.lit(None).cast("string").alias(n) for n in names))


def roster(spark: SparkSession, path: str) -> DataFrame:
    """The registry from its JSON array, each row with its place."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"no registry at {path}: fetch the official list of agencies as a JSON array first")
    schema = ", ".join(f"`{v}` string" for v in REGISTRY_FIELDS.values())
    raw = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("pos", F.monotonically_increasing_id())
    return registry.roster(raw.select("pos", *(F.col(v).alias(k) for k, v in REGISTRY_FIELDS.items())))


def roster_age_days(spark: SparkSession, path: str) -> DataFrame:
    """Days since the registry's file was written, for a notice."""
    return spark.read.format("binaryFile").load(path).select(F.datediff(F.current_date(), F.to_date("modificationTime")).alias("days"))


def gazetteer_roads(spark: SparkSession, path: str, custom: str = "") -> DataFrame:
    """gaz_road from nested JSON, with own roads from a second file, if it is there, laid over it."""
    out = gazetteer.flatten(spark.read.schema(CITY_SCHEMA).option("multiLine", True).json(path))
    if custom and _exists(spark, custom):
        out = gazetteer.overlay(out, spark.read.schema(ROAD_SCHEMA).option("multiLine", True).json(custom).where("CityName is not null"))
    return out
