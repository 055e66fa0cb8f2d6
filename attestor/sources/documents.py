"""Documents as tables: files, the page images in them, and pluggable readers of the images."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.operators import routing, votes
from attestor.schema import OCR_READ, conform
from attestor.session import cut

# Image types that the scan and the employer extraction look at.
SCAN_TYPES = ("png", "jpg", "jpeg", "bmp", "tiff", "tif", "gif")
EXTRACT_TYPES = ("png", "jpg", "jpeg", "gif")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(source_docx, path, length, content) of a folder's .docx files, without lock files; not recursive."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").option("recursiveFileLookup", "false").load(folder)
    # The path comes as the file is named, without escapes.
    name = F.element_at(F.split("path", "/"), -1)
    return files.withColumn("source_docx", name).where(~F.col("source_docx").startswith("~$")).select("source_docx", "path", "length", "content")


def page_images(docs: DataFrame) -> DataFrame:
    """(source_docx, image_name, extension, content, error) of the images under word/media.

    What can't be read, a file or a single image, gives a row with an error and no content, so one bad
    file never ends a batch.  Files come a few at a time, as each may be large.
    """

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for source, content in zip(frame["source_docx"], frame["content"], strict=True):
                for row in _images_in(content):
                    yield pd.DataFrame([(source, *row)], columns=["source_docx", "image_name", "extension", "content", "error"])

    few_rows(docs.sparkSession)
    return docs.select("source_docx", "content").mapInPandas(work, "source_docx string, image_name string, extension string, content binary, error string")


def _images_in(content: bytes) -> Iterator[tuple[str, str, bytes | None, str]]:
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
    except Exception as e:  # any damage to a directory: a row, not a failed task
        yield "", "", None, f"{type(e).__name__}: {e}"
        return
    with archive:
        for member in archive.namelist():
            name = member.rsplit("/", 1)[-1]
            kind = name.rsplit(".", 1)[-1].lower()
            if not member.startswith("word/media/") or kind not in SCAN_TYPES:
                continue
            try:
                yield name, kind, archive.read(member), ""
            except Exception as e:  # a damaged stream, a password, an odd method
                yield name, kind, None, f"{type(e).__name__}: {e}"


def few_rows(spark: SparkSession) -> None:
    """Arrow batches of at most 64 MB, whatever the number of rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def for_extraction(images: DataFrame) -> DataFrame:
    """The narrower set of images that the employer extraction reads."""
    return images.where(F.col("extension").isin(*EXTRACT_TYPES))


#: A reader takes an image and a dict of settings and gives (text, confidence).
Reader = Callable[[bytes, dict], tuple[str, float]]


def read_images(images: DataFrame, configs: DataFrame, reader: Reader, keep: tuple[str, ...] = ("source_docx", "image_name")) -> DataFrame:
    """Readings of every image under every config row (roi, phase, config_ord, config, settings JSON).

    The configs are a small dimension (some fifty rows) and go to the workers, so each image is sent
    once.  A reader's error becomes an ``error`` value with an empty text, never a failed task.  Save the
    result before branching on it: reading is the costly step and must not run twice.
    """
    import json

    plan = [(r["roi"], r["phase"], r["config_ord"], r["config"], json.loads(r["settings"])) for r in configs.collect()]
    columns = [*keep, "roi", "phase", "config_ord", "config", "text", "conf", "error"]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                out = []
                for roi, phase, place, config, settings in plan:
                    try:
                        text, conf, error = (*reader(bytes(row["content"]), settings), "") if row["content"] is not None else ("", 0.0, "no content")
                    except Exception as e:  # an external engine may raise anything
                        text, conf, error = "", 0.0, f"{type(e).__name__}: {e}"
                    out.append([*(row[c] for c in keep), roi, phase, place, config, text, float(conf), error])
                yield pd.DataFrame(out, columns=columns)

    schema = ", ".join(f"{c} string" for c in keep) + ", roi string, phase string, config_ord int, config string, text string, conf double, error string"
    few_rows(images.sparkSession)
    return images.select(*keep, "content").mapInPandas(work, schema)


def scan_in_tiers(images: DataFrame, configs: DataFrame, reader: Reader, whole: bool = False) -> DataFrame:
    """Readings (OCR_READ) of a table of images (source_docx, image_name, content): see ``read_in_tiers``."""
    named = images.where("error = ''") if "error" in images.columns else images
    content = named.select("source_docx", "image_name", "content")
    pages = routing.pages(named.select("source_docx", "image_name"))
    return conform(read_in_tiers(pages, lambda wanted: content.join(wanted.select("source_docx", "image_name"), ["source_docx", "image_name"]), configs, reader, whole), OCR_READ)


def read_in_tiers(pages: DataFrame, fetch: Callable[[DataFrame], DataFrame], configs: DataFrame, reader: Reader, whole: bool = False, keep: tuple[str, ...] = ("source_docx", "image_name")) -> DataFrame:
    """Readings of the first tier of pages, and of the rest only for large documents without a sure permit vote.

    ``fetch`` gives the content of wanted pages, with the columns to keep.  Each pass is cut (its readings, no
    contents), as the second depends on what the first read; ``whole`` reads every page at once.
    """

    def read(wanted: DataFrame) -> DataFrame:
        return cut(read_images(fetch(wanted), configs, reader, keep))

    if whole:
        return read(pages)
    first = read(pages.where("docx_class = 'small' or tier = 1"))
    classes = pages.where("docx_class = 'large' and tier = 1").select("source_docx", "image_name", "docx_class", F.lit(1).alias("scan_tier"))
    return first.unionByName(read(routing.second_tier(pages, votes.scan_images(conform(first, OCR_READ), classes))))


# The order of the readings; the first six of them vote.
SCAN_CONFIGS = (
    ("red 2x median 3", {"channel": "R", "scale": 2, "median": 3, "psm": 3}, True),
    ("red 1x", {"channel": "R", "scale": 1, "median": 0, "psm": 3}, True),
    ("gray 2x median 3", {"channel": "gray", "scale": 2, "median": 3, "psm": 3}, True),
    ("red sharpened psm 6", {"channel": "R", "scale": 2, "median": 3, "psm": 6, "sharpen": True}, True),
    ("red 2x psm 6", {"channel": "R", "scale": 2, "median": 3, "psm": 6}, True),
    ("gray 2x psm 6", {"channel": "gray", "scale": 2, "median": 3, "psm": 6}, True),
    ("gray 1x", {"channel": "gray", "scale": 1, "median": 0, "psm": 3}, False),
    ("red 2x psm 11", {"channel": "R", "scale": 2, "median": 3, "psm": 11}, False),
    ("gray 2x psm 11", {"channel": "gray", "scale": 2, "median": 3, "psm": 11}, False),
)
READABLE = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz :.'-,"
FALLBACK_CONFIGS = (
    ("Latin psm 6", {"channel": "R", "scale": 2, "median": 3, "psm": 6, "lang": "eng", "characters": READABLE}),
    ("Latin psm 3", {"channel": "gray", "scale": 2, "median": 3, "psm": 3, "lang": "eng", "characters": READABLE}),
)
#: The part of a page whose text marks a contract page.
PAGE_TOP = (0.0, 0.0, 1.0, 0.35)
REGIONS = {"mol": (0.05, 0.04, 0.40, 0.25), "permit_upper": (0.40, 0.05, 1.00, 0.55), "permit_lower": (0.40, 0.45, 1.00, 0.95)}


def engine_options(settings: dict) -> str:
    """A config as the command-line options of a reading engine: page segmentation and, if named, the characters it may give."""
    allowed = settings.get("characters")
    return f"--psm {settings.get('psm', 3)}" + (f" -c tessedit_char_whitelist={allowed}" if allowed else "")


def page_top_config(spark: SparkSession) -> DataFrame:
    """The one config under which page tops are read to tell contract pages, their stamps removed first."""
    import json

    settings = json.dumps({"channel": "R", "scale": 1, "psm": 3, "lang": "ind+eng", "roi": PAGE_TOP, "remove_stamp": True})
    return spark.createDataFrame([("page_top", "scan", 0, "page top", settings)], "roi string, phase string, config_ord int, config string, settings string")


def config_table(spark: SparkSession, roi: str = "") -> DataFrame:
    """The dimension of regions, phases and configs; ``roi`` keeps one region."""
    import json

    rows = []
    for name, box in REGIONS.items():
        if roi and roi != name:
            continue
        for i, (config, settings, votes) in enumerate(SCAN_CONFIGS):
            full = json.dumps({**settings, "contrast": [2, 98], "roi": box})
            rows += [(name, "vote", i, config, full)] * votes + [(name, "scan", i, config, full)]
        rows += [(name, "fallback", i, config, json.dumps({**settings, "contrast": [2, 98], "roi": box})) for i, (config, settings) in enumerate(FALLBACK_CONFIGS)]
    if roi and not rows:
        raise ValueError(f"unknown region {roi!r}")
    return spark.createDataFrame(rows, "roi string, phase string, config_ord int, config string, settings string")
