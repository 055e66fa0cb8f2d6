"""Archives read by range: first the lists of pages, from the directories alone, then only the pages that are wanted.

A scan that stops after the first tier so reads the directories and that tier's pages; nothing else of an
archive is read or unpacked.  Both steps are maps over tables of names, so wanted pages are chosen
in between by joins and filters.  Files are opened in the tasks, by range, in any store that Arrow knows (shared
files, HDFS, object stores); elsewhere ``documents.page_images`` takes whole files from Spark.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.operators import routing
from attestor.schema import OCR_READ, conform
from attestor.session import cut
from attestor.sources import documents

PAGE_LIST = "source_docx string, path string, image_name string, extension string, at bigint, size bigint, unpacked bigint, method int, crc bigint, locked boolean, error string, bytes_read bigint"
_COLUMNS = [c.split()[0] for c in PAGE_LIST.split(", ")]


class Ranges(io.RawIOBase):
    """A file in a store, read by range; counts the bytes that it gives."""

    def __init__(self, path: str):
        if path.startswith("file:") or "://" not in path:
            files, name = arrow_fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        else:
            files, name = arrow_fs.FileSystem.from_uri(path)
        self._file = files.open_input_file(name)
        self.given = 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        return self._file.seek(offset, whence)

    def tell(self) -> int:
        return self._file.tell()

    def read(self, size: int = -1) -> bytes:
        data = self._file.read(None if size is None or size < 0 else size)
        self.given += len(data)
        return data

    def close(self) -> None:
        self._file.close()
        super().close()


def files(spark: SparkSession, folder: str, source: str = "") -> DataFrame:
    """(source_docx, path) of a folder's documents, or of the one that is named; no content is read."""
    out = documents.documents(spark, folder).select("source_docx", "path")
    return out.where(F.col("source_docx") == source) if source else out


def page_list(found: DataFrame) -> DataFrame:
    """The images under word/media of every archive, with where their bytes are; a damaged archive gives one row with an error."""

    def listed(source: str, path: str) -> Iterator[tuple]:
        given = 0
        try:
            with Ranges(path) as file, zipfile.ZipFile(file) as archive:
                members, given = archive.infolist(), file.given
        except Exception as e:  # any damage to a directory, a file that is gone: a row, not a failed task
            yield (source, path, "", "", 0, 0, 0, 0, 0, False, f"{type(e).__name__}: {e}", given)
            return
        for m in members:
            name = m.filename.rsplit("/", 1)[-1]
            kind = name.rsplit(".", 1)[-1].lower()
            if m.filename.startswith("word/media/") and kind in documents.SCAN_TYPES:
                yield (source, path, name, kind, m.header_offset, m.compress_size, m.file_size, m.compress_type, m.CRC, bool(m.flag_bits & 1), "", given)
                given = 0

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [row for s, p in zip(frame["source_docx"], frame["path"], strict=True) for row in listed(s, p)]
            yield pd.DataFrame(rows, columns=_COLUMNS)

    return found.select("source_docx", "path").mapInPandas(work, PAGE_LIST)


def unpack(file: Ranges, at: int, size: int, unpacked: int, method: int, crc: int, locked: bool) -> bytes:
    """One member's bytes, read by its local header and its range."""
    if locked:
        raise zipfile.BadZipFile("the member is locked by a password")
    file.seek(at)
    header = file.read(30)
    if len(header) < 30 or header[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("no member where the directory says")
    names = sum(struct.unpack("<HH", header[26:30]))
    file.seek(at + 30 + names)
    raw = file.read(size)
    if len(raw) < size:
        raise EOFError("the archive ends within the member")
    if method == zipfile.ZIP_DEFLATED:
        data = zlib.decompressobj(-15).decompress(raw, unpacked + 1)  # no more than the directory promises
    elif method == zipfile.ZIP_STORED:
        data = raw
    else:
        raise NotImplementedError(f"compression method {method}")
    if len(data) != unpacked or zlib.crc32(data) != crc:
        raise zipfile.BadZipFile("the member doesn't match its checksum")
    return data


def page_contents(pages: DataFrame) -> DataFrame:
    """(source_docx, image_name, extension, content, error, bytes_read) of rows of ``page_list``, and of no other pages."""
    columns = ["source_docx", "image_name", "extension", "content", "error", "bytes_read"]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, file = None, None
        for frame in frames:
            for r in frame.itertuples(index=False):
                content, error, before = None, r.error, 0
                if not error:
                    try:
                        if r.path != path:
                            if file is not None:
                                file.close()
                            path, file = None, None
                            file, path = Ranges(r.path), r.path
                        before = file.given
                        content = unpack(file, r.at, r.size, r.unpacked, r.method, r.crc, r.locked)
                    except Exception as e:  # a damaged stream, a password, an odd method: a row
                        error = f"{type(e).__name__}: {e}"
                given = file.given - before if file is not None and not r.error else 0
                yield pd.DataFrame([(r.source_docx, r.image_name, r.extension, content, error, given)], columns=columns)
        if file is not None:
            file.close()

    documents.few_rows(pages.sparkSession)
    wanted = pages.select(*_COLUMNS).sortWithinPartitions("path", "at")
    return wanted.mapInPandas(work, "source_docx string, image_name string, extension string, content binary, error string, bytes_read bigint")


def scan(
    spark: SparkSession, folder: str, configs: DataFrame, reader: documents.Reader, whole: bool = False, source: str = "", image: str = "",
) -> tuple[DataFrame, DataFrame]:
    """(readings, what was read): a tiered scan of a folder that reads second-tier pages only where the first gave no sure vote.

    ``source`` keeps one document and ``image`` one image of it; a document's class follows all its images all
    the same.  ``whole`` reads every page.  The second table has source_docx, image_name, error and bytes_read.
    """
    if image and not source:
        raise ValueError("an image is named within a document: name that too")
    listed = cut(page_list(files(spark, folder, source)))
    named = listed.where("error = ''")
    pages = routing.pages(named.select("source_docx", "image_name"))
    pages = pages.where(F.col("image_name") == image) if image else pages

    def fetch(wanted: DataFrame) -> DataFrame:
        content = page_contents(named.join(wanted.select("source_docx", "image_name"), ["source_docx", "image_name"]))
        return content.withColumnRenamed("error", "page_error").withColumn("bytes_read", F.col("bytes_read").cast("string"))

    out = documents.read_in_tiers(pages, fetch, configs, reader, whole, ("source_docx", "image_name", "page_error", "bytes_read"))
    read = out.groupBy("source_docx", "image_name").agg(F.max("page_error").alias("error"), F.max(F.col("bytes_read").cast("bigint")).alias("bytes_read"))
    # A document's directory counts as a page without a name.
    directories = listed.groupBy("source_docx").agg(F.lit("").alias("image_name"), F.max("error").alias("error"), F.sum("bytes_read").alias("bytes_read"))
    return conform(out, OCR_READ), directories.unionByName(read)
