"""A store of readings by content: what a reader was paid for once is never read again.

A reading's key is the digest of the image's bytes and of the settings it is read under.  A scan asks the
store first; only unknown keys go to the reader, each once however many pages hold the same image.  Tasks
publish what they read every ``FLUSH`` readings, by linking a finished file into the store, so a job that
fails or an executor that is lost costs the readings since the last flush, not the task's: another
attempt of the task, and the next run, find the rest.  Errors aren't stored and are tried again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.operators.routing import ordered
from attestor.session import cut
from attestor.sources.documents import Reader, few_rows, page_top_config
from attestor.sources.ledger import Store

#: Readings after which a task publishes.
FLUSH = 64
SCHEMA = "key string, text string, conf double"
_ARROW = pa.schema([("key", pa.string()), ("text", pa.string()), ("conf", pa.float64())])


class Readings:
    """The store at a path, in a shared file system or HDFS."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        Store(path).make("data", "making")

    def table(self) -> DataFrame:
        """key, text and conf; of a key that two attempts read at once one reading."""
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/data").groupBy("key").agg(F.min(F.struct("text", "conf")).alias("r")).select("key", "r.*")

    def read(self, images: DataFrame, configs: DataFrame, reader: Reader, keep: tuple[str, ...] = ("source_docx", "image_name")) -> DataFrame:
        """As ``documents.read_images``, from the store where it has the reading, else from the reader and into the store.

        ``images`` holds the kept columns and ``content``; a page without content gives readings with an error.
        """
        pages = images.select(*keep, "content", F.sha2("content", 256).alias("image"))
        plan = configs.select("roi", "phase", "config_ord", "config", "settings")
        asked = cut(pages.select(*keep, "image").join(F.broadcast(plan)).withColumn("key", F.sha2(F.concat("image", F.lit("|"), "settings"), 256)))  # plan: some fifty rows
        unknown = asked.where("key is not null").select("image", "key", "settings").distinct().join(self.table().select("key"), "key", "left_anti")
        wanted = unknown.groupBy("image").agg(F.collect_list(F.struct("key", "settings")).alias("asked"))  # at most one a config
        content = pages.where("image is not null").select("image", "content").dropDuplicates(["image"])
        failed = cut(_read(content.join(wanted, "image"), self.path, reader))
        errors = failed.select("key", "error")
        out = asked.join(self.table(), "key", "left").join(errors, "key", "left")
        error = F.when(F.col("key").isNull(), "no content").when(F.col("conf").isNull(), F.coalesce("error", F.lit("not read"))).otherwise("")
        return out.select(*keep, "roi", "phase", "config_ord", "config", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("conf", F.lit(0.0)).alias("conf"), error.alias("error"))


def page_texts(store: Readings, images: DataFrame, reader: Reader) -> DataFrame:
    """(source_docx, ord, image_name, text) of every page's top, as ``extract.contract_pages`` scores them.

    Employer and agency extraction ask for the same pages, and so does the next run: the store reads a
    page's top once, and again only when its image has changed.
    """
    pages = images.select("source_docx", "image_name", "content")
    tops = store.read(pages, page_top_config(store.spark), reader).select("source_docx", "image_name", "text")
    return ordered(pages.select("source_docx", "image_name")).join(tops, ["source_docx", "image_name"]).select("source_docx", "ord", "image_name", "text")


def _read(wanted: DataFrame, path: str, reader: Reader) -> DataFrame:
    """(key, error) of what the reader failed on; all else is in the store then."""
    job = uuid.uuid4().hex

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, context = Store(path), TaskContext.get()
        mine = f"{job}-{context.partitionId()}-"
        # An earlier attempt of this task may have published some already.
        known = set()
        if context.attemptNumber():
            for f in store.names("data"):
                if f.base_name.startswith(mine):
                    known.update(pq.read_table(store.at(f"data/{f.base_name}"), columns=["key"], filesystem=store.files)["key"].to_pylist())
        held: list[tuple[str, str, float]] = []

        def publish() -> None:
            if held:
                name = f"{mine}{uuid.uuid4().hex}.parquet"
                pq.write_table(pa.table([list(c) for c in zip(*held, strict=True)], schema=_ARROW), store.at(f"making/{name}"), filesystem=store.files)
                if not store.publish(f"making/{name}", f"data/{name}"):
                    raise FileExistsError(name)
                held.clear()

        for frame in frames:
            for content, asked in zip(frame["content"], frame["asked"], strict=True):
                failed = []
                for a in asked:
                    if a["key"] in known:
                        continue
                    try:
                        text, conf = reader(bytes(content), json.loads(a["settings"]))
                        held.append((a["key"], text, float(conf)))
                    except Exception as e:  # an external engine may raise anything
                        failed.append((a["key"], f"{type(e).__name__}: {e}"))
                    if len(held) >= FLUSH:
                        publish()
                if failed:
                    yield pd.DataFrame(failed, columns=["key", "error"])
        publish()

    few_rows(wanted.sparkSession)
    return wanted.select("content", "asked").mapInPandas(work, "key string, error string")
