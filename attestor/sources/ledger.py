"""A table whose appends are transactions: rows and what the log says of them are published together or not at all.

A ledger is a folder.  Tasks write Parquet files into ``data`` under names of their own; nothing reads a
file there until a manifest in ``commits`` lists it.  The driver publishes one manifest an append, by
linking a finished file to the next version's name, which fails if another append took that version.

* Killed before the link: the files stay unlisted; the next append doesn't see them, ``vacuum`` removes them.
* Killed after it: rows and log are both there, and the next append, under whatever run id, leaves them out.
* Two appends at once: the later one finds its version taken, drops its files and is planned anew on the
  newer log.

The log is a view of the committed rows, so it can never lag behind them.  The folder must be one that the
driver and all executors share, in a store with an atomic link (a file system) or a rename that doesn't replace (HDFS).
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "attestor_ledger"
#: What an error of a lost race says; the append is planned anew.
CONFLICT = "another append took version"
_MANIFEST = "version bigint, run string, committed_at string, job string, file string, n bigint"
_DIGITS = 12


@dataclass
class Written(WriterCommitMessage):
    """A task's file, or none where it had no rows."""

    file: str | None
    n: int


class Store:
    """The few file operations that a ledger needs, on a path or URI."""

    def __init__(self, path: str):
        self.local = path.startswith("file:") or "://" not in path
        if self.local:
            self.files, self.root = arrow_fs.LocalFileSystem(), os.path.abspath("/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path)
        else:
            self.files, self.root = arrow_fs.FileSystem.from_uri(path)
            if self.files.type_name != "hdfs":
                raise ValueError(f"a ledger needs a store with an atomic link or rename, not {self.files.type_name}")

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def make(self, *folders: str) -> None:
        for folder in folders:
            self.files.create_dir(self.at(folder), recursive=True)

    def names(self, folder: str) -> list[arrow_fs.FileInfo]:
        return self.files.get_file_info(arrow_fs.FileSelector(self.at(folder), allow_not_found=True))

    def read(self, name: str) -> str | None:
        try:
            with self.files.open_input_stream(self.at(name)) as f:
                return f.read().decode()
        except FileNotFoundError:
            return None

    def write(self, name: str, text: str) -> None:
        with self.files.open_output_stream(self.at(name)) as f:
            f.write(text.encode())

    def remove(self, name: str) -> None:
        try:
            self.files.delete_file(self.at(name))
        except FileNotFoundError:
            pass

    def publish(self, made: str, name: str) -> bool:
        """Give a finished file its name, unless that is taken."""
        if self.local:
            try:
                os.link(self.at(made), self.at(name))
            except FileExistsError:
                return False
            self.remove(made)
            return True
        try:
            self.files.move(self.at(made), self.at(name))
        except OSError:
            if self.read(name) is None:
                raise
            return False
        return True


def _commit_name(version: int) -> str:
    return f"commits/{version:0{_DIGITS}d}.json"


class LedgerWriter(DataSourceArrowWriter):
    """Tasks write files; the driver's commit publishes them under the version after ``base``."""

    def __init__(self, options: dict[str, str]):
        self.path, self.run, self.base = options["path"], options["run"], int(options["base"])
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, name, n, writer = Store(self.path), f"data/{self.job}-{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if batch.num_rows:
                    writer = writer or pq.ParquetWriter(store.at(name), batch.schema, filesystem=store.files, compression="zstd")
                    writer.write_batch(batch)
                    n += batch.num_rows
        except BaseException:
            if writer:
                writer.close()
                store.remove(name)
            raise
        if writer:
            writer.close()
        return Written(name if writer else None, n)

    def commit(self, messages: list[Written | None]) -> None:
        written = [m for m in messages if m and m.file]
        if not written:
            return
        store, version, made = Store(self.path), self.base + 1, f"commits/.{self.job}"
        now = time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime())
        entries = [{"version": version, "run": self.run, "committed_at": now, "job": self.job, "file": m.file, "n": m.n} for m in written]
        store.write(made, "".join(json.dumps(e) + "\n" for e in entries))
        if not store.publish(made, _commit_name(version)):
            store.remove(made)
            raise RuntimeError(f"{CONFLICT} {version}")

    def abort(self, messages: list[Written | None]) -> None:
        """Remove the files of this job, unless they are published after all."""
        store = Store(self.path)
        if f'"job": "{self.job}"' in (store.read(_commit_name(self.base + 1)) or ""):
            return
        store.remove(f"commits/.{self.job}")
        for m in messages:
            if m and m.file:
                store.remove(m.file)


class LedgerSource(DataSource):
    """``df.write.format("attestor_ledger")``; reading is Spark's own Parquet reader, see ``Ledger.rows``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        raise NotImplementedError("read a ledger with Ledger.rows")

    def writer(self, schema: StructType, overwrite: bool) -> LedgerWriter:
        if overwrite:
            raise ValueError("a ledger is only appended to")
        return LedgerWriter(dict(self.options))


class Ledger:
    """A ledger of rows of one schema at a path."""

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType):
        self.spark, self.path = spark, path
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.store = Store(path)
        self.store.make("data", "commits")
        spark.dataSource.register(LedgerSource)

    def manifests(self) -> DataFrame:
        """version, run, committed_at, job, file and n of every committed file."""
        return self.spark.read.schema(_MANIFEST).json(f"{self.path}/commits")

    def version(self) -> int:
        """The last committed version; 0 for an empty ledger."""
        return max((int(f.base_name.removesuffix(".json")) for f in self.store.names("commits") if f.base_name.endswith(".json")), default=0)

    def rows(self, version: int | None = None) -> DataFrame:
        """The committed rows, of all versions up to the given one, with the columns ``version``, ``run`` and ``committed_at``.

        Only the names of files pass the driver; Spark reads them with pruning and pushdown.
        """
        known = self.manifests() if version is None else self.manifests().where(F.col("version") <= version)
        files = [r["file"] for r in known.select("file").collect()]
        of = known.select(F.element_at(F.split("file", "/"), -1).alias("__file"), "version", "run", "committed_at")
        if not files:
            return self.spark.createDataFrame([], self.schema).withColumn("__file", F.lit("")).join(of, "__file").drop("__file")
        data = self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in files))
        return data.withColumn("__file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)).join(of, "__file").drop("__file")

    def append(self, rows: DataFrame, run: str, new: Any = None, tries: int = 8) -> int:
        """Append rows in one transaction and return how many were written.

        ``new(rows, committed)`` picks the rows that the ledger doesn't have (default: all); it is asked again
        after a lost race and after a failure whose outcome isn't known, so no row is written twice.
        """
        fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        for attempt in range(1, tries + 1):
            base = self.version()
            chosen = new(rows, self.rows(base)) if new else rows
            try:
                chosen.select(*fields).write.format(FORMAT).mode("append").option("path", self.path).option("run", run).option("base", str(base)).save()
            except Exception as e:
                if attempt == tries or CONFLICT not in str(e):
                    raise
                continue
            if self.version() == base:
                return 0
            mine = self.manifests().where((F.col("version") == base + 1) & (F.col("run") == run))
            return int(mine.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        return 0

    def vacuum(self, older_than_s: float = 86_400) -> int:
        """Remove files that no manifest lists and that are older than any append still running; return how many."""
        listed = {r["file"] for r in self.manifests().select("file").collect()}
        gone = 0
        for folder in ("data", "commits"):
            for f in self.store.names(folder):
                name = f"{folder}/{f.base_name}"
                stale = name not in listed if folder == "data" else f.base_name.startswith(".")
                if stale and f.mtime is not None and time.time() - f.mtime.timestamp() >= older_than_s:
                    self.store.remove(name)
                    gone += 1
        return gone
