"""An addition of ours: page readings that arrive as a stream are routed batch by batch.

Readings of a document may come late and in parts.  They are kept as keyed state of the stream, so a micro-batch
decides the documents that it touches from all their readings and reads nothing that was stored before;
what a batch costs follows its own documents, not the stream's age.  A reading that comes again replaces
the earlier one.  State that isn't touched for a while may be given up (``keep_s``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from attestor.plans.batch import decide_documents
from attestor.schema import OCR_READ
from attestor.session import cut

_COLUMNS = [c.split()[0] for c in OCR_READ.split(", ")]
#: What tells a document's readings apart, and what a reading is.
_PLACE = "image_name string, roi string, phase string, config_ord int"
_READING = "config string, engine string, text string, conf double"
_PLACE_COLUMNS, _READING_COLUMNS = ([c.split()[0] for c in s.split(", ")] for s in (_PLACE, _READING))
#: Readings that the state hands on at a time.
_ROWS = 1000


class KnownReadings(StatefulProcessor):
    """Takes a document's new readings and gives all that are known of it."""

    def __init__(self, keep_s: int | None = None):
        self.keep_ms = keep_s * 1000 if keep_s else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getMapState("readings", _PLACE, _READING, self.keep_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for frame in rows:
            # Of equal places in one batch the last in order of its values counts, whatever order rows come in.
            for r in frame.sort_values(_COLUMNS[1:]).to_dict("records"):
                self.known.updateValue(tuple(r[c] for c in _PLACE_COLUMNS), tuple(r[c] for c in _READING_COLUMNS))
        held = []
        for place, reading in self.known.iterator():
            held.append(dict(zip(_PLACE_COLUMNS, place, strict=True)) | dict(zip(_READING_COLUMNS, reading, strict=True)))
            if len(held) >= _ROWS:
                yield self._frame(key, held)
                held = []
        if held:
            yield self._frame(key, held)

    @staticmethod
    def _frame(key: tuple, rows: list[dict]) -> pd.DataFrame:
        return pd.DataFrame(rows).assign(source_docx=key[0])[_COLUMNS]

    def close(self) -> None:
        pass


def watch(spark: SparkSession, reads_dir: str, output: str, checkpoint: str, keep_s: int | None = None, files_a_batch: int = 1000) -> StreamingQuery:
    """Start routing readings that appear as Parquet files in ``reads_dir``; stops when all are done."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = spark.readStream.schema(OCR_READ).option("maxFilesPerTrigger", files_a_batch).parquet(reads_dir)
    whole = stream.fillna("").fillna(0).groupBy("source_docx").transformWithStateInPandas(KnownReadings(keep_s), OCR_READ, "Update", "ProcessingTime" if keep_s else "None")

    def batch(df: DataFrame, number: int) -> None:
        # The state is advanced once; a batch that runs again after a failure writes the same folder again.
        _, queue = decide_documents(cut(df))
        queue.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{output}/number={number}")

    return whole.writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, output: str) -> DataFrame:
    """Each document's queue items from the last batch that decided it."""
    rows = spark.read.parquet(output)
    last = rows.groupBy("source_docx").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["source_docx", "batch"]).drop("batch", "number")
