"""Appends killed between any two steps, lost races, failing tasks, and logs that hold any text."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from attestor.schema import SHEET_COLUMNS
from attestor.sources import ledger, sinks, tables

SCHEMA = "source_docx string, permit string, status string, reason string"
ROWS = [("a", "1", "keyed-in", "r"), ("b", "", "manual_review", 'first line\nsecond, "quoted"\r\n'), ("b", "2", "keyed-in", " "), ("c", "3", "keyed-in", "三 x")]


def sheet_rows(spark, rows=ROWS):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select(*(c if c in df.columns else F.lit("").alias(c) for c in SHEET_COLUMNS))


def found(spark, path):
    return sorted((r["source_docx"], r["permit"], r["status"], r["reason"]) for r in sinks.sheet(spark, path).rows().collect())


def logged(spark, path):
    return sorted((r["source_docx"], r["final_value"], r["status"], r["reason"]) for r in sinks.sheet_log(spark, path).collect())


def staged(spark, path, base=0, run="dying"):
    """A writer whose tasks are done, as the driver has it before the commit."""
    sinks.sheet(spark, path)
    writer = ledger.LedgerWriter({"path": path, "run": run, "base": str(base)})
    table = sheet_rows(spark).toArrow()
    return writer, [writer.write(iter([b])) for b in table.to_batches()] + [writer.write(iter([]))]


@pytest.mark.parametrize("step", ["tasks done", "manifest made", "published", "published, abort called"])
def test_killed_between_two_steps(spark, tmp_path, monkeypatch, step):
    path = f"file://{tmp_path}/sheet"
    writer, messages = staged(spark, path)
    if step != "tasks done":
        link = os.link

        def dying(one, two):
            if step != "manifest made":
                link(one, two)
            raise MemoryError("killed")

        monkeypatch.setattr(os, "link", dying)
        with pytest.raises(MemoryError):
            writer.commit(messages)
        monkeypatch.undo()
        if "abort" in step:
            writer.abort(messages)
    appended = sinks.append_sheet(sheet_rows(spark), path, "next")
    assert appended == (0 if step.startswith("published") else len(ROWS))
    assert found(spark, path) == logged(spark, path) == sorted(ROWS)
    assert sinks.append_sheet(sheet_rows(spark), path, "another") == 0
    sinks.sheet(spark, path).vacuum(0)
    listed = {r["file"] for r in sinks.sheet(spark, path).manifests().collect()}
    assert {f"data/{n}" for n in os.listdir(f"{tmp_path}/sheet/data")} == listed
    assert all(n.endswith(".json") for n in os.listdir(f"{tmp_path}/sheet/commits") if not n.endswith(".crc"))
    assert found(spark, path) == sorted(ROWS)


def test_a_lost_race_is_planned_anew(spark, tmp_path):
    path = f"{tmp_path}/sheet"
    rows, rival, calls = sheet_rows(spark), sheet_rows(spark, ROWS[:2]), []

    def new(df, committed):
        calls.append(1)
        left = sinks.not_yet_written(df, committed)
        if len(calls) == 1:
            left = spark.createDataFrame(left.collect(), left.schema)
            assert sinks.append_sheet(rival, path, "rival") == 2
        return left

    assert sinks.sheet(spark, path).append(rows, "slow", new) == 2
    assert len(calls) == 2
    assert found(spark, path) == sorted(ROWS)
    assert {r["run"]: r["count"] for r in sinks.sheet(spark, path).rows().groupBy("run").count().collect()} == {"rival": 2, "slow": 2}
    assert len(os.listdir(f"{tmp_path}/sheet/data")) == len({r["file"] for r in sinks.sheet(spark, path).manifests().collect()})


def test_a_failing_task_publishes_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/sheet"
    bad = sheet_rows(spark).repartition(3, "source_docx").withColumn("permit", F.when(F.col("source_docx") == "c", F.raise_error(F.lit("broken reading"))).otherwise(F.col("permit")))
    with pytest.raises(Exception, match="broken reading"):
        sinks.append_sheet(bad, path, "one")
    assert found(spark, path) == []
    assert os.listdir(f"{tmp_path}/sheet/commits") == []
    assert sinks.append_sheet(sheet_rows(spark), path, "one") == len(ROWS)
    assert found(spark, path) == sorted(ROWS)


def test_old_logs_and_exports(spark, tmp_path):
    path = f"file://{tmp_path}/sheet"
    old = spark.createDataFrame([("t", "a", "1", "vision", "line\nbreak"), ("t", "z", "9", "keyed-in", "")], "timestamp string, source_docx string, final_value string, status string, reason string")
    sinks.export_log(old, f"file://{tmp_path}/old")
    back = tables.upload_log(spark, f"file://{tmp_path}/old")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, old.collect()))
    assert sinks.append_sheet(sheet_rows(spark), path, "one", back) == len(ROWS) - 1
    sinks.export_log(sinks.sheet_log(spark, path), f"file://{tmp_path}/log")
    again = tables.upload_log(spark, f"file://{tmp_path}/log")
    assert sorted((r["source_docx"], r["final_value"], r["status"], r["reason"]) for r in again.collect()) == sorted(ROWS[1:])
    assert all(r["timestamp"] for r in again.collect())


def test_empty_appends_and_versions(spark, tmp_path):
    sheet = sinks.sheet(spark, f"{tmp_path}/sheet")
    assert sheet.append(sheet_rows(spark).limit(0), "none") == 0
    assert (sheet.version(), sheet.rows().count()) == (0, 0)
    sheet.append(sheet_rows(spark, ROWS[:1]), "one")
    sheet.append(sheet_rows(spark, ROWS[1:]), "two")
    assert (sheet.version(), sheet.rows(1).count(), sheet.rows().count()) == (2, 1, len(ROWS))
    assert sheet.vacuum(0) == 0


def test_stores(tmp_path):
    store = ledger.Store(f"file:{tmp_path}/x y")
    store.make("commits")
    store.write("commits/.a", "1")
    store.write("commits/.b", "2")
    assert store.publish("commits/.a", "commits/1")
    assert not store.publish("commits/.b", "commits/1")
    assert store.read("commits/1") == "1"
    assert store.read("commits/none") is None
    with pytest.raises((ValueError, OSError, pa.ArrowException)):
        ledger.Store("s3://bucket/x")
