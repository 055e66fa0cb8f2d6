"""Readings are paid for once: second runs, equal images, failing jobs and errors."""

import collections
import os

import pytest

from attestor.sources import documents, readings


def counting(folder, dies=None, fails=None):
    """A reader that leaves a mark a call; at ``dies`` its task ends, at ``fails`` it raises."""

    def read(content, settings):
        with open(f"{folder}/calls", "a") as f:  # noqa: PTH123
            f.write(f"{content.decode()}|{settings['psm']}|{settings['roi'][0]}\n")
        if content == dies:
            raise SystemExit("the executor is lost")
        if content == fails:
            raise ValueError("unreadable")
        return f"text of {content.decode()}", 50.0 + settings["psm"]

    return read


def calls(folder):
    return collections.Counter(open(f"{folder}/calls").read().split()) if os.path.exists(f"{folder}/calls") else collections.Counter()  # noqa: PTH123, SIM115


def images(spark, n, start=0):
    rows = [(f"d{i}", "image1.png", f"page{i % (n - 2)}".encode()) for i in range(start, n)] + [("d0", "image2.png", None)]
    return spark.createDataFrame(rows, "source_docx string, image_name string, content binary")


def test_a_second_run_reads_nothing(spark, tmp_path):
    store, configs = readings.Readings(spark, f"file://{tmp_path}/store"), documents.config_table(spark, "mol")
    df = images(spark, 8)
    got = {tuple(r) for r in store.read(df, configs, counting(tmp_path)).collect()}
    first = calls(tmp_path)
    distinct = configs.select("settings").distinct().count()
    assert sum(first.values()) == 6 * distinct  # six different images; equal settings of two phases are one reading
    plain = {tuple(r) for r in documents.read_images(df, configs, counting(tmp_path / "..")).collect()}
    assert got == plain
    assert {tuple(r) for r in store.read(df, configs, counting(tmp_path)).collect()} == got
    assert calls(tmp_path) == first
    more = store.read(images(spark, 12), configs, counting(tmp_path)).where("error = ''")
    assert more.count() == 12 * configs.count()
    assert sum(calls(tmp_path).values()) == 10 * distinct


def test_a_failed_job_keeps_what_was_published(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readings, "FLUSH", 1)
    store, configs = readings.Readings(spark, f"file://{tmp_path}/store"), documents.config_table(spark, "permit_upper")
    df = images(spark, 10).coalesce(1)
    with pytest.raises(Exception, match=r"lost|SystemExit|crashed|exited"):
        store.read(df, configs, counting(tmp_path, dies=b"page5")).collect()
    paid = store.table().count()
    before = calls(tmp_path)
    out = store.read(df, configs, counting(tmp_path)).where("error = ''")
    assert out.count() == 10 * configs.count()
    again = calls(tmp_path) - before
    assert sum(again.values()) == 8 * configs.select("settings").distinct().count() - paid
    assert all(n == 1 or k.startswith("page5|") for k, n in (before + again).items() if before[k] and again[k])


def test_errors_are_tried_again(spark, tmp_path):
    store, configs = readings.Readings(spark, f"file://{tmp_path}/store"), documents.config_table(spark, "mol")
    df = images(spark, 5)
    out = store.read(df, configs, counting(tmp_path, fails=b"page1")).collect()
    bad = {r["source_docx"]: r["error"] for r in out if r["error"]}
    assert bad == {"d1": "ValueError: unreadable", "d4": "ValueError: unreadable", "d0": "no content"}
    fine = store.read(df, configs, counting(tmp_path)).where("error <> ''").select("image_name").distinct().collect()
    assert [r["image_name"] for r in fine] == ["image2.png"]
    assert store.read(df.limit(0), configs, counting(tmp_path)).count() == 0


def test_page_tops_are_read_once(spark, tmp_path):
    """Scores of pages come from the store; a changed page alone is read anew."""
    from attestor.operators import extract

    marks = f"{tmp_path}/calls"

    def reader(content, settings):
        assert settings["roi"] == [0.0, 0.0, 1.0, 0.35]
        with open(marks, "a") as f:  # noqa: PTH123
            f.write(content.decode().split()[0] + "\n")
        return content.decode(), 90.0

    def pages(**changed):
        texts = {"image1.png": "cover", "image2.png": "form Nama Majikan Alamat", "image10.png": "prose PIHAK PERTAMA"} | changed
        return spark.createDataFrame([("d", n, t.encode()) for n, t in texts.items()], "source_docx string, image_name string, content binary")

    store = readings.Readings(spark, f"file://{tmp_path}/store")
    for _ in range(2):
        texts = readings.page_texts(store, pages(), reader)
        assert [(r["ord"], r["image_name"]) for r in texts.orderBy("ord").collect()] == [(0, "image1.png"), (1, "image2.png"), (2, "image10.png")]
        assert [(r["image_name"], r["found"]) for r in extract.contract_pages(texts).collect()] == [("image2.png", True)]
    assert calls(tmp_path) == {"cover": 1, "form": 1, "prose": 1}
    moved = readings.page_texts(store, pages(**{"image1.png": "other Nama Majikan Alamat MOL License"}), reader)
    assert [r["image_name"] for r in extract.contract_pages(moved).collect()] == ["image1.png"]
    assert calls(tmp_path) == {"cover": 1, "form": 1, "prose": 1, "other": 1}


def test_two_extractions_compared(spark):
    from attestor.operators import extract

    schema = "source_docx string, name_cn string, phone string"
    one = spark.createDataFrame([("a", "x", "1"), ("b", None, "2"), ("c", "z", "3")], schema)
    two = spark.createDataFrame([("a", "x", "9"), ("b", "y", "2"), ("d", "w", "4")], schema)
    got = sorted(map(tuple, extract.compare_extractions(one, two, ["name_cn", "phone"]).collect()))
    assert got == [("a", "phone", "1", "9"), ("b", "name_cn", None, "y")]
