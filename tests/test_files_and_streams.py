"""Sources, sinks, the stream and the catalogue."""

import io
import os
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from attestor.plans import batch, catalogue
from attestor.operators import registry
from attestor.schema import EMPLOYER, OCR_READ, SCAN_RESULT, SHEET_COLUMNS, conform
from attestor.sources import documents, images, sinks, tables
from attestor.streaming import watch


def docx(path, names):
    with zipfile.ZipFile(path, "w") as z:
        for n in names:
            z.writestr(n, b"img:" + n.encode())


def test_documents_and_pages(spark, tmp_path):
    docx(tmp_path / "a b.docx", ["word/media/image2.png", "word/media/image10.JPG", "word/media/x.tiff", "word/document.xml", "docProps/image1.png"])
    (tmp_path / "~$a.docx").write_bytes(b"lock")
    (tmp_path / "bad.docx").write_bytes(b"no archive")
    (tmp_path / "other.txt").write_bytes(b"x")
    files = documents.documents(spark, f"file://{tmp_path}")
    assert sorted(r["source_docx"] for r in files.collect()) == ["a b.docx", "bad.docx"]
    pages = documents.page_images(files)
    assert sorted((r["source_docx"], r["image_name"]) for r in pages.where("error = ''").collect()) == [("a b.docx", "image10.JPG"), ("a b.docx", "image2.png"), ("a b.docx", "x.tiff")]
    assert [r["source_docx"] for r in pages.where("error <> ''").collect()] == ["bad.docx"]
    assert sorted(r["image_name"] for r in documents.for_extraction(pages).collect()) == ["image10.JPG", "image2.png"]


def test_names_and_damaged_archives(spark, tmp_path):
    docx(tmp_path / "a+b %41.docx", ["word/media/image1.png", "word/media/image2.png"])
    raw = bytearray((tmp_path / "a+b %41.docx").read_bytes())
    with zipfile.ZipFile(tmp_path / "c.docx", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/media/image1.png", bytes(range(256)) * 40)
        z.writestr("word/media/image2.png", b"fine")
    raw = bytearray((tmp_path / "c.docx").read_bytes())
    raw[60:90] = b"\xff" * 30  # inside the first deflate stream
    (tmp_path / "c.docx").write_bytes(raw)
    pages = documents.page_images(documents.documents(spark, f"file://{tmp_path}")).collect()
    assert sorted((r["source_docx"], r["image_name"], r["error"] == "") for r in pages) == [("a+b %41.docx", "image1.png", True), ("a+b %41.docx", "image2.png", True), ("c.docx", "image1.png", False), ("c.docx", "image2.png", True)]


def test_second_tier_is_read_only_where_needed(spark):
    """A sure vote in images 2, 5, 6 spares the rest; the reader's calls are in its readings."""
    names = [f"image{i}.png" for i in range(1, 8)]
    rows = [(d, n, n.encode() + d.encode()) for d in ("sure", "open") for n in names] + [("small", "image1.png", b"image1.pngsmall")]
    pages = spark.createDataFrame(rows, "source_docx string, image_name string, content binary")

    def reader(content, settings):
        return ("No. izin: 1234", 80.0) if content == b"image2.pngsure" else ("", 0.0)

    got = documents.scan_in_tiers(pages, documents.config_table(spark), reader)
    read = {(r["source_docx"], r["image_name"]) for r in got.select("source_docx", "image_name").distinct().collect()}
    assert {n for d, n in read if d == "sure"} == {"image2.png", "image5.png", "image6.png"}
    assert {n for d, n in read if d == "open"} == set(names)
    assert ("small", "image1.png") in read
    assert got.groupBy("source_docx", "image_name").count().where("count <> 51").count() == 0
    whole = documents.scan_in_tiers(pages, documents.config_table(spark, "mol"), reader, whole=True)
    assert whole.count() == 15 * 17
    assert documents.engine_options({"psm": 6, "characters": "ab"}) == "--psm 6 -c tessedit_char_whitelist=ab"


def test_errors_that_may_pass():
    class Odd(Exception):
        def __init__(self, code):
            self.code = code

    assert [sinks.may_pass(e) for e in (ConnectionError(), TimeoutError(), Odd(429), Odd(503), Odd(404), ValueError())] == [True, True, True, True, False, False]


def test_readers_never_fail_a_task(spark):
    pages = spark.createDataFrame([("d", "image1.png", b"ok"), ("d", "image2.png", b"bad")], "source_docx string, image_name string, content binary")

    def reader(content, settings):
        if content == b"bad":
            raise RuntimeError("engine")
        return f"{settings['psm']}", 50.0

    got = documents.read_images(pages, documents.config_table(spark, "mol"), reader)
    assert got.count() == 2 * (6 + 9 + 2)
    assert got.where("error <> ''").count() == 17
    assert documents.config_table(spark).count() == 51
    with pytest.raises(ValueError, match="unknown region"):
        documents.config_table(spark, "nowhere")


def test_pixels():
    image = np.full((40, 60, 3), 200, np.uint8)
    image[10:20, 10:20] = (200, 20, 20)
    image[25:30, 5:50] = 10
    assert images.crop(image, (0.5, 0.0, 1.0, 0.5)).shape == (20, 30, 3)
    clean = images.remove_stamp(image)
    assert clean[15, 15] == 255
    assert clean[27, 20] == 0
    out = images.prepare(image, {"channel": "R", "scale": 2, "median": 3, "sharpen": True, "roi": (0, 0, 1, 1)})
    assert out.shape == (80, 120)
    page = np.full((20, 20), 255.0)
    page[3, 4] = 0
    assert (images.stretch(page) == page).all()
    assert images.median(np.arange(81.0).reshape(9, 9), 5)[4, 4] == 40
    assert out.dtype == np.uint8


def test_csv_codec(spark, tmp_path):
    (tmp_path / "m.csv").write_text("﻿source_docx,mol,mol_conf,mol_from_vote,vision_review,status\na,1,67.1,Y,✓,permit_partial\nb,,,,,odd\nc,2,x,N,,ok\n", encoding="utf-8")
    rows = {r["source_docx"]: r for r in tables.scan_results(spark, f"file://{tmp_path}/m.csv").collect()}
    assert (rows["a"]["mol_conf"], rows["a"]["mol_from_vote"], rows["a"]["vision_review"], rows["a"]["status"]) == (67.1, True, True, "permit_partial")
    assert (rows["b"]["mol"], rows["b"]["mol_conf"], rows["b"]["status"], rows["b"]["scan_tier"]) == ("", 0.0, "ok", 1)
    assert (rows["c"]["mol_conf"], rows["c"]["mol_from_vote"]) == (0.0, False)
    full = conform(spark.createDataFrame([("a", 67.14, True)], "source_docx string, mol_conf double, cross_match boolean"), SCAN_RESULT)
    sinks.write_results(full, f"file://{tmp_path}/out")
    back = tables.scan_results(spark, f"file://{tmp_path}/out").first()
    assert (back["mol_conf"], back["cross_match"], back["id_conf"]) == (67.1, True, 0.0)


def test_log_sheet_and_reports(spark, tmp_path):
    base = f"file://{tmp_path}"
    assert tables.upload_log(spark, f"{base}/none.csv").count() == 0
    rows = spark.createDataFrame([("a", "1", "keyed-in", "r"), ("b", "", "manual_review", "r")], "source_docx string, permit string, status string, reason string")
    whole = conform(rows, ", ".join(f"{c} string" for c in SHEET_COLUMNS))
    assert [sinks.append_sheet(whole, f"{base}/sheet", run, tables.upload_log(spark, f"{base}/none.csv")) for run in ("one", "two")] == [2, 0]
    assert sinks.sheet(spark, f"{base}/sheet").rows().count() == 2
    emp = conform(spark.createDataFrame([("a", "J: x"), ("b", "")], "source_docx string, doubt string"), EMPLOYER)
    sinks.write_doubts(emp, f"{base}/doubts")
    assert spark.read.option("header", True).csv(f"{base}/doubts").count() == 1


def test_roster_and_gazetteer_files(spark, tmp_path):
    (tmp_path / "r.json").write_text('﻿[{"許可證":"0234","機構名稱":" 新星 ","電話":"02-23456789#1","廢止許可日期":null,"終止營業日期":""},{"許可證":"235","終止營業日期":"20200101"}]', encoding="utf-8")
    rows = tables.roster(spark, f"file://{tmp_path}/r.json").orderBy("pos").collect()
    assert [(r["base"], r["name"], r["active"]) for r in rows] == [(234, "新星", True), (235, "", False)]
    assert tables.roster_age_days(spark, f"file://{tmp_path}/r.json").first()["days"] in (0, 1)
    out = sinks.roster_export(tables.roster(spark, f"file://{tmp_path}/r.json")).orderBy("permit").collect()
    assert [(r["permit"], r["phones"], r["phone_note"], r["state"], r["closed_on"]) for r in out] == [("0234", "0223456789", "extension", "active", ""), ("235", "", "none", "inactive", "2020-01-01")]
    (tmp_path / "g.json").write_text('[{"CityName":"臺北市","CityEngName":"Taipei City","AreaList":[{"AreaName":"中山區","AreaEngName":"Z","ZipCode":"104","RoadList":[{"RoadName":"一路二段","RoadEngName":"Y"}]}]}]', encoding="utf-8")
    (tmp_path / "c.json").write_text('[{"CityName":"台北市","AreaName":"中山區","RoadName":"新路","RoadEngName":"N"}]', encoding="utf-8")
    roads = tables.gazetteer_roads(spark, f"file://{tmp_path}/g.json", f"file://{tmp_path}/c.json").orderBy("road_pos").collect()
    assert [(r["road_norm"], r["road_base"]) for r in roads] == [("一路2段", "一路"), ("新路", "新路")]


def test_retries():
    calls, waits = [], []

    def action():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError
        return "done"

    assert sinks.retrying(action, sleep=waits.append) == "done"
    assert waits == [2.0, 4.0]
    with pytest.raises(ValueError, match="no"):
        sinks.retrying(lambda: (_ for _ in ()).throw(ValueError("no")), sleep=waits.append)


def _reads(spark, rows):
    return conform(spark.createDataFrame(rows, "source_docx string, image_name string, roi string, phase string, config_ord int, text string, conf double"), OCR_READ)


def test_batch_end_to_end(spark):
    permit = "No. izin: {}"
    rows = [("key", f"image{i}.png", "permit_upper", p, n, permit.format("2340"), 80.0) for i in (5,) for p, n in (("scan", 0), ("vote", 0), ("vote", 1))]
    rows += [("ask", "image5.png", "mol", "scan", 0, "MOL 1111", 60.0), ("ask", "image5.png", "permit_upper", "scan", 0, permit.format("2222"), 50.0)]
    pages = spark.createDataFrame([(d, f"image{i}.png") for d in ("key", "ask", "none") for i in range(1, 6)], "source_docx string, image_name string")
    second = spark.createDataFrame([("ask", "image5.png", "No. izin: 2222")], "source_docx string, image_name string, text string")
    blocks = spark.createDataFrame([("none", ["02-2345-6789"], "", "")], "source_docx string, phones array<string>, agency_text_name string, agency_text_address string")
    reg = registry.roster(spark.createDataFrame([(0, "2340", "新星", "", "02-2345-6789", "", "")], "pos long, permit string, name string, address string, phone string, revoked_on string, closed_on string"))
    log = spark.createDataFrame([("2222",)], "final_value string")
    emp = conform(spark.createDataFrame([("key", "林大明")], "source_docx string, name_cn string"), EMPLOYER)
    got = {r["source_docx"]: (r["permit"], r["status"], r["agency_name"], r["employer_cn"]) for r in batch.run(_reads(spark, rows), second, blocks, reg, emp, log, pages).collect()}
    assert got == {"key": ("2340", "keyed-in", "新星", "林大明"), "ask": ("2222", "keyed-in", "", ""), "none": ("2340", "manual_review", "新星", "")}


def test_stream_routes_late_readings_anew(spark, tmp_path):
    base = f"file://{tmp_path}"
    permit = "No. izin: 2340"
    _reads(spark, [("d", "image5.png", "permit_upper", "scan", 0, permit, 40.0), *(("d", f"image{i}.png", "mol", "vote", 0, "", 1.0) for i in range(1, 5))]).write.mode("append").parquet(f"{base}/in")
    paths = (f"{base}/in", f"{base}/out", f"{base}/check")
    watch.watch(spark, *paths).awaitTermination(120)
    assert [r["route"] for r in watch.latest(spark, paths[1]).collect()] == ["second_reader"]
    _reads(spark, [("d", "image5.png", "permit_upper", "vote", n, permit, 80.0) for n in (0, 1)]).write.mode("append").parquet(f"{base}/in")
    watch.watch(spark, *paths).awaitTermination(120)
    assert [(r["route"], r["candidate_value"]) for r in watch.latest(spark, paths[1]).collect()] == [("direct", "2340")]
    # A reading that comes again replaces the one before.
    _reads(spark, [("d", "image5.png", "permit_upper", "vote", n, "No. izin: 7777", 90.0) for n in (0, 1)]).write.mode("append").parquet(f"{base}/in")
    watch.watch(spark, *paths).awaitTermination(120)
    assert [(r["route"], r["candidate_value"]) for r in watch.latest(spark, paths[1]).collect()] == [("direct", "7777")]


def test_batches_of_a_stream_stay_small(spark, tmp_path, monkeypatch):
    """Every batch decides its own document from state; what was stored before isn't read again."""
    base, sizes = f"file://{tmp_path}", []
    decide = watch.decide_documents

    def counting(df):
        sizes.append((df.count(), df.select("source_docx").distinct().count()))
        return decide(df)

    monkeypatch.setattr(watch, "decide_documents", counting)
    for i in range(4):
        rows = [(f"d{i // 2}", f"image{k}.png", "permit_upper", "vote" if i % 2 else "scan", 0, "No. izin: 2340", 80.0) for k in range(1, 6)]
        _reads(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/in")
        os.utime(next(p for p in (tmp_path / "in").glob("*.parquet") if p.stat().st_mtime > 1000 + 10 * i or not i), (1000 + 10 * i, 1000 + 10 * i))
    query = watch.watch(spark, f"{base}/in", f"{base}/out", f"{base}/check", files_a_batch=1)
    query.awaitTermination(240)
    assert [n for n, _ in sizes if n] == [5, 10] * 2
    assert {d for n, d in sizes if n} == {1}
    assert {p["numInputRows"] for p in query.recentProgress if p["numInputRows"]} == {5}
    _, whole = decide(spark.read.schema(OCR_READ).parquet(f"{base}/in"))
    columns = ("source_docx", "image_name", "candidate_value", "route")
    want = sorted(tuple(r[c] for c in columns) for r in whole.collect())
    assert sorted(tuple(r[c] for c in columns) for r in watch.latest(spark, f"{base}/out").collect()) == want
    assert {r[0] for r in want} == {f"d{i}" for i in range(2)}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no driver tables")
def test_catalogue_against_duckdb(spark):
    duckdb = pytest.importorskip("duckdb")
    folder, db = "/root/testdata/sf0.001", duckdb.connect()
    for f in os.listdir(folder):
        db.execute(f"create view {f.removesuffix('.parquet')} as select * from '{folder}/{f}'")
    for name, sql in catalogue.oracle_sql().items():
        own = catalogue.queries()[name](spark, folder)
        columns = sorted(own.columns)
        want = db.execute(sql).fetch_df()
        assert sorted(want.columns) == columns, name
        a = sorted(str([str(v) for v in r]) for r in own.select(*(F.col(c).cast("string") for c in columns)).collect())
        b = sorted(str([str(v) for v in r]) for r in db.execute(f"select {', '.join(f'CAST({c} AS VARCHAR)' for c in columns)} from ({sql})").fetchall())
        assert a == b, name
    assert catalogue.flagship(spark, folder).count() > 0


def test_permits_of_more_than_four_digits(spark, tmp_path):
    """Agencies with long keys are found by their own permit, on their own row of the sheet too."""
    folder = str(tmp_path)
    spark.createDataFrame([(k, f"s{k}", 3) for k in (1234, 12345, 12346, 99999)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(k, f"c{k}", 1, 1.0) for k in (1234, 12345, 12346, 99999)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(k, k, "F", "p") for k in (1234, 12345, 12346)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    found = {r["c_custkey"]: r["agency_name"] for r in catalogue.queries()["permit_lookup"](spark, folder).collect()}
    assert found == {1234: "", 12345: "s12345", 12346: "", 99999: "s99999"}
    sheet = {r["permit"]: r["agency_name"] for r in catalogue.queries()["union_batches"](spark, folder).collect()}
    assert sheet == {"1234": "", "12345": "s12345", "12346": ""}


def test_sheet_of_keys_beyond_int_and_of_orders_without_status(spark, tmp_path):
    """Keys of any size find their agency, and an order without a status is a row for review."""
    folder, big = str(tmp_path), 3 * 10**9
    spark.createDataFrame([(k, f"s{k}", 3) for k in (5, big, 2**40 + 2)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(k, f"c{k}", 1, 1.0) for k in (5, big)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(1, 5, None, "p"), (2, big, "F", "p"), (3, 2**40 + 2, "O", "p")], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    sheet = {r["permit"]: (r["status"], r["agency_name"]) for r in catalogue.queries()["union_batches"](spark, folder).collect()}
    assert sheet == {"5": ("manual_review", "s5"), str(big): ("keyed-in", f"s{big}"), str(2**40 + 2): ("manual_review", f"s{2**40 + 2}")}
