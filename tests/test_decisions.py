"""Votes, decisions, aggregation, routing, verification: one row for each branch and each boundary."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from attestor.operators import routing, verify, votes
from attestor.plans.batch import decide_documents
from attestor.schema import LARGE_NO_HIT, OCR_READ, PERMIT_PARTIAL, SCAN_RESULT, SMALL_NO_HIT, conform

FIELDS = "source_docx string, image_name string, docx_class string, mol string, mol_conf double, mol_from_vote boolean, id string, id_conf double, id_from_vote boolean, cross_match boolean, final_value string, final_conf double, vision_review boolean, note string, status string, ord bigint"
NAMES = [f.split(" ")[0] for f in FIELDS.split(", ")]


def results(spark, *rows):
    base = dict(source_docx="d", image_name="image1.png", docx_class="large", mol="", mol_conf=0.0, mol_from_vote=False, id="", id_conf=0.0, id_from_vote=False, cross_match=False, final_value="", final_conf=0.0, vision_review=False, note="", status="ok", ord=0)
    data = [tuple({**base, "ord": i, **r}[n] for n in NAMES) for i, r in enumerate(rows)]
    return conform(spark.createDataFrame(data, FIELDS), SCAN_RESULT + ", ord bigint")


def test_majority_vote_needs_two_and_ties_go_to_the_first(spark):
    rows = [("a", "x", 1), ("a", "y", 2), ("a", "y", 3), ("a", "x", 4), ("b", "x", 1), ("c", "", 1), ("c", "", 2), ("d", None, 1)]
    got = votes.majority_vote(spark.createDataFrame(rows, "k string, v string, o int"), ["k"], "v", "o").collect()
    assert [tuple(r) for r in got] == [("a", "x", 2)]


@pytest.mark.parametrize(("row", "want"), [
    (dict(mol="1", id="1", mol_conf=60.0, id_conf=60.0), ("1", 60.0, False)),
    (dict(mol="1", id="2", mol_conf=60.0, id_conf=60.0), ("1", 60.0, False)),  # equal confidence is no conflict
    (dict(mol="1", id="2", mol_conf=61.0, id_conf=60.0), ("1", 61.0, True)),
    (dict(mol="1", id="2", mol_conf=59.0, id_conf=60.0), ("2", 60.0, False)),
    (dict(mol="1", id="1", mol_conf=55.0, id_conf=40.0), ("1", 55.0, True)),
    (dict(mol="1", mol_conf=55.0), ("1", 55.0, True)),
    (dict(mol="1", mol_conf=55.1), ("1", 55.1, False)),
    (dict(mol="1", mol_conf=50.0, mol_from_vote=True), ("1", 50.0, True)),
    (dict(mol="1", mol_conf=50.1, mol_from_vote=True), ("1", 50.1, False)),
    (dict(mol="1", mol_conf=10.0, docx_class="small"), ("1", 10.0, False)),
    (dict(id="2", id_conf=45.0, id_from_vote=True), ("2", 45.0, True)),
    (dict(id="2", id_conf=45.1, id_from_vote=True), ("2", 45.1, False)),
    (dict(id="2", id_conf=55.0), ("2", 55.0, True)),
    (dict(mol="1", mol_conf=55.0, mol_from_vote=True, cross_match=True), ("1", 55.0, True)),
    (dict(id="2", id_conf=90.0, status=PERMIT_PARTIAL), ("2", 90.0, True)),
    (dict(), ("", 0.0, False)),
])
def test_decide(spark, row, want):
    got = votes.decide(results(spark, row)).first()
    assert (got["final_value"], got["final_conf"], got["vision_review"]) == want


def test_small_documents_share_the_surest_value(spark):
    rows = [dict(docx_class="small", mol="1", mol_conf=40.0), dict(docx_class="small", mol="2", mol_conf=70.0), dict(docx_class="small"), dict(docx_class="small", id="3", id_conf=70.0)]
    got = votes.aggregate_small(results(spark, *rows)).orderBy("ord").collect()
    assert [(r["ord"], r["final_value"], r["final_conf"], r["vision_review"]) for r in got] == [(0, "2", 70.0, False), (1, "2", 70.0, True), (3, "2", 70.0, False)]
    sure = votes.aggregate_small(results(spark, dict(docx_class="small", mol="1", mol_conf=50.1, mol_from_vote=True))).first()
    assert not sure["vision_review"]
    assert sure["mol_from_vote"]
    edge = votes.aggregate_small(results(spark, dict(docx_class="small", mol="1", mol_conf=50.0, mol_from_vote=True))).first()
    assert edge["vision_review"]
    none = votes.aggregate_small(results(spark, dict(docx_class="small"), dict(docx_class="small"))).collect()
    assert [r["status"] for r in none] == [SMALL_NO_HIT] * 2
    assert all(r["vision_review"] for r in none)


def routed(spark, *rows):
    got = routing.route(results(spark, *rows)).orderBy("image_name").collect()
    return [(r["image_name"], r["candidate_value"], r["candidate_conf"], r["route"]) for r in got]


def test_rules_of_large_documents(spark):
    a, b, c = (f"image{i}.png" for i in (10, 2, 3))
    assert routed(spark, dict(image_name=a, status=LARGE_NO_HIT), dict(image_name=b, status=LARGE_NO_HIT)) == [("", "", 0.0, "manual_review")]
    # agreement in the document: the surest of the common values, direct above the mark
    assert routed(spark, dict(image_name=a, mol="1", mol_conf=56.0), dict(image_name=b, id="1", id_conf=50.0)) == [(a, "1", 56.0, "direct")]
    assert routed(spark, dict(image_name=a, mol="1", mol_conf=55.0), dict(image_name=b, id="1", id_conf=55.0)) == [(a, "1", 55.0, "second_reader")]
    # no common value: the earliest permit page by number
    assert routed(spark, dict(image_name=a, id="2", id_conf=90.0), dict(image_name=b, id="3", id_conf=20.0), dict(image_name=c, mol="1", mol_conf=99.0)) == [(b, "3", 20.0, "second_reader")]
    # permit votes alone: the earliest sure one
    vote = dict(id_from_vote=True, id_conf=46.0)
    assert routed(spark, dict(image_name=a, id="2", **vote), dict(image_name=b, id="3", **vote), dict(image_name=c, id="4", id_conf=10.0, status=PERMIT_PARTIAL, vision_review=True)) == [(b, "3", 46.0, "direct")]
    assert routed(spark, dict(image_name=a, id="2", id_from_vote=True, id_conf=45.0, vision_review=True, final_value="2", final_conf=45.0)) == [(a, "2", 45.0, "second_reader")]
    # partial readings and reviews give a row each; weak partial ones are rescued
    partial = dict(status=PERMIT_PARTIAL, vision_review=True)
    assert routed(spark, dict(image_name=a, id="2", id_conf=49.9, **partial), dict(image_name=b, id="3", id_conf=50.0, **partial), dict(image_name=c, vision_review=True, final_value="4", final_conf=30.0)) == [(a, "2", 49.9, "rescue"), (b, "3", 50.0, "second_reader"), (c, "4", 30.0, "second_reader")]
    # nothing open: the surest value is keyed in
    assert routed(spark, dict(image_name=a, id="2", id_conf=60.0, final_value="2", final_conf=60.0), dict(image_name=b, id="3", id_conf=70.0, final_value="3", final_conf=70.0)) == [(b, "3", 70.0, "direct")]


def test_rules_of_small_documents(spark):
    s = dict(docx_class="small")
    assert routed(spark, dict(status=SMALL_NO_HIT, **s)) == [("", "", 0.0, "manual_review")]
    assert routed(spark, dict(mol="1", mol_from_vote=True, mol_conf=51.0, final_value="1", final_conf=51.0, **s)) == [("image1.png", "1", 51.0, "direct")]
    assert routed(spark, dict(mol="1", mol_conf=40.0, vision_review=True, final_value="1", final_conf=40.0, **s)) == [("image1.png", "1", 40.0, "rescue")]
    assert routed(spark, dict(mol="1", mol_conf=50.0, vision_review=True, final_value="1", final_conf=50.0, **s)) == [("image1.png", "1", 50.0, "second_reader")]
    assert routed(spark, dict(mol="1", mol_from_vote=True, mol_conf=40.0, vision_review=True, final_value="1", final_conf=40.0, **s)) == [("image1.png", "1", 40.0, "second_reader")]
    assert routed(spark, dict(mol="1", mol_conf=80.0, final_value="1", final_conf=80.0, **s)) == [("image1.png", "1", 80.0, "second_reader")]


@pytest.mark.parametrize(("value", "candidate", "level", "final", "keyed"), [
    ("1234", "1234", "confirmed", "1234", True), ("1234-5", "1234-5", "confirmed", "1234-5", True), ("1234", "1235", "likely_ocr_confusion", "", False),
    ("1234", "1234-5", "disagreement", "1234", False), ("1234", "", "vision_only", "1234", False), ("", "1234", "format_invalid", "1234", False),
    ("12a4", "1234", "format_invalid", "12a4", False), ("1234", "5678", "disagreement", "1234", False), (None, None, "format_invalid", "", False),
])
def test_verify(spark, value, candidate, level, final, keyed):
    items = spark.createDataFrame([(value, candidate)], "second_value string, candidate_value string")
    known = spark.createDataFrame([("1234",), ("1234",)], "permit string")
    got = verify.verify(items, known).collect()
    assert len(got) == 1
    assert (got[0]["level"], got[0]["final_value"], got[0]["should_keyin"]) == (level, final, keyed)
    assert got[0]["in_known_list"] == (value == "1234" and level != "format_invalid")


def test_known_permits(spark):
    log = spark.createDataFrame([(" 1234 ",), ("1234",), ("",), (None,), ("2",)], "final_value string")
    assert sorted(r[0] for r in verify.known_permits(log).collect()) == ["1234", "2"]


def reads(spark, rows):
    return conform(spark.createDataFrame(rows, "source_docx string, image_name string, roi string, phase string, config_ord int, text string, conf double"), OCR_READ)


def test_scan_of_images(spark):
    permit, licence = "No. izin: {}", "MOL {}"
    rows = []
    for i, c in ((0, 60.0), (1, 51.1), (2, 53.0)):
        rows.append(("vote", "image2.png", "mol", "vote", i, licence.format("1111"), c))
    rows += [("vote", "image2.png", "mol", "scan", 0, licence.format("9999"), 99.0)]
    rows += [("pool", "image5.png", "permit_upper", "scan", 0, permit.format("2222"), 30.0), ("pool", "image5.png", "permit_upper", "vote", 0, permit.format("3333"), 40.0), ("pool", "image5.png", "permit_lower", "vote", 0, permit.format("3333"), 51.0)]
    rows += [("part", "image5.png", "permit_lower", "fallback", 1, permit.format("2222"), 30.0), ("part", "image5.png", "permit_upper", "vote", 3, permit.format("4444"), 44.0), ("part", "image5.png", "permit_upper", "vote", 4, permit.format("5555"), 44.0)]
    rows += [("cross", "image5.png", "mol", "scan", 0, licence.format("7777"), 30.0), ("cross", "image5.png", "permit_upper", "vote", 0, permit.format("7777"), 44.0), ("cross", "image5.png", "permit_upper", "vote", 1, permit.format("7777"), 44.0)]
    rows += [("drop", "image5.png", "mol", "scan", 0, licence.format("7777"), 30.0), ("drop", "image5.png", "permit_upper", "vote", 0, permit.format("8888"), 44.0), ("drop", "image5.png", "permit_upper", "vote", 1, permit.format("8888"), 44.0)]
    rows += [("none", "image5.png", "permit_upper", "vote", 0, permit.format("8888"), 44.0)]
    df = reads(spark, rows)
    pages = df.select("source_docx", "image_name", F.lit("large").alias("docx_class"), F.lit(1).alias("scan_tier")).distinct()
    got = {r["source_docx"]: r for r in votes.scan_images(df, pages).collect()}
    r = got["vote"]
    assert (r["mol"], r["mol_conf"], r["mol_from_vote"], r["mol_layer"], r["hit_roi"]) == ("1111", round((60.0 + 51.1 + 53.0) / 3, 1), True, 0, "mol")
    r = got["pool"]
    assert (r["id"], r["id_conf"], r["id_from_vote"], r["id_layer"]) == ("3333", 45.5, True, 0)
    r = got["part"]
    assert (r["id"], r["id_conf"], r["status"], r["id_from_vote"]) == ("4444", 44.0, PERMIT_PARTIAL, False)
    assert (got["cross"]["id"], got["cross"]["cross_match"]) == ("", True)
    assert (got["drop"]["id"], got["drop"]["cross_match"], got["drop"]["mol"]) == ("", False, "7777")
    assert "none" not in got  # no first hit in any region


def test_tiers_and_placeholders(spark):
    permit = "No. izin: 1234"
    rows = [("a", f"image{i}.png", "permit_upper", p, n, permit, 60.0) for i in (5, 7) for p, n in (("scan", 0), ("vote", 0), ("vote", 1))]
    rows += [("b", "image7.png", "permit_upper", "scan", 0, permit, 60.0)]
    images = spark.createDataFrame([(d, f"image{i}.png") for d in "abc" for i in range(1, 8)], "source_docx string, image_name string")
    found, queue = decide_documents(reads(spark, rows), images)
    got = sorted((r["source_docx"], r["image_name"], r["scan_tier"], r["status"]) for r in found.collect())
    assert got == [("a", "image5.png", 1, "ok"), ("b", "image7.png", 2, "ok"), ("c", "", 2, LARGE_NO_HIT)]
    assert {r["source_docx"]: r["route"] for r in queue.collect()} == {"a": "direct", "b": "direct", "c": "manual_review"}


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.integers(1, 9), st.sampled_from(["mol", "permit_upper", "permit_lower"]), st.sampled_from(["vote", "scan", "fallback"]), st.integers(0, 5), st.sampled_from(["MOL 1111", "No. izin: 1111", "No. izin: 2222", "junk"]), st.integers(0, 100)), min_size=1, max_size=40, unique_by=lambda r: r[:5]))
def test_every_document_is_routed(spark, rows):
    df = reads(spark, [(d, f"image{i}.png", roi, phase, n, text, float(c)) for d, i, roi, phase, n, text, c in rows])
    _, queue = decide_documents(df)
    got = queue.groupBy("source_docx").agg(F.count_distinct("route").alias("n"), F.collect_set("route").alias("r")).collect()
    assert {r["source_docx"] for r in got} == {r[0] for r in rows}
    assert all(r["n"] == 1 or set(r["r"]) <= {"rescue", "second_reader"} for r in got)


def test_pages_without_a_number_never_tie(spark):
    """Equal numbers and none at all: one page wins, the first by name."""
    reads = spark.createDataFrame([(d, n, "mol", "scan", 0, "c", "", f"MOL No {v}", 40.0) for d, n, v in (("a", "front.png", 5678), ("a", "back.png", 1234), ("b", "image2.png", 5678), ("b", "image2.jpeg", 1234))], OCR_READ)
    results, queue = decide_documents(reads)
    got = {(r["source_docx"], r["image_name"]): (r["final_value"], r["vision_review"]) for r in results.collect()}
    assert got == {("a", "back.png"): ("1234", True), ("a", "front.png"): ("1234", False), ("b", "image2.jpeg"): ("1234", True), ("b", "image2.png"): ("1234", False)}
    assert queue.count() == 2
