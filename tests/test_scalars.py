"""Keys, predicates, cascades and telephone forms: literal inputs, literal results."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from attestor.functions import scalars as S
from attestor.functions.kernels import fold, fold_variants, section_number


def column(spark, values, expr, schema="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[1] for r in rows.select("i", expr(F.col("v"))).orderBy("i").collect()]


def test_cascade_takes_the_first_pattern_and_gives_up_a_suffix_of_two_digits(spark):
    texts = ["No. izin : NO.1234", "Nomen: 2345-6", "i1in﹕3456", "NO.4567-89", "NO.45678", "nothing", "", "no izin:1111 NO.2222"]
    got = column(spark, texts, lambda c: S.cascade(c, S.ID_PATTERNS))
    assert [tuple(g) for g in got] == [("1234", 1), ("2345-6", 2), ("3456", 3), ("4567", 4), ("", 0), ("", 0), ("", 0), ("1111", 1)]


def test_lower_region_may_lack_the_colon(spark):
    assert tuple(column(spark, ["No izin 1234"], lambda c: S.cascade(c, S.LOWER_ID_PATTERNS))[0]) == ("1234", 1)
    assert tuple(column(spark, ["No izin 1234"], lambda c: S.cascade(c, S.ID_PATTERNS))[0]) == ("", 0)


def test_licence_cascade(spark):
    texts = ["Agency's MOL License Num ber: 1234", "Agancy M0L cense Number：2345", "umber : 3456", "MOL xx 4567-1", "MOL 45671"]
    assert [tuple(g) for g in column(spark, texts, S.licence_of)] == [("1234", 1), ("2345", 2), ("3456", 3), ("4567-1", 4), ("", 0)]


@pytest.mark.parametrize(("value", "good"), [("1234", True), ("1234-5", True), ("123", False), ("12345", False), ("1234-56", False), ("", False), ("１２３４", False), (None, False)])
def test_permit_format(spark, value, good):
    assert column(spark, [value], S.valid_permit) == [good]


def test_natural_order(spark):
    names = ["image10.png", "cover.png", "image2.png", "image1.png"]
    df = spark.createDataFrame([(n,) for n in names], "v string")
    assert [r[0] for r in df.orderBy(S.natural_key(F.col("v"))).collect()] == ["image1.png", "image2.png", "image10.png", "cover.png"]
    assert column(spark, names, S.image_index) == [10, 0, 2, 1]


def test_phones_in_a_line(spark):
    lines = ["Tel 02-2345-6789", "(04)7775-863", "+886 2 2345 6789", "+886-0912-345-678", "id 1234567890123456", "03-5310852 and 0912345678", "", "886 12"]
    assert column(spark, lines, S.phones_in) == [["02-2345-6789"], ["04-7775863"], ["0223456789"], ["0912-345-678", "0912345678"], [], ["03-5310852", "0912345678"], [], []]


def test_phone_field(spark):
    raw = ["02-2727-6999", "03-3253456/3253507", "072114387、0925510286", "037-364897.364898", "(03)-3554436#171", "02-29819295*13", "+886-2-27276999", "", None, "123"]
    want = [["0227276999"], ["033253456"], ["072114387", "0925510286"], ["037364897"], ["033554436"], ["0229819295"], ["0227276999"], [], [], []]
    assert column(spark, raw, S.split_phone_field) == want
    assert column(spark, raw, S.phone_note) == ["", "partial", "several", "partial", "extension", "extension", "", "none", "none", "unusable"]


def test_parse_permit(spark):
    got = column(spark, ["2340", "0234", "2340-2", "2340-02", "2340-a", "x1", "", None], S.parse_permit)
    assert [tuple(g) if g else None for g in got] == [(2340, ""), (234, ""), (2340, "2"), (2340, "2"), (2340, "A"), None, None, None]


def test_brackets_names_and_dates(spark):
    assert column(spark, ["ab(c", "ab)c", "（甲", "a", ""], S.balance_brackets) == ["ab(c)", "(ab)c", "（甲）", "a", ""]
    assert column(spark, ["LTD(新星開發有限公司", "新星（股）LTD", "abc", "甲"], S.clean_agency_name) == ["新星開發有限公司", "新星（股）", "", "甲"]
    assert column(spark, ["20240131", "2024", "", None], S.iso_date) == ["2024-01-31", "2024", "", ""]
    assert column(spark, ["WANG, DA-MING", "", "A  B"], S.syllables) == [3, 0, 2]
    assert column(spark, ["中山北路", "中山路", "大東街"], S.direction) == ["北", "", "東"]


def test_page_score_and_labels(spark):
    assert column(spark, ["Nama Majikan Alamat PIHAK PERTAMA", "Surat Pernyataan", ""], S.page_score) == [5, 0, 0]
    line = ["台灣仲介公司(Agency Taiwan):", "另一份由台灣仲介公司存查。", "x" * 50 + "台灣仲介", " 台灣仲介 "]
    assert column(spark, line, lambda c: S.label_line(c, "台灣仲介")) == [True, False, False, True]


def test_rounding_is_pythons(spark):
    values = [55.05, 45.05, 50.05, 66.35, 0.0, 0.25, 0.35, 0.45, 2.5, 99.95, 33.333, 12.65, *(i / 20 for i in range(2001)), *(i / 7 for i in range(500))]
    assert column(spark, values, S.round1, "v double") == [round(v, 1) for v in values]


def test_folding(spark):
    raw = ["臺北市中山路二段", "ＡＢ１２", "鍾 山　村", "十二段", "一十段", "7段", None]
    assert column(spark, raw, fold_variants) == ["台北市中山路2段", "AB12", "鐘山村", "12段", "10段", "7段", ""]
    assert [section_number(s) for s in ("二", "十", "十二", "二十", "二十三", "7")] == ["2", "10", "12", "20", "23", "7"]


@settings(max_examples=200, suppress_health_check=[HealthCheck.too_slow], deadline=None)
@given(st.text(alphabet="臺鍾一二十段0９Ａb路", max_size=12))
def test_folding_twice_changes_nothing(text):
    assert fold(fold(text)) == fold(text)


def test_numbers_of_any_length(spark):
    """Long numbers sort by value and never end the job."""
    names = ["image10.png", "image2.png", "image1700000000000.png", "front.png", "image99999999999999999999.png", "image0.png", "p" + "9" * 60 + ".png", "image002.png", "image100000000000000000000.png"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    order = [r["n"] for r in df.orderBy(S.natural_key(F.col("n"))).collect()]
    assert order == sorted(names, key=lambda n: ((0, int(m.group()), n) if (m := re.search(r"\d+", n)) else (1, 0, n)))
    index = {r["n"]: r["i"] for r in df.select("n", S.image_index(F.col("n")).alias("i")).collect()}
    assert (index["image10.png"], index["front.png"], index["image0.png"], index["image1700000000000.png"]) == (10, 0, 0, 2**31 - 1)
    flat = {r["n"]: r["k"]["n"] for r in df.select("n", S.natural_key_flat(F.col("n")).alias("k")).collect()}
    assert (flat["front.png"], flat["image99999999999999999999.png"]) == (1 << 30, 99999999999999999999)


def test_costly_texts_are_worked_out_once_and_in_many_tasks(spark):
    """The rules on a page's lines are not repeated in the plan, and a small file of customers is read by all tasks."""
    from attestor.operators import extract
    from attestor.plans import catalogue

    fields = extract.employer_fields(spark.createDataFrame([("甲方名稱:王明安",)], "text string"))
    assert fields._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") < 60
    assert catalogue.queries()["employer_block"](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 4


def test_texts_of_documents_are_not_broadcast(spark):
    """Pages from a small file meet in a shuffle, as their texts may be many times its size."""
    from attestor.operators import extract

    pages = spark.createDataFrame([("a", 0, "image1.png", "Surat Pernyataan"), ("a", 1, "image2.png", "x")], "source_docx string, ord int, image_name string, text string")
    plan = extract.pledge_pages(pages)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan
