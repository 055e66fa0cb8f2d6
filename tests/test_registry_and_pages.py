"""Registry lookups, rescue, page texts, addresses: invented names and numbers throughout."""

import pytest
from pyspark.sql import functions as F

from attestor.functions.kernels import Ratios
from attestor.operators import assemble, extract, gazetteer, registry
from attestor.operators.rescue import rescue
from attestor.schema import EMPLOYER, SHEET_COLUMNS, conform

ROWS = [
    ("2340", "新星人力仲介股份有限公司", "臺北市中山區一號路1段2號", "02-2345-6789", "", ""),
    ("2340-2", "新星人力仲介股份有限公司台中分公司", "臺中市西區二號街5號", "04-22223333/0911222333", "", ""),
    ("0777", "舊海開發有限公司", "高雄市前金區三號路9號", "07-1234567", "20200101", ""),
    ("777", "藍海國際開發有限公司", "高雄市前金區三號路88號", "07-7654321", "", ""),
    ("888", "雙子企業管理顧問有限公司", "桃園市中壢區四號路1號", "03-4567890", "", None),
    ("889", "雙生企業管理顧問有限公司", "桃園市中壢區五號路2號", "03-4567890", "", " "),
    ("x", "無號公司", "", "", "", ""),
]


@pytest.fixture(scope="module")
def reg(spark):
    raw = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "pos long, permit string, name string, address string, phone string, revoked_on string, closed_on string")
    return registry.roster(raw).cache()


def test_lookup_by_permit(spark, reg):
    asked = spark.createDataFrame([("2340",), ("02340",), ("2340-2",), ("2340-02",), ("2340-9",), ("777",), ("abc",), ("",), (None,)], "permit_value string")
    got = {r["permit_value"]: r["agency_name"][:4] for r in registry.lookup(asked, reg).collect()}
    assert got == {"2340": "新星人力", "02340": "新星人力", "2340-2": "新星人力", "2340-02": "新星人力", "2340-9": "", "777": "藍海國際", "abc": "", "": "", None: ""}


def test_lookup_by_phone_and_prefix(spark, reg):
    index = registry.phone_index(reg)
    q = spark.createDataFrame([("+886-2-2345-6789",), ("0911222333",), ("03-4567890",), ("07-1234567",), ("02-2345-67",), ("0223456789012",), ("02234",)], "phone string")
    exact = sorted((r["phone"], r["permit"]) for r in registry.by_phone(q, index).collect())
    assert exact == [("+886-2-2345-6789", "2340"), ("03-4567890", "888"), ("03-4567890", "889"), ("0911222333", "2340-2")]
    near = sorted((r["phone"], r["permit"]) for r in registry.by_phone_prefix(q, index).collect())
    assert near == [("+886-2-2345-6789", "2340"), ("02-2345-67", "2340"), ("0223456789012", "2340"), ("03-4567890", "888"), ("03-4567890", "889"), ("0911222333", "2340-2")]
    plan = registry.by_phone_prefix(q, index)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan
    assert "Cartesian" not in plan
    one = registry.unique_hits(registry.by_phone(q, index), ["phone"]).collect()
    assert {r["phone"] for r in one} == {"+886-2-2345-6789", "0911222333"}


def test_similarity(spark, reg):
    q = spark.createDataFrame([("藍海國際開発有限公司",), ("完全不同",), ("abc",), ("",)], "t string")
    got = [(r["t"], r["permit"]) for r in registry.best_by_text(q, reg, "t", "name").collect()]
    assert got == [("藍海國際開発有限公司", "777")]
    addr = registry.best_by_text(spark.createDataFrame([("台北市中山區一號路一段2號",)], "t string"), reg, "t", "address").first()
    assert (addr["permit"], addr["ratio"]) == ("2340", 1.0)


def test_similarity_in_blocks(spark, monkeypatch):
    """Blocks of any size give what one pass over all keys gives; equals in different blocks go to the first."""
    names = ["alpha trading", "alpha tradings", "beta service", "alpha trading", None, "", "betas services", "gamma", "alpha trade", "beta service", "delta works"]
    asked = ["alpha trading", "alpha tradin", "beta servic", "gamm", "delta wrks", "zzzz", "abc", "", None, "alpha trading"]
    keys = spark.createDataFrame(list(enumerate(names)), "pos long, key string")
    queries = spark.createDataFrame([(q,) for q in asked], "q string")
    table = Ratios([n or "" for n in names])
    best = {q: table.best(q, 0.7) for q in asked if q and len(q) >= registry.SHORTEST}
    want = {(q, hit[0], round(hit[1], 3)) for q, hit in best.items() if hit}
    assert ("alpha trading", 0, 1.0) in want and ("zzzz", -1, 0.0) not in want and len(want) == 5
    for k, q in ((20_000, 250), (2, 3), (1, 1)):
        monkeypatch.setattr(registry, "BLOCK_KEYS", k)
        monkeypatch.setattr(registry, "BLOCK_QUERIES", q)
        assert {tuple(r) for r in registry.most_similar(queries, keys, "q", 0.7).collect()} == want
    assert registry.most_similar(queries, keys.limit(0), "q", 0.7).count() == 0
    assert registry.most_similar(queries.limit(0), keys, "q", 0.7).count() == 0


def test_rescue_in_order(spark, reg):
    items = spark.createDataFrame([(d, "old", "why") for d in "abcdef"], "source_docx string, candidate_value string, reason string")
    blocks = [("a", ["0000000000", "02-2345-6789"], "藍海國際開發有限公司", ""), ("b", ["02-2345-67"], "藍海國際開發有限公司", ""), ("c", ["03-4567890"], "藍海國際開發有限公司", "桃園市中壢區四號路1號"), ("d", ["03-4567890"], "", ""), ("e", [], "", "")]
    df = spark.createDataFrame(blocks, "source_docx string, phones array<string>, agency_text_name string, agency_text_address string")
    got = {r["source_docx"]: (r["candidate_value"], r["rescued_by"]) for r in rescue(items, df, reg).collect()}
    assert got == {"a": ("2340", "phone"), "b": ("2340", "phone_prefix"), "c": ("777", "name"), "d": ("old", "phone_several"), "e": ("old", ""), "f": ("old", "")}


# --- page texts ---


def fields(spark, text):
    return extract.employer_fields(spark.createDataFrame([("d", text)], "source_docx string, text string")).first()


def test_employer_block(spark):
    text = "仲介 電話:02-9999-8888\n甲方名稱(以下簡稱甲方):林大明\nNama Majikan: LIN, DA-MING\n地址:桃園市中壢區四號路12號\nAlamat: No. 12, 4th Rd., Zhongli Dist., Taoyuan City\nR.O.C.\n電話:03-5310852,傳真:03-5277128\nNomor Telepon: 03-5310852\n勞工姓名(以下簡稱乙方)\n電話:0900000000"
    got = fields(spark, text)
    assert (got["name_cn"], got["name_en"], got["phone"]) == ("林大明", "LIN, DA-MING", "03-5310852")
    assert (got["addr_cn"], got["addr_en"]) == ("桃園市中壢區四號路12號", "No. 12, 4th Rd., Zhongli Dist., Taoyuan City R.O.C.")
    assert got["note"] == ""


def test_damaged_or_missing_anchor(spark):
    got = fields(spark, "用戶名稱:林大明\nNama Majikan: LIN, DA-MING\nSELANJUTNYA DISEBUT\nSiti")
    assert (got["name_cn"], got["name_en"]) == ("林大明", "LIN, DA-MING")
    got = fields(spark, "仲介公司\n電話:02-9999-8888")
    assert (got["name_cn"], got["phone"], got["note"]) == ("", "", "employer block not anchored")
    assert fields(spark, None)["note"] == "employer block not anchored"
    assert fields(spark, "甲方名稱:勞動契約 家庭幫傭")["name_cn"] == ""


@pytest.mark.parametrize(("cn", "en", "doubt"), [("林大明", "LIN, DA-MING", ""), ("大明", "LIN, DA-MING", "H: 2 characters, 3 syllables"), ("", "LIN", "H: no Chinese name"), ("新星公司", "Star Co., Ltd.", ""), ("林大明", "", "")])
def test_name_doubt(spark, cn, en, doubt):
    df = spark.createDataFrame([(cn, en)], "a string, b string")
    assert df.select(extract.name_doubt(F.col("a"), F.col("b"))).first()[0] == doubt


@pytest.mark.parametrize(("cn", "en", "doubt"), [("8之15之2號", "No.8-15-2, X Rd.", ""), ("7號", "No. 62, X Rd.", "J: house number 7 / 62"), ("7號", "X Rd.", ""), ("", "No. 1", "")])
def test_house_doubt(spark, cn, en, doubt):
    df = spark.createDataFrame([(cn, en)], "a string, b string")
    assert df.select(extract.house_doubt(F.col("a"), F.col("b"))).first()[0] == doubt


def test_agency_block(spark):
    texts = {
        "strict": "甲方\n台灣仲介公司(Agency Taiwan):\n名稱:新星人力仲介股份有限公司 LTD\n地址:臺北市中山區一號路1段2號\n電話:02-2345-6789 傳真:02-1111-2222\nTelp: +62 21 555\n03-9999999",
        "loose": "tensi Taiwan:\n藍海國際開發有限公司\n電話:07-7654321\n印尼仲介",
        "wide": "台灣仲介\nP3MI\n新星人力仲介股份有限公司\nJL. SUDIRMAN 02-0000-0000\n02-2345-6789\n乙方\n03-9999999",
        "prose": "另一份由台灣仲介公司存查。\n02-2345-6789",
    }
    got = {r["k"]: r["agency"] for r in extract.with_agency_block(spark.createDataFrame(list(texts.items()), "k string, text string")).collect()}
    assert (got["strict"]["phones"], got["strict"]["name"], got["strict"]["address"]) == (["02-2345-6789"], "新星人力仲介股份有限公司", "臺北市中山區一號路1段2號")
    assert (got["loose"]["phones"], got["loose"]["name"]) == (["07-7654321"], "藍海國際開發有限公司")
    assert (got["wide"]["phones"], got["wide"]["name"]) == (["02-2345-6789"], "新星人力仲介股份有限公司")
    assert (got["prose"]["phones"], got["prose"]["name"], got["prose"]["address"]) == ([], "", "")


def test_pages_and_pledges(spark):
    rows = [("a", 0, "image1.png", "x"), ("a", 1, "image2.png", "Nama Majikan Alamat"), ("a", 2, "image3.png", "PIHAK PERTAMA PERJANJIAN KERJA SELANJUTNYA MAJIKAN DENGAN"), ("a", 3, "image4.png", "Surat Pernyataan"), ("a", 4, "image5.png", "中華民國雇主/Majikan R.O.C: 姜小安/JIANG"), ("b", 0, "image1.png", "x"), ("b", 1, "image2.png", "y"), ("c", 0, "p.png", "Alamat"), ("c", 1, "q.png", "Alamat")]
    df = spark.createDataFrame(rows, "source_docx string, ord int, image_name string, text string")
    pages = {r["source_docx"]: (r["image_name"], r["score"], r["found"]) for r in extract.contract_pages(df).collect()}
    assert pages == {"a": ("image2.png", 4, True), "b": ("image2.png", 0, False), "c": ("p.png", 2, True)}
    nxt = extract.next_pages(df, extract.contract_pages(df)).collect()
    assert sorted((r["source_docx"], r["image_name"]) for r in nxt) == [("a", "image3.png"), ("c", "q.png")]
    emp = spark.createDataFrame([("a", "", "JIANG XIAO AN"), ("b", "", ""), ("c", "林大明", "")], "source_docx string, name_cn string, name_en string")
    got = {r["source_docx"]: (r["name_cn"], r["doubt_name"]) for r in extract.rescue_names(emp, df).collect()}
    assert got == {"a": ("姜小安", "H: name from pledge page image5.png"), "b": ("", "H: no Chinese name"), "c": ("林大明", "")}


# --- addresses ---

CITIES = [
    ("臺北市", "Taipei City", [("中山區", "Zhongshan Dist.", "104", [("一號路1段", "Sec. 1, Yihao Rd."), ("一號路2段", "Sec. 2, Yihao Rd."), ("中山北路", "Zhongshan N. Rd.")]), ("大安區", "Da'an Dist.", "106", [("共同路", "Gongtong Rd.")])]),
    ("新北市", "New Taipei City", [("板橋區", "Banqiao Dist.", "220", [("共同路", "Gongtong Rd.")])]),
    ("臺南市", "Tainan City", [("南區", "South Dist.", "702", [("海濱路", "Haibin Rd.")]), ("安南區", "Annan Dist.", "709", [("海佃路", "Haidian Rd."), ("大眾北路", "Dazhong N. Rd.")])]),
    ("桃園市", "Taoyuan City", [("桃園區", "Taoyuan Dist.", "330", [("春日路", "Chunri Rd.")]), ("龜山區", "Guishan Dist.", "333", [("文化七路", "Wenhua 7th Rd."), ("共同路", "Gongtong Rd.")]), ("大溪區", "Daxi Dist.", "335", [("共同路", "Gongtong Rd.")])]),
    ("甲市", "Jia City", [("空區", "Kong Dist.", "901", []), ("滿區", "Man Dist.", "902", [("甲乙路", "Jiayi Rd.")]), ("無區", "Wu Dist.", "903", None)]),
    ("孤島縣", "Gudao County", []),
]


@pytest.fixture(scope="module")
def gaz(spark):
    road = "struct<RoadName:string,RoadEngName:string>"
    raw = spark.createDataFrame([(c, e, [(a, ae, z, r) for a, ae, z, r in areas]) for c, e, areas in CITIES], f"CityName string, CityEngName string, AreaList array<struct<AreaName:string,AreaEngName:string,ZipCode:string,RoadList:array<{road}>>>").coalesce(1)
    custom = spark.createDataFrame([("台南市", "南區", "新開路", "Xinkai Rd."), ("臺南市", "南區", "海濱路", "dup"), ("無市", "南區", "x路", "x"), ("甲市", "空區", "補路", "Bu Rd."), ("孤島縣", "", "y路", "y"), ("台南市", "南區", "新開路", "again")], "CityName string, AreaName string, RoadName string, RoadEngName string")
    return gazetteer.overlay(gazetteer.flatten(raw), custom).cache()


def test_overlay_and_search(gaz):
    assert gaz.count() == 13 + 2 + 3  # roads, own roads, two areas without roads and a city without areas
    assert [r["road_raw"] for r in gazetteer.search(gaz, city="甲市").collect()] in (["甲乙路", "補路"], ["補路", "甲乙路"])
    whole = gazetteer.search(gaz, "路").collect()
    assert len(whole) == 15
    assert gazetteer.search(gaz, "路", first=4).count() == 4
    assert [r["road_raw"] for r in gazetteer.search(gaz, city="甲市", first=gazetteer.SHOWN).collect()] == ["補路", "甲乙路"]
    assert [r["zip"] for r in gazetteer.search(gaz, keyword="新開").collect()] == ["702"]
    assert sorted(r["area_raw"] for r in gazetteer.search(gaz, "共同路", city="台北").collect()) == ["大安區"]
    only = {(r["city_norm"], r["road_norm"]): r["area_raw"] for r in gazetteer.unique_area(gaz).collect()}
    assert only["桃園市", "文化七路"] == "龜山區"
    assert ("桃園市", "共同路") not in only


CASES = [
    ("台北市中山區一號路二段 38 號三樓之2", "", ("臺北市", "中山區", "一號路2段", "104", 1)),
    ("台北市中山區一號路一段5號", "", ("臺北市", "中山區", "一號路1段", "104", 1)),
    ("臺南市安南區海佃路5號", "", ("臺南市", "安南區", "海佃路", "709", 1)),  # the longest area, not 南區
    ("台南安南區海佃路5號", "", ("臺南市", "安南區", "海佃路", "709", 2)),
    ("桃園市高山里文化七路8號", "", ("桃園市", "龜山區", "文化七路", "333", 1)),  # area from the road
    ("桃園市共同路8號", "", ("桃園市", "", "共同路", "", 1)),
    ("臺南市安南區大眾東路9號", "", ("臺南市", "安南區", "", "709", 1)),  # another direction is another road
    ("●●市●●區一號路2段7號", "No. 7, Sec. 2, Yihao Rd., Zhongshan Dist., Taipei City", ("臺北市", "中山區", "一號路2段", "104", 1)),
    ("●●●●7號", "No. 7, Haidian Rd, Annan Dist., Tainan City", ("臺南市", "安南區", "海佃路", "709", 1)),
    ("板橋共同路", "Banqiao Dist., New Taipei City", ("新北市", "板橋區", "共同路", "220", 1)),
    ("甲市空區補路3號", "", ("甲市", "空區", "補路", "901", 1)),
    ("甲市無區某某路3號", "", ("甲市", "無區", "", "903", 1)),  # an area without roads has a zip code all the same
    ("孤島縣某路3號", "", ("孤島縣", "", "", "", 1)),  # and a city without areas is a city
    ("桃園市龜山區文花七路8號", "", ("桃園市", "龜山區", "文化七路", "333", 1)),  # a similar road
    ("桃園市龜由區文化七路8號", "", ("桃園市", "龜山區", "文化七路", "333", 1)),  # an area open, given by the road
    ("xyz", "", ("", "", "", "", 0)),
    ("", "Taipei City", ("", "", "", "", 0)),
]


def test_standardiser(spark, gaz):
    df = spark.createDataFrame([(i, c, e) for i, (c, e, _) in enumerate(CASES)], "i int, addr_cn string, addr_en string")
    got = {r["i"]: r for r in gazetteer.standard_address(gazetteer.normalise(df, gaz)).collect()}
    for i, (cn, _, want) in enumerate(CASES):
        n = got[i]["norm"]
        assert (n["city"], n["district"], n["road"], n["zip"], n["city_tier"]) == want, cn
    assert got[0]["addr_std"] == "臺北市中山區一號路2段38號三樓之2"
    assert got[0]["norm"]["address_en"] == "3F.-2, No. 38, Sec. 2, Yihao Rd., Zhongshan Dist., Taipei City"
    assert [got[i]["doubt_addr"] for i in (0, 5, 6, 15, 16)] == ["", "J: area open, the road is in several", "J: road not listed in the area", "J: city not in the gazetteer", "J: no Chinese address"]
    assert (got[5]["addr_std"], got[5]["zip"], got[15]["addr_matched"]) == ("", "", False)


def test_english_anchor_as_a_join(spark, gaz):
    q = spark.createDataFrame([("a", "Banqiao Dist.,  New Taipei City"), ("b", "x, Taipei City"), ("c", "nowhere")], "k string, t string")
    got = {r["k"]: (r["city_raw"], r["area_raw"]) for r in gazetteer.english_anchor(q, gaz, "t").collect()}
    assert got == {"a": ("新北市", "板橋區"), "b": ("臺北市", None)}


# --- assembly ---


def test_sheet_rows(spark, reg):
    keyed = spark.createDataFrame([("a", "2340", "sure")], "source_docx string, permit string, reason string")
    manual = spark.createDataFrame([("b", "", "none"), ("b", "999", "two")], keyed.schema)
    emp = conform(spark.createDataFrame([("a", "林大明", "J: x")], "source_docx string, name_cn string, doubt string"), EMPLOYER)
    rows = assemble.sheet_rows(keyed, manual, reg, emp)
    assert tuple(rows.columns) == SHEET_COLUMNS
    got = sorted(tuple(r) for r in rows.collect())
    assert [(r[0], r[1], r[2], r[4][:2], r[7], r[11]) for r in got] == [("a", "2340", "keyed-in", "新星", "林大明", "J: x"), ("b", "", "manual_review", "", "", ""), ("b", "999", "manual_review", "", "", "")]
    assert [r["source_docx"] for r in assemble.doubt_report(emp).collect()] == ["a"]


@pytest.mark.parametrize(("detail", "want"), [
    ("38號", "No. 38, R, A, C"), ("38號三樓之2", "3F.-2, No. 38, R, A, C"), ("41號之8", "No. 41-8, R, A, C"), ("1之9號", "No. 1-9, R, A, C"), ("11.13.15.17號", "No. 11.13.15.17, R, A, C"), ("3-5號", "No. 5, R, A, C"),
    ("201巷2號", "No. 2, Ln. 201, R, A, C"), ("69巷7弄15號12樓", "12F., No. 15, Aly. 7, Ln. 69, R, A, C"), ("5號十二樓", "12F., No. 5, R, A, C"), ("", "R, A, C"),
])
def test_english_address(spark, detail, want):
    df = spark.createDataFrame([(detail,)], "d string")
    assert df.select(gazetteer.english_address(F.lit("R"), F.lit("A"), F.lit("C"), F.col("d"))).first()[0] == want
    assert df.select(gazetteer.english_address(F.lit(""), F.lit(""), F.lit(""), F.col("d"))).first()[0] == ""
