"""Fields of the employer, the agency and the pledge from page texts, as expressions over arrays of lines.

A page's lines are bounded by the page, so every rule works inside the row: no explode, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.functions import scalars as S
from attestor.session import grows

# --- fixed values: label and content patterns -------------------------------------------------
PARTY_A = r"甲方名稱|雇主名[稱称]|以下簡稱為?甲方"
PARTY_A_ID = r"(?i)Nama\s*(?:Majikan|Perusahaan)"
PARTY_A_END = r"(?i)SELANJUTNYA\s*DISEBUT|勞工姓名|Nama\s*Pekerja|PIHAK\s*KEDUA|以下簡稱乙方"
PHONE_LABEL = r"(?i)電話|Nomor\s*Telepon"
ANY_PHONE_LABEL = r"(?i)電話|Nomor\s*Telepon|傳真"
ADDRESS_LABEL = "地址|Alamat"
LABELS = r"甲方名稱|雇主名[稱称]|以下簡稱為?甲方|地址|電話|傳真"
CN_ADDRESS = "[縣市].{0,20}?[路街道段巷弄號樓]"
EN_ADDRESS = r"(?i)\b(?:No\.|Rd\.|St\.|Dist\.|Lane|Alley|Sec\.|Village|Township|County|City|Taiwan)\b"
EN_BOILERPLATE = r"(?i)SEKTOR|INFORMAL|FORMAL|SELANJUTNYA|DISEBUT|PIHAK|PERTAMA|PERJANJIAN|MAJIKAN|DENGAN|PEKERJA|ANTARA|Perawat|Care\s*Giver|Agency|Nama|Perusahaan|Alamat|Nomor|Telepon"
EN_COMPANY = r"(?i)\b(?:Co|Ltd|Inc|Corp|Company|Limited|Enterprise|Industr|Tech)\b"
PLEDGE_NAME = r"中\s*華\s*民\s*國\s*雇\s*主[^\n]{0,24}?[:：﹕]\s*([^\n]{1,30})"
PLEDGE_CUT = r"[/／(（]|[A-Za-z]|負責人|簽章|日期|Tanggal"
TW_AGENCY = r"(?i)[台臺]灣仲介|Agen(?:cy|si)\s*Taiwan"
TW_AGENCY_LOOSE = r"(?iU)(?:gen|nsi|si|cy)\w*\s*Taiwan\s*[)）]?\s*[:：]"
ID_AGENCY = r"(?i)印尼仲介|P3MI|Agen(?:cy|si)\s*Indonesia|Perwakilan"
ID_PHONE = r"(?i)\bTelp(?:on|epon)?\b"
PARTY_B = r"(?i)乙方|PIHAK\s*KEDUA"
ID_LINE = r"(?i)JL\.|JALAN|KELURAHAN|KECAMATAN|\bKEC\b|\bKOTA\b|PROVINSI|DESA|DUSUN|PPTKIS|P3MI|Pengirim|Perwakilan|\bNTB\b|LOMBOK|MATARAM|JAKARTA|\bTelp(?:on|epon)?\b|\+62"
AGENCY_WORDS = "公司|人力|仲介|企業|顧問|管理|服務|股份|有限"
AGENCY_LABEL_WORDS = r"(?i)[台臺]灣仲介公司|[台臺]灣仲介|Agen(?:cy|si)\s*Taiwan"
HOUSE_CN, HOUSE_EN = r"(\d+(?:\s*之\s*\d+)*)\s*號", r"(?i)\bNo\.?\s*(\d+(?:\s*-\s*\d+)*)"
MIN_PAGE_SCORE, PLEDGE_PAGES = 2, 2

AGENCY_BLOCK = "struct<phones:array<string>,name:string,address:string>"


def lines_of(text: Column) -> Column:
    """Trimmed lines that are not empty."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\R|[\x0B\x0C\x1C-\x1E]"), S.strip), lambda l: l != "")


def _place(lines: Column, test: Callable[[Column], Column], after: Column | int = -1) -> Column:
    """Index from 0 of the first line past ``after`` that passes, or null."""
    found = F.filter(F.transform(lines, lambda l, i: F.when((i > after) & test(l), i)), lambda i: i.isNotNull())
    return F.get(found, F.lit(0))


def _value(lines: Column, one: Callable[[Column], Column]) -> Column:
    """The first non-null value that a rule draws from a line, or ''; lines after it are not looked at."""
    return F.coalesce(F.aggregate(lines, F.lit(None).cast("string"), lambda got, l: F.coalesce(got, one(l))), F.lit(""))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is worked out once, however often it occurs there."""
    return F.transform(F.array(value), body)[0]


def _between(lines: Column, start: Column, end: Column) -> Column:
    return F.when(start.isNotNull(), F.slice(lines, start + 1, F.greatest(F.coalesce(end, F.size(lines)) - start, F.lit(0)))).otherwise(F.filter(lines, lambda _: F.lit(False)))


def with_employer_block(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``block``, the lines of party A, and ``anchored``; without an anchor nothing is guessed."""
    df = df.withColumn("__l", lines_of(F.col(text)))
    label = _place(F.col("__l"), lambda l: l.rlike(PARTY_A))
    step_back = F.greatest(_place(F.col("__l"), lambda l: l.rlike(PARTY_A_ID)) - 1, F.lit(0))
    fallback = F.when(_place(F.col("__l"), lambda l: l.rlike(PARTY_A_ID)).isNotNull(), step_back)
    df = df.withColumn("__s", F.coalesce(label, fallback))
    df = df.withColumn("__e", _place(F.col("__l"), lambda l: l.rlike(PARTY_A_END), F.col("__s")))
    return df.withColumns({"block": _between(F.col("__l"), F.col("__s"), F.col("__e")), "anchored": F.col("__s").isNotNull()}).drop("__l", "__s", "__e")


def _phone(block: Column) -> Column:
    """The number read most often, on labelled lines if any is there; ties go to the first seen."""

    def numbers(line: Column) -> Column:
        return _let(S.before_fax(line), lambda l: F.transform(S.phones_in(l), lambda p: F.struct(p.alias("p"), l.rlike(PHONE_LABEL).alias("on"))))

    def chosen(entry: Column) -> Column:
        return F.transform(F.filter(entry, lambda e: e["on"] | ~F.exists(entry, lambda x: x["on"])), lambda e: e["p"])

    def most(pool: Column) -> Column:
        tally = F.transform(F.array_distinct(pool), lambda p, i: F.struct(F.size(F.filter(pool, lambda q: q == p)).alias("n"), (-i).alias("back"), p.alias("p")))
        return F.coalesce(F.array_max(tally)["p"], F.lit(""))

    return _let(F.flatten(F.transform(block, numbers)), lambda entry: _let(chosen(entry), most))


def _english_address(block: Column) -> Column:
    """The first address line without Chinese, with a short alphabetic line after it joined."""
    nxt = F.concat(F.slice(block, F.lit(2), F.greatest(F.size(block) - 1, F.lit(0))), F.array(F.lit("")))
    pairs = F.zip_with(block, nxt, lambda l, n: F.when(~S.has_cjk(l) & l.rlike(EN_ADDRESS) & (F.length(l) > 12), F.when(n.rlike(r"^[A-Za-z.()\s]{2,8}$"), F.concat_ws(" ", l, n)).otherwise(l)))
    joined = F.coalesce(F.get(F.filter(pairs, lambda v: v.isNotNull()), F.lit(0)), F.lit(""))
    return S.strip(F.regexp_replace(joined, r"(?i)^Alamat\s*[:：]?\s*", ""))


def employer_fields(df: DataFrame, text: str = "text") -> DataFrame:
    """name_cn, name_en, addr_cn, addr_en, en_hint, phone and note from the text of a contract page."""
    df = with_employer_block(df, text)
    block = F.col("block")
    addr = _value(block, lambda l: F.when(S.has_cjk(l) & l.rlike(CN_ADDRESS), S.strip(F.regexp_replace(F.regexp_replace(l, LABELS, ""), "^[:： ]+", ""))))
    hint = _value(block, lambda l: F.when(S.has_cjk(l) & l.rlike(EN_ADDRESS) & (F.length(l) > 12), l))
    df = df.withColumns({"addr_cn": addr, "addr_en": _english_address(block), "en_hint": hint, "phone": _phone(block)})

    def named(l: Column, value: Column) -> Column:
        return F.when(~l.rlike(ADDRESS_LABEL) & ~l.rlike(ANY_PHONE_LABEL) & (l != F.col("addr_cn")) & (l != F.col("addr_en")), value)

    def english(l: Column) -> Column:
        labelled = r"(?i)^.*Nama\s*(?:Majikan|Perusahaan)\s*[:：]?"
        core = S.strip(F.when(l.rlike(labelled), F.regexp_replace(l, labelled, "")).otherwise(F.regexp_replace(l, ".*[:：]", "")))
        return named(l, _let(core, lambda v: F.when(~S.has_cjk(v) & v.rlike("[A-Za-z]") & ~v.rlike(EN_BOILERPLATE) & ~v.rlike(EN_ADDRESS) & (F.length(v) > 2), v)))

    def chinese(l: Column) -> Column:
        def name(core: Column) -> Column:
            bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(core, LABELS, ""), "(?i)Nama.*", ""), "^[ ()（）:：;；]+|[ ()（）:：;；]+$", "")
            return F.when(S.has_cjk(core) & ~core.rlike(CN_ADDRESS) & ~core.rlike(EN_ADDRESS), _let(bare, lambda v: F.when((v != "") & S.has_cjk(v) & S.name_like(v), v)))

        return named(l, _let(S.strip(F.regexp_replace(l, ".*[:：;；]", "")), name))

    df = df.withColumns({"name_cn": S.balance_brackets(_value(block, chinese)), "name_en": S.balance_brackets(_value(block, english))})
    return df.withColumn("note", F.when(F.col("anchored"), "").otherwise("employer block not anchored")).drop("block", "anchored")


# --- doubts ----------------------------------------------------------------------------------


def name_doubt(name_cn: Column, name_en: Column) -> Column:
    n = F.regexp_count(name_cn, F.lit(S.CJK))
    differs = (name_en != "") & ~name_en.rlike(EN_COMPANY) & (n != S.syllables(name_en))
    return F.when(name_cn == "", "H: no Chinese name").when(differs, F.format_string("H: %d characters, %d syllables", n, S.syllables(name_en))).otherwise("")


def house_doubt(addr_cn: Column, addr_en: Column) -> Column:
    """Both addresses have a house number and they differ; the two ways of writing sub-numbers are one."""

    def number(text: Column, pattern: str) -> Column:
        return F.replace(F.regexp_replace(F.regexp_extract(text, pattern, 1), r"(?U)\s", ""), F.lit("之"), F.lit("-"))

    a, b = number(addr_cn, HOUSE_CN), number(addr_en, HOUSE_EN)
    return F.when((a != "") & (b != "") & (a != b), F.concat(F.lit("J: house number "), a, F.lit(" / "), b)).otherwise("")


def compose_doubt(*doubts: Column) -> Column:
    return F.concat_ws("；", *(F.nullif(d, F.lit("")) for d in doubts))


# --- pages -----------------------------------------------------------------------------------


def contract_pages(page_texts: DataFrame) -> DataFrame:
    """(source_docx, ord, image_name, score, found) of the page with the highest score, the first of equals.

    Below the least score the page is not known; with no score at all the page named image2.* stands in.
    """
    scored = page_texts.select("source_docx", "ord", "image_name", S.page_score(F.col("text")).alias("score"))
    best = scored.groupBy("source_docx").agg(
        F.max_by(F.struct("ord", "image_name", "score"), F.struct("score", -F.col("ord"))).alias("b"),
        F.min_by(F.struct("ord", "image_name", "score"), F.when(F.col("image_name").startswith("image2."), F.col("ord"))).alias("second"),
    )
    pick = F.when((F.col("b.score") == 0) & F.col("second").isNotNull(), F.col("second")).otherwise(F.col("b"))
    return best.select("source_docx", pick.alias("p")).select("source_docx", "p.ord", "p.image_name", "p.score", (F.col("p.score") >= MIN_PAGE_SCORE).alias("found"))


def next_pages(page_texts: DataFrame, contract: DataFrame) -> DataFrame:
    """The page after each contract page that was found."""
    after = contract.where("found").select("source_docx", (F.col("ord") + 1).alias("ord"))
    return page_texts.join(after, ["source_docx", "ord"])


def pledge_pages(page_texts: DataFrame) -> DataFrame:
    """Up to two pages after the first pledge front page of each document."""
    front = page_texts.where(S.is_pledge_front(F.col("text"))).groupBy("source_docx").agg(F.min("ord").alias("__front"))
    after = page_texts.join(grows(front), "source_docx").where(F.col("ord").between(F.col("__front") + 1, F.col("__front") + PLEDGE_PAGES))
    return after.drop("__front")


def pledge_name(text: Column) -> Column:
    """The employer's Chinese name from a pledge page, or ''."""
    v = F.regexp_replace(F.split(F.regexp_extract(text, PLEDGE_NAME, 1), PLEDGE_CUT, 2)[0], r"(?U)\s+", "")
    return F.when(S.has_cjk(v) & S.name_like(v), v).otherwise("")


def rescue_names(employers: DataFrame, page_texts: DataFrame) -> DataFrame:
    """Employers without a Chinese name take it from the first pledge page that has one; the English name stays."""
    need = employers.where("name_cn = ''").select("source_docx")
    names = pledge_pages(page_texts).join(grows(need), "source_docx", "left_semi").withColumn("got", pledge_name(F.col("text"))).where("got <> ''")
    first = names.groupBy("source_docx").agg(F.min_by(F.struct("got", "image_name"), "ord").alias("pledge"))
    out = employers.join(grows(first), "source_docx", "left")
    name = F.coalesce("pledge.got", "name_cn")
    source = F.when(F.col("pledge").isNotNull(), F.concat(F.lit("H: name from pledge page "), F.col("pledge.image_name")))
    return out.withColumn("name_cn", name).withColumn("doubt_name", compose_doubt(F.coalesce(source, F.lit("")), name_doubt(F.col("name_cn"), F.col("name_en")))).drop("pledge")


# --- the agency's block ----------------------------------------------------------------------


def with_agency_block(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``agency``: phones, name and address of the agency's block on the page after the contract."""
    df = df.withColumn("__l", lines_of(F.col(text)))
    strict, loose = (_place(F.col("__l"), lambda l, p=p: S.label_line(l, p)) for p in (TW_AGENCY, TW_AGENCY_LOOSE))
    df = df.withColumn("__s", F.coalesce(strict, loose))
    end = _place(F.col("__l"), lambda l: S.label_line(l, ID_AGENCY) | S.label_line(l, TW_AGENCY) | l.rlike(ID_PHONE), F.col("__s"))
    df = df.withColumn("__e", F.coalesce(end, F.size("__l")))
    wide = F.coalesce(_place(F.col("__l"), lambda l: l.rlike(PARTY_B), F.col("__s")), F.size("__l"))
    df = df.withColumn("__e", F.when(F.col("__e") - F.col("__s") <= 2, wide).otherwise(F.col("__e")))
    df = df.withColumn("__b", F.filter(_between(F.col("__l"), F.col("__s"), F.col("__e")), lambda l: ~l.rlike(ID_LINE)))
    phones = F.array_distinct(F.flatten(F.transform("__b", lambda l: S.phones_in(S.before_fax(l)))))

    def name(l: Column) -> Column:
        value = F.regexp_replace(S.first_of(S.strip(F.regexp_replace(l, ".*[:：]", "")), l), AGENCY_LABEL_WORDS, "")
        v = S.clean_agency_name(value)
        return F.when((v != "") & v.rlike(AGENCY_WORDS) & ~v.rlike(CN_ADDRESS) & (F.length(v) >= 4), v)

    def address(l: Column) -> Column:
        v = F.regexp_replace(l, r"(?i).*(?:地址|Alamat)\s*[:：]", "")
        return F.when(S.has_cjk(v) & v.rlike(CN_ADDRESS), S.strip(F.regexp_replace(F.regexp_replace(v, LABELS, ""), "^[:： ]+", "")))

    block = F.struct(phones.alias("phones"), _value(F.col("__b"), name).alias("name"), _value(F.col("__b"), address).alias("address"))
    return df.withColumn("agency", block).drop("__l", "__s", "__e", "__b")


def compare_extractions(one: DataFrame, two: DataFrame, fields: list[str]) -> DataFrame:
    """Fields in which two extractions of the same documents differ."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"x.{f}").alias("first"), F.col(f"y.{f}").alias("second")) for f in fields))
    joined = one.alias("x").join(two.alias("y"), "source_docx")
    return joined.select("source_docx", F.explode(F.filter(pairs, lambda p: ~p["first"].eqNullSafe(p["second"]))).alias("p")).select("source_docx", "p.*")
