"""Scalar rules as JVM column expressions: keys, predicates, extraction cascades, telephone forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: thresholds and positions --------------------------------------------------
KEY_IN, PERMIT_VOTE_MIN, MOL_VOTE_MIN, RESCUE_BELOW = 55.0, 45.0, 50.0, 50.0
SMALL_LIMIT, TIER1_IMAGES, VOTE_MIN = 3, (2, 5, 6), 2
PHONE_MIN, LABEL_MAX = 8, 40
ROIS = ("mol", "permit_upper", "permit_lower")

# --- fixed values: permit patterns (value = four digits, optional dash and digit) ------------
_VALUE = r"(\d{4}(?:-\d)?)(?!\d)"
_COLON = r"\s*[:：﹕]\s*(?:NO\.)?"
ID_PATTERNS = (
    r"(?iU)No\.?\s*i[zjl1]in" + _COLON + _VALUE,
    r"(?iU)n\w{0,5}n" + _COLON + _VALUE,
    r"(?iU)\bi[zjl1]in" + _COLON + _VALUE,
    r"(?iU)\bNO\." + _VALUE,
)
LOWER_ID_PATTERNS = (r"(?iU)No\.?\s*i[zjl1]in\s*[:：﹕]?\s*(?:NO\.)?" + _VALUE, *ID_PATTERNS[1:])
_LICENCE = r"'?s?\s+M[O0]L?\s+(?:L[i1I])?i?cense\s+Num\s*ber\s*[:：]\s*"
MOL_PATTERNS = (
    r"(?iU)Agency" + _LICENCE + _VALUE,
    r"(?iU)A\w{3,6}" + _LICENCE + _VALUE,
    r"(?iU)(?:Num\s*ber|umber|namber)\s*[:：]\s*" + _VALUE,
    r"(?iU)M[O0]L\D{0,30}" + _VALUE,
)
PERMIT_FORMAT = r"^[0-9]{4}(-[0-9])?\n?$"

# --- fixed values: telephone, fax and page patterns -------------------------------------------
PHONE_DOMESTIC = r"(?<!\d)(0\d(?:[-\s]?\d){7,8})(?!\d)"
PHONE_PAREN = r"\((0\d{1,3})\)\s*(\d{3,4})\s*-?\s*(\d{3,4})(?!\d)"
PHONE_INTL = r"(?<!\d)\+?886[\s.-]*(\d[\d\s.-]{6,12}\d)"
FAX = r"(?i)傳真|Fax"
CJK = "[一-鿿]"
FORM_LABELS = r"(?i)Nama\s*Majikan|Nama\s*Perusahaan|Pemberi\s*Kerja|Nomor\s*Telepon|Alamat|MOL\s*License|招募許可|甲方名稱|雇主名[稱称]"
PROSE_MARKERS = r"(?i)PERJANJIAN\s*KERJA|MAJIKAN\s*DENGAN|PIHAK\s*PERTAMA|SELANJUTNYA|勞動契約"
PLEDGE_FRONT = r"(?i)Surat\s*Pernyataan"
CN_BOILERPLATE = r"勞動契約|家庭幫傭|監護工|看護工|家庭看護|製造工|廠工|漁工|以下簡稱|以下$|^以下"


def strip(c: Column) -> Column:
    """Unicode-aware trim."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def first_digits(name: Column) -> Column:
    """The first run of digits without leading zeros, or null."""
    return F.when(name.rlike(r"\d"), F.regexp_replace(F.regexp_extract(name, r"\d+", 0), "^0+", ""))


def natural_key(name: Column) -> Column:
    """Sorts image2 before image10, and names without a number last; numbers may have any length."""
    n = first_digits(name)
    return F.struct(F.when(n.isNull(), 1).otherwise(0).alias("none"), F.coalesce(F.length(n), F.lit(0)).alias("width"), F.coalesce(n, F.lit("")).alias("n"), name.alias("name"))


def _number(name: Column, kind: str, most: int) -> Column:
    """The first number of a name, ``most`` for larger ones, null without one."""
    n = first_digits(name)
    return F.when(n == "", F.lit(0).cast(kind)).when(n.isNotNull(), F.coalesce(n.try_cast(kind), F.lit(str(most)).cast(kind)))


def natural_key_flat(name: Column) -> Column:
    """The second reader's order: names without a number at 2**30."""
    return F.struct(F.coalesce(_number(name, "decimal(38,0)", 10**38 - 1), F.lit(1 << 30)).alias("n"), name.alias("name"))


def image_index(name: Column) -> Column:
    """The number of an image, 0 without one; a number beyond an int's range is its largest."""
    return F.coalesce(_number(name, "int", (1 << 31) - 1), F.lit(0))


def docx_class(n_images: Column) -> Column:
    return F.when(n_images <= SMALL_LIMIT, "small").otherwise("large")


def tier(index: Column) -> Column:
    return F.when(index.isin(*TIER1_IMAGES), 1).otherwise(2)


def roi_field(roi: Column) -> Column:
    return F.split_part(roi, F.lit("_"), F.lit(1))


def valid_permit(value: Column) -> Column:
    return F.coalesce(value.rlike(PERMIT_FORMAT), F.lit(False))


def first_of(*values: Column) -> Column:
    """The first that is neither null nor ''."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values), F.lit(""))


def has_cjk(text: Column) -> Column:
    return text.rlike(CJK)


def name_like(text: Column) -> Column:
    """No Chinese boilerplate and no digit."""
    return ~text.rlike(CN_BOILERPLATE) & ~text.rlike(r"(?U)\d")


def label_line(line: Column, pattern: str) -> Column:
    """A short line with the label that does not end as a sentence does."""
    s = strip(line)
    return s.rlike(pattern) & (F.length(s) <= LABEL_MAX) & ~s.rlike(r"[。．.]$")


def cascade(text: Column, patterns: Sequence[str]) -> Column:
    """(value, layer) of the first pattern that occurs; ('', 0) if none does.

    Every pattern's value has a character at least.  A pattern runs once a text, and not after a hit.
    """

    def found(i: int, pattern: str) -> Column:
        return F.transform(F.array(F.regexp_extract(text, pattern, 1)), lambda v: F.when(v != "", F.struct(v.alias("value"), F.lit(i).alias("layer"))))[0]

    return F.coalesce(*(found(i + 1, p) for i, p in enumerate(patterns)), F.struct(F.lit("").alias("value"), F.lit(0).alias("layer")))


def round1(value: Column) -> Column:
    """One decimal as Python rounds: to the nearest, by the exact binary value, ties to even.

    Ten times the value is taken as the sum of eight and two times it, both exact, with the error of the sum.
    """
    a, b = value * F.lit(8.0), value * F.lit(2.0)

    def of(total: Column) -> Column:
        part = total - a
        error = (a - (total - part)) + (b - part)
        low = F.floor(total).cast("double")
        over = total - low
        up = (over > 0.5) | ((over == 0.5) & ((error > 0) | ((error == 0) & (F.abs(low) % 2 == 1))))
        return (low + F.when(up, 1.0).otherwise(0.0)) / 10

    return F.transform(F.array(a + b), of)[0]


def permit_of(text: Column, roi: Column) -> Column:
    """The id cascade of a permit region; the lower one may lack the first colon."""
    return F.when(roi == "permit_lower", cascade(text, LOWER_ID_PATTERNS)).otherwise(cascade(text, ID_PATTERNS))


def licence_of(text: Column) -> Column:
    return cascade(text, MOL_PATTERNS)


def second_reader_value(text: Column) -> Column:
    """The second engine's short text: an id if there is one, else a licence number."""
    return first_of(cascade(text, ID_PATTERNS)["value"], cascade(text, MOL_PATTERNS)["value"])


# --- telephones ------------------------------------------------------------------------------


def before_fax(line: Column) -> Column:
    return F.split(line, FAX, 2)[0]


def phones_in(line: Column) -> Column:
    """Candidates of a line: domestic, then with area code in brackets, then international ones."""
    plain = F.regexp_extract_all(line, F.lit(PHONE_DOMESTIC), F.lit(1))
    bracket = F.transform(F.regexp_extract_all(line, F.lit(PHONE_PAREN), F.lit(0)), lambda p: F.regexp_replace(p, r"^\((0\d{1,3})\)\s*(\d{3,4})\s*-?\s*(\d{3,4})$", "$1-$2$3"))
    digits = F.transform(F.regexp_extract_all(line, F.lit(PHONE_INTL), F.lit(1)), lambda p: F.ltrim(F.regexp_replace(p, r"\D", ""), F.lit("0")))
    abroad = F.transform(F.filter(digits, lambda d: F.length(d).between(8, 9)), lambda d: F.concat(F.lit("0"), d))
    return F.concat(plain, bracket, abroad)


def phone_norm(phone: Column) -> Column:
    """Digits alone; a leading 886 becomes a single leading 0."""
    n = F.regexp_replace(F.coalesce(phone, F.lit("")), r"\D", "")
    return F.when(n.startswith("886"), F.concat(F.lit("0"), F.ltrim(F.substr(n, F.lit(4)), F.lit("0")))).otherwise(n)


def split_phone_field(raw: Column) -> Column:
    """Numbers of a registry field: several in a cell, extensions cut, short remainders dropped."""
    parts = F.transform(F.split(F.coalesce(raw, F.lit("")), "[/、.]"), lambda p: phone_norm(F.split(p, "[#*]", 2)[0]))
    return F.array_distinct(F.filter(parts, lambda n: F.length(n) >= PHONE_MIN))


def phone_note(raw: Column) -> Column:
    """What a user should know of a registry's telephone field."""
    n = F.size(split_phone_field(raw))
    return F.when(strip(F.coalesce(raw, F.lit(""))) == "", "none").when(n == 0, "unusable").when(n > 1, "several").when(raw.rlike("[#*]"), "extension").when(raw.rlike("[/、.]"), "partial").otherwise("")


# --- permits in a registry -------------------------------------------------------------------


def parse_permit(permit: Column) -> Column:
    """(base, suffix): a numeric head, and a tail without leading zeros or in upper case; null if no number."""
    text = strip(F.coalesce(permit, F.lit("")))
    head = strip(F.substring_index(text, "-", 1))
    tail = F.when(F.contains(text, F.lit("-")), strip(F.substr(text, F.instr(text, F.lit("-")) + 1))).otherwise("")
    suffix = F.when(tail.rlike("^[0-9]+$"), F.regexp_replace(tail, "^0+(?=[0-9])", "")).otherwise(F.upper(tail))
    return F.when(head.rlike("^[0-9]+$"), F.struct(F.expr("1").cast("int").alias("one"), head.try_cast("int").alias("base"), suffix.alias("suffix")).dropFields("one"))


def permit_number(permit: Column) -> Column:
    """The numeric head as digits without leading zeros, however many; null if no number."""
    head = strip(F.substring_index(strip(F.coalesce(permit, F.lit(""))), "-", 1))
    return F.when(head.rlike("^[0-9]+$"), F.regexp_replace(head, "^0+(?=[0-9])", ""))


def branch_key(base: Column, suffix: Column) -> Column:
    return F.concat_ws("-", base.cast("string"), suffix)


def active(revoked: Column, closed: Column) -> Column:
    """Neither revoked nor closed; a null date counts as blank."""
    return (strip(F.coalesce(revoked, F.lit(""))) == "") & (strip(F.coalesce(closed, F.lit(""))) == "")


def iso_date(eight: Column) -> Column:
    return F.when(eight.rlike("^[0-9]{8}$"), F.concat_ws("-", F.substr(eight, F.lit(1), F.lit(4)), F.substr(eight, F.lit(5), F.lit(2)), F.substr(eight, F.lit(7), F.lit(2)))).otherwise(F.coalesce(eight, F.lit("")))


# --- names and addresses ---------------------------------------------------------------------


def balance_brackets(text: Column) -> Column:
    """Missing closing brackets are added at the end, missing opening ones at the front, each width by itself."""

    def balanced(text: Column, left: str, right: str) -> Column:
        def whole(t: Column) -> Column:
            lead = F.length(F.replace(t, F.lit(right), F.lit(""))) - F.length(F.replace(t, F.lit(left), F.lit("")))
            return F.when(lead > 0, F.concat(t, F.repeat(F.lit(right), lead))).when(lead < 0, F.concat(F.repeat(F.lit(left), -lead), t)).otherwise(t)

        return F.transform(F.array(text), whole)[0]  # the text is worked out once, however costly that is

    return balanced(balanced(text, "（", "）"), "(", ")")


def clean_agency_name(text: Column) -> Column:
    """From the first Chinese character to the last one or its closing bracket."""
    return F.regexp_extract(text, f"(?s){CJK}(?:.*[一-鿿）)])?", 0)


def syllables(name_en: Column) -> Column:
    return F.size(F.filter(F.split(strip(name_en), r"[\s,\-]+"), lambda p: p != ""))


def page_score(text: Column, form: str = FORM_LABELS, prose: str = PROSE_MARKERS) -> Column:
    """Two for each form label, one for each prose marker."""
    return 2 * F.regexp_count(text, F.lit(form)) + F.regexp_count(text, F.lit(prose))


def is_pledge_front(text: Column) -> Column:
    return text.rlike(PLEDGE_FRONT)


def strip_section(road: Column) -> Column:
    return F.regexp_replace(road, r"\d+段$", "")


def direction(road: Column) -> Column:
    """The compass character before a road's suffix, or ''."""
    return F.regexp_extract(road, "([東西南北])(?:大道|路|街|道)$", 1)
