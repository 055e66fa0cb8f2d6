"""Surrogates for personal data, in DataFrame and SQL functions alone.

Detected are e-mail addresses, telephone numbers, payment cards, social security numbers, IBANs,
IPv4 addresses, and names that follow a title (Mr, Frau, Señora, Г-жа, ...).  Every entity gets a
replacement derived from a keyed SHA-512 of its type and canonical form:

* type-consistent: octets stay within 0-255, a card that passes the Luhn check and an IBAN that passes
  its check modulo 97 still do, the top domain and the country code stay, equal domains get equal domains;
* format and script: letters become letters of the same case and script, digits digits, all else
  stays; a leading non-zero digit stays non-zero; names come from lists by script and by the gender
  of title or first name, in the case of the original;
* coreference: an entity has one canonical form (folded case, digits without separators), so all its
  spellings get the same surrogate poured into their own format;
* distinctness: over the whole table the surrogates of distinct entities of a type are compared;
  of those that collide with each other or with an original all but one are derived anew, until none
  does.  With each attempt names get a syllable more, and from the second on local parts of e-mail
  addresses and telephone numbers a character more, so that their space never runs out; the other
  types keep their format, of which more than half of all values would have to occur in one table.

Telephone numbers are those with '+' or 00 and a country code, with a leading 0 (9 to 12 digits, dates
aside), and those of an area code of three digits and seven more ('555-123-4567', '(555) 123-4567', a
1 or 8 may lead).  Left out are other national forms: without any prefix ('5551234567', '91 123 45 67'),
local ones without an area code ('555-1234'), extensions, numbers spelt in words, and those joined to a
letter.  A number's national and international forms count as two entities.

Matches are leftmost, non-overlapping, first alternative first.  Null texts stay null.  Letters of
scripts without a list become letters of the same Unicode block row only where that is Latin, Greek
or Cyrillic; others stay as they are in e-mail addresses and names.  Texts of any length are taken
whole; an address ends with its 127th label and begins 254 characters before the sign at most.  Empty
texts and tables stay so, repeated rows are replaced alike, and other columns pass through, but for
one named ``n_entities``, which the result's replaces.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.llm.common import Scratch

# Titles by gender, and names by script and gender.
MALE_TITLES = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Господин", "Κύριος"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа", "Госпожа", "Κυρία"]
OTHER_TITLES = ["Dr", "Prof"]
FIRST = {
    ("latin", "m"): "Adam Albin Bruno Carl Cyril Dario Edgar Emil Felix Georg Hugo Ivan Jonas Karl Leon Marc Noel Oscar Pablo Ralf Simon Theo Urban Viktor Walter".split(),
    ("latin", "f"): "Ada Alma Berta Carla Clara Daria Elena Emma Flora Greta Helena Ida Julia Karla Laura Maria Nora Olga Paula Rosa Sofia Tessa Ulla Vera Wanda".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Семён Тимур".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Кира Лидия Мария Нина Ольга Полина Рита Софья".split(),
    ("greek", "m"): "Αλέξης Γιάννης Δημήτρης Ηλίας Θάνος Κώστας Λεωνίδας Μάρκος Νίκος Πέτρος".split(),
    ("greek", "f"): "Αθηνά Βάσω Γεωργία Δάφνη Ειρήνη Ζωή Ιωάννα Καίτη Μαρία Σοφία".split(),
}
HEADS = {
    "latin": "Al Bar Ber Bo Bran Cal Car Cor Dal Dor El Fal Fer Gal Gar Hal Har Hol Jar Kal Kel Lan Lor Mal Mar Mor Nel Nor Or Pal Per Ral Ros Sal San Sel Sor Tal Tor Val Ver Wal Wil Zan".split(),
    "cyrillic": "Алек Бар Вол Гор Дав Ель Жар Зор Ива Кар Лав Мор Нов Оль Пет Рог Сав Тар Фед Чер".split(),
    "greek": "Αλεξ Βασ Γεωρ Δημ Ευαγ Ζαφ Θεο Καρ Λαμ Μαν Νικ Παπ Ραφ Σταμ Τσιρ Φωτ".split(),
}
MIDDLES = {"latin": "a e i o u an en in on ar er or al el il".split(), "cyrillic": "а е и о ан ен ин ов ар ер".split(), "greek": "α ε ι ο αν εν ιν".split()}
TAILS = {
    "latin": "berg bert cini dale dero din feld field ford gard hart holm land ler lin man mann mer mont more nell ner nez novi quist ras rell rini ro sen ski son stad ston ter tini ton tor vale vall ver vic win wood zeller zio".split(),
    "cyrillic": "енко ич ко чук юк ян ук ман".split(),
    "greek": "άκης ίδης όπουλος έλης άτος ούσης ώτης άς".split(),
}

_W = r"(?<![\p{L}\p{N}_])"
_E = r"(?![\p{L}\p{N}_])"
_NAME = r"\p{Lu}[\p{L}'’-]+"
_CARD = r"\d{4}(?:\d{12}|(?: \d{4}){3}|(?:-\d{4}){3})"


def _domain(label: str) -> str:
    """Labels given up one by one until a top domain of letters follows; what comes after it, say a hyphen, is no part."""
    return rf"{label}(?:\.{label}){{0,126}}\.\p{{L}}{{2,}}+(?![\p{{L}}\p{{N}}])"


# One pattern for each type, in order of preference; all begin where no word goes on.
PATTERNS = {
    "email": r"[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,253}+@(?:" + _domain(r"[\p{L}\p{N}]++(?:-++[\p{L}\p{N}]++)*+") + "|" + _domain(r"[\p{L}\p{N}-]++") + ")",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _E,
    "card": _CARD + _E,
    "phone": r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?(?:\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\d(?:[ .-]?\d{2,4}){2,5})" + _E,
    "ssn": r"\d{3}-\d{2}-\d{4}" + _E,
    "ip": r"(?<!\.)(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}_]|\.\d)",
    # With a leading 0 (also in brackets, also 00 and the country code) but no date, or with an area code of three digits.
    "national": r"(?<!\d[.-])(?=[(\d])(?:(?!\d{2}[./-]\d{2}[./-]\d{2}(?:\d{2})?(?![./-]?\d))"
    r"(?:0[1-9](?:[ ./-]?\d){7,10}|00[1-9](?:[ ./-]?\d){8,13}|\(0[1-9]\d{0,3}\)(?:[ ./-]?\d){5,10})"
    r"|(?:[18][ .-]?)?(?:\(\d{3}\)[ .-]?|(?<![18])[2-9]\d{2}[ .-])\d{3}[ .-]?\d{2}[ .-]?\d{2})" + _E + r"(?!-\d)",
    "name": r"(?=[DFHMPSГΚ])(?:" + "|".join(sorted(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES, key=len, reverse=True)) + r")\.? " + _NAME + r"(?: " + _NAME + r")?",
}
PATTERN = _W + "(?:" + "|".join(PATTERNS.values()) + ")"


def kind(match: Column) -> Column:
    """The type of a match, from its shape alone."""
    out = F.when(F.contains(match, F.lit("@")), "email").when(match.startswith("+"), "phone")
    out = out.when(match.rlike(r"^(?:\d{1,3}\.){3}\d{1,3}$"), "ip").when(match.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
    return out.when(match.rlike(f"^{_CARD}$"), "card").when(match.rlike("^[(0-9]"), "phone").when(match.rlike(r"^[A-Z]{2}\d{2}[A-Z0-9 ]+$"), "iban").otherwise("name")


def _gender(title: Column, first: Column) -> Column:
    """m, f or n: by the title, else by a known first name."""
    by_name = F.when(first.isin([x.lower() for (_, g), v in FIRST.items() if g == "m" for x in v]), "m").when(first.isin([x.lower() for (_, g), v in FIRST.items() if g == "f" for x in v]), "f")
    return F.when(title.isin(MALE_TITLES), "m").when(title.isin(FEMALE_TITLES), "f").otherwise(F.coalesce(by_name, F.lit("n")))


def canonical(match: Column) -> Column:
    """Type and form that all spellings of an entity share, as ``type:form``; names as ``name:gender:form``."""

    def of(k: Column) -> Column:
        name = F.lower(F.regexp_replace(match, r"^\S+ ", ""))
        gender = _gender(F.rtrim(F.substring_index(match, " ", 1), F.lit(".")), F.substring_index(name, " ", 1))
        form = F.when(k.isin("card", "phone", "ssn"), F.regexp_replace(match, r"\D", "")).when(k == "iban", F.replace(match, F.lit(" "), F.lit("")))
        form = form.when(k == "name", F.concat(gender, F.lit(":"), name)).when(k == "ip", match).otherwise(F.lower(match))
        return F.concat(k, F.lit(":"), form)

    return _let(kind(match), of)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _byte(digest: Column, i: Column | int) -> Column:
    """A number 0 to 4095 from three hex digits at a place of a SHA-512 digest (128 digits, used in turn)."""
    at = F.pmod((F.lit(i) if isinstance(i, int) else i) * 3, F.lit(125)) + 1
    return F.conv(F.substr(digest, at.cast("int"), F.lit(3)), 16, 10).cast("int")


def _pick(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(n, F.lit(len(values))) + 1).cast("int"))


# The alphabets that letters are replaced within.
ALPHABETS = ["abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшщэюя", "αβγδεζηθικλμνξοπρστυφχψω"]


def _poured(text: Column, digest: Column) -> Column:
    """Letters and digits replaced one by one, each from its own part of the digest; the rest stays."""

    def one(c: Column, i: Column) -> Column:
        n = _byte(digest, i)
        low = F.lower(c)
        out = F.when(c.rlike("^[0-9]$"), F.when((i == 0) & (c != "0"), F.pmod(n, F.lit(9)) + 1).otherwise(F.pmod(n, F.lit(10))).cast("string"))
        for a in ALPHABETS:
            letter = F.substr(F.lit(a), (F.pmod(n, F.lit(len(a))) + 1).cast("int"), F.lit(1))
            test = "^[a-zà-öø-ÿ]$" if a[0] == "a" else f"^[{a[0]}-{a[-1]}ё]$" if a[0] == "а" else f"^[{a[0]}-{a[-1]}ά-ώ]$"
            out = out.when(low.rlike(test), F.when(c == low, letter).otherwise(F.upper(letter)))
        return out.otherwise(c)

    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn check modulo 10 (digits from the right, every second one doubled)."""
    cs = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    parts = F.transform(cs, lambda c, i: F.when(i % 2 == 1, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10


def _mod97(iban: Column) -> Column:
    """The number that an IBAN stands for (its first four characters last, letters as 10 to 35), modulo 97."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    cs = F.filter(F.split(turned, ""), lambda c: c != "")

    def step(total: Column, c: Column) -> Column:
        return F.when(c.rlike("^[0-9]$"), total * 10 + c.cast("int")).otherwise(total * 100 + F.ascii(F.upper(c)) - 55) % 97

    return F.aggregate(cs, F.lit(0), lambda t, c: F.coalesce(step(t, c), F.lit(0)))


def surrogate_form(canon: Column, attempt: Column, key: str) -> Column:
    """The surrogate's canonical form, which collisions are checked on."""

    def digest(*parts: Column) -> Column:
        return F.sha2(F.concat_ws("|", F.lit(key), *parts), 512)

    def of(d: Column) -> Column:
        k, form = F.substring_index(canon, ":", 1), F.regexp_replace(canon, "^[a-z]+:", "")
        local, domain = F.substring_index(form, "@", 1), F.substring_index(form, "@", -1)
        top = F.substring_index(domain, ".", -1)
        host = F.substr(domain, F.lit(1), (F.length(domain) - F.length(top)).cast("int"))
        more = F.greatest(attempt - 1, F.lit(0))
        email = F.concat(_poured(F.concat(local, F.repeat(F.lit("a"), more)), d), F.lit("@"), _let(digest(F.lit("domain"), domain), lambda e: _poured(host, e)), top)

        def checked(raw: Column) -> Column:
            body = F.substr(raw, F.lit(1), (F.length(raw) - 1).cast("int"))
            check = F.pmod(F.lit(10) - _luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("int").cast("string")
            return F.when(_luhn(form) == 0, F.concat(body, check)).otherwise(raw)

        octets = F.transform(F.split(form, r"\."), lambda _, i: F.when(i == 0, F.pmod(_byte(d, i), F.lit(223)) + 1).otherwise(F.pmod(_byte(d, i), F.lit(256))).cast("string"))
        fixed = F.when(form.startswith("00"), 3).otherwise(1)
        phone = F.concat(F.substr(form, F.lit(1), fixed), _poured(F.concat(F.substr(form, fixed + 1), F.repeat(F.lit("0"), more)), d))

        def proven(raw: Column) -> Column:
            country, rest = F.substr(raw, F.lit(1), F.lit(2)), F.substr(raw, F.lit(5))
            check = F.lpad((F.lit(98) - _mod97(F.concat(country, F.lit("00"), rest))).cast("string"), 2, "0")
            return F.when(_mod97(form) == 1, F.concat(country, check, rest)).otherwise(raw)

        iban = _let(F.upper(F.concat(F.substr(form, F.lit(1), F.lit(2)), _poured(F.substr(form, F.lit(3)), d))), proven)
        out = F.when(k == "email", email).when(k == "card", _let(_poured(form, d), checked)).when(k == "ip", F.array_join(octets, "."))
        return F.concat(k, F.lit(":"), out.when(k == "phone", phone).when(k == "iban", iban).when(k == "name", _name(form, d, attempt)).otherwise(_poured(form, d)))

    return _let(digest(canon, attempt.cast("string")), of)


def _name(form: Column, d: Column, attempt: Column) -> Column:
    """``gender:name`` of the same gender, script and number of words; a lone word is a family name.

    Each attempt has a middle syllable more than the one before, so it draws from a larger space.
    """
    gender, two = F.substr(form, F.lit(1), F.lit(1)), F.contains(form, F.lit(" "))

    def of(script: str) -> Column:
        first = F.when(gender == "m", _pick(FIRST[script, "m"], _byte(d, 0))).when(gender == "f", _pick(FIRST[script, "f"], _byte(d, 0))).otherwise(_pick(FIRST[script, "m"] + FIRST[script, "f"], _byte(d, 0)))
        more = F.array_join(F.transform(F.sequence(F.lit(0), attempt), lambda i: F.when(i == 0, "").otherwise(_pick(MIDDLES[script], _byte(d, i + 3)))), "")
        last = F.concat(_pick(HEADS[script], _byte(d, 1)), _pick(MIDDLES[script], _byte(d, 2)), F.when(attempt > 0, more).otherwise(""), _pick(TAILS[script], _byte(d, 3)))
        return F.concat(gender, F.lit(":"), F.lower(F.when(two, F.concat(first, F.lit(" "), last)).otherwise(last)))

    return F.when(form.rlike(r"\p{IsCyrillic}"), of("cyrillic")).when(form.rlike(r"\p{IsGreek}"), of("greek")).otherwise(of("latin"))


def formatted(match: Column, form: Column) -> Column:
    """The surrogate's canonical form poured into the format of one spelling."""

    def of(value: Column) -> Column:
        k = kind(match)
        # Places of digits (of an IBAN also letters) take the form's characters in turn; more characters than places follow at the end.
        free = F.when(k == "iban", "[^A-Z0-9]").otherwise("[^0-9]")

        def poured(chars: Column) -> Column:
            def one(c: Column, i: Column) -> Column:
                n = F.length(F.regexp_replace(F.array_join(F.slice(chars, F.lit(1), i + 1), ""), free, F.lit("")))
                return F.when(F.regexp_replace(c, free, F.lit("")) != "", F.substr(value, n, F.lit(1))).otherwise(c)

            places = F.length(F.regexp_replace(match, free, F.lit("")))
            return F.concat(F.array_join(F.transform(chars, one), ""), F.substr(value, places + 1))

        email = F.when(match == F.upper(match), F.upper(value)).otherwise(value)
        title, rest = F.substring_index(match, " ", 1), F.regexp_replace(match, r"^\S+ ", "")
        name = F.when(rest == F.upper(rest), F.upper(value)).otherwise(F.initcap(value))
        return F.when(k == "email", email).when(k == "ip", value).when(k == "name", F.concat(title, F.lit(" "), name)).otherwise(_let(F.filter(F.split(match, ""), lambda c: c != ""), poured))

    return _let(F.regexp_replace(form, "^(?:name:[mfn]|[a-z]+):", ""), of)


def matches(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def _attempts(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(canon, attempt) of the entities whose first surrogate collides, with the attempt that does not.

    An entity keeps its surrogate if no original has that form and it is the smallest of its claimants.
    """
    state = scratch.save(entities.select("canon", F.lit(0).alias("attempt"), surrogate_form(F.col("canon"), F.lit(0), key).alias("form")), "state-0")
    for r in itertools.count(1):
        # Claims and originals side by side: for each form its first claimant, and whether an original has it.
        claims = state.select("form", F.struct("attempt", "canon").alias("by"), F.lit(0).alias("taken"))
        originals = state.select(F.col("canon").alias("form"), F.lit(None).cast("struct<attempt:int,canon:string>").alias("by"), F.lit(1).alias("taken"))
        held = claims.unionByName(originals).groupBy("form").agg(F.min("by").alias("by"), F.count("by").alias("n"), F.max("taken").alias("taken"))
        owner = F.when(F.col("taken") == 0, F.col("by.canon"))
        bad = scratch.save(held.where("n > 1 or (n > 0 and taken = 1)").select("form", F.lit(True).alias("bad"), owner.alias("owner")), f"bad-{r}")
        if bad.isEmpty():
            return state.where("attempt > 0").select("canon", "attempt")
        again = F.coalesce("bad", F.lit(False)) & ~F.coalesce(F.col("canon") == F.col("owner"), F.lit(False))
        marked = state.join(bad, "form", "left").withColumn("again", again).withColumn("attempt", F.when(F.col("again"), F.lit(r)).otherwise(F.col("attempt")))
        form = F.when(F.col("again"), surrogate_form(F.col("canon"), F.col("attempt"), key)).otherwise(F.col("form"))
        state = scratch.save(marked.select("canon", "attempt", form.alias("form")), f"state-{r}")
    raise AssertionError


def replace(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All columns of ``df`` with the entities in ``text`` replaced, and ``n_entities``.

    Attempts other than the first are joined to the texts that hold their entities, by the text's hash.
    """
    scratch = Scratch(df.sparkSession)
    found = df.select(F.xxhash64(text).alias("h"), F.explode(F.array_distinct(F.transform(matches(F.col(text)), canonical))).alias("canon")).distinct()
    found = scratch.save(found, "entities")
    again = scratch.save(_attempts(found.select("canon").distinct(), key, scratch), "again")
    maps = scratch.save(found.join(again, "canon").groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("canon", "attempt"))).alias("again")), "maps")
    names = [c for c in df.columns if c.lower() != "n_entities"]
    base = df.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(f"`{text}`").alias("text"), F.xxhash64(text).alias("h"))
    base = base.join(maps, "h", "left").withColumn("m", matches(F.col("text")))

    def one(x: Column) -> Column:
        def form(c: Column) -> Column:
            return surrogate_form(c, F.coalesce(F.try_element_at(F.col("again"), c), F.lit(0)), key)

        return formatted(x, _let(canonical(x), form))

    between = F.split(F.col("text"), PATTERN, -1)
    whole = F.array_join(F.zip_with(between, F.transform("m", one), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    replaced = F.when(F.size("m") > 0, whole).otherwise(F.col("text"))
    n = F.greatest(F.coalesce(F.size("m"), F.lit(0)), F.lit(0)).alias("n_entities")
    return scratch.keep_for(base.select(*((replaced if c == text else F.col("row")[c]).alias(c) for c in names), n), "maps")
