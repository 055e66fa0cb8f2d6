"""The few rules that Spark has no expression for, as Arrow UDFs: NFKC folding and similarity."""

from __future__ import annotations

import difflib
import math
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Characters written in two ways, and Chinese digits.
VARIANTS = str.maketrans("臺鍾", "台鐘")
DIGITS = {c: str(i) for i, c in enumerate("零一二三四五六七八九")}
_SECTION = re.compile("([0-9一二三四五六七八九十]+)段")


def section_number(text: str) -> str:
    """A section's number in Arabic digits (up to 99)."""
    if text.isdigit():
        return text
    tens, ten, ones = text.partition("十")
    if not ten:
        return DIGITS.get(text, text)
    return f"{DIGITS.get(tens, '1')}{DIGITS.get(ones, '0')}"


def fold(text: str | None) -> str:
    """The comparison form of an address or name: width, variants, section numbers, no white space."""
    t = unicodedata.normalize("NFKC", text or "").translate(VARIANTS)
    return "".join(_SECTION.sub(lambda m: section_number(m[1]) + "段", t).split())


@F.pandas_udf(StringType())
def fold_variants(text: pd.Series) -> pd.Series:
    return text.map(fold)


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKC", t or ""))


@F.pandas_udf(StringType())
def name_norm(text: pd.Series) -> pd.Series:
    """Folded, with Chinese characters, letters and digits alone, in upper case."""
    return text.map(lambda t: re.sub("[^0-9A-Za-z一-鿿]", "", fold(t)).upper())


@F.pandas_udf(StringType())
def addr_norm(text: pd.Series) -> pd.Series:
    """Folded, without punctuation and brackets, in upper case."""
    return text.map(lambda t: re.sub(r"[\s,，、.。\-—()（）:：]", "", fold(t)).upper())


class Ratios:
    """Gestalt similarity of many keys with one query at a time, best first-come result."""

    def __init__(self, keys: list[str]):
        self.keys = keys

    def best(self, query: str, least: float) -> tuple[int, float] | None:
        """(place, ratio) of the most similar key, the first of equals; None below ``least``."""
        matcher, place, top = difflib.SequenceMatcher(), -1, max(0.0, math.nextafter(least, 0.0))
        matcher.set_seq2(query)
        for i, key in enumerate(self.keys):
            if not key:
                continue
            matcher.set_seq1(key)
            if matcher.real_quick_ratio() > top and matcher.quick_ratio() > top and (r := matcher.ratio()) > top:
                place, top = i, r
        return (place, top) if place >= 0 else None


def best_keys(queries: pd.Series, keys: list[str], least: float) -> pd.DataFrame:
    """place (-1: none), exact ratio and ratio to three places for each query."""
    table = Ratios(keys)
    hits = [table.best(q, least) or (-1, 0.0) for q in queries]
    return pd.DataFrame([(place, ratio, round(ratio, 3)) for place, ratio in hits], columns=["place", "exact", "ratio"])
