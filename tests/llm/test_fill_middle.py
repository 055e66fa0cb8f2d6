"""Rank and select by counting, cuts by a list of lines, and the exact text from every output."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from attestor.llm import fill_middle


def plain(doc_id, text, percent=100, spm=50):
    """n, form, lengths and output by the definition."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("size", [0, 1, 63, 64, 511, 512, 513, 5000])
@pytest.mark.parametrize("share", [0.0, 0.01, 0.5, 1.0])
def test_rank_and_select(size, share):
    flags = np.random.default_rng(size).random(size) < share
    v = fill_middle.BitVector(flags)
    assert len(v) == flags.sum()
    assert v.rank(np.arange(size + 1)).tolist() == [int(flags[:i].sum()) for i in range(size + 1)]
    assert v.select(np.arange(len(v))).tolist() == np.flatnonzero(flags).tolist()


TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "one\ntwo\nthree", "ends\n", "é\nü写\n\U0001f600 x\n", "has <P> in it\nand more", "a<\nP>\n<S\n>", "\r\n\r\nx\r", "<P", "\n<S", "<\n<\nM>\n", "word " * 300_000,
    "".join(f"line {i}\n" for i in range(60_000)), "y\n" * 9,
]


def test_cuts_and_restoration(spark):
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no\nid\nhere"), (3, "twice\na"), (3, "twice\na"), (-9, "minus\nnine")]
    rows += [(100 + i, "".join(rng.choice("ab<PSM>é\n\n") for _ in range(rng.randrange(60)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as form", "1 as n", "'y' as `a.b`")
    for percent, spm in ((100, 50), (60, 100), (60, 0)):
        out = fill_middle.transform(docs, percent=percent, spm_percent=spm, keep=("doc_id", "text", "form", F.col("`a.b`")))
        assert out.columns == ["doc_id", "text", "a.b", "n", "form", "prefix_chars", "middle_chars", "output"]
        got = out.withColumn("back", fill_middle.restored()).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain(r["doc_id"], r["text"], percent, spm)
            assert r["back"] == (r["text"] or "")


def test_empty_table(spark):
    assert fill_middle.transform(spark.createDataFrame([], "doc_id long, text string")).collect() == []
