"""Language identification by compression with per-language zstandard dictionaries.

For every language a raw-content dictionary is made of excerpts of its training documents.  A text
(lower case, without ASCII digits and marks) is cut into blocks, each block is compressed with every language's dictionary, and the language
with the fewest bytes in all wins.  The whole text counts.  A margin below ``min_margin`` is
flagged as rejected: the prediction stays, and a user may drop it.

Nulls and texts without a letter give ``und`` with score 0; without any training row all texts do.
Ties go to the alphabetically smallest language.  Rows with a null id are scored, never learned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.llm.common import map_arrow, with_text

#: Bounds of the training sample: excerpts for each language, and characters of each.
EXCERPTS, EXCERPT_CHARS = 100, 1000
#: Bytes of text in a block, the compressor's level, bytes of difference worth a factor e in the score.
BLOCK, LEVEL, TEMPERATURE = 4096, 9, 6.0
MIN_MARGIN = 0.01

_BLANKS = b"\t\n\v\f\r"
_TO_BLANK = bytes(0x20 if b in _BLANKS else b for b in range(256))
_DROPPED = bytes(b for b in range(128) if not (chr(b).isalpha() or b == 0x20 or b in _BLANKS))


def plain(text: str) -> bytes:
    """What is compressed: lower case, white space as blanks, ASCII digits and marks left out."""
    return text.lower().encode().translate(_TO_BLANK, _DROPPED)


def learn(train: DataFrame, text: str = "text", lang: str = "lang", excerpts: int = EXCERPTS, chars: int = EXCERPT_CHARS) -> dict[str, bytes]:
    """A dictionary of at most ``excerpts * chars`` characters for each language.

    Texts are dealt to ``excerpts`` buckets by hash; in each bucket the text with the smallest
    hash gives an excerpt at a place chosen by the hash.  Equal texts share a bucket, so copies
    take one place only.  What reaches the driver is bounded by languages times that size.
    """
    h = F.xxhash64(F.col(text))
    room = F.greatest(F.length(text) - F.lit(chars), F.lit(0))
    start = F.pmod(F.shiftrightunsigned(h, 20), room + 1).cast("int") + 1
    rows = (
        train.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
        .select(F.col(lang).alias("lang"), F.pmod(h, F.lit(excerpts)).alias("bucket"), h.alias("h"), F.substr(F.col(text), start, F.lit(chars)).alias("excerpt"))
        .groupBy("lang", "bucket")
        .agg(F.min_by("excerpt", "h").alias("excerpt"))
        .collect()
    )
    found: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        found.setdefault(r["lang"], []).append((r["bucket"], r["excerpt"]))
    return {k: b" ".join(plain(x) for _, x in sorted(v)) for k, v in sorted(found.items())}


def predict(df: DataFrame, dictionaries: dict[str, bytes], text: str = "text", keep: tuple[str | Column, ...] = ("doc_id",), min_margin: float = MIN_MARGIN, level: int = LEVEL) -> DataFrame:
    """``keep`` columns with ``lang_pred``, ``score`` (0 to 1), ``margin`` and ``rejected``."""
    state: dict = {}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as z

        if "coders" not in state:
            coders = []
            for name, data in dictionaries.items():
                d = z.ZstdCompressionDict(data, dict_type=z.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=level)
                coders.append((name, z.ZstdCompressor(level=level, dict_data=d, write_content_size=False)))
            state["coders"], state["letter"] = coders, regex.compile(r"\p{L}")
        coders, letter = state["coders"], state["letter"]
        for batch in batches:
            out: list[tuple[str, float, float]] = []
            for value in batch.column(0).to_pylist():
                if not value or not coders or not letter.search(value):
                    out.append(("und", 0.0, 0.0))
                    continue
                data = plain(value)
                blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
                sizes = [sum(len(c.compress(b)) for b in blocks) for _, c in coders]
                best = min(range(len(sizes)), key=sizes.__getitem__)
                rest = [s for i, s in enumerate(sizes) if i != best]
                margin = (min(rest) - sizes[best]) / max(sizes[best], 1) if rest else 1.0
                out.append((coders[best][0], 1 / (1 + sum(math.exp((sizes[best] - s) / TEMPERATURE) for s in rest)), margin))
            lang, score, margin = (list(x) for x in zip(*out, strict=True)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64())], [*names, "lang_pred", "score", "margin"])

    inner = with_text(df, text, keep, "lang_pred", "score", "margin", "rejected")
    names = inner.columns[1:]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields[1:])
    out = map_arrow(inner, work, f"{schema}, lang_pred string, score double, margin double")
    return out.withColumn("rejected", F.col("margin") < min_margin)
