"""Reverse lookup of documents without a usable permit: by the agency block of the page after the contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestor.operators import registry as R


def rescue(items: DataFrame, blocks: DataFrame, registry: DataFrame, value: str = "candidate_value") -> DataFrame:
    """Items with ``value`` and reason replaced where the registry knows the agency.

    ``blocks``: (source_docx, phones array, agency_text_name, agency_text_address), one row a document.
    In order: a number that one agency has; a number whose prefix one agency has; the better of
    name and address by similarity, the name on a tie; else the agencies of the first number that
    several have are listed and the value stays.  ``rescued_by`` names the way, '' if none.
    """
    index = R.phone_index(registry)
    numbers = blocks.select("source_docx", F.posexplode("phones").alias("place", "phone"))
    exact = R.by_phone(numbers, index).groupBy("source_docx", "place", "phone").agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.struct("permit", "name"))).alias("hits"))
    exact = exact.groupBy("source_docx").agg(
        F.min_by(F.struct("phone", "hits"), F.when(F.col("n") == 1, F.col("place"))).alias("single"),
        F.min_by(F.struct("phone", "hits"), F.when(F.col("n") > 1, F.col("place"))).alias("several"),
    )
    prefix = R.unique_hits(R.by_phone_prefix(numbers, index), ["source_docx", "place", "phone"])
    prefix = prefix.groupBy("source_docx").agg(F.min_by(F.struct("phone", "permit", "name"), "place").alias("prefix"))
    by_name = R.best_by_text(blocks, registry, "agency_text_name", "name").select("agency_text_name", F.struct("permit", "name", "ratio").alias("by_name"))
    by_addr = R.best_by_text(blocks, registry, "agency_text_address", "address").select("agency_text_address", F.struct("permit", "name", "ratio").alias("by_addr"))
    known = blocks.join(exact, "source_docx", "left").join(prefix, "source_docx", "left").join(by_name, "agency_text_name", "left").join(by_addr, "agency_text_address", "left")
    name_wins = F.col("by_name").isNotNull() & (F.col("by_addr").isNull() | (F.col("by_name.ratio") >= F.col("by_addr.ratio")))
    text = F.when(name_wins, F.col("by_name")).otherwise(F.col("by_addr"))
    way = F.when(F.col("single").isNotNull(), "phone").when(F.col("prefix").isNotNull(), "phone_prefix").when(text.isNotNull(), F.when(name_wins, "name").otherwise("address")).when(F.col("several").isNotNull(), "phone_several").otherwise("")
    permit = F.coalesce(F.col("single.hits")[0]["permit"], "prefix.permit", text["permit"])
    listed = F.array_join(F.transform("several.hits", lambda h: F.concat_ws("/", h["permit"], h["name"])), ", ")
    note = F.when(way == "phone_several", F.concat(F.lit("[phone, choose by hand] "), F.col("several.phone"), F.lit(": "), listed)).when(way != "", F.concat(F.lit("["), way, F.lit("] "), permit))
    known = known.select("source_docx", way.alias("rescued_by"), permit.alias("__permit"), note.alias("__note"))
    out = items.join(known, "source_docx", "left")
    return out.withColumns({
        value: F.coalesce("__permit", F.col(value)),
        "reason": F.array_join(F.array_compact(F.array(F.nullif("reason", F.lit("")), "__note")), "; "),
        "rescued_by": F.coalesce("rescued_by", F.lit("")),
    }).drop("__permit", "__note")
