"""The batch from readings to sheet rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attestor.functions import scalars as S
from attestor.operators import assemble, extract, gazetteer, routing, verify, votes
from attestor.operators.rescue import rescue
from attestor.schema import EMPLOYER, conform
from attestor.session import cut, grows


def decide_documents(reads: DataFrame, images: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(scan results, queue) from readings (OCR_READ).

    Pages are those of ``images`` (source_docx, image_name), or else those that have readings; the
    class of a document follows all its pages.  Pages of the second tier count only where the first
    gives no sure permit vote.
    """
    # A document's pages come together once, and every step after works where they lie: counts, votes, tiers and routes.
    pages = votes.gathered(reads)
    if images is not None:
        pages = images.join(pages, ["source_docx", "image_name"], "left").repartition("source_docx")
    pages = routing.pages_in_place(pages).withColumn("scan_tier", F.when(F.col("docx_class") == "small", 1).otherwise(F.col("tier")))
    has_vote = F.max(votes.sure_permit_vote() & (F.col("scan_tier") == 1)).over(W.partitionBy("source_docx"))
    # Cut once: the votes, the tiers and the routes all start from it.
    scanned = cut(votes.scan_pages(pages).withColumn("has_vote", has_vote))
    kept = scanned.where("docx_class = 'small' or (any_hit and (scan_tier = 1 or not has_vote))").drop("any_hit", "has_vote")
    # The order within a document: tier, then the page's natural key, in which no two pages are equal.
    place = F.struct("scan_tier", S.natural_key(F.col("image_name")))
    large, small = kept.where("docx_class = 'large'"), kept.where("docx_class = 'small'")
    expanded = scanned.where("docx_class = 'large'").groupBy("source_docx").agg(F.max("scan_tier").alias("scan_tier"))
    large = routing.with_placeholders(votes.decide(large), expanded).withColumn("ord", place)
    small = votes.aggregate_small(small.withColumn("ord", place))
    results = cut(large.unionByName(small))  # routing reads it for its states and for its rows
    return results.drop("ord"), routing.route(results)


def employers(page_texts: DataFrame, contract_texts: DataFrame, gaz: DataFrame) -> DataFrame:
    """Employer rows: ``page_texts`` (source_docx, ord, image_name, text) score the pages, ``contract_texts`` are the second reader's."""
    pages = extract.contract_pages(page_texts)
    # Cut where several branches start from the same rows: pages and patterns are the costly steps.
    read = cut(pages.join(grows(contract_texts.select("source_docx", "image_name", F.col("text").alias("full_text"))), ["source_docx", "image_name"], "left"))
    known = cut(extract.employer_fields(read.where("found"), "full_text").drop("full_text"))
    known = gazetteer.standard_address(gazetteer.normalise(known.withColumn("__en", S.first_of(F.col("addr_en"), F.col("en_hint"))), gaz, "addr_cn", "__en"))
    known = cut(known.withColumn("doubt_name", extract.name_doubt(F.col("name_cn"), F.col("name_en"))))
    known = extract.rescue_names(known, contract_texts.join(grows(page_texts.select("source_docx", "image_name", "ord", F.col("text").alias("front"))), ["source_docx", "image_name"]).select("source_docx", "image_name", "ord", F.concat_ws("\n", "front", "text").alias("text")))
    known = known.withColumn("doubt_house", extract.house_doubt(F.col("addr_cn"), F.col("addr_en")))
    known = known.withColumns({"doubt": extract.compose_doubt(F.col("doubt_name"), F.col("doubt_addr"), F.col("doubt_house")), "image": F.col("image_name")})
    unknown = read.where(~F.col("found")).select("source_docx", F.col("image_name").alias("image"), F.lit("no contract page").alias("note"))
    return conform(known, EMPLOYER).unionByName(conform(unknown, EMPLOYER))


def run(reads: DataFrame, second_reads: DataFrame, blocks: DataFrame, registry: DataFrame, employer_rows: DataFrame, log: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """Sheet rows of all documents.

    ``second_reads``: (source_docx, image_name, text) of the second reader on queued regions; an item
    without one is reported for review, never dropped.  ``blocks`` as ``rescue`` takes them.
    """
    _, queue = decide_documents(reads, images)
    queue = cut(queue)
    keyed = queue.where(F.col("route") == routing.DIRECT).select("source_docx", F.col("candidate_value").alias("permit"), "reason")
    second = second_reads.select("source_docx", "image_name", S.second_reader_value(F.col("text")).alias("second_value"))
    asked = queue.where(F.col("route") == routing.SECOND_READER).join(second, ["source_docx", "image_name"], "left")
    checked = cut(verify.verify(asked, verify.known_permits(log)))
    keyed = keyed.unionByName(checked.where("should_keyin").select("source_docx", F.col("final_value").alias("permit"), F.col("rationale").alias("reason")))
    review = checked.where(~F.col("should_keyin")).select("source_docx", F.col("final_value").alias("permit"), F.concat_ws("; ", "reason", "rationale").alias("reason"))
    saved = rescue(queue.where(F.col("route").isin(routing.RESCUE, routing.MANUAL)), blocks, registry)
    review = review.unionByName(saved.select("source_docx", F.col("candidate_value").alias("permit"), "reason"))
    return assemble.sheet_rows(keyed, review, registry, employer_rows)
