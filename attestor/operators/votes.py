"""Votes and arg-max decisions, and the scan of one image from its readings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.functions import scalars as S
from attestor.schema import OK, PERMIT_PARTIAL, SCAN_RESULT, SMALL_NO_HIT, conform


def majority_vote(df: DataFrame, keys: Sequence[str], value: str, order: str, least: int = S.VOTE_MIN, total: str | None = None) -> DataFrame:
    """The most frequent value of each key with its count, and the sum of ``total`` over its rows; ties go to the value seen first.

    Two partial aggregations; no value's rows are gathered.  Keys without a value of ``least``
    occurrences give no row.  Null and '' don't vote.
    """
    counted = df.where(F.col(value).isNotNull() & (F.col(value).cast("string") != "")).groupBy(*keys, value).agg(F.count("*").alias("votes"), F.min(order).alias("first_seen"), *([F.sum(total).alias("total")] if total else []))
    kept = [value, "votes", *(["total"] if total else [])]
    best = counted.groupBy(*keys).agg(F.max_by(F.struct(*kept), F.struct("votes", -F.col("first_seen"))).alias("b"))
    return best.select(*keys, *(F.col(f"b.{c}").alias(c) for c in kept)).where(F.col("votes") >= least)


def first_by(df: DataFrame, keys: Sequence[str], value: Sequence[str], order: Column) -> DataFrame:
    """Columns of the first row of each key in an order that has no ties."""
    one = df.groupBy(*keys).agg(F.min_by(F.struct(*value), order).alias("b"))
    return one.select(*keys, *(F.col(f"b.{v}").alias(v) for v in value))


def last_by(df: DataFrame, keys: Sequence[str], value: Sequence[str], rank: str, order: str) -> DataFrame:
    """Columns of the row with the highest rank; ties go to the smallest ``order``."""
    one = df.groupBy(*keys).agg(F.max_by(F.struct(*value), F.struct(F.col(rank), -F.col(order))).alias("b"))
    return one.select(*keys, *(F.col(f"b.{v}").alias(v) for v in value))


# --- one image -------------------------------------------------------------------------------
# The readings of an image are at most some fifty, so they are gathered into one array and
# decided there: one shuffle for everything.


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def _vote(entries: Column) -> Column:
    """Of ordered (value, conf) entries: the winner with its confidences' mean, or null."""

    def counted(values: Column) -> Column:
        tally = F.transform(values, lambda v, i: F.struct(F.size(F.filter(entries, lambda e: e["value"] == v)).alias("n"), (-i).alias("back"), v.alias("value")))
        return _let(F.array_max(tally), lambda top: F.when(top["n"] >= S.VOTE_MIN, F.struct(top["value"].alias("value"), _mean(F.filter(entries, lambda e: e["value"] == top["value"])).alias("conf"))))

    return _let(F.array_distinct(F.transform(entries, lambda e: e["value"])), counted)


def _mean(entries: Column) -> Column:
    return F.aggregate(entries, F.lit(0.0), lambda a, e: a + e["conf"]) / F.size(entries)


def _with_hits(reads: DataFrame) -> DataFrame:
    is_mol = F.col("roi") == "mol"
    hit = F.when(is_mol, S.licence_of(F.col("text"))).otherwise(S.permit_of(F.col("text"), F.col("roi")))
    phase = F.when(F.col("phase") == "vote", 0).when(F.col("phase") == "scan", 1).otherwise(2)
    roi = F.array_position(F.array(*map(F.lit, S.ROIS)), F.col("roi"))
    return reads.withColumn("hit", hit).withColumn("place", phase * 100_000 + roi * 1000 + F.col("config_ord"))


def read_values(reads: DataFrame) -> DataFrame:
    """Readings with the value and layer of their region's own cascade, and their place in the order."""
    return _with_hits(reads).where("hit.value <> ''")


def _entry() -> Column:
    return F.struct("place", F.col("hit.value").alias("value"), F.col("hit.layer").alias("layer"), F.col("conf").cast("double").alias("conf"), "config", "roi", (F.col("phase") == "vote").alias("vote"))


def gathered(reads: DataFrame) -> DataFrame:
    """(source_docx, image_name, e): every page that has readings with its hits in order, a document's pages in one partition."""
    rows = _with_hits(reads).select("source_docx", "image_name", F.when(F.col("hit.value") != "", _entry()).alias("entry"))
    return rows.repartition("source_docx").groupBy("source_docx", "image_name").agg(F.array_sort(F.collect_list("entry")).alias("e"))


def scan_images(reads: DataFrame, classes: DataFrame) -> DataFrame:
    """A scan result for each image of ``classes`` (source_docx, image_name, docx_class, scan_tier).

    Small documents are read at the licence region alone and every image gives a row; large ones at
    all regions, and an image without a hit gives none.  ``crop`` names stand for the saved regions.
    """
    found = read_values(reads).groupBy("source_docx", "image_name").agg(F.array_sort(F.collect_list(_entry())).alias("e"))
    pages = scan_pages(classes.join(found, ["source_docx", "image_name"], "left"))
    return conform(pages.where("docx_class = 'small' or any_hit"), SCAN_RESULT)


def scan_pages(pages: DataFrame) -> DataFrame:
    """A scan result for each page with the hits ``e`` of its readings (null: none), and ``any_hit``."""
    base = pages.withColumn("e", F.coalesce("e", F.filter(F.array(F.lit(None).cast(pages.schema["e"].dataType.elementType)), lambda x: x.isNotNull())))

    def part(cond: Callable[[Column], Column]) -> Column:
        return F.filter("e", cond)

    first = base.select(
        "source_docx", "image_name", "docx_class", "scan_tier",
        _vote(part(lambda x: x["vote"] & (x["roi"] == "mol"))).alias("mv"),
        part(lambda x: ~x["vote"] & (x["roi"] == "mol")).alias("mh"),
        part(lambda x: ~x["vote"] & (x["roi"] == "permit_upper")).alias("up"),
        part(lambda x: ~x["vote"] & (x["roi"] == "permit_lower")).alias("lo"),
        part(lambda x: x["vote"] & (x["roi"] != "mol")).alias("pv"),
    )
    first = first.withColumns({"mh": F.get("mh", F.lit(0)), "ph": F.when(F.col("docx_class") == "large", F.coalesce(F.get("up", F.lit(0)), F.get("lo", F.lit(0))))})
    mol, mol_vote = F.coalesce("mv.value", "mh.value", F.lit("")), F.col("mv").isNotNull()
    hit = F.col("mv").isNotNull() | F.col("mh").isNotNull() | F.col("ph").isNotNull()
    first = first.withColumns({"mol": mol, "mol_from_vote": mol_vote, "any_hit": hit, "id0": F.coalesce("ph.value", F.lit(""))})
    # Permit votes of both regions are pooled where a field is missing.
    pooled = (F.col("docx_class") == "large") & ((F.col("mol") == "") | (F.col("id0") == ""))
    second = first.withColumn("vote", F.when(pooled, _vote(F.col("pv"))))
    best = F.array_max(F.transform("pv", lambda x: F.struct(x["conf"].alias("conf"), (-x["place"]).alias("back"), x["value"].alias("value"))))
    second = second.withColumn("partial", F.when(pooled & F.col("vote").isNull() & (F.size("pv") > 0), best))
    winner = F.when(pooled, F.coalesce("vote.value", F.lit(""))).otherwise(F.col("id0"))
    take = (F.col("docx_class") == "large") & (F.col("mol") == "") & (winner != "")
    id_, conf = F.coalesce("partial.value", "id0"), F.coalesce("partial.conf", "ph.conf", F.lit(0.0))
    out = second.select(
        "source_docx", "image_name", "docx_class", "scan_tier", "any_hit", "mol", "mol_from_vote",
        F.when(mol_vote, 0).otherwise(F.coalesce("mh.layer", F.lit(0))).alias("mol_layer"),
        F.when(mol_vote, S.round1(F.col("mv.conf"))).otherwise(F.coalesce("mh.conf", F.lit(0.0))).alias("mol_conf"),
        F.when(take, winner).otherwise(id_).alias("id"),
        F.when(take, 0).otherwise(F.coalesce("ph.layer", F.lit(0))).alias("id_layer"),
        F.when(take, F.when(pooled, S.round1(F.col("vote.conf"))).otherwise(0.0)).otherwise(conf).alias("id_conf"),
        take.alias("id_from_vote"),
        ((F.col("docx_class") == "large") & (F.col("mol") != "") & (winner == F.col("mol"))).alias("cross_match"),
        F.when(F.col("partial").isNotNull(), PERMIT_PARTIAL).otherwise(OK).alias("status"),
        F.when(~mol_vote & F.col("mh").isNotNull(), F.col("mh.config")).when(F.col("ph").isNotNull(), F.col("ph.config")).otherwise("").alias("hit_config"),
        F.when(mol_vote | F.col("mh").isNotNull(), "mol").when(F.col("ph").isNotNull(), F.col("ph.roi")).otherwise("").alias("hit_roi"),
        F.when((F.col("docx_class") == "small") & (F.col("mol") == ""), "no licence number").otherwise("").alias("manual_review"),
        F.when(mol_vote | F.col("mh").isNotNull(), F.concat_ws("_", "source_docx", "image_name", F.lit("mol"))).otherwise("").alias("mol_crop"),
        F.when(F.col("ph").isNotNull(), F.concat_ws("_", "source_docx", "image_name", F.lit("permit"))).otherwise("").alias("permit_crop"),
    )
    return conform(out, SCAN_RESULT + ", any_hit boolean")


# --- decisions on scan results ---------------------------------------------------------------


def decide(results: DataFrame) -> DataFrame:
    """final_value, final_conf, vision_review and note of every row (large documents)."""
    mol, id_ = F.col("mol") != "", F.col("id") != ""
    mc, ic = F.col("mol_conf"), F.col("id_conf")
    both, higher = mol & id_, mc >= ic
    value = F.when(both, F.when(higher, F.col("mol")).otherwise(F.col("id"))).when(mol, F.col("mol")).when(id_, F.col("id")).otherwise("")
    conf = F.when(both, F.greatest(mc, ic)).when(mol, mc).when(id_, ic).otherwise(0.0)
    clash = both & (mc > ic) & (F.col("mol") != F.col("id"))
    weak_mol = mol & ~id_ & (F.col("docx_class") == "large") & (mc <= F.when(F.col("mol_from_vote"), S.MOL_VOTE_MIN).otherwise(S.KEY_IN))
    weak_id = id_ & ~mol & (ic <= F.when(F.col("id_from_vote"), S.PERMIT_VOTE_MIN).otherwise(S.KEY_IN))
    weak_cross, partial = F.col("cross_match") & (conf <= S.KEY_IN), F.col("status") == PERMIT_PARTIAL
    note = F.when(clash, "licence and permit differ, licence surer").when(both & (mc == ic), "licence equals permit").when(both & higher, "licence surer").when(both, "permit surer")
    note = note.when(weak_mol, F.when(F.col("mol_from_vote"), "licence vote, low confidence").otherwise("licence alone, low confidence"))
    note = note.when(weak_id, F.when(F.col("id_from_vote"), "permit vote, low confidence").otherwise("permit alone, low confidence")).otherwise(F.col("note"))
    parts = F.array(note, F.when(weak_cross, "agreement with low confidence"), F.when(partial, "permit read in part, no majority"))
    review = (both & (conf <= S.KEY_IN)) | clash | weak_mol | weak_id | weak_cross | partial
    return results.withColumns({"final_value": value, "final_conf": S.round1(conf), "vision_review": review, "note": F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), " ")})


def aggregate_small(results: DataFrame, order: str = "ord") -> DataFrame:
    """Small documents: the surest hit's value goes to all hits; rows without a hit go, unless all are.

    ``order`` has no ties within a document; it may be a number or a struct.
    """
    hit = (F.col("mol") != "") | (F.col("id") != "")
    best = F.greatest("mol_conf", "id_conf")
    top = results.where(hit).groupBy("source_docx").agg(F.min_by(F.struct(F.col(order).alias("place"), S.first_of(F.col("mol"), F.col("id")).alias("value"), best.alias("conf"), (F.col("mol_from_vote") & (F.col("mol_conf") > S.MOL_VOTE_MIN)).alias("sure")), F.struct(-best, F.col(order))).alias("w"))
    joined = results.join(top, "source_docx", "left").where(hit | F.col("w").isNull())
    none, wins = F.col("w").isNull(), F.col("w.place") == F.col(order)
    return joined.withColumns({
        "final_value": F.when(none, F.col("final_value")).otherwise(F.col("w.value")),
        "final_conf": F.when(none, F.col("final_conf")).otherwise(S.round1(F.col("w.conf"))),
        "vision_review": F.when(none, True).otherwise(F.coalesce(wins & ~F.col("w.sure"), F.lit(False)) | F.col("vision_review")),
        "mol_from_vote": F.when(none | wins, F.col("mol_from_vote")).otherwise(False),
        "note": F.when(none, "no hit in a small document").otherwise(F.col("note")),
        "status": F.when(none, SMALL_NO_HIT).otherwise(F.col("status")),
    }).drop("w")


def has_permit_vote(results: DataFrame) -> DataFrame:
    """Documents with a permit vote sure enough to stop the scan."""
    return results.groupBy("source_docx").agg(F.bool_or(sure_permit_vote()).alias("has_vote"))


def sure_permit_vote() -> Column:
    return F.col("id_from_vote") & (F.col("id") != "") & (F.col("id_conf") > S.PERMIT_VOTE_MIN)
