"""Tiering of pages, placeholder rows, and routing of documents by ordered rules.

Routing keeps one state a document, whose parts merge before and after the shuffle: no rows are gathered, and
a document may have any number of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attestor.functions import scalars as S
from attestor.operators.votes import has_permit_vote
from attestor.schema import LARGE_NO_HIT, PERMIT_PARTIAL, QUEUE, SCAN_RESULT, SMALL_NO_HIT, conform
from attestor.session import cut

DIRECT, SECOND_READER, RESCUE, MANUAL = "direct", "second_reader", "rescue", "manual_review"


def pages(images: DataFrame) -> DataFrame:
    """Page rows from (source_docx, image_name): index, order, class by the unfiltered count, and tier.

    The count is a plain aggregate joined back, so one very long document is not sorted in a window;
    the order is carried as a sortable key.
    """
    counted = images.groupBy("source_docx").agg(F.count("*").cast("int").alias("n_images"))
    return _classed(images.join(counted, "source_docx"))


def pages_in_place(images: DataFrame) -> DataFrame:
    """As ``pages``, of images that lie together by document: nothing is shuffled, and a long document's rows spill."""
    return _classed(images.withColumn("n_images", F.count("*").over(W.partitionBy("source_docx")).cast("int")))


def _classed(images: DataFrame) -> DataFrame:
    index = S.image_index(F.col("image_name"))
    out = images.withColumns({"image_index": index, "has_number": F.col("image_name").rlike(r"\d"), "sort_key": S.natural_key(F.col("image_name"))})
    return out.withColumns({"docx_class": S.docx_class(F.col("n_images")), "tier": S.tier(index)})


def ordered(images: DataFrame) -> DataFrame:
    """Pages with their place in natural order within the document, counted from 0."""
    lists = images.groupBy("source_docx").agg(F.array_sort(F.collect_list(F.struct(S.natural_key(F.col("image_name")).alias("k"), "image_name"))).alias("l"))
    return lists.select("source_docx", F.posexplode("l").alias("ord", "p")).select("source_docx", "ord", F.col("p.image_name").alias("image_name"))


def second_tier(page_rows: DataFrame, first_results: DataFrame) -> DataFrame:
    """Pages of the second tier whose document got no sure permit vote from the first."""
    done = has_permit_vote(first_results).where("has_vote").select("source_docx")
    return page_rows.where("docx_class = 'large' and tier = 2").join(done, "source_docx", "left_anti")


def with_placeholders(results: DataFrame, documents: DataFrame) -> DataFrame:
    """Results and one no-hit row for each large document without any (source_docx, scan_tier)."""
    missing = documents.join(results.select("source_docx").distinct(), "source_docx", "left_anti")
    rows = missing.select("source_docx", F.lit("large").alias("docx_class"), "scan_tier", F.lit(LARGE_NO_HIT).alias("status"), F.lit(True).alias("vision_review"), F.lit("no hit in a large document").alias("note"))
    return results.unionByName(conform(rows, SCAN_RESULT))


# --- routing ---------------------------------------------------------------------------------

# How a document ends: without a hit, by one item that the state of all its rows gives, or by an item a row.
_NO_HIT, _ONE, _ROWS, _NOTHING = "no_hit", "one", "rows", "nothing"


def _item(value: Column, conf: Column, reason: Column, direct: Column | None = None, rescue: Column | None = None, of: str = "") -> Column:
    """An item of the row at hand, or of the page that a state holds (``of``: its name and a dot)."""
    no = F.lit(False)
    return F.struct(
        F.col(f"{of}image_name").alias("image_name"), F.col(f"{of}img_path").alias("img_path"), value.alias("candidate_value"), conf.alias("candidate_conf"), reason.alias("reason"),
        (no if direct is None else direct).alias("direct_keyin"), (no if rescue is None else rescue).alias("no_vote_rescue"),
    )


def _why() -> Column:
    """The row's note, or what its state says."""
    r = F.col
    conf = F.format_string("%.1f", F.when(r("final_conf") > 0, r("final_conf")).otherwise(F.greatest("mol_conf", "id_conf")))
    small = F.when(r("mol_from_vote"), "small: licence vote below the key-in mark").otherwise(F.concat(F.lit("small: single licence reading, conf="), conf))
    large = F.when(r("cross_match"), "large: agreement, low confidence").when((r("mol") != "") & (r("id") != ""), "large: both values, low confidence").when(r("mol") != "", "large: licence alone, low confidence").when(r("id") != "", "large: permit alone, low confidence").otherwise("to be confirmed")
    return F.when(r("note") != "", r("note")).when(r("docx_class") == "small", small).otherwise(F.concat(large, F.lit(", conf="), conf))


def _first(item: Column, where: Column, *order: Column) -> Column:
    """An aggregate: the item of the first of the rows that count."""
    return F.min_by(item, F.when(where, F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)))))


def _agreements(rows: DataFrame) -> DataFrame:
    """(source_docx, agree): of the values that a document has both as licence and as permit the surest reading.

    Readings are brought together by value first, so nothing of a document is gathered.
    """
    read = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("mol").alias("value"), F.col("mol_conf").alias("conf")),
        F.struct(F.lit(1).alias("kind"), F.col("id").alias("value"), F.col("id_conf").alias("conf")),
    )
    each = rows.where("mol <> '' or id <> ''").select("source_docx", "ord", "image_name", "img_path", F.explode(read).alias("r")).select("*", "r.*").where("value <> ''")
    best = F.struct((-F.col("conf")).alias("less"), "kind", "ord", "image_name", "img_path", "value", "conf")
    by_value = each.groupBy("source_docx", "value").agg(F.min("kind").alias("low"), F.max("kind").alias("high"), F.min(best).alias("best"))
    one = by_value.where("low < high").groupBy("source_docx").agg(F.min("best").alias("b"))
    conf = F.col("b.conf")
    return one.select("source_docx", _item(F.col("b.value"), conf, F.concat(F.lit("agreement in document, conf="), conf.cast("string")), conf > S.KEY_IN, of="b.").alias("agree"))


def _decisions(rows: DataFrame) -> DataFrame:
    """One row a document: how it ends, its item if that is one, and the number of its rows.

    Every rule is a state that merges (a flag, or the first row in some order), so partial results are
    combined before and after one shuffle, whatever a document's size.
    """
    r = F.col
    valued, review, partial = r("final_value") != "", r("vision_review"), r("status") == PERMIT_PARTIAL
    vote = (r("id") != "") & r("id_from_vote") & (r("id_conf") > S.PERMIT_VOTE_MIN)
    page = F.struct("image_name", "img_path", "id", "id_conf", "final_value", "final_conf")
    # Once a row, as several states order by it; only permits do.
    used = rows.select("*", page.alias("page"), F.when(r("id") != "", S.natural_key(r("image_name"))).alias("early"))
    states = used.groupBy("source_docx").agg(
        F.count("*").alias("n"), F.min_by("docx_class", "ord").alias("class"),
        F.bool_and(r("status") == F.when(r("docx_class") == "large", LARGE_NO_HIT).otherwise(SMALL_NO_HIT)).alias("no_hit"),
        F.bool_or(r("mol") != "").alias("has_mol"), F.bool_or(r("id") != "").alias("has_id"), F.bool_or(partial | review).alias("open_large"), F.bool_or(_sure_licence() | review).alias("open_small"),
        _first(r("page"), r("id") != "", r("early"), r("ord")).alias("clash"), _first(r("page"), vote, r("early"), r("ord")).alias("voted"),
        _first(r("page"), valued, -r("final_conf"), r("ord")).alias("sure"), _first(r("page"), valued, r("ord")).alias("rest"),
    )
    made = {
        "clash": ("id", F.concat(F.lit("licence and permit differ, earliest permit of "), "clash.image_name"), False),
        "voted": ("id", F.concat(F.lit("sure permit vote, earliest of "), "voted.image_name"), True),
        "sure": ("final", F.concat(F.lit("high confidence, conf="), r("sure.final_conf").cast("string")), True),
        "rest": ("final", F.lit("value without a deciding flag"), False),
    }
    states = states.withColumns({state: F.when(r(state).isNotNull(), _item(r(f"{state}.{'id' if of == 'id' else 'final_value'}"), r(f"{state}.{of}_conf"), why, F.lit(direct), of=f"{state}.")) for state, (of, why, direct) in made.items()})
    known = states.join(_agreements(rows), "source_docx", "left")
    blank = F.struct(
        F.lit("").alias("image_name"), F.lit("").alias("img_path"), F.lit("").alias("candidate_value"), F.lit(0.0).alias("candidate_conf"),
        F.concat(F.lit("no hit in all "), r("n").cast("string"), F.lit(" images")).alias("reason"), F.lit(False).alias("direct_keyin"), F.lit(False).alias("no_vote_rescue"),
    )
    both, large = r("has_mol") & r("has_id"), r("class") == "large"
    one = F.when(large, F.when(both, F.coalesce("agree", "clash")).when(~r("has_mol") & r("voted").isNotNull(), r("voted")).when(~r("open_large"), r("sure"))).when(~r("open_small"), r("rest"))
    many = F.when(large, r("open_large")).otherwise(r("open_small"))
    end = F.when(r("no_hit"), _NO_HIT).when(one.isNotNull(), _ONE).when(many, _ROWS).otherwise(_NOTHING)
    return known.select("source_docx", "class", end.alias("end"), F.when(r("no_hit"), blank).otherwise(one).alias("item"))


def _sure_licence() -> Column:
    return F.col("mol_from_vote") & (F.col("mol_conf") > S.MOL_VOTE_MIN) & (F.col("final_value") != "")


def _row_items(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """(source_docx, end, item) of every row that gives an item, of documents whose rows decide for themselves.

    The join is by document alone, as the rows may lie together by it.
    """
    r = F.col
    partial, review = r("status") == PERMIT_PARTIAL, r("vision_review")
    conf = F.when(r("id_conf") > 0, r("id_conf")).otherwise(r("final_conf"))
    part = _item(S.first_of(r("id"), r("final_value")), conf, F.lit("permit read in part, no majority"), rescue=conf < S.RESCUE_BELOW)
    large = F.when(partial, part).when(review, _item(r("final_value"), r("final_conf"), _why()))
    direct = _item(r("final_value"), r("mol_conf"), F.concat(F.lit("sure licence vote, conf="), r("mol_conf").cast("string")), F.lit(True))
    small = F.when(_sure_licence(), direct).when(review, _item(r("final_value"), r("final_conf"), _why(), rescue=~r("mol_from_vote") & (r("final_conf") < S.RESCUE_BELOW)))
    handled = F.max(partial).over(W.partitionBy("source_docx", "image_name"))
    # Shuffled once, for the pages and for the join.
    found = rows.where(partial | review | _sure_licence()).repartition("source_docx").withColumn("handled", handled)
    again = ~partial & r("handled")  # a page that is in review by its partial reading
    item = F.when(r("class") == "large", F.when(~again, large)).otherwise(small)
    return found.join(ends, "source_docx").select("source_docx", "end", item.alias("item")).where("item is not null")


def route(results: DataFrame, order: str = "ord") -> DataFrame:
    """Queue items of all documents with their route; documents without any hit go to manual review.

    ``order`` keeps the rows' own order within a document.  ``results`` is read several times: cut it where it is costly.
    """
    # Of a page's crops a state or an item holds the one that it names.
    rows = results.withColumns({"ord": F.col(order), "img_path": S.first_of(F.col("permit_crop"), F.col("mol_crop"))})
    # Cut: the documents that end by one item and those whose rows decide both start from the states.
    ends = cut(_decisions(rows).withColumn("class", F.when(F.col("class") == "large", "large").otherwise("small")))
    one = ends.where(F.col("end").isin(_NO_HIT, _ONE)).select("source_docx", "end", "item")
    items = one.unionByName(_row_items(rows, ends.where(F.col("end") == _ROWS).select("source_docx", "class", "end")))
    way = F.when(F.col("end") == _NO_HIT, MANUAL).when(F.col("item.direct_keyin"), DIRECT).when(F.col("item.no_vote_rescue"), RESCUE).otherwise(SECOND_READER)
    return conform(items.select("source_docx", "item.*", way.alias("route")), QUEUE)
