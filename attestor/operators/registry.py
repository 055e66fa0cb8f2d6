"""Lookups in the registry of agencies: by permit, telephone, telephone prefix, and similarity."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.functions import scalars as S
from attestor.functions.kernels import addr_norm, best_keys, name_norm
from attestor.operators import similarity
from attestor.schema import ROSTER, conform

NAME_MIN, ADDRESS_MIN, SHORTEST = 0.78, 0.72, 4
#: Keys and queries that one task of the similarity join holds, about.
BLOCK_KEYS, BLOCK_QUERIES = 20_000, 250


def roster(raw: DataFrame) -> DataFrame:
    """Typed registry rows from (pos, permit, name, address, phone, revoked_on, closed_on); unusable permits keep a null base."""
    text = raw.select("pos", *(S.strip(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in ("permit", "name", "address", "phone", "revoked_on", "closed_on")))
    parsed = S.parse_permit(F.col("permit"))
    out = text.withColumns({"base": parsed["base"], "suffix": F.coalesce(parsed["suffix"], F.lit("")), "active": S.active(F.col("revoked_on"), F.col("closed_on"))})
    return conform(out.withColumn("base", F.coalesce("base", F.lit(-1))), ROSTER)


def best_records(df: DataFrame, keys: list[str], is_active: Column, order: str) -> DataFrame:
    """One row for each key: an active one first, then the first in order."""
    columns = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct((~is_active).alias("a"), F.col(order).alias("o"))).alias("b"))
    return one.select(*keys, "b.*")


def lookup(items: DataFrame, registry: DataFrame, value: str = "permit_value") -> DataFrame:
    """Items with agency_name, agency_address and agency_phone ('' on a miss); a branch never falls back to its parent.

    Numbers are compared as digits, so those beyond an int's range count too.
    """
    index = best_records(registry.withColumn("__b", S.permit_number(F.col("permit"))).where("__b is not null"), ["__b", "suffix"], F.col("active"), "pos")
    index = index.select("__b", F.col("suffix").alias("__s"), F.col("name").alias("agency_name"), F.col("address").alias("agency_address"), F.col("phone").alias("agency_phone"))
    parsed = S.parse_permit(F.col(value))
    out = items.withColumns({"__base": S.permit_number(F.col(value)), "__suffix": parsed["suffix"]})
    out = out.join(index, (F.col("__base") == F.col("__b")) & (F.col("__suffix") == F.col("__s")), "left").drop("__b", "__s", "__base", "__suffix")
    return out.withColumns({c: F.coalesce(c, F.lit("")) for c in ("agency_name", "agency_address", "agency_phone")})


def phone_index(registry: DataFrame) -> DataFrame:
    """(phone_norm, p8, permit, name) of active agencies; a record may have several numbers."""
    rows = registry.where("active").select(F.explode(S.split_phone_field(F.col("phone"))).alias("phone_norm"), "permit", "name", "pos")
    return rows.withColumn("p8", F.substr("phone_norm", F.lit(1), F.lit(S.PHONE_MIN)))


def by_phone(queries: DataFrame, index: DataFrame, phone: str = "phone") -> DataFrame:
    """(query columns, permit, name) of every agency with exactly this number, one row a permit."""
    q = queries.withColumn("phone_norm", S.phone_norm(F.col(phone)))
    return q.join(index.groupBy("phone_norm", "permit").agg(F.max_by("name", "pos").alias("name")), "phone_norm").drop("phone_norm")


def by_phone_prefix(queries: DataFrame, index: DataFrame, phone: str = "phone") -> DataFrame:
    """As ``by_phone``, where one number begins with the other and both have 8 digits or more.

    Numbers that agree so share their first 8 digits: an equi-join on those with the rest as a
    residual, in place of a nested loop.
    """
    q = queries.withColumn("__q", S.phone_norm(F.col(phone))).where(F.length("__q") >= S.PHONE_MIN).withColumn("p8", F.substr("__q", F.lit(1), F.lit(S.PHONE_MIN)))
    hit = F.col("__q").startswith(F.col("phone_norm")) | F.col("phone_norm").startswith(F.col("__q"))
    rows = q.join(index, "p8").where(hit)
    return rows.groupBy(*queries.columns, "permit").agg(F.max_by("name", "pos").alias("name"))


def unique_hits(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with exactly one permit, and that permit with its name."""
    return hits.groupBy(*keys).agg(F.min("permit").alias("a"), F.max("permit").alias("b"), F.min(F.struct("permit", "name")).alias("h")).where("a = b").select(*keys, "h.permit", "h.name")


def most_similar(queries: DataFrame, keys: DataFrame, query: str, least: float, shortest: int = SHORTEST) -> DataFrame:
    """(query, pos, ratio) of the key most similar to each distinct normalised query, the first of equals.

    ``keys`` is (pos, key) with distinct ``pos``.  An index finds the pairs that may reach the ratio; where
    it is so low that nearly all do, every query is compared with every key, block by block.
    """
    asked = queries.select(F.col(query).alias("query")).where(F.length("query") >= shortest).distinct()
    known = keys.select("pos", "key").where("key <> ''")
    if least < similarity.WORTH_INDEXING:
        return _most_similar_of_all(asked, known, least)
    best = similarity.most_similar(asked, known, "pos", least)
    return best.select("query", "pos", F.bround("ratio", 3).alias("ratio"))


def _most_similar_of_all(asked: DataFrame, known: DataFrame, least: float) -> DataFrame:
    """As ``most_similar``, by comparing all pairs.

    Both sides are dealt by hash into blocks of bounded size and each pair of blocks is one group; the
    best of a query's blocks is kept.  Only the two counts reach the driver, and no plan holds keys.
    """
    n_keys, n_asked = _blocks(known, BLOCK_KEYS), _blocks(asked, BLOCK_QUERIES)
    tasks = max(1, min(n_keys * n_asked, int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    known = known.select("pos", "key", _dealt("pos", n_keys).alias("b"), _all(n_asked).alias("c")).repartition(tasks, "b", "c")
    asked = asked.select("query", _all(n_keys).alias("b"), _dealt("query", n_asked).alias("c")).repartition(tasks, "b", "c")

    def best(keys: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        keys = keys.sort_values("pos")
        hits = best_keys(queries["query"], keys["key"].tolist(), least).assign(query=queries["query"].to_numpy(object))
        hits = hits[hits["place"] >= 0]
        hits = hits.assign(pos=keys["pos"].to_numpy()[hits["place"]])[["query", "pos", "exact", "ratio"]]
        return hits.astype({"query": object})  # an empty Arrow string column can't be sent back

    found = known.groupBy("b", "c").cogroup(asked.groupBy("b", "c")).applyInPandas(best, "query string, pos bigint, exact double, ratio double")
    one = found.groupBy("query").agg(F.max_by(F.struct("pos", "ratio"), F.struct("exact", -F.col("pos"))).alias("b"))
    return one.select("query", "b.pos", "b.ratio")


def _blocks(df: DataFrame, size: int) -> int:
    return max(1, -(-df.count() // size))


def _dealt(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n))


def _all(n: int) -> Column:
    """Every block's number, one row each."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))


def best_by_text(queries: DataFrame, registry: DataFrame, query: str, kind: str) -> DataFrame:
    """(query text, permit, name, ratio) by agency ``name`` or ``address``, if similar enough."""
    norm, least = (name_norm, NAME_MIN) if kind == "name" else (addr_norm, ADDRESS_MIN)
    keyed = queries.select(F.col(query).alias("text")).where(F.col(query) != "").distinct().withColumn("q", norm("text"))
    act = registry.where("active")
    keys = act.select("pos", norm(F.col(kind)).alias("key"))
    hit = most_similar(keyed, keys, "q", least)
    return keyed.join(hit, keyed["q"] == hit["query"]).join(act.select("pos", "permit", "name"), "pos").select(F.col("text").alias(query), "permit", "name", "ratio")


def stats(registry: DataFrame) -> DataFrame:
    """Rows in all, active rows, and rows by telephone note."""
    note = S.phone_note(F.col("phone"))
    return registry.groupBy(note.alias("phone_note")).agg(F.count("*").alias("n"), F.count_if("active").alias("n_active"))
