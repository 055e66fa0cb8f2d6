"""Routing by merged states against the rules applied to a document's rows one by one, and a document of a million rows."""

import random
import re

from pyspark.sql import functions as F

from attestor.operators import routing
from attestor.schema import LARGE_NO_HIT, OK, PERMIT_PARTIAL, SCAN_RESULT, SMALL_NO_HIT, conform

COLUMNS = "source_docx string, image_name string, docx_class string, mol string, mol_conf double, mol_from_vote boolean, id string, id_conf double, id_from_vote boolean, final_value string, final_conf double, vision_review boolean, status string, ord int"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def number(name):
    m = re.search(r"\d+", name)
    return (0, int(m.group()), name) if m else (1, 0, name)


def plain(rows):
    """(image_name, value, conf, route) of one document's rows in order."""
    large = rows[0]["docx_class"] == "large"
    if all(r["status"] == (LARGE_NO_HIT if r["docx_class"] == "large" else SMALL_NO_HIT) for r in rows):
        return [("", "", 0.0, "manual_review")]
    valued = [r for r in rows if r["final_value"]]
    if not large:
        out = []
        for r in rows:
            if r["mol_from_vote"] and r["mol_conf"] > 50 and r["final_value"]:
                out.append((r["image_name"], r["final_value"], r["mol_conf"], "direct"))
            elif r["vision_review"]:
                out.append((r["image_name"], r["final_value"], r["final_conf"], "rescue" if not r["mol_from_vote"] and r["final_conf"] < 50 else "second_reader"))
        return out or [(r["image_name"], r["final_value"], r["final_conf"], "second_reader") for r in valued[:1]]
    mol, ids = [r for r in rows if r["mol"]], [r for r in rows if r["id"]]
    if mol and ids:
        common = {r["mol"] for r in mol} & {r["id"] for r in ids}
        if common:
            pool = [(r, r["mol"], r["mol_conf"]) for r in mol] + [(r, r["id"], r["id_conf"]) for r in ids]
            r, v, c = max((x for x in pool if x[1] in common), key=lambda x: x[2])
            return [(r["image_name"], v, c, "direct" if c > 55 else "second_reader")]
        r = min(ids, key=lambda r: number(r["image_name"]))
        return [(r["image_name"], r["id"], r["id_conf"], "second_reader")]
    votes = [r for r in ids if r["id_from_vote"] and r["id_conf"] > 45]
    if not mol and votes:
        r = min(votes, key=lambda r: number(r["image_name"]))
        return [(r["image_name"], r["id"], r["id_conf"], "direct")]
    partial = [r for r in rows if r["status"] == PERMIT_PARTIAL]
    out = []
    for r in partial:
        c = r["id_conf"] or r["final_conf"]
        out.append((r["image_name"], r["id"] or r["final_value"], c, "rescue" if c < 50 else "second_reader"))
    handled = {r["image_name"] for r in partial}
    out += [(r["image_name"], r["final_value"], r["final_conf"], "second_reader") for r in rows if r["vision_review"] and r["image_name"] not in handled]
    if not out and valued:
        r = max(valued, key=lambda r: r["final_conf"])
        out = [(r["image_name"], r["final_value"], r["final_conf"], "direct")]
    return out


def test_equal_to_the_rules_row_by_row(spark):
    rng = random.Random(6)
    docs = {}
    for d in range(400):
        kind, rows = rng.choice(("large", "large", "small")), []
        some = rng.sample(("mol", "id", "partial", "review", "value"), rng.randrange(5))
        for i in range(rng.randrange(1, 6)):
            has = lambda x: x in some and rng.random() < 0.6  # noqa: B023, E731
            conf = lambda: float(rng.choice((0, 44, 45, 46, 49, 50, 51, 55, 56, 90)))
            rows.append(dict(zip(NAMES, (
                f"d{d}", rng.choice(("image2.png", "image10.png", "front.png", f"image{i}.png")), kind, rng.choice("12") if has("mol") else "", conf(), rng.random() < 0.5, rng.choice("123") if has("id") else "", conf(), rng.random() < 0.5,
                rng.choice("12") if has("value") else "", conf(), has("review"), PERMIT_PARTIAL if has("partial") else rng.choice((OK, LARGE_NO_HIT if kind == "large" else SMALL_NO_HIT)), i,
            ), strict=True)))
        docs[f"d{d}"] = rows
    df = conform(spark.createDataFrame([tuple(r.values()) for rows in docs.values() for r in rows], COLUMNS).repartition(7), SCAN_RESULT + ", ord int")
    got = {}
    for r in routing.route(df).collect():
        got.setdefault(r["source_docx"], []).append((r["image_name"], r["candidate_value"], r["candidate_conf"], r["route"]))
    want = {d: plain(rows) for d, rows in docs.items()}
    assert {d: sorted(v) for d, v in got.items()} == {d: sorted(v) for d, v in want.items() if v}
    assert {x[3] for v in want.values() for x in v} == {"direct", "second_reader", "rescue", "manual_review"}


def test_a_document_of_a_million_rows(spark):
    n = 1_000_000
    ids = spark.range(n)
    rows = ids.select(
        F.lit("hot").alias("source_docx"), F.concat(F.lit("image"), "id", F.lit(".png")).alias("image_name"), F.lit("large").alias("docx_class"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).otherwise("").alias("mol"),
        F.when(F.col("id") % 2 == 1, (F.col("id") + F.when(F.col("id") == 777, 1).otherwise(2 * n)).cast("string")).otherwise("").alias("id"), F.lit(60.0).alias("mol_conf"), F.lit(70.0).alias("id_conf"), F.lit(OK).alias("status"), F.col("id").alias("ord"),
    )
    got = routing.route(conform(rows, SCAN_RESULT + ", ord bigint")).collect()
    assert [(r["image_name"], r["candidate_value"], r["candidate_conf"], r["route"]) for r in got] == [("image777.png", "778", 70.0, "direct")]
    review = rows.select(*(c for c in rows.columns if c not in ("mol", "id")), F.lit("").alias("mol"), F.lit("").alias("id"), F.lit(True).alias("vision_review"))
    assert routing.route(conform(review, SCAN_RESULT + ", ord bigint")).count() == n


def test_routes_shuffle_the_states_once_and_the_rows_once(spark):
    """What is left to do after the states: the rows' own items, for which only rows and ends move."""
    rows = spark.range(1000).selectExpr("cast(id % 100 as string) source_docx", "concat('image', id, '.png') image_name", "'large' docx_class", "'1234' mol", "20.0D mol_conf", "'1234' final_value", "20.0D final_conf", "true vision_review", "id ord")
    plan = routing.route(conform(rows, SCAN_RESULT + ", ord bigint"))._jdf.queryExecution().executedPlan().toString()
    assert 1 <= plan.count("Exchange hashpartitioning") <= 2
