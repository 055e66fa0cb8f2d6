"""The registered queries of this subpackage: thin wrappers that derive digests from the operators."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> Path:
    import public_tokenizers

    return Path(public_tokenizers.path(name))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the best licence with its coefficient, and all that were found, for every document."""
    from attestor.llm import license_scan

    return license_scan.scan(_table(spark, sf_dir, "documents")).select("doc_id", "license", "dice", F.size("licenses").alias("n_licenses"), "licenses")


def op2_repair_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of what the files hold; null ids come first."""
    from attestor.llm import repair_output
    from attestor.llm.common import Scratch

    scratch = Scratch(spark)
    path = f"{scratch.root}/ids"
    repair_output.write(_table(spark, sf_dir, "documents"), path, _tokenizer("word_bpe_49k.json").read_text(encoding="utf-8"), end_id=2)
    out = repair_output.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return scratch.keep_for(out)


def _fold(column: str, folds: int) -> Column:
    """crc32 of a column as text, modulo the number of folds."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, base counts and digest, and all spans, for every document."""
    from attestor.llm import secret_scan

    out = secret_scan.scan(_table(spark, sf_dir, "documents"))

    def own(kinds: tuple[str, ...]) -> Column:
        return F.filter("findings", lambda f: f["kind"].isin(*kinds))

    def joined(findings: Column) -> Column:
        return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")

    counts = [F.size(own((k,))).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    digest = F.sha2(joined(own(("assign", "access", "hex"))).cast("binary"), 256).alias("base_sha256")
    return out.select("doc_id", *counts, digest, joined(F.col("findings")).alias("spans"))


#: Shingles of a table's texts: A-Z folded, words at white space, runs of five words or the whole of fewer.
_SHINGLES_SQL = """
  SELECT DISTINCT {id}, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
  FROM (SELECT {id}, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM {table} WHERE text IS NOT NULL)
"""


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, n_shared, n_item and containment of every item found in a document."""
    from attestor.llm import decontaminate

    out = decontaminate.flag(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.inline("leaks")).withColumn("containment", F.col("n_shared") / F.col("n_item"))


#: Exact containment of every item in every document that shares a shingle with it.
OP4_SQL = f"""
WITH d AS ({_SHINGLES_SQL.format(id="doc_id", table="documents")}),
b AS ({_SHINGLES_SQL.format(id="item_id", table="benchmark")}),
n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id),
c AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (shingle) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, CAST(n_shared AS DOUBLE) / n_item AS containment
FROM c JOIN n USING (item_id) WHERE 4 * n_shared >= 3 * n_item
"""


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 5 best of every query row."""
    from attestor.llm import exact_topk

    return exact_topk.search(_table(spark, sf_dir, "embeddings"), is_query=F.col("id") % 50 == 0)


OP5_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.q) = len(b.q)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, and whether the margin is too narrow; a null id is not held out."""
    from attestor.llm import language_id

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    dictionaries = language_id.learn(docs.where(_fold("doc_id", 4) != 2))
    return language_id.predict(docs, dictionaries, keep=("doc_id", held)).select("doc_id", "held_out", "lang_pred", "score", "margin", "rejected")


#: The key of the registered query; a user passes an own secret.
OP8_KEY = "a fixed key for the registered query"


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the whole text with surrogates, and the number of entities replaced in it."""
    from attestor.llm import pii_surrogates

    out = pii_surrogates.replace(_table(spark, sf_dir, "documents").select("doc_id", "text"), OP8_KEY)
    return out.select("doc_id", "text", F.col("n_entities").cast("long").alias("n_entities"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted; a null id is not held out and never learned."""
    from attestor.llm import toxicity

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, _table(spark, sf_dir, "labels"), allowed=_fold("doc_id", 5) != 0)
    held = F.coalesce(_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return toxicity.score(docs, model, keep=("doc_id", held)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the digest of the spans, for every document."""
    from attestor.llm import sentencepiece_codec

    out = sentencepiece_codec.encode_decode(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model").read_bytes())
    return out.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.crc32("spans").alias("spans_crc32"),
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    from attestor.llm import jaccard_join

    return jaccard_join.join(_table(spark, sf_dir, "documents"))


#: All pairs that share a shingle, then the closure of their links.
OP10_SQL = f"""
WITH RECURSIVE s AS MATERIALIZED ({_SHINGLES_SQL.format(id="doc_id", table="documents")}),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT a AS doc_id, coalesce(max(n), 0) AS n_shingles, min(b) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = a GROUP BY a
"""


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, main text and its length in code points, for every page."""
    from attestor.llm import html_extraction

    out = html_extraction.extract(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


#: The given pages: one ``article`` each, whose blocks begin and end at tags other than ``b``, with these references.
OP11_SQL = r"""
WITH a AS (
  SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '') AS body FROM pages
), t AS (
  SELECT page_id, url, regexp_replace(regexp_replace(body, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS marked FROM a
), d AS (
  SELECT page_id, url, regexp_replace(replace(replace(replace(replace(marked, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;?', '&', 'g') AS plain FROM t
), w AS (
  SELECT page_id, url, trim(regexp_replace(plain, '[\s\x{0B}\x{85}\p{Z}]+', ' ', 'g')) AS text FROM d
)
SELECT page_id, url, text, length(text) AS n_chars FROM w
"""


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of every conversation, after damage that a hash of each row decides."""
    from attestor.llm import conversation_repair

    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = rows.withColumn("damage", F.crc32(name.cast("binary")) % 20)
    damage = F.col("damage")
    damaged = rows.select(
        "conv_id", "turn", "damage",
        F.when(damage == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(damage == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return conversation_repair.audit(damaged, present=damage != 0)


#: The damage with CRC-32 by table, then the shortest path over rows and states (0 start, 1 after s, 2 after u, 3 after a).
#: A weight is its cost in twelve digits and the audit, so the least string is the least weight.
OP12_SQL = r"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i FROM range(256) t(i) UNION ALL SELECT i, k + 1, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END) FROM bits WHERE k < 8
), crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
raw AS (
  SELECT dense_rank() OVER (ORDER BY conv_id) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), hashed AS (
  SELECT raw.*, xor(list_reduce(list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(name[i]) AS BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS h FROM raw, crc
), damaged AS (
  SELECT c, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) copies
), ordered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
placed AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) AS nth FROM ordered),
r AS MATERIALIZED (
  SELECT *, role[1:1] AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN nth > 1 THEN 2 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault FROM placed
), moves(q, p, icost, ins) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 2, 2, 'I'), (1, 3, 4, 'II'), (2, 3, 2, 'I'), (3, 2, 2, 'I')),
edits(p, e, needs, nq, ecost) AS (VALUES (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (3, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0),
  (0, 'R', NULL, 2, 2), (1, 'R', NULL, 2, 2), (3, 'R', NULL, 2, 2), (2, 'R', NULL, 3, 2), (0, 'D', NULL, 0, 3), (1, 'D', NULL, 1, 3), (2, 'D', NULL, 2, 3), (3, 'D', NULL, 3, 3)),
steps AS MATERIALIZED (
  SELECT q, nq, ins || e AS es, e, needs, icost + ecost AS cost FROM moves JOIN edits USING (p)
), best(c, i, q, w) AS (
  SELECT DISTINCT c, CAST(0 AS BIGINT), 0, '000000000000' FROM raw
  UNION ALL
  SELECT b.c, b.i + 1, s.nq, min(printf('%012d', CAST(b.w[1:12] AS BIGINT) + s.cost + CASE WHEN r.fault = 3 AND s.e <> 'D' THEN 1 ELSE 0 END) || b.w[13:] || s.es)
  FROM best b JOIN r ON r.c = b.c AND r.i = b.i + 1
  JOIN steps s ON s.q = b.q AND (s.needs IS NULL OR s.needs = r.initial) AND (s.e = 'D' OR r.fault NOT IN (1, 2))
  GROUP BY b.c, b.i + 1, s.nq
), n AS (SELECT c, conv_id, (SELECT count(*) FROM r WHERE r.c = raw.c) AS n FROM raw GROUP BY c, conv_id),
done AS MATERIALIZED (
  SELECT n.c, min(printf('%012d', CAST(w[1:12] AS BIGINT) + cost) || w[13:] || es) AS w
  FROM n JOIN best b ON b.c = n.c AND b.i = n.n JOIN (VALUES (0, 0, ''), (1, 4, 'II'), (2, 2, 'I'), (3, 0, '')) l(q, cost, es) ON l.q = b.q GROUP BY n.c
), letters AS (
  SELECT c, p, w[12 + p] AS e, length(replace(w[13:], 'D', '')) AS m,
    length(replace(w[13:12 + p], 'I', '')) AS i, length(replace(w[13:12 + p], 'D', '')) AS place
  FROM done, range(1, length(w) - 11) t(p)
), repaired AS (
  SELECT l.c, string_agg(CASE WHEN l.e = 'K' THEN r.role WHEN (m - place) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN l.e = 'I' THEN '' ELSE r.text END, chr(10) ORDER BY p) AS t
  FROM letters l LEFT JOIN r ON r.c = l.c AND r.i = l.i WHERE l.e <> 'D' GROUP BY l.c
), pairs AS (SELECT c, lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair FROM r),
faults AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated FROM r GROUP BY c
)
SELECT n.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  (SELECT count(*) FROM pairs WHERE pairs.c = n.c AND pair NOT IN ('su', 'ua', 'au')) AS illegal,
  CAST(w[1:12] AS BIGINT) AS cost, w[13:] AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM n JOIN done USING (c) LEFT JOIN faults USING (c) LEFT JOIN repaired USING (c)
"""


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of the output and of the text rebuilt from it."""
    from attestor.llm import fill_middle

    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    out = fill_middle.transform(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(fill_middle.restored()).alias("restored_sha256"))


#: Lines as a list; prefix and middle are its first a and b elements.
OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines, sha256(concat('7:', doc_id)) AS h FROM documents
), c AS (
  SELECT *, len(lines) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(lines) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(lines) + 1) AS y,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
         WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d
), p AS (
  SELECT *, array_to_string(lines[1:least(x, y)], '') AS p, array_to_string(lines[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(lines[greatest(x, y) + 1:], '') AS s FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_repair_output": op2_repair_output,
        "op3_secret_scan": op3_secret_scan,
        "op4_decontaminate": op4_decontaminate,
        "op5_exact_topk": op5_exact_topk,
        "op6_language_id": op6_language_id,
        "op8_pii_surrogates": op8_pii_surrogates,
        "op9_toxicity": op9_toxicity,
        "op7_sentencepiece": op7_sentencepiece,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_html_extraction": op11_html_extraction,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_fill_middle": op13_fill_middle,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_decontaminate": OP4_SQL,
        "op5_exact_topk": OP5_SQL,
        "op10_jaccard_join": OP10_SQL,
        "op11_html_extraction": OP11_SQL,
        "op12_conversation_repair": OP12_SQL,
        "op13_fill_middle": OP13_SQL,
    }
