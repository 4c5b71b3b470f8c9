"""Registered queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scarp.sources.tables import table

from . import (bpe, conversation_repair, damage, decontaminate, html_extract, licenses, near_dup, periodic_runs, pii, posting_ann,
               secret_scan, suffix_dedup, topk, toxicity)

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers     # where this module is missing, the other queries still work

    return public_tokenizers.path(TOKENIZER)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded and decoded with the public 50k byte-level vocabulary."""
    return bpe.encode_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text of ``documents``, learned from the labelled rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families of every text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.train(docs))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text of ``documents``; the source owns, its languages are its repositories."""
    repo = F.concat_ws("/", "source", "lang")
    return secret_scan.scan(table(spark, sf_dir, "documents"), repo, F.col("source"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item it contains (five-word shingles, containment 0.75)."""
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of ``documents`` (five-word shingles, Jaccard 0.75)."""
    return near_dup.near_groups(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 200-byte passages removed from every text of ``documents``."""
    return suffix_dedup.removal_digests(table(spark, sf_dir, "documents"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows of ``embeddings`` for every row whose id is divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by a labeller trained on a bounded sample of the pages."""
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit_on(pages))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``, and the terms that disclose it."""
    return pii.find(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every text of ``documents`` with planted repeats, and what is left without them."""
    found = periodic_runs.find_runs(damage.periodic_tails(table(spark, sf_dir, "documents")))
    # greatest length first, then smallest start, then period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    rows = found.select("*", best.alias("best"))
    period = -F.col("best.p")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.l").alias("length"),
        period.alias("period"), F.floor(F.lit(1000) * F.col("best.l") / period).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


def op12_posting_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest rows of ``embeddings`` found for every row whose id is divisible by 20."""
    return posting_ann.nearest(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation of ``conversations``, after planted damage."""
    rows = conversation_repair.conversation_rows(table(spark, sf_dir, "conversations"))
    audits, repaired = conversation_repair.repair(damage.damaged_rows(rows))
    key = F.struct("conv_id").alias("key")           # structs compare null ids as equal
    digests = conversation_repair.text_digests(repaired).select(key, "repaired_sha256")
    all_ids = rows.select("conv_id").distinct().select(key)
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (all_ids.join(audits.withColumn("key", F.struct("conv_id")).drop("conv_id"), "key", "left").join(digests, "key", "left")
            .select("key.conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_licenses": op3_licenses,
    "op4_secrets": op4_secrets,
    "op5_decontaminate": op5_decontaminate,
    "op6_near_dup": op6_near_dup,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_topk": op8_topk,
    "op9_html": op9_html,
    "op10_pii": op10_pii,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_posting_ann": op12_posting_ann,
    "op13_conversation_repair": op13_conversation_repair,
}

# words and five-word shingles of a text, as lists (ASCII letters lower-cased, ASCII white space between words)
_SHINGLES = """
  SELECT {id}, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh
  FROM (SELECT {id}, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
        FROM {table} WHERE {id} IS NOT NULL)
"""

ORACLE: dict[str, str] = {
    "op5_decontaminate": """
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS ws
  FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT 'i', item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')
  FROM benchmark WHERE item_id IS NOT NULL),
s AS (SELECT kind, id, list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS sh
      FROM w WHERE len(ws) >= 5),
e AS (SELECT kind, id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT d.id AS doc_id, i.id AS item_id, any_value(i.n) AS n_item, count(*) AS n_shared
      FROM e i JOIN e d ON i.g = d.g AND i.kind = 'i' AND d.kind = 'd' GROUP BY d.id, i.id)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment FROM p WHERE n_shared >= 0.75 * n_item
""",
    "op8_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(a.q::DOUBLE[], b.q::DOUBLE[]) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op6_near_dup": f"""
WITH RECURSIVE s AS ({_SHINGLES.format(id="doc_id", table="documents")}),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb
      FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p WHERE 100 * c >= 75 * (na + nb - c)),
k AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, k.b FROM r JOIN k ON r.other = k.a)
SELECT s.doc_id, len(s.sh) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
""",
}
