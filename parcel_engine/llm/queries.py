"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel_engine.llm import anchors, hmm, jaccard, licenses, packing, periods, pfor, rules, styletree, tiling, warc, whitening, toxicity as toxic
from parcel_engine.llm.common import fold, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = rules.quality_rules(documents, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hmm.hmm_scores(documents, fold("doc_id", 5) == 1)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(documents, public_tokenizers.path("byte_bpe_50k.json"))


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pfor.round_trip(documents, public_tokenizers.path("word_bpe_49k.json"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_known", "sentence_ids", "license", "licenses")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tiling.find_leaks(documents, table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = documents.where(fold("doc_id", 3) != 1)
    model = toxic.train(learned, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    out = toxic.toxicity(documents, model)
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return styletree.main_text(table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.periodic_runs(table(spark, sf_dir, "documents"), alter=True)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_vectors(table(spark, sf_dir, "embeddings"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.simhash_components(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_hmm_scores, op3_warc, op4_best_fit_packing, op5_token_ids, op6_license_scan, op7_decontamination,
    op8_toxicity, op9_jaccard_join, op10_html_extraction, op11_periodic_runs, op12_whitening, op13_simhash,
)}


#: The same results as DuckDB SQL, where SQL can express them.
ORACLE = {
    "op3_warc": """
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
least AS (SELECT payload_digest, min(page_id) AS first_id FROM sized WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM sized LEFT JOIN least USING (payload_digest)
""",
    "op6_license_scan": licenses.oracle(),
}
