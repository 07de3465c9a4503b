"""Contract queries of the corpus operators: thin calls that derive the digest columns.

``SQL`` has the DuckDB twin where SQL can express a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_url_reputation(spark, sf_dir):
    from .url_reputation import judge_urls, page_outcomes
    return judge_urls(table(spark, sf_dir, "pages"), page_outcomes(table(spark, sf_dir, "labels"))).select(
        "page_id", "host", "path", "rule", "verdict")


def op2_best_fit_packing(spark, sf_dir):
    from .packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op3_token_counts(spark, sf_dir):
    from .token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_decontaminate(spark, sf_dir):
    from .decontaminate import contamination
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op5_sharding(spark, sf_dir):
    from .sharding import shard_plan
    return shard_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_simhash(spark, sf_dir):
    from .simhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_suffix_dedup(spark, sf_dir):
    from .suffix_dedup import repeat_report
    return repeat_report(table(spark, sf_dir, "documents"), length=100)


def op8_html_wrapper(spark, sf_dir):
    from .html_wrapper import extract
    return extract(table(spark, sf_dir, "pages"))


def op9_toxicity(spark, sf_dir):
    from .toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_nn_descent(spark, sf_dir):
    from .ann import nearest
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 50 = 0").select("vec_id"), k=5)


def op11_license_scan(spark, sf_dir):
    from .license_scan import scan_licenses
    return scan_licenses(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


def op12_heap_clusters(spark, sf_dir):
    from .heap_clusters import cluster_vectors
    return cluster_vectors(table(spark, sf_dir, "embeddings")).drop("centroid")


def op13_lexical_search(spark, sf_dir):
    from .lexical_search import ranked_search
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_url_reputation, op2_best_fit_packing, op3_token_counts, op4_decontaminate, op5_sharding, op6_simhash,
        op7_suffix_dedup, op8_html_wrapper, op9_toxicity, op10_nn_descent, op11_license_scan, op12_heap_clusters, op13_lexical_search)}


def oracle_sql() -> dict:
    from . import sql
    return dict(sql.ORACLES)
