"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabular_spark.llm import bpe, centroids, divergence, exact_dedup, fingerprints, html_wrappers, licenses, mixing, quality, secrets, sharding, similarity_join, token_files
from tabular_spark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": lambda spark, sf: similarity_join.op1(table(spark, sf, "documents")),
    "op2_sharding": lambda spark, sf: sharding.op2(table(spark, sf, "documents")),
    "op3_secrets": lambda spark, sf: secrets.op3(table(spark, sf, "documents")),
    "op4_html": lambda spark, sf: html_wrappers.op4(table(spark, sf, "pages")),
    "op5_bpe": lambda spark, sf: bpe.op5(table(spark, sf, "documents")),
    "op6_fingerprints": lambda spark, sf: fingerprints.op6(table(spark, sf, "documents")),
    "op7_licenses": lambda spark, sf: licenses.licenses(table(spark, sf, "documents")),
    "op8_exact_dedup": lambda spark, sf: exact_dedup.exact_dedup(table(spark, sf, "documents")),
    "op9_quality": lambda spark, sf: quality.op9(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op10_mixing": lambda spark, sf: mixing.op10(table(spark, sf, "documents")),
    "op11_token_files": lambda spark, sf: token_files.op11(table(spark, sf, "documents")),
    "op12_centroids": lambda spark, sf: centroids.op12(table(spark, sf, "embeddings")),
    "op13_divergence": lambda spark, sf: divergence.op13(table(spark, sf, "documents")),
}

ORACLES: dict[str, str] = {
    "op7_licenses": licenses.oracle(),
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op12_centroids": centroids.oracle(),
    "op13_divergence": divergence.ORACLE,
}
