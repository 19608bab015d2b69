"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from clickloom.llm import decontaminate, exact_substrings, language, licenses, line_dedup, mixing, near_dedup, prefix_trie, quality_rules, secrets, toxicity, url_filter, whitening
from clickloom.llm.text import documents

QUERIES = {
    "op1_suffix_array_dedup": lambda spark, d: exact_substrings.substrings_query(documents(spark, d)),
    "op2_license_scan": lambda spark, d: licenses.licenses_query(documents(spark, d)),
    "op3_near_dedup": lambda spark, d: near_dedup.near_query(documents(spark, d)),
    "op4_benchmark_decontamination": lambda spark, d: decontaminate.leaks_query(
        documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet")
    ),
    "op5_line_dedup": lambda spark, d: line_dedup.lines_query(documents(spark, d)),
    "op6_toxicity": lambda spark, d: toxicity.toxicity_query(
        documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")
    ),
    "op7_secrets": lambda spark, d: secrets.secrets_query(documents(spark, d)),
    "op8_quality_rules": lambda spark, d: quality_rules.quality_query(documents(spark, d)),
    "op9_language_id": lambda spark, d: language.language_query(documents(spark, d)),
    "op10_mixing": lambda spark, d: mixing.mix_query(documents(spark, d)),
    "op11_prefix_trie": lambda spark, d: prefix_trie.trie_query(spark.read.parquet(f"{d}/conversations.parquet")),
    "op12_url_filter": lambda spark, d: url_filter.urls_query(spark.read.parquet(f"{d}/pages.parquet")),
    "op13_whitening": lambda spark, d: whitening.whitening_query(spark.read.parquet(f"{d}/embeddings.parquet")),
}

SQL = {
    "op3_near_dedup": near_dedup.NEAR_SQL,
    "op4_benchmark_decontamination": decontaminate.LEAKS_SQL,
    "op8_quality_rules": quality_rules.QUALITY_SQL,
    "op10_mixing": mixing.MIX_SQL,
    "op11_prefix_trie": prefix_trie.TRIE_SQL,
    "op12_url_filter": url_filter.URLS_SQL,
}
