"""Queries of this subpackage and, where SQL can express them, their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prismarq.llm import compression_classifier, decontaminate, html_extract, lexical_search, mixing, near_dedup, near_dedup_sql, prefix_tree, quality_rules, sharding, substring_dedup, token_files, url_filter, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_compression_quality": compression_classifier.op1_compression_quality,
        "op2_pareto_mix": mixing.op2_pareto_mix,
        "op3_suffix_dedup": substring_dedup.op3_suffix_dedup,
        "op4_tree_scoring": html_extract.op4_tree_scoring,
        "op5_chosen_path": near_dedup.op5_chosen_path,
        "op6_token_files": token_files.op6_token_files,
        "op7_url_filter": url_filter.op7_url_filter,
        "op8_hypergeometric_shards": sharding.op8_hypergeometric_shards,
        "op9_host_rules": quality_rules.op9_host_rules,
        "op10_decontaminate": decontaminate.op10_decontaminate,
        "op11_wavelet_search": lexical_search.op11_wavelet_search,
        "op12_capture_index": warc.op12_capture_index,
        "op13_prefix_tree": prefix_tree.op13_prefix_tree,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_pareto_mix": mixing.ORACLE_SQL,
        "op5_chosen_path": near_dedup_sql.ORACLE_SQL,
        "op7_url_filter": url_filter.ORACLE_SQL,
        "op9_host_rules": quality_rules.ORACLE_SQL,
        "op10_decontaminate": decontaminate.ORACLE_SQL,
        "op11_wavelet_search": lexical_search.ORACLE_SQL,
        "op12_capture_index": warc.ORACLE_SQL,
        "op13_prefix_tree": prefix_tree.ORACLE_SQL,
    }
