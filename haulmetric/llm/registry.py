"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from haulmetric.llm import (
    decontaminate,
    importance,
    line_dedup,
    mixing,
    ngram_join,
    prefix_trie,
    privacy,
    quality,
    sentence_spans,
    token_files,
    url_filter,
    vector_codes,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": quality.op1_quality_rules,
        "op2_personal_data": privacy.op2_personal_data,
        "op3_line_dedup": line_dedup.op3_line_dedup,
        "op4_warc": warc.op4_warc,
        "op5_substring_dedup": sentence_spans.op5_substring_dedup,
        "op6_mix_sources": mixing.op6_mix_sources,
        "op7_decontaminate": decontaminate.op7_decontaminate,
        "op8_quality_classifier": importance.op8_quality_classifier,
        "op9_token_files": token_files.op9_token_files,
        "op10_ngram_join": ngram_join.op10_ngram_join,
        "op11_vector_codes": vector_codes.op11_vector_codes,
        "op12_url_filter": url_filter.op12_url_filter,
        "op13_prefix_trie": prefix_trie.op13_prefix_trie,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    """Queries without SQL are compared with plain Python in tests/llm."""
    found = {
        "op1_quality_rules": quality.oracle_sql(),
        "op3_line_dedup": line_dedup.oracle_sql(),
        "op4_warc": warc.oracle_sql(),
        "op10_ngram_join": ngram_join.oracle_sql(),
        "op11_vector_codes": vector_codes.oracle_sql(),
        "op12_url_filter": url_filter.oracle_sql(),
        "op13_prefix_trie": prefix_trie.oracle_sql(),
    }
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
