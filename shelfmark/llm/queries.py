"""The text operators' queries and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm.alignment import op12_token_alignment
from shelfmark.llm.bpe import op6_bpe_codec
from shelfmark.llm.decontamination import op1_benchmark_decontamination
from shelfmark.llm.line_dedup import op10_line_dedup
from shelfmark.llm.html_text import op5_html_extraction
from shelfmark.llm.near_dedup import op2_minhash_dedup
from shelfmark.llm.quality_rules import op3_quality_rules
from shelfmark.llm.quality_classifier import op8_quality_classifier
from shelfmark.llm.secrets import op4_secret_scan
from shelfmark.llm.token_counts import op9_token_counts
from shelfmark.llm.toxicity import op7_toxicity
from shelfmark.llm.vector_codes import codes_sql, op11_vector_codes
from shelfmark.llm.vector_search import SEARCH_SQL, op13_exact_top_k


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_benchmark_decontamination, op2_minhash_dedup, op3_quality_rules, op4_secret_scan, op5_html_extraction, op6_bpe_codec, op7_toxicity, op8_quality_classifier, op9_token_counts, op10_line_dedup, op11_vector_codes, op12_token_alignment, op13_exact_top_k)}


def oracle_sql() -> dict[str, str]:
    return {"op11_vector_codes": codes_sql(), "op13_exact_top_k": SEARCH_SQL}
